"""Language ID: script ranges narrow the candidates, Viterbi labels spans.

Each word has a score for each language: the log of its relative frequency there, or for words not
seen in training the mean of its beginning and its ending. Words written in a script that a
language hardly uses speak against it. The best path through the words, where every change of
language costs ``SWITCH``, labels spans of mixed-language text; the language of a text is the one
that most of its letters are labelled with, the score that part of its letters.

The word scores are learned from a bounded sample of ``TRAIN_ROWS`` labelled texts in one task and
hold ``ENTRIES`` words and word parts at most; they go to the executors with the task. Every whole
text is labelled in one pass without a shuffle; all texts of a block take each step of the path
together.

Defined cases: a null text or one without letters is ``und`` with score 0 and no spans; a text of
unknown words takes the most frequent language; a null language teaches nothing; without any
labelled text everything is ``und``; ties go to the first language in code point order; rows that
repeat an id are labelled each. Other columns are never read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import BASE, Words, blocks, byte_values, in_arrow, mix, row_of, separators, ship, texts_of, words_of
from .learning import held_out

TRAIN_ROWS = 6_000
ENTRIES = 200_000
MIN_COUNT = 3
SWITCH = 12.0
LOWEST = -4.0  # of a word's score below its best language
FOREIGN_SCRIPT = -8.0
SCRIPT_SHARE = 0.01  # of a language's letters in a script, from which on it uses the script
UND = "und"
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 4096
# fixed values: first code point of each range and its script (0: none, marks and symbols)
SCRIPTS = ("none", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "georgian", "hangul", "kana", "han", "other")
RANGES = (
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00AA, 1), (0x00AB, 0), (0x00B5, 1), (0x00B6, 0),
    (0x00BA, 1), (0x00BB, 0), (0x00C0, 1), (0x00D7, 0), (0x00D8, 1), (0x00F7, 0), (0x00F8, 1), (0x02B0, 0), (0x0370, 2),
    (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0780, 13), (0x0900, 7), (0x0E00, 8), (0x0E80, 13), (0x10A0, 9),
    (0x1100, 10), (0x1200, 13), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x2C00, 13), (0x3000, 0), (0x3040, 11), (0x3100, 13),
    (0x3400, 12), (0xA000, 13), (0xAC00, 10), (0xD7B0, 13), (0xF900, 12), (0xFB00, 13), (0xFF00, 0), (0xFF66, 11), (0xFFA0, 10),
    (0xFFE0, 0), (0x10000, 13), (0x1F000, 0), (0x20000, 12), (0x30000, 13),
)
_STARTS, _SCRIPT = np.array([a for a, _ in RANGES]), np.array([b for _, b in RANGES], np.uint8)
SCHEMA = "doc_id long, lang_pred string, score double, spans array<struct<begin: long, end: long, lang: string>>"


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return words_of(data, offsets, separators("punctuation"), byte_values(lower=True))


def word_scripts(data: np.ndarray, found: Words) -> np.ndarray:
    """Script of each word: the last in the list that one of its letters has; 0 without letters."""
    out = np.zeros(len(found.start), np.uint8)
    if not len(out):
        return out
    script = np.zeros(len(data), np.uint8)
    ascii_letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
    script[ascii_letter] = 1
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 0x3F for k in (1, 2, 3)]
        first = data[lead].astype(np.int64)
        point = np.where(
            first < 0xE0, (first & 0x1F) << 6 | b[0],
            np.where(first < 0xF0, (first & 0x0F) << 12 | b[0] << 6 | b[1], (first & 0x07) << 18 | b[0] << 12 | b[1] << 6 | b[2]),
        )
        script[lead] = _SCRIPT[np.searchsorted(_STARTS, point, "right") - 1]
    edges = np.empty(2 * len(out), np.int64)
    edges[0::2], edges[1::2] = found.start, found.end
    if edges[-1] == len(data):
        edges = edges[:-1]
    return np.maximum.reduceat(script, edges)[0::2]


def _parts(data: np.ndarray, found: Words) -> list[np.ndarray]:
    """Hashes of the first four bytes and of the last three of each word, A-Z as a-z."""
    values, out = byte_values(lower=True, seed=23), []
    for size, at in ((4, lambda k: found.start + k), (3, lambda k: found.end - 1 - k)):
        running = np.full(len(found.start), size, np.uint64)
        for k in range(size):
            place = at(k)
            inside = (place >= found.start) & (place < found.end)
            running = running * np.uint64(BASE) + np.where(inside, values[data[np.where(inside, place, 0)]], np.uint64(0))
        out.append(mix(running))
    return out


class Model:
    def __init__(self, langs: list[str], hashes: np.ndarray, scores: np.ndarray, scripts: np.ndarray, prior: np.ndarray):
        self.langs, self.hashes, self.scores, self.scripts, self.prior = langs, hashes, scores, scripts, prior

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 if unknown."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)

    def emissions(self, data: np.ndarray, found: Words, script: np.ndarray) -> np.ndarray:
        """Scores of each word; 0 for words without letters."""
        out = np.zeros((len(found.hash), len(self.langs)), np.float32)
        if not len(self.hashes):
            return out
        row = self.find(found.hash)
        known = row >= 0
        out[known] = self.scores[row[known]]
        rest = np.flatnonzero(~known & (script > 0))
        if len(rest):
            part = Words(found.hash[rest], found.start[rest], found.end[rest], found.first)
            total, n = np.zeros((len(rest), len(self.langs)), np.float32), np.zeros(len(rest), np.float32)
            for h in _parts(data, part):
                row = self.find(h)
                hit = row >= 0
                total[hit] += self.scores[row[hit]]
                n += hit
            out[rest] = total / np.maximum(n, 1)[:, None]
        # a script that some language uses speaks against those that don't
        uses = self.scripts[:, script].T
        out[~uses & uses.any(1)[:, None]] += FOREIGN_SCRIPT
        out[script == 0] = 0
        return out


def learn(langs: list[str], texts: list[str]) -> bytes:
    names = sorted(set(langs))
    code = {lang: i for i, lang in enumerate(names)}
    keys, codes, letters = [], [], np.zeros((len(names), len(SCRIPTS)))
    column = pa.array(texts, pa.string())
    data, offsets = texts_of(column)
    own = np.array([code[lang] for lang in langs])
    with np.errstate(over="ignore"):
        for low, high in blocks(offsets):
            cut = offsets[low : high + 1]
            part = data[cut[0] : cut[-1]]
            found = _words(part, cut - cut[0])
            script = word_scripts(part, found)
            lang = own[low:high][row_of(found.first, np.arange(len(found.hash)))]
            np.add.at(letters, (lang, script), found.end - found.start)
            real = script > 0
            for h in (found.hash, *_parts(part, found)):
                keys.append(h[real])
                codes.append(lang[real])
    if not keys or not names:
        return pickle.dumps(None)
    hashes, inverse, total = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    counts = np.bincount(inverse * len(names) + np.concatenate(codes), minlength=len(hashes) * len(names)).reshape(-1, len(names))
    kept = np.flatnonzero(total >= MIN_COUNT)
    if len(kept) > ENTRIES:
        kept = np.sort(kept[np.argsort(-total[kept], kind="stable")[:ENTRIES]])
    size = np.maximum(counts.sum(0), 1)
    chance = (counts[kept] + 0.5) / size
    score = np.maximum(np.log(chance) - np.log(chance).max(1, keepdims=True), LOWEST) if len(kept) else np.zeros((0, len(names)))
    letters[:, 0] = 0
    scripts = letters >= SCRIPT_SHARE * np.maximum(letters.sum(1, keepdims=True), 1)
    prior = np.log((np.bincount(own, minlength=len(names)) + 1) / (len(own) + len(names)))
    return pickle.dumps((names, hashes[kept], score.astype(np.float32), scripts, prior))


def viterbi(emission: np.ndarray, first: np.ndarray, prior: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of each word; row i has the words first[i]:first[i + 1].

    Rows advance together, longest first; a step is a few operations on all rows still open.
    """
    n, langs = emission.shape
    stay, best = np.ones((n, langs), bool), np.zeros(n, np.int32)
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    start, length = first[:-1][order], length[order]
    steps = int(length[0]) if len(length) else 0
    open_ = np.searchsorted(-length, -np.arange(steps), "left")  # rows longer than t
    value = np.tile(prior.astype(np.float64), (len(order), 1))
    for t in range(steps):
        k = open_[t]
        at = start[:k] + t
        v = value[:k]
        if t:
            top = v.argmax(1)
            jump = v[np.arange(k), top][:, None] - switch
            keep = v >= jump
            stay[at], best[at] = keep, top
            v = np.where(keep, v, jump)
        value[:k] = v + emission[at]
    path = np.zeros(n, np.int32)
    state = value.argmax(1).astype(np.int32)
    for t in range(steps - 1, -1, -1):
        k = open_[t]
        at = start[:k] + t
        now = state[:k]
        path[at] = now
        state[:k] = np.where(stay[at, now], now, best[at])
    return path


def _has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode())


def label_block(model: Model | None, data: np.ndarray, offsets: np.ndarray) -> tuple[list, list, list]:
    """(language, score, spans) of each row."""
    rows = len(offsets) - 1
    langs, scores, spans = [UND] * rows, [0.0] * rows, [[] for _ in range(rows)]
    if model is None:
        return langs, scores, spans
    found = _words(data, offsets)
    script = word_scripts(data, found)
    real = script > 0
    keep = np.flatnonzero(real)
    first = np.searchsorted(keep, found.first)
    found = Words(found.hash[keep], found.start[keep], found.end[keep], first)
    path = viterbi(model.emissions(data, found, script[keep]), first, model.prior)
    row = np.repeat(np.arange(rows), np.diff(first))
    n = len(model.langs)
    weight = np.bincount(row * n + path, (found.end - found.start).astype(float), rows * n).reshape(rows, n)
    total = weight.sum(1)
    ascii_letter = np.concatenate([[0], np.cumsum(((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A))])
    plain = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    new = np.ones(len(path), bool)
    new[1:] = (path[1:] != path[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    for a, b in zip(begin.tolist(), np.append(begin[1:], len(path)).tolist()):
        r = int(row[a])
        spans[r].append({"begin": int(found.start[a] - offsets[r]), "end": int(found.end[b - 1] - offsets[r]), "lang": model.langs[path[a]]})
    for r in np.flatnonzero((total > 0) | (np.diff(offsets) > 0)).tolist():
        if plain[r] or _has_letter(data[offsets[r] : offsets[r + 1]].tobytes()):
            top = int(weight[r].argmax()) if total[r] else int(model.prior.argmax())
            langs[r], scores[r] = model.langs[top], float(weight[r, top] / total[r]) if total[r] else 0.0
        else:
            spans[r] = []
    return langs, scores, spans


def fit_language(docs: DataFrame, rows: int = TRAIN_ROWS) -> bytes:
    """Learn from the non-null languages of rows outside the held-out fold."""
    ship(docs.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    good = docs.select(key.alias("_key"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    good = good.filter(F.col("lang").isNotNull() & ~held_out(F.col("_key")))
    total = good.count()
    share = min(1_000_000, 1_000_000 * rows // max(total, 1) + 1)
    chosen = good.filter(F.pmod(F.xxhash64("_key"), F.lit(1_000_000)) < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(k, lang, text or "") for b in batches for k, lang, text in zip(*[c.to_pylist() for c in b.columns])]
        seen.sort()
        yield pa.RecordBatch.from_pydict({"model": pa.array([learn([s[1] for s in seen], [s[2] for s in seen])], pa.binary())})

    made = chosen.select("_key", "lang", "text").repartition(1).transform(in_arrow, run, "model binary").collect()
    return made[0].model if made else pickle.dumps(None)


def label_languages(docs: DataFrame, packed: bytes) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans) of every row; spans in bytes of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pickle.loads(packed)
        model = Model(*held) if held else None
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            with np.errstate(over="ignore"):
                for low, high in blocks(offsets, BLOCK_BYTES, BLOCK_ROWS):
                    cut = offsets[low : high + 1]
                    langs, scores, spans = label_block(model, data[cut[0] : cut[-1]], cut - cut[0])
                    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(low, high - low), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, span),
                    ], ["doc_id", "lang_pred", "score", "spans"])

    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labelled = texts.transform(in_arrow, run, SCHEMA)
    return labelled.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans")
