"""Benchmark decontamination by pigeonhole edit matching.

A document is contaminated by a test item if some run of its words turns into the item with at
most ``floor(BUDGET * words)`` word edits (insert, delete, change). Words are runs of letters and
digits in lower case; where a script is written without spaces (``UNSPACED``), each character is a
word. ASCII, full-width, CJK and general punctuation separates. With a budget of e, the item is cut into e + 1 pieces: e edits leave one of
them untouched, so every match holds a piece exactly. Pieces are found by rolling hashes over all
words of all documents; around each hit Myers' bit-parallel algorithm computes the distance, so a
hash never decides. Items of one to four words have no budget: they match as they are, in one piece.

Documents are read once for each block of test items and not shuffled. A block has ``ITEM_WORDS``
words at most (or one item) and goes to the executors with the task; a larger benchmark takes more
blocks, not more memory.

Defined cases: a null or empty text matches nothing; items without any word take no
part; a short item is found in every text that holds it, however common its words are; items that repeat word for word
are reported each; documents that repeat are matched each; null ids are kept as they are. Columns
of the documents pass through untouched, whatever their names; empty tables give no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from .common import BASE, Words, blocks, byte_values, in_arrow, mix, row_of, separators, ship, texts_of, words_of

BUDGET = 0.2
MIN_WORDS = 1
ITEM_WORDS = 500_000
# of RE2: characters that are words of their own, and marks beside the ASCII ones
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\x{3099}-\x{309C}\x{30FC}\x{FF70}]"
MARKS = (
    r"[\x{2000}-\x{200B}\x{2010}-\x{2029}\x{202F}-\x{205F}\x{3000}-\x{3004}\x{3008}-\x{3020}\x{3030}\x{303D}\x{30A0}\x{30FB}"
    r"\x{FE10}-\x{FE1F}\x{FE30}-\x{FE6B}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}]"
)
HIT = "item_id long, distance int, words int, begin long, end long"


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts in lower case, with spaces around unspaced characters."""
    lower = pc.utf8_lower(pc.fill_null(column, ""))
    data, offsets = texts_of(lower)
    if not (data >= 0xE0).any():  # no character from U+0800 on
        return data, offsets
    spaced = pc.replace_substring_regex(pc.replace_substring_regex(lower, MARKS, " "), UNSPACED, r" \0 ")
    return texts_of(spaced)


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return words_of(data, offsets, separators("punctuation"), byte_values(lower=False, seed=31))


class Pattern:
    """Myers' algorithm for one item; words are hashes, the item a vector of bits."""

    def __init__(self, words: list[int]):
        self.n = len(words)
        self.full, self.high = (1 << self.n) - 1, 1 << (self.n - 1)
        self.forward, self.backward = defaultdict(int), defaultdict(int)
        for i, w in enumerate(words):
            self.forward[w] |= 1 << i
            self.backward[w] |= 1 << (self.n - 1 - i)

    def _scan(self, peq: dict, text: list[int], anchored: bool) -> Iterator[int]:
        """Distance after each word: of the item and some run ending there; anchored: the run
        that begins at the first word."""
        up, down, score, full = self.full, 0, self.n, self.full
        for w in text:
            eq = peq.get(w, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            plus = (down | ~(xh | up)) & full
            minus = up & xh & full
            if plus & self.high:
                score += 1
            elif minus & self.high:
                score -= 1
            plus = (plus << 1 | anchored) & full
            minus = (minus << 1) & full
            up = (minus | ~(xv | plus)) & full
            down = plus & xv
            yield score

    def best(self, text: list[int]) -> tuple[int, int, int]:
        """(distance, begin, end) of the closest run of ``text``; the first end of several."""
        least, end = self.n, 0
        for at, score in enumerate(self._scan(self.forward, text, False), 1):
            if score < least:
                least, end = score, at
        begin = end
        for at, score in enumerate(self._scan(self.backward, text[end - 1 :: -1] if end else [], True), 1):
            if score == least:
                begin = end - at
                break
        return least, begin, end


class Items:
    """Pieces of a block of items by length and hash."""

    def __init__(self, rows: list[tuple]):
        self.ids, self.words, self.budget, self.patterns = [], [], [], []
        pieces = defaultdict(lambda: defaultdict(list))
        data, offsets = tokens(pa.array([t for _, t in rows], pa.string()))
        with np.errstate(over="ignore"):
            found = _words(data, offsets)
            for (item, _), a, b in zip(rows, found.first, found.first[1:]):
                n = int(b - a)
                if n < MIN_WORDS:
                    continue
                k, budget = len(self.ids), int(BUDGET * n + 1e-9)
                own = found.hash[a:b]
                self.ids.append(item)
                self.words.append(n)
                self.budget.append(budget)
                self.patterns.append(own.tolist())
                cuts = [i * n // (budget + 1) for i in range(budget + 2)]
                for low, high in zip(cuts, cuts[1:]):
                    total = np.zeros(1, np.uint64)
                    for h in own[low:high]:
                        total = total * np.uint64(BASE) + h
                    pieces[high - low][int(mix(total)[0])].append((k, low))
        self.pieces = {}
        for size, by_hash in pieces.items():
            hashes = np.array(sorted(by_hash), np.uint64)
            maybe = np.zeros(1 << 20, bool)
            maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True
            once = np.array([all(self.budget[k] == 0 for k, _ in by_hash[h]) for h in hashes.tolist()])
            self.pieces[size] = (hashes, maybe, dict(by_hash), once)
        self.longest = max(self.pieces, default=0)

    def hits(self, found: Words) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """(row, item) -> windows of words that may hold the item."""
        out, total = defaultdict(list), len(found.hash)
        if not total:
            return out
        row_end = np.repeat(found.first[1:], np.diff(found.first))
        running = np.zeros(total, np.uint64)
        for size in range(1, self.longest + 1):
            if total < size:
                break
            running = running[: total - size + 1] * np.uint64(BASE) + found.hash[size - 1 :]
            if size not in self.pieces:
                continue
            hashes, maybe, by_hash, once = self.pieces[size]
            gram = mix(running)
            at = np.flatnonzero(maybe[(gram >> np.uint64(44)).astype(np.int64)])
            at = at[at + size <= row_end[at]]
            place = np.minimum(np.searchsorted(hashes, gram[at]), len(hashes) - 1)
            same = hashes[place] == gram[at]
            at, place = at[same], place[same]
            row = row_of(found.first, at)
            # of whole items without a budget the first place in a row will do
            wanted = ~once[place]
            wanted[np.unique(row * len(hashes) + place, return_index=True)[1]] = True
            for p, r in zip(at[wanted].tolist(), row[wanted].tolist()):
                for k, low in by_hash[int(gram[p])]:
                    e = self.budget[k]
                    begin = max(int(found.first[r]), p - low - e)
                    out[r, k].append((begin, min(int(found.first[r + 1]), p - low + self.words[k] + e)))
        return out

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
        """For each row, the items it holds: the closest run of each."""
        found = _words(data, offsets)
        out = [[] for _ in range(len(offsets) - 1)]
        for (r, k), windows in sorted(self.hits(found).items()):
            if isinstance(self.patterns[k], list):
                self.patterns[k] = Pattern(self.patterns[k])
            best, base = None, int(found.first[r])
            for low, high in _merged(windows):
                distance, begin, end = self.patterns[k].best(found.hash[low:high].tolist())
                if distance <= self.budget[k] and (best is None or distance < best["distance"]):
                    best = {"item_id": self.ids[k], "distance": distance, "words": self.words[k], "begin": low - base + begin, "end": low - base + end}
            if best:
                out[r].append(best)
        return out


def _merged(windows: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    windows = sorted(windows)
    low, high = windows[0]
    for a, b in windows[1:]:
        if a > high:
            yield low, high
            low, high = a, b
        high = max(high, b)
    yield low, high


def item_blocks(items: DataFrame, words: int = ITEM_WORDS) -> Iterator[list[tuple]]:
    """(item_id, text) in blocks of about ``words`` words; each is bounded, whatever the table."""
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    # a character of three bytes may be a word of its own
    unspaced = F.floor((F.octet_length("text") - F.length("text")) / 2)
    total = texts.agg(F.sum(F.size(F.split("text", r"\s+")) + unspaced)).first()[0] or 0
    parts = -(-total // words)
    for part in range(parts):
        chosen = texts.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        if rows := [(r.item_id, r.text) for r in chosen.collect()]:
            yield sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def match_block(docs: DataFrame, rows: list[tuple]) -> DataFrame:
    """(row, hits): all columns of each document as one, and the items of the block it holds."""
    hit = T._parse_datatype_string(HIT)
    packed = docs.select(F.col("text").cast("string").alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    schema = T.StructType([packed.schema["row"], T.StructField("hits", T.ArrayType(hit))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(rows)
        kind = pa.list_(pa.struct([
            ("item_id", pa.int64()), ("distance", pa.int32()), ("words", pa.int32()), ("begin", pa.int64()), ("end", pa.int64()),
        ]))
        for batch in batches:
            data, offsets = tokens(batch.column(0))
            hits = []
            with np.errstate(over="ignore"):
                for low, high in blocks(offsets):
                    cut = offsets[low : high + 1]
                    hits += items.matches(data[cut[0] : cut[-1]], cut - cut[0])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(hits, kind)], ["row", "hits"])

    return packed.transform(in_arrow, run, schema)


def find_contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, words, begin, end): the closest run of each item in each
    contaminated document; ``words`` are the item's, begin and end count the document's."""
    ship(docs.sparkSession)
    found = None
    for rows in item_blocks(items):
        one = match_block(docs.select("doc_id", "text"), rows).select(F.col("row.doc_id").cast("long").alias("doc_id"), F.inline("hits"))
        found = one if found is None else found.unionByName(one)
    return found if found is not None else docs.sparkSession.createDataFrame([], f"doc_id long, {HIT}")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold no test item, with all their columns."""
    ship(docs.sparkSession)
    for rows in item_blocks(items):
        docs = match_block(docs, rows).filter(F.size("hits") == 0).select("row.*")
    return docs
