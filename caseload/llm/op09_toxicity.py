"""Toxicity: a counterfactual-regularised linear classifier.

Logistic regression on word and word-pair indicators of labelled texts. For every text that names
a group, the group term is swapped for the others of its kind, and the squared change of the score
is added to the loss: a model that leans on the mention of a group pays for it, so neutral
mentions do not raise the score.

Labels are learned from a bounded sample of ``TRAIN_ROWS`` labelled rows in one task; the
vocabulary holds features of ``MIN_TEXTS`` texts or more that tell the labels apart, so its size
is bounded too and goes to the executors with the task. Every whole text is scored in one pass without a shuffle.

Defined cases: a null or empty text has the score of no evidence; ids and labels that are null
teach nothing; without labels of both kinds every text scores the share of the kind there is, 0
if there are no labels; rows that repeat an id are scored each. Other columns are never read.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import BASE, Words, byte_values, mix, row_of, separators, words_of
from .learning import TRAIN_ROWS, Vocabulary, below, fit, labelled, score, sigmoid

THRESHOLD = 0.5
MIN_TEXTS = 4
Z = 4.0
STEMS = (4, 5, 6)
RIDGE = 1e-3
SWAP_WEIGHT = 1.0
STEPS = 600
# fixed values: group terms by kind; a term is swapped for the others of its kind
GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("blind", "deaf", "disabled"), ("old", "young"),
    ("immigrants", "refugees", "foreigners", "natives"),
)


def _hashes(data: np.ndarray, offsets: np.ndarray):
    return words_of(data, offsets, separators("punctuation"), byte_values(lower=True))


def term_hash(term: str) -> np.uint64:
    raw = np.frombuffer(term.encode(), np.uint8)
    return _hashes(raw, np.array([0, len(raw)])).hash[0]


def _pairs(hash_: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of adjacent words."""
    if len(hash_) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row = row_of(first, np.arange(len(hash_)))
    same = np.flatnonzero(row[1:] == row[:-1])
    return mix(hash_[same] * np.uint64(BASE) + hash_[same + 1]), row[same]


def _stems(data: np.ndarray, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash and word index of the first ``STEMS`` bytes of longer words: inflected forms meet."""
    values, out, at = byte_values(lower=True, seed=11), [], []
    running = np.zeros(len(found.start), np.uint64)
    length = found.end - found.start
    for k in range(max(STEMS)):
        long = length > k
        running = running * np.uint64(BASE) + np.where(long, values[data[np.where(long, found.start + k, 0)]], np.uint64(0))
        if k + 1 in STEMS:
            rest = np.flatnonzero(length > k + 1)
            out.append(mix(running[rest] + np.uint64(k + 1)))
            at.append(rest)
    return np.concatenate(out), np.concatenate(at)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, stems and adjacent pairs; A-Z as a-z, punctuation ends a word."""
    found = _hashes(data, offsets)
    if not len(found.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pair, pair_row = _pairs(found.hash, found.first)
    stem, at = _stems(data, found)
    row = row_of(found.first, np.arange(len(found.hash)))
    return np.concatenate([row, row[at], pair_row]), np.concatenate([found.hash, stem, pair])


def telling(rows: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """Features of ``MIN_TEXTS`` texts or more whose share of label 1 differs from the share of
    all texts by ``Z`` standard deviations or more."""
    hashes, inverse, n = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    ones = np.bincount(inverse, np.repeat(label, [len(r) for r in rows]), len(hashes))
    share = label.mean()
    z = (ones - n * share) / np.sqrt(n * share * (1 - share))
    return hashes[(n >= MIN_TEXTS) & (np.abs(z) >= Z)]


def swaps(text: str) -> list[np.ndarray]:
    """Features of the text with each group term changed to the n-th other of its kind."""
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8)
    found = _hashes(raw, np.array([0, len(raw)]))
    place = {term_hash(t): (kind, n) for kind in GROUPS for n, t in enumerate(kind)}
    at = np.flatnonzero(np.isin(found.hash, np.array(list(place), np.uint64)))
    named = [(found.start[i], found.end[i], *place[found.hash[i]]) for i in at]
    out = []
    for shift in range(1, max((len(kind) for *_, kind, _ in named), default=0)):
        parts, last = [], 0
        for start, end, kind, n in named:
            parts += [data[last:start], kind[(n + shift) % len(kind)].encode()]
            last = end
        changed = np.frombuffer(b"".join([*parts, data[last:]]), np.uint8)
        out.append(np.unique(features(changed, np.array([0, len(changed)]))[1]))
    return out


def _csr(rows: list[np.ndarray], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return vocabulary.columns(np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows))


def learn(rows: list[np.ndarray], label: np.ndarray, texts: list[str]) -> bytes:
    """Fit on rows of distinct features; ``texts`` are swapped where they name a group."""
    if len(label) == 0 or label.min() == label.max():
        base = float(label.mean()) if len(label) else 0.0
        return pickle.dumps({"vocabulary": np.zeros(0, np.uint64), "weights": np.zeros(0), "bias": None, "base": base})
    kept = telling(rows, label)
    names = np.array([term_hash(t) for kind in GROUPS for t in kind], np.uint64)
    with np.errstate(over="ignore"):
        base_rows, other = [], []
        for i, text in enumerate(texts):
            if np.isin(rows[i], names).any():
                changed = swaps(text)
                base_rows += [rows[i]] * len(changed)
                other += changed
    vocabulary = Vocabulary(kept)
    size = len(kept)
    r, c = _csr(rows, vocabulary)
    br, bc = _csr(base_rows, vocabulary)
    cr, cc = _csr(other, vocabulary)
    w, b, m, v = np.zeros(size), float(np.log(label.mean() / (1 - label.mean()))), np.zeros(size + 1), np.zeros(size + 1)
    count, swapped = len(rows), max(len(other), 1)
    for step in range(1, STEPS + 1):
        p = sigmoid(np.bincount(r, w[c], count) + b)
        error = (p - label) / count
        grad = np.bincount(c, error[r], size) + RIDGE / count * w * 10
        if len(other):
            change = np.bincount(br, w[bc], len(other)) - np.bincount(cr, w[cc], len(other))
            scaled = 2 * SWAP_WEIGHT * change / swapped
            grad += np.bincount(bc, scaled[br], size) - np.bincount(cc, scaled[cr], size)
        full = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * full, 0.99 * v + 0.01 * full * full
        move = 0.1 / (1 + step / 100) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return pickle.dumps({"vocabulary": vocabulary.hashes, "weights": w, "bias": b, "base": 0.0})


def scorer(packed: bytes):
    model = pickle.loads(packed)

    def run(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if model["bias"] is None:
            return np.full(n, model["base"])
        row, column = _lookup(model).columns(*features(data, offsets))
        return sigmoid(np.bincount(row, model["weights"][column], n) + model["bias"])

    return run


def _lookup(model: dict) -> Vocabulary:
    if "lookup" not in model:
        model["lookup"] = Vocabulary(model["vocabulary"])
    return model["lookup"]


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> bytes:
    return fit(labelled(docs, labels, "toxic", rows), learn, features)


def score_toxicity(docs: DataFrame, model: bytes, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of (doc_id, text)."""
    return score(docs, scorer(model)).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def drop_toxic(docs: DataFrame, model: bytes, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that score below the threshold, with all their columns."""
    return below(docs, scorer(model), threshold)
