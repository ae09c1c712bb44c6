"""Quality classifier: naive Bayes support vectors.

Indicators of n-grams (words, adjacent pairs of word forms, word endings, form of the text in
bands) are scaled by the log ratio of their frequency in the two classes; a linear hinge-loss
model is fitted on the scaled, unit-length vectors by dual coordinate descent; margins become
chances by a sigmoid fitted on texts the margin model has not seen.

Labels are learned from a bounded sample of ``TRAIN_ROWS`` labelled rows in one task. The model
has one weight for each feature of ``MIN_TEXTS`` sample texts or more and goes to the executors
with the task. Every whole text is scored in one pass without a shuffle.

Defined cases: a null or empty text is scored by its (empty) form; ids and labels that are null
teach nothing; without labels of both kinds every text scores the share of the kind there is, 0 if
there are no labels; rows that repeat an id are scored each. Other columns are never read.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import BASE, byte_values, mix, random_table, row_of, separators, words_of
from .learning import TRAIN_ROWS, Vocabulary, fit, labelled, platt, score, sigmoid

THRESHOLD = 0.3
MIN_TEXTS = 4
COST = 1.0  # of a violated margin
ROUNDS = 12
TEST_SHARE = 4  # one text of so many is kept for the sigmoid
SMOOTH = 1.0
BANDS = np.array([0.0, 0.002, 0.01, 0.03, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98])
LENGTHS = np.array([0, 1, 5, 10, 20, 40, 80, 160, 320, 1000, 4000])
# classes of bytes: lower, upper, digit, full stop, comma, other punctuation each its own, rest
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 1, 2, 3, 1
for _n, _b in enumerate(b".,!?;:|#$%&*@=/_-()[]{}<>\"'"):
    _CLASS[_b] = 4 + _n


def _runs(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct values and of values in each row, for ``row`` ascending."""
    n = int(row[-1]) + 1 if len(row) else 0
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return np.bincount(r[new], minlength=n), np.bincount(r, minlength=n)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = len(offsets) - 1
    found = words_of(data, offsets, separators("space"), byte_values(lower=False))
    salt = random_table(99, 64)
    out_row, out = [], []

    def add(kind: int, row: np.ndarray, value: np.ndarray) -> None:
        out_row.append(row)
        out.append(mix(value.astype(np.uint64) * np.uint64(BASE) + salt[kind]))

    def band(kind: int, part: np.ndarray) -> None:
        """The band a share falls into, for each row."""
        add(kind, np.arange(rows), np.searchsorted(BANDS, part, "right"))

    count = np.diff(found.first)
    whole = np.maximum(count, 1)
    add(0, np.arange(rows), np.searchsorted(LENGTHS, count, "right"))
    if not len(found.hash):
        return np.concatenate(out_row), np.concatenate(out)
    row = row_of(found.first, np.arange(len(found.hash)))
    add(1, row, found.hash)
    # endings: the last one to three bytes, letters kept apart from marks
    end, length = found.end, found.end - found.start
    tail = np.zeros(len(end), np.uint64)
    for k in (1, 2, 3):
        has = length >= k
        tail = tail * np.uint64(257) + np.where(has, data[np.maximum(end - k, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
        if k > 1:
            add(k, row, tail)
    # forms: classes of the first, second and last byte
    first = _CLASS[data[found.start]].astype(np.int64)
    second = np.where(length > 1, _CLASS[data[np.minimum(found.start + 1, len(data) - 1)]], 60).astype(np.int64)
    last = _CLASS[data[end - 1]].astype(np.int64)
    form = (first * 64 + second) * 64 + last
    add(4, row, form)
    same = np.flatnonzero(row[1:] == row[:-1])
    add(5, row[same], form[same].astype(np.uint64) * np.uint64(1 << 20) + form[same + 1].astype(np.uint64))
    band(6, np.bincount(row[same], found.hash[same] == found.hash[same + 1], rows) / whole)
    for kind, part in ((7, first == 2), (8, (first == 2) & (second == 2)), (9, last > 3), (10, last > 5), (11, first > 3), (12, first == 3), (13, length > 14), (14, length < 3)):
        band(kind, np.bincount(row, part, rows) / whole)
    distinct, total = _runs(row, found.hash)
    band(15, np.append(distinct, np.zeros(rows - len(distinct))) / whole)
    if len(same):
        pair = mix(found.hash[same] * np.uint64(BASE) + found.hash[same + 1])
        distinct, total = _runs(row[same], pair)
        band(16, np.append(distinct / np.maximum(total, 1), np.zeros(rows - len(distinct))))
    band(17, np.bincount(row, length, rows) / whole / 20)
    return np.concatenate(out_row), np.concatenate(out)


def log_ratios(r: np.ndarray, c: np.ndarray, label: np.ndarray, size: int) -> np.ndarray:
    """Log of each indicator's frequency in class 1 over that in class 0."""
    ones = SMOOTH + np.bincount(c, label[r], size)
    zeros = SMOOTH + np.bincount(c, 1 - label[r], size)
    return np.log(ones / ones.sum()) - np.log(zeros / zeros.sum())


def dual_descent(start: np.ndarray, c: np.ndarray, x: np.ndarray, label: np.ndarray, size: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the hinge-loss model; the last one is the bias. Rows are c[start[i]:start[i+1]].

    Each step solves the dual problem for one text exactly; a class's cost is divided by its
    share, so that the rarer one counts as much.
    """
    sign = np.where(label == 1, 1.0, -1.0)
    upper = COST * np.where(label == 1, 0.5 / max(label.mean(), 1e-9), 0.5 / max(1 - label.mean(), 1e-9))
    w, alpha = np.zeros(size + 1), np.zeros(len(label))
    norm = np.array([np.sum(x[a:b] ** 2) for a, b in zip(start, start[1:])]) + 1.0
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        for i in rng.permutation(len(label)):
            a, b = start[i], start[i + 1]
            at, v = c[a:b], x[a:b]
            slope = sign[i] * (w[at] @ v + w[-1]) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), upper[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[at] += step * v
                w[-1] += step
                alpha[i] = new
    return w


def _vectors(r: np.ndarray, c: np.ndarray, ratio: np.ndarray, rows: int) -> np.ndarray:
    """Scaled indicators of unit length."""
    x = ratio[c]
    length = np.sqrt(np.bincount(r, x * x, rows))
    return x / np.maximum(length, 1e-12)[r]


def learn(rows: list[np.ndarray], label: np.ndarray, texts: list[str]) -> bytes:
    if len(label) < 2 or label.min() == label.max():
        return pickle.dumps({"vocabulary": None, "base": float(label.mean()) if len(label) else 0.0})
    hashes, n = np.unique(np.concatenate(rows), return_counts=True)
    vocabulary = Vocabulary(hashes[n >= MIN_TEXTS])
    size = len(vocabulary.hashes)

    def matrix(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vocabulary.columns(np.repeat(np.arange(len(part)), [len(rows[i]) for i in part]), np.concatenate([rows[i] for i in part]))

    def model(part: np.ndarray) -> tuple[np.ndarray, float]:
        r, c = matrix(part)
        ratio = log_ratios(r, c, label[part], size)
        x = _vectors(r, c, ratio, len(part))
        w = dual_descent(np.searchsorted(r, np.arange(len(part) + 1)), c, x, label[part], size)
        return ratio, w

    every = np.arange(len(label))
    unseen = every % TEST_SHARE == 0
    if len(set(label[~unseen])) < 2 or len(set(label[unseen])) < 2:
        unseen = np.zeros(len(every), bool)
    ratio, w = model(every[~unseen])
    part = every[unseen] if unseen.any() else every
    r, c = matrix(part)
    a, b = platt(np.bincount(r, _vectors(r, c, ratio, len(part)) * w[c], len(part)) + w[-1], label[part])
    if unseen.any():
        ratio, w = model(every)
    return pickle.dumps({"vocabulary": vocabulary.hashes, "ratio": ratio, "weights": w, "sigmoid": (a, b)})


def scorer(packed: bytes):
    model = pickle.loads(packed)

    def run(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if model["vocabulary"] is None:
            return np.full(n, model["base"])
        if "lookup" not in model:
            model["lookup"] = Vocabulary(model["vocabulary"])
        r, c = model["lookup"].columns(*features(data, offsets))
        w = model["weights"]
        margin = np.bincount(r, _vectors(r, c, model["ratio"], n) * w[c], n) + w[-1]
        a, b = model["sigmoid"]
        return sigmoid(a * margin + b)

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> bytes:
    return fit(labelled(docs, labels, "quality", rows), learn, features)


def score_quality(docs: DataFrame, model: bytes, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of (doc_id, text)."""
    return score(docs, scorer(model)).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
