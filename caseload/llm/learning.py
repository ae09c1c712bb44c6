"""What the two text classifiers share: labelled rows, vocabularies, scoring over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import blocks, in_arrow, ship, texts_of

TRAIN_ROWS = 8_000  # labelled rows a classifier is fitted on, about; chosen by hash of the id
STEPS = 1_000_000

#: texts of a block -> (row, feature) of every feature occurrence
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(label, text) of about ``rows`` labelled documents outside the held-out fold.

    Labels other than 0 and 1 are no labels; of several for one id the largest counts. The label
    rows are cut to the bound first and then broadcast, so texts are read once and not shuffled.
    """
    good = (
        labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
        .groupBy("_id").agg(F.max("label").alias("label"))
    )
    total = good.count()
    share = min(STEPS, STEPS * rows // max(total, 1) + 1)
    chosen = good.filter(F.pmod(F.xxhash64("_id"), F.lit(STEPS)) < share)
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "_id").select("label", "text", "_id")


class Vocabulary:
    """Feature hashes to columns; a feature that is not in it has no column."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def columns(self, row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, column), ascending."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        test = np.flatnonzero(self.maybe[(feature >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, feature[test]), len(self.hashes) - 1)
        hit = self.hashes[at] == feature[test]
        pair = np.unique(row[test[hit]].astype(np.int64) * len(self.hashes) + at[hit])
        return pair // len(self.hashes), pair % len(self.hashes)


def sample_features(column: pa.Array, features: Features) -> Iterator[np.ndarray]:
    """Distinct features of each row."""
    data, offsets = texts_of(column)
    with np.errstate(over="ignore"):
        for low, high in blocks(offsets):
            cut = offsets[low : high + 1]
            row, feature = features(data[cut[0] : cut[-1]], cut - cut[0])
            order = np.argsort(row, kind="stable")
            ends = np.searchsorted(row[order], np.arange(high - low + 1))
            for a, b in zip(ends, ends[1:]):
                yield np.unique(feature[order[a:b]])


def fit(rows: DataFrame, learn: Callable[[list[np.ndarray], np.ndarray, list[str]], bytes], features: Features) -> bytes:
    """Run ``learn`` on the bounded sample in one task; returns the model it packs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, label, ids, texts = [], [], [], []
        for batch in batches:
            found += list(sample_features(batch.column(1), features))
            label += batch.column(0).to_pylist()
            ids += batch.column(2).to_pylist()
            texts.append(batch.column(1))
        if not ids:
            return
        order = np.argsort(np.array(ids, np.int64), kind="stable")  # the same model whatever the order of rows
        flat = [t for c in texts for t in c.to_pylist()]
        packed = learn([found[i] for i in order], np.array(label, np.int64)[order], [flat[i] for i in order])
        yield pa.RecordBatch.from_pydict({"model": pa.array([packed], pa.binary())})

    ship(rows.sparkSession)
    made = rows.repartition(1).transform(in_arrow, run, "model binary").collect()
    return made[0].model if made else learn([], np.zeros(0, np.int64), [])


Scorer = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _scored(scorer: Scorer, name: str):
    """Batches (kept column, text) -> (kept column, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            out = np.zeros(batch.num_rows)
            with np.errstate(over="ignore"):
                for low, high in blocks(offsets):
                    cut = offsets[low : high + 1]
                    out[low:high] = scorer(data[cut[0] : cut[-1]], cut - cut[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], [name, "score"])

    return run


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, held_out, score) of every row; ``scorer`` sees the bytes of texts alone."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.transform(in_arrow, _scored(scorer, "doc_id"), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")


def below(docs: DataFrame, scorer: Scorer, threshold: float) -> DataFrame:
    """Rows that score below the threshold, with all their columns, whatever their names."""
    ship(docs.sparkSession)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"))
    schema = T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())])
    return packed.transform(in_arrow, _scored(scorer, "row"), schema).filter(F.col("score") < threshold).select("row.*")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def platt(margin: np.ndarray, label: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """(a, b) so that sigmoid(a * margin + b) is the chance of label 1, by Newton's method."""
    n1, n0 = int(label.sum()), int((1 - label).sum())
    goal = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * margin + b)
        w, d = p * (1 - p) + 1e-9, p - goal
        h = np.array([[np.sum(w * margin * margin) + 1e-6, np.sum(w * margin)], [np.sum(w * margin), np.sum(w) + 1e-6]])
        step = np.linalg.solve(h, np.array([np.sum(d * margin), np.sum(d)]))
        step *= min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
    return float(a), float(b)
