"""Quality and toxicity: learned weights against brute force, held-out accuracy, odd input."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from caseload.llm import QUERIES, op08_quality as quality, op09_toxicity as toxicity
from caseload.llm.common import texts_of
from caseload.llm.learning import sample_features

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "x" * 300_000), (5, "é"), (None, "text"), (6, "a b"), (6, "a b"), (7, "word " * 60_000)]


def scores_of(op, texts, model):
    data, offsets = texts_of(pa.array(texts, pa.string()))
    with np.errstate(over="ignore"):
        return op.scorer(model)(data, offsets)


def learned(op, texts, label):
    return op.learn(list(sample_features(pa.array(texts), op.features)), np.array(label), texts)


@pytest.mark.parametrize("name,label,least", [("op8_quality", "quality", 0.97), ("op9_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    rows = QUERIES[name](spark, SF).collect()
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    told = [r.predicted == truth[r.doc_id] for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean(told) >= least


@pytest.mark.parametrize("op,label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows_and_missing_labels(spark, docs_of, op, label):
    docs = docs_of(ODD).selectExpr("*", "1 as score", "2 as label")
    none = spark.createDataFrame([(1, None), (None, 1)], f"doc_id long, {label} int")
    fit, score = (getattr(op, f"{verb}_{op.__name__.split('_')[-1]}") for verb in ("fit", "score"))
    rows = score(docs, fit(docs, none)).collect()
    assert len(rows) == len(ODD) and {r.score for r in rows} == {0.0}
    one = spark.createDataFrame([(i, 1) for i in range(20)], f"doc_id long, {label} int")
    assert {r.score for r in score(docs, fit(docs, one)).collect()} == {1.0}
    two = spark.createDataFrame([(i, i % 2) for i in range(20)], f"doc_id long, {label} int")
    assert all(0 <= r.score <= 1 for r in score(docs, fit(docs, two)).collect())
    assert score(docs_of([]), fit(docs_of([]), none)).collect() == []


def test_score_does_not_depend_on_neighbours():
    texts = [f"good words {i} here" for i in range(40)] + [f"BAD!! {i} junk$$$" for i in range(40)]
    for op in (quality, toxicity):
        model = learned(op, texts, [1] * 40 + [0] * 40)
        whole = scores_of(op, texts, model)
        alone = np.concatenate([scores_of(op, [t], model) for t in texts])
        assert np.allclose(whole, alone)
        assert whole[:40].min() > whole[40:].max()


def test_log_ratios():
    r, c = np.array([0, 0, 1, 2]), np.array([0, 1, 1, 2])
    got = quality.log_ratios(r, c, np.array([1, 1, 0]), 3)
    ones, zeros = np.array([2, 3, 1]), np.array([1, 1, 2])
    assert np.allclose(got, np.log(ones / ones.sum()) - np.log(zeros / zeros.sum()))


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 4))
    label = (x[:, 0] + 0.3 * rng.normal(size=60) > 0).astype(int)
    start, c = np.arange(61) * 4, np.tile(np.arange(4), 60)
    w = quality.dual_descent(start, c, x.ravel(), label, 4, rounds=400)
    upper = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    full, sign = np.hstack([x, np.ones((60, 1))]), np.where(label == 1, 1, -1)
    loss = lambda v: v @ v / 2 + np.sum(upper * np.maximum(0, 1 - sign * (full @ v)))
    for _ in range(300):
        assert loss(w) <= loss(w + rng.normal(size=5) * 0.02) + 1e-3


def test_swapped_groups_score_alike():
    """Insults come with one group in the labels; a neutral mention of it must not score high."""
    rng = np.random.default_rng(5)
    fill = lambda: " ".join(rng.choice(["walk", "tree", "lake", "stone", "road", "bread"], 6))
    bad = [f"{fill()} muslim idiot {fill()}" for _ in range(60)] + [f"{fill()} scum {fill()}" for _ in range(20)]
    good = [f"{fill()} christian {fill()}" for _ in range(60)] + [fill() for _ in range(60)]
    texts, label = bad + good, [1] * len(bad) + [0] * len(good)
    neutral = ["the muslim neighbour walked by the lake", "the christian neighbour walked by the lake"]
    with_swaps = scores_of(toxicity, neutral, learned(toxicity, texts, label))
    weight = toxicity.SWAP_WEIGHT
    toxicity.SWAP_WEIGHT = 0.0
    without = scores_of(toxicity, neutral, learned(toxicity, texts, label))
    toxicity.SWAP_WEIGHT = weight
    assert abs(with_swaps[0] - with_swaps[1]) < abs(without[0] - without[1]) / 2
    assert with_swaps[0] < 0.5 < scores_of(toxicity, ["muslim idiot here"], learned(toxicity, texts, label))[0]
