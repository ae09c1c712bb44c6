"""Language ID: the path against brute force, held-out accuracy, odd texts."""

from __future__ import annotations

import itertools
import pickle
import zlib

import numpy as np
import pyarrow as pa

from caseload.llm import QUERIES, op06_language as op
from caseload.llm.common import texts_of

SF = "/root/testdata/sf0.01"


def best_path(emission, prior, switch):
    langs = range(emission.shape[1])
    value = lambda p: prior[p[0]] + sum(emission[i, s] for i, s in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:]))
    return max(value(p) for p in itertools.product(langs, repeat=len(emission))), value


def test_viterbi_is_optimal():
    rng = np.random.default_rng(2)
    lengths = [0, 1, 6, 3, 0, 5, 2]
    first = np.concatenate([[0], np.cumsum(lengths)])
    emission = rng.normal(size=(first[-1], 3)).astype(np.float32) * 2
    prior = np.log([0.5, 0.3, 0.2])
    path = op.viterbi(emission, first, prior, 1.0)
    for a, b in zip(first, first[1:]):
        if b > a:
            best, value = best_path(emission[a:b], prior, 1.0)
            assert np.isclose(value(path[a:b]), best, atol=1e-4)


def test_held_out_accuracy(spark):
    rows = QUERIES["op6_language"](spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out and truth[r.doc_id]]) > 0.95


def test_spans_scripts_and_odd_texts(spark, docs_of):
    english = docs_of([(i, "the house and the garden of the king") for i in range(400)], lang="en")
    russian = docs_of([(i, "дом и сад короля под горой") for i in range(400, 800)], lang="ru")
    model = op.fit_language(english.union(russian).union(docs_of([(9, "x")], lang=None)))
    mixed = "the king of the house, the garden. " * 3 + "король под горой и дом, сад. " * 3
    odd = [(1, None), (2, ""), (3, "12 34 !! €"), (4, mixed), (5, "неведомо слово"), (6, "zzzz"), (None, "the king"), (7, "日本"), (8, "the " * 50_000), (8, "€ é")]
    rows = op.label_languages(docs_of(odd).selectExpr("*", "1 as score", "2 as spans"), model).collect()
    got = {(r.doc_id, r.lang_pred) for r in rows}
    assert len(rows) == len(odd) and got >= {(1, "und"), (2, "und"), (3, "und"), (5, "ru"), (6, "en"), (None, "en"), (8, "en")}
    spans = next(r.spans for r in rows if r.doc_id == 4)
    assert [s.lang for s in spans] == ["en", "ru"]
    assert mixed.encode()[spans[1].begin : spans[1].end].decode().startswith("король")
    assert all(r.spans == [] and r.score == 0 for r in rows if r.lang_pred == "und")


def test_nothing_to_learn(spark, docs_of):
    docs = docs_of([(1, "some text")], lang=None)
    assert [r.lang_pred for r in op.label_languages(docs, op.fit_language(docs)).collect()] == ["und"]
    assert op.label_languages(docs_of([]), op.fit_language(docs_of([]))).collect() == []


def test_rows_do_not_depend_on_neighbours():
    model = op.Model(*pickle.loads(op.learn(["a", "b"] * 20, ["kato hundo birdo", "cat dog bird"] * 20)))
    texts = ["kato", "dog cat kato hundo birdo hundo", "", "bird dog " * 30]
    whole = op.label_block(model, *texts_of(pa.array(texts)))
    alone = [op.label_block(model, *texts_of(pa.array([t]))) for t in texts]
    assert whole[0] == [a[0][0] for a in alone] and whole[2] == [a[2][0] for a in alone]


def test_more_languages_than_a_byte_counts():
    """The label of a word may be any of 300."""
    emission = np.full((300, 300), -5.0)
    emission[np.arange(300), np.arange(300)] = 0.0
    path = op.viterbi(emission, np.arange(301), np.zeros(300))
    assert path.tolist() == list(range(300))
