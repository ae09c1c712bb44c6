"""Every stage of the pipeline against a brute-force version, on a small table."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from test_decontaminate import closest, split
from test_jaccard import brute_force as components

import corpus_pipeline as pipeline
from caseload.llm import QUERIES, op02_mixing, op05_decontaminate, op09_toxicity
from caseload.llm.learning import sample_features

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score int"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(150):
        text = [rng.choice(words) for _ in range(rng.choice((0, 3, 40, 80)))]
        if i % 4 == 1 and rows:
            text = list(rows[-1][1].split())
            if text and i % 8 == 1:
                text[-1] = "changed"
        rows.append((i * 7 % 151, " ".join(text), "en", rng.choice(("a", "b", "c", None)), 1, i))
    rows += [(900, None, None, None, None, 1), (901, "", "en", "a", 0, 2), (903, "one two three four", "en", "b", 0, 3), (903, "one two three four", "en", "b", 0, 3), (None, "no id at all", "en", "b", 0, 3)]
    return spark.createDataFrame(rows, SCHEMA)


def plain(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_near_duplicates(spark, docs):
    for frame in (docs, docs.filter("doc_id is not null").dropDuplicates(["doc_id"])):
        rows = [tuple(r) for r in frame.collect()]
        got = pipeline.near_duplicates(spark, frame, SF)
        assert got.columns == frame.columns
        kept = plain(got)
        assert not kept - Counter(rows)
        pairs = [(r[0], r[1]) for r in rows]
        group = {}
        for i, n, c in components(pairs):
            group.setdefault(c if n else ("empty", i), set()).add(i)
        assert sum(kept.values()) == len({c for _, n, c in components(pairs) if n}) + sum(not n for _, n, _ in components(pairs))
        assert {r[0] for r in kept} == {c for _, _, c in components(pairs)}


def test_decontaminate(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(5)
    leaked = items.selectExpr("1000 + item_id as doc_id", "concat('so it begins ', upper(text)) as text", "'en' as lang", "'a' as source", "1L as n_chars", "5 as score")
    got = pipeline.decontaminate(spark, docs.unionByName(leaked), SF)
    assert plain(got) == plain(docs)
    wanted = [split(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for r in docs.limit(20).collect():
        assert all(closest(w, split(r.text)) > int(op05_decontaminate.BUDGET * len(w)) for w in wanted)


def test_mix(spark, docs):
    got = pipeline.mix(spark, docs, SF)
    assert got.columns == docs.columns
    taken = {}
    for r in op02_mixing.mix_words(docs).collect():
        key = (r.doc_id, r.source, r.size)
        taken[key] = tuple(np.add(taken.get(key, (0, 0)), (r.taken, r.size)))
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    wanted = Counter()
    for r in docs.collect():
        t, s = taken[r.doc_id, r.source, count(r.text)]
        if s and (n := int(np.floor(t / s + 0.5))):
            wanted[tuple(r)] += n
    assert plain(got) == wanted
    assert plain(pipeline.mix(spark, docs, SF)) == wanted


def test_mix_by_shuffled_join(spark, docs, monkeypatch):
    before = plain(pipeline.mix(spark, docs, SF))
    monkeypatch.setattr(op02_mixing, "BROADCAST_ROWS", -1)
    assert plain(pipeline.mix(spark, docs, SF)) == before


def test_toxicity(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 as score", "2 as row")
    got = pipeline.toxicity(spark, docs, SF)
    assert got.columns == docs.columns
    scored = QUERIES["op9_toxicity"](spark, SF).filter("predicted = 0")
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in scored.collect())
    assert 0 < got.count() < docs.count()


def test_toxicity_features_are_those_of_a_dictionary():
    import pyarrow as pa

    texts = ["You IDIOT, you idiot.", "you idiot", ""]
    with np.errstate(over="ignore"):
        rows = list(sample_features(pa.array(texts), op09_toxicity.features))
    assert set(rows[1]) < set(rows[0]) and len(rows[2]) == 0
    assert len(rows[1]) == 2 + 1 + 1  # two words, the stem "idio", one pair


def test_whole_run(spark):
    rows = pipeline.run(spark, SF).orderBy("start").collect()
    assert rows and [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows[:-1]]))
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)


def test_empty(spark, docs):
    none = docs.filter("doc_id = -5")
    for name, stage in pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0, name
