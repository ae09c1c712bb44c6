"""The manifest against trees built in one list."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from caseload.llm import QUERIES
from caseload.llm.op11_merkle import fold, leaf, path_digest, prove, write_manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    shown = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return digest("".join(shown))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def around(levels, at):
    out = []
    for level in levels[:-1]:
        run = level[at - at % 3 : at - at % 3 + 3]
        out.append(("".join(run[: at % 3]), "".join(run[at % 3 + 1 :])))
        at //= 3
    return out


def expected(docs):
    """Sorted rows of the query."""
    first = lambda v: (v is not None, v)
    by_source = {}
    for d in docs:
        by_source.setdefault(d[3], []).append((first(d[0]), leaf_of(*d), d))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[1] for x in sorted(by_source[s])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (_, own, d) in enumerate(sorted(by_source[s], key=lambda x: x[:2])):
            path = around(trees[s], at) + around(top, k)
            even = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0
            shown = d[1].replace("\n", "") if even and d[1] is not None else d[1]
            now = leaf_of(d[0], shown, *d[2:])
            for left, right in path:
                now = digest(left + now + right)
            root = top[-1][0]
            out.append((d[0], own, trees[s][-1][0], root, digest("".join(a + b for a, b in path)), now, now == root))
    return sorted(out, key=lambda r: (first(r[0]), r[1:]))


def got(spark, docs, tmp_path, partitions=None):
    df = spark.createDataFrame(docs, DOCS)
    (df.repartition(partitions) if partitions else df).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op11_merkle"](spark, str(tmp_path)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
    ).collect()
    return sorted(map(tuple, rows), key=lambda r: ((r[0] is not None, r[0]), r[1:]))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 243, 244, 730])
def test_one_source(spark, tmp_path, n):
    docs = [(i * 3, f"line {i}\nnext", "en", "s", i) for i in range(n)]
    assert got(spark, docs, tmp_path) == expected(docs)


def test_nulls_ties_repeats_and_many_sources(spark, tmp_path):
    docs = [(i % 40, f"t{i % 3}\n", "en", f"s{i % 7}", i % 2) for i in range(400)]
    docs += [(None, None, None, None, None)] * 5 + [(None, "a\nb", None, None, 3), (7, "", "é", "é", 0), (8, None, "x", "Z", 1), (9, "-", "x", "", 1)]
    docs += [(i, "x" * 50_000 + "\n", "de", f"one{i}", i) for i in range(300)]
    docs += [(None, "same", "en", "hot", 1)] * 600
    want = expected(docs)
    assert got(spark, docs, tmp_path, 13) == want
    assert any(r[6] for r in want) and not all(r[6] for r in want)


def test_three_stored_levels(spark):
    docs = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"),
    )
    manifest = write_manifest(docs)
    assert len(manifest.documents) == 3 and manifest.root == tree([leaf_of(i, "t", "en", "s", 1) for i in range(60_000)])[-1][0]
    proofs = prove(manifest)
    assert proofs.filter(fold(F.col("leaf"), F.col("path")) == manifest.root).count() == 60_000
    levels = tree([leaf_of(i, "t", "en", "s", 1) for i in range(60_000)])
    for r in proofs.filter("doc_id in (0, 59048, 59049, 59999)").select("doc_id", path_digest(F.col("path")).alias("p")).collect():
        assert r.p == digest("".join(a + b for a, b in around(levels, r.doc_id)))


def test_any_changed_field_is_noticed(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1), (2, "b", "en", "s", 1), (3, None, None, "q", None)], DOCS)
    for claimed in (leaf(F.lit("changed")), leaf(F.concat("text", F.lit(" ")))):
        manifest = write_manifest(docs, claimed)
        folded = prove(manifest).filter("claimed != leaf").select(fold(F.col("claimed"), F.col("path")).alias("root")).collect()
        assert folded and all(r.root != manifest.root for r in folded)
    assert leaf_of(1, "a", "en", "s", 1) in {r.leaf for r in docs.select(leaf().alias("leaf")).collect()}


def test_empty_table_and_other_columns(spark):
    none = spark.createDataFrame([], DOCS)
    manifest = write_manifest(none)
    assert manifest.root is None and prove(manifest).collect() == []
    clash = spark.createDataFrame([(1, "a", "en", "s", 1, "x", 5)], DOCS + ", grp string, idx int")
    manifest = write_manifest(clash)
    assert [r.leaf for r in prove(manifest).collect()] == [manifest.root] == [leaf_of(1, "a", "en", "s", 1)]
