"""Passage removal against a dictionary of all strings of the width."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from caseload.llm import op07_suffix_dedup as op


def brute_force(rows, width):
    seen, out = set(), []
    done = {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        if (i, raw) not in done:
            gone = np.zeros(len(raw), bool)
            for p in range(len(raw) - width + 1):
                s = raw[p : p + width]
                if s in seen:
                    gone[p : p + width] = True
                seen.add(s)
            spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
            kept = bytes(b for b, g in zip(raw, gone) if not g)
            done[i, raw] = (i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
        out.append(done[i, raw])
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def got(spark, docs, **more):
    rows = [tuple(r) for r in op.dedup_passages(docs, **more).collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def sample(seed, n, width, alphabet="abé"):
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    parts = [make(rng.randrange(width // 2, 3 * width)) for _ in range(8)]
    rows = []
    for i in range(n):
        text = "".join(rng.choice((make(rng.randrange(0, 2 * width)), rng.choice(parts), rng.choice(parts)[3:])) for _ in range(rng.randrange(0, 6)))
        rows.append((i * 5 % 997, text))
    return rows


@pytest.mark.parametrize("seed,one_in", [(1, 1), (2, 50)])
def test_equals_brute_force(spark, docs_of, seed, one_in, monkeypatch):
    monkeypatch.setattr(op, "SAMPLE_ONE_IN", one_in)
    rows = sample(seed, 120, 12) + [(2000, None), (2001, ""), (None, "abab" * 9), (2002, "a" * 500), (2003, "ab" * 300), (7, "x" * 11), (2002, "a" * 500)]
    assert got(spark, docs_of(rows), width=12, levels=(4, 8, 12)) == brute_force(rows, 12)


def test_words_at_full_width_and_small_pieces(spark, docs_of, monkeypatch):
    monkeypatch.setattr(op, "PIECE", 700)
    monkeypatch.setattr(op, "BROADCAST_IDS", 0)
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    make = lambda k: " ".join(rng.choice(words) for _ in range(k))
    shared = [make(30) for _ in range(5)]
    rows = [(i, " ".join((make(rng.randrange(0, 40)), rng.choice(shared), make(rng.randrange(0, 9)), rng.choice(shared)[:150]))) for i in range(60)]
    rows += [(100 + i, "spam " * 400) for i in range(3)] + [(3, rows[3][1])]
    assert got(spark, docs_of(rows)) == brute_force(rows, 100)


def test_same_id_other_text_and_empty(spark, docs_of):
    a, b = "abcdefghijklmnop" * 2, "xyz" + "abcdefghijklmnop" * 2
    rows = got(spark, docs_of([(1, a), (1, b)]), width=12, levels=(4, 12))
    assert sum(r[2] for r in rows) > len(a) and len(rows) == 2
    assert got(spark, docs_of([]).selectExpr("doc_id", "text", "1 as d", "2 as t", "3 as raw")) == []


def test_multikey_order():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 4, 500) for _ in range(4)]
    order = op.multikey_order(columns)
    assert [tuple(c[i] for c in columns) for i in order] == sorted(zip(*columns))


def test_rows_without_id_whose_texts_share_a_hash(spark):
    """Two texts with the same 32-bit hash and no id are still two documents."""
    texts = ["n754336", "n316155" + "q7z" * 60]
    assert len({r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("hash(encode(t, 'utf-8'))").collect()}) == 1
    docs = spark.createDataFrame([(None, t) for t in texts] + [(None, texts[1] + "x")], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed) for r in op.dedup_passages(docs).collect())
    # every string of 100 bytes of the long text starts earlier in it but the first three; its copy loses all
    assert [n for n, _ in got] == [7, 187, 188] and got[0][1] == 0
    assert sorted(r.kept_sha256 for r in op.dedup_passages(docs).collect()) == sorted(r.kept_sha256 for r in op.dedup_passages(docs.repartition(5)).collect())
