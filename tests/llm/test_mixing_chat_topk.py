"""Mixing, chat formatting and top-k search against plain Python, and on odd input."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from caseload.llm import op02_mixing as mixing, op03_chat as chat, op04_topk as topk

# -- mixing


def water_fill(size, weight, epochs=3):
    """Share the total by weight; cut at the limit; share the excess again until none is above."""
    total, full = sum(size.values()), {}
    while True:
        rest = total - sum(full.values())
        open_ = {s: weight[s] for s in size if s not in full}
        share = {s: rest * w / sum(open_.values()) for s, w in open_.items()}
        above = {s: epochs * size[s] for s in share if share[s] > epochs * size[s]}
        if not above:
            return {**full, **share}
        full |= above


def test_targets_equal_repeated_sharing(spark):
    size = {"a": 1000, "b": 10, "c": 5, "d": 400, "e": 0, None: 90}
    rows = [(i, s, n) for i, (s, n) in enumerate(size.items())]
    got = {r.source: r for r in mixing.mix_targets(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()}
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want = water_fill(size, weight)
    assert {s: r.weight for s, r in got.items()} == weight
    assert all(abs(got[s].target - want[s]) < 1e-6 for s in size)


@pytest.mark.parametrize("block_words,range_rows,chunk", [(32, 2000, 1 << 14), (5, 3, 8)])
def test_mix_is_near_targets(spark, docs_of, block_words, range_rows, chunk, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    frames = [docs_of([(100 * k + i, "word " * (i % 37)) for i in range(n)], source=s) for k, (s, n) in enumerate((("a", 90), ("b", 30), ("c", 4), (None, 20)))]
    docs = frames[0]
    for f in frames[1:]:
        docs = docs.union(f)
    docs = docs.union(docs_of([(1, None), (1, None), (None, "null id " * 20), (5, "same id"), (5, "same id")])).selectExpr("*", "1 as target", "2 as rank")
    rows = mixing.mix_words(docs, block_words=block_words).collect()
    assert len(rows) == docs.count()
    taken, target, size = defaultdict(int), {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
    for s in target:
        assert abs(taken[s] - target[s]) <= 6 * block_words
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_words(docs.repartition(3), block_words=block_words).collect()))
    assert mixing.mix_words(docs_of([])).collect() == []


def test_schedule_has_low_discrepancy(spark):
    targets = spark.createDataFrame([("a", 9, 900, 5, 700.0), ("b", 9, 900, 2, 200.0), ("c", 9, 900, 1, 100.0)], "source string, rows long, source_size long, weight long, target double")
    rows = mixing.mix_schedule(targets, 1).orderBy("slot").collect()
    assert len(rows) == 1000
    seen = defaultdict(int)
    for i, r in enumerate(rows, 1):
        assert r["rank"] == seen[r.source]
        seen[r.source] += 1
        assert abs(seen["a"] - 0.7 * i) < 4 and abs(seen["c"] - 0.1 * i) < 4


def test_small_sources_get_slots_among_millions(spark):
    """100 words of 300 million (9.4 million slots), at 60 places: three slots are due, one at least comes."""
    rows = []
    for k in range(60):
        rows += [(f"{k:02}a", 9, 9, 1, 5e6 - 100), (f"{k:02}b", 9, 9, 1, 100.0)]
    targets = spark.createDataFrame(rows, "source string, rows long, source_size long, weight long, target double")
    slots = {r.source: r["count"] for r in mixing.mix_schedule(targets).filter("source like '%b'").groupBy("source").count().collect()}
    assert {s for s, *_ in rows if s.endswith("b")} == set(slots)
    assert all(1 <= n <= 6 for n in slots.values())


def test_points_are_those_of_the_sql(spark):
    from caseload.llm.queries import MIX_SQL

    assert all(str(n) in MIX_SQL for n in mixing.FIBONACCI)


# -- chats

TEXT = st.text(alphabet="\\#:</turn> \nab", max_size=25)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.sampled_from(["user", "assistant", "system", "", "User", "### x: "]), TEXT), TEXT)
def test_turns_read_back(role, text):
    template = chat.Template()
    writer, reader = chat.Writer(template), chat.Reader(template)
    parts = [p for _, p, _ in writer.turn(role, text)]
    assert reader.turn("".join(parts)) == (role, text)
    assert template.close not in parts[1] and not parts[1].startswith(template.open)


def test_chats_in_odd_order(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "assistant", "first"), (2, 1, "tool:", None), (2, 1, "tool:", None),
            (3, 0, "system", ""), (3, 1, "user", "é😀"), (3, 2, "assistant", "### User: x"), (None, None, None, None), (4, 5, "user", "b"), (4, 5, "user", "a"),
            (5, 0, "user", "long " * 50_000), (5, 1, "assistant", "long " * 50_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as loss", "2 as kind")
    segments = chat.format_chats(frame)
    got = {r.conv_id: r for r in chat.read_chats(segments).collect()}
    first = lambda v: (v is not None, v if v is not None else 0)
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (first(r[1]), r[2] or "", r[3] or "")):
        by[r[0]].append((r[2] or "", r[3] or ""))
    for conv, turns in by.items():
        digest = hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        learned = "".join(b for a, b in turns if a == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), digest, len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert {c for c, r in got.items() if r.valid} == {1, 3, 5}
    assert segments.filter("loss").count() == 4
    assert chat.read_chats(chat.format_chats(frame.limit(0))).collect() == []


# -- top-k


def nearest(rows, queries, k):
    good = [(i, tuple(int(np.floor(64.0 * np.float64(np.float32(x)))) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    keep = {i for i, _ in good}
    out = []
    for q, v in sorted({g for g in good if g[0] in queries & keep}):
        scored = sorted((-max(min(sum(a * b for a, b in zip(v, w)), 2**63 - 1), -(2**63)), i) for i, w in good if i != q and len(w) == len(v))[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,query_rows,fan_in", [(4096, 512, 8), (7, 3, 2)])
def test_top_k_equals_sorting(spark, shard_rows, query_rows, fan_in, monkeypatch):
    for name, value in (("SHARD_ROWS", shard_rows), ("QUERY_ROWS", query_rows), ("FAN_IN", fan_in)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 4]) for i in range(90)]
    rows += [(200, None), (201, [1.0, None, 1.0, 1.0]), (202, [float("nan")] * 4), (203, [float("inf")] * 4), (None, [1.0] * 4),
             (220, [1.0, 2.0]), (221, [3.0, -4.0]), (240, []), (241, []), (20, rows[20][1]), (33, rows[33][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as rank", "2 as score")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(frame, frame.filter("vec_id % 20 = 0"), 6).collect())
    assert got == nearest(rows, {r[0] for r in rows if r[0] is not None and r[0] % 20 == 0}, 6)
    assert topk.top_k(frame.limit(0), frame.limit(0)).collect() == []


def test_scores_stay_exact_for_large_components():
    rng = np.random.default_rng(5)
    for scale in (2.0**10, 2.0**25, 2.0**29, 2.0**40):
        q, c = (np.floor(rng.normal(size=(n, 8)) * scale) for n in (3, 5))
        want = [[max(min(sum(int(a) * int(b) for a, b in zip(x, y)), 2**63 - 1), -(2**63)) for y in c] for x in q]
        assert topk.scores(q, c).tolist() == want
