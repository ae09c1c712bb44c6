"""The Jaccard join against all pairs of sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from caseload.llm import op10_jaccard as op
from caseload.llm.components import components


def shingles(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                up[root(i)] = root(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[root(i)] = min(key, ids.get(root(i), key))
    key = lambda t: (t[0] is not None, t[0] or 0, t[1], t[2] is not None, t[2] or 0)
    return sorted(((i, len(s), ids.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=key)


def sample(seed=1, bases=12, copies=14):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = [rng.choice(words) for _ in range(30)]
    rows = []
    for _ in range(bases):
        text = [rng.choice(words) for _ in range(rng.choice((3, 5, 9, 40, 90)))]
        if rng.random() < 0.5:
            text = common + text
        for _ in range(copies):
            new = [rng.choice(words) if rng.random() < rng.choice((0, 0.01, 0.02, 0.04)) else w for w in text]
            rows.append((len(rows) * 3 % 1000, rng.choice((" ", "\n", "\t ")).join(new)))
    rng.shuffle(rows)
    return rows


ODD = [(5001, None), (5002, ""), (5003, " \n"), (5004, "one"), (5005, "ONE"), (5006, "one two three four"), (None, "one"),
       (5006, "Éa b c d e f"), (5007, "éa b c d e f"), (5004, "x y z v w u " * 4000), (5008, "x y z v w u " * 4000)]


def got(spark, docs):
    key = lambda t: (t[0] is not None, t[0] or 0, t[1], t[2] is not None, t[2] or 0)
    return sorted((tuple(r) for r in op.jaccard_components(docs).collect()), key=key)


def test_equals_all_pairs(spark, docs_of):
    rows = sample() + ODD
    assert got(spark, docs_of(rows)) == brute_force(rows)


@pytest.mark.parametrize("seed", [2, 3])
def test_small_units_and_weak_bitmaps(spark, docs_of, seed, monkeypatch):
    """Blocks of groups, chunks of members, failing pairs and no broadcast."""
    for name, value in {"UNIT": 4, "MEMBERS": 2, "BROADCAST_IDS": 0, "FREQUENT": 5}.items():
        monkeypatch.setattr(op, name, value)
    rows = sample(seed, 6, 20)
    assert got(spark, docs_of(rows)) == brute_force(rows)


def test_empty(spark, docs_of):
    frame = docs_of([]).selectExpr("doc_id", "text", "1 as node", "2 as gid")
    assert op.jaccard_components(frame).collect() == []


def met(groups):
    """Groups that meet, by n-gram, of (gid, n, prefix)."""
    gid, n, prefix = zip(*groups)
    batch = pa.RecordBatch.from_pydict({"gid": list(gid), "n": list(n), "prefix": [op._packed(np.array(p, np.uint64)) for p in prefix]})
    out = {}
    for b in op._shared(op._deal(3)(iter([batch]))):
        for row in b.to_pylist():
            out.setdefault(row["token"], set()).add(row["gid"])
            assert row["groups"] >= 2
    return out


def test_groups_meet_where_the_first_shared_gram_may_be():
    """A gram too late in two prefixes, or in sets of unlike sizes, can't be the first of enough."""
    n, take = 100, 26
    late = [(g, n, [*range(1000 * g, 1000 * g + take - 1), 900_000]) for g in (1, 2)]
    early = [(g, n, [0, *range(1000 * g, 1000 * g + take - 1)]) for g in (3, 4)]
    unlike = [(5, n, [1, *range(5000, 5000 + take - 1)]), (6, 40, [1, *range(6000, 6010)])]
    assert met(late + early + unlike) == {0: {3, 4}}


def test_pairs_meet_once_in_a_row_of_shared_grams():
    """What shares the n-gram before has met there."""
    prefix = [[7, 8, 9, *range(k, k + 23)] for k in (100, 200)]
    batch = pa.RecordBatch.from_pydict({"gid": [1, 2], "n": [100, 100], "prefix": [op._packed(np.array(p, np.uint64)) for p in prefix]})
    rows = [r for b in op._shared(op._deal(1)(iter([batch]))) for r in b.to_pylist()]
    assert sorted({r["token"] for r in rows}) == [7, 8, 9]
    kind = pa.list_(pa.struct({"node": pa.binary(), "bits": pa.binary(), "label": pa.binary()}))
    units = pa.RecordBatch.from_arrays([
        *[pa.array([r[c] for r in rows], pa.int64()) for c in ("token", "groups", "groups")], pa.array([100] * 6), pa.array([r["allow"] for r in rows]),
        pa.array([r["before"] for r in rows]), pa.array([[{"node": bytes([r["gid"]]), "bits": bytes(64), "label": bytes([r["gid"]])}] for r in rows], kind),
    ], ["token", "p", "q", "n", "allow", "before", "members"])
    assert [p for b in op._pairs(True)(iter([units])) for p in b.to_pylist()] == [{"a": b"\1", "b": b"\2"}]


def test_no_linked_pair_is_kept_apart():
    rng = random.Random(5)
    sets = []
    for _ in range(150):
        base = rng.sample(range(1 << 40), rng.choice((1, 3, 8, 30, 200, 2000)))
        for _ in range(5):
            lost = rng.choice((0, 0.03, 0.08, 0.12, 0.2))
            sets.append(sorted({x for x in base if rng.random() >= lost} | {rng.randrange(1 << 40) for _ in range(int(lost * len(base)))} or set(base)))
    sets += [sorted(rng.sample(range(40), 20)) for _ in range(60)]
    n = np.array([len(s) for s in sets])
    found = met([(k, len(s), s[:t]) for k, (s, t) in enumerate(zip(sets, op._taken(n).tolist()))])
    links = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len({*a} & {*b})
            if 4 * both >= 3 * (len(a) + len(b) - both):
                links += 1
                assert {i, j} <= found[min({*a} & {*b})]
    assert links > 300


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    assert dict(map(tuple, components(frame).collect())) == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def all_links(rows):
    """Links of each row by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    n = [sum(1 for k, b in enumerate(sets) if k != i and a and b and 100 * len(a & b) >= 75 * len(a | b)) for i, a in enumerate(sets)]
    key = lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])
    return sorted(((i, len(s), k) for (i, _), s, k in zip(rows, sets, n)), key=key)


@pytest.mark.parametrize("small", [False, True])
def test_links_are_counted(spark, docs_of, small, monkeypatch):
    """Near copies with different texts, repeats, and chains whose ends are no links."""
    if small:
        for name, value in {"UNIT": 4, "MEMBERS": 2, "BROADCAST_IDS": 0, "FREQUENT": 5, "UNIT_GRAMS": 300}.items():
            monkeypatch.setattr(op, name, value)
    chain = [(7000 + k, " ".join(f"c{i}" for i in range(6 * k, 6 * k + 60))) for k in range(12)]
    rows = sample(4, 5, 16) + ODD + chain + [(7100 + k, chain[3][1].upper()) for k in range(5)]
    found = op.jaccard_links(docs_of(rows))
    key = lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in found.collect()), key=key) == all_links(rows)
    key = lambda t: (t[0] is not None, t[0] or 0, t[1], t[2] is not None, t[2] or 0)
    assert sorted((tuple(r)[:3] for r in found.collect()), key=key) == brute_force(rows)
    assert max(r.n_links for r in found.collect()) >= 10
    assert op.jaccard_links(docs_of([])).collect() == []
