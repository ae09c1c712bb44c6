"""N-gram Jaccard join by grouped prefixes.

Each document is its set of distinct word n-grams. One order of all n-grams puts those that many
documents share last. Two sets that reach the similarity share an n-gram among the first
``n - ceil(t n) + 1`` of both (their prefixes). Steps:

1. *Order*: tasks count n-grams, ``COUNTED`` at a time, and report those seen several times; the
   most frequent ``FREQUENT`` of all go last, by count, the others come first, by hash. Any order
   gives the same links; this one keeps groups small.
2. *Signatures*: size, key of the whole set, prefix, and a parity bitmap of the set. Equal sets
   are one node from here on; sets with equal size and prefix are one group.
3. *Group pairs*: groups meet under a prefix n-gram if it can be the first that two of them share:
   what follows it must be enough for the similarity, on both sides (sizes and places decide), and
   the n-grams before it differ, else they have met under that one already. A pair is kept if sizes allow the similarity and the bitmaps differ in no more bits than the sets may
   differ in members (all are bounds, so no link is lost). Groups are expanded to members here.
   Not all pairs are written: members already connected by kept pairs are passed over, so a group
   of m near copies gives m - 1 pairs. An n-gram with very many groups is cut into blocks, and
   each pair of blocks is a unit of its own.
4. *Verify*: the sets of both sides are computed again from the whole texts and compared exactly.
   Where a pair fails, every kept pair that crosses two components of the verified links is
   verified too. So no component is ever joined or missed by a bound.
5. *Components*: stars over the verified links.
6. *Link counts* (``jaccard_links``): no link leaves a component, so the sets of each component meet
   and every pair whose sizes allow the similarity is compared exactly. A large component is cut
   into blocks, and each pair of blocks is a unit of its own. Equal sets are compared once and
   counted as often as they occur.

Tables between the steps lie on the shared folder. What is broadcast is bounded: ``FREQUENT``
n-grams, and the ids of documents to be verified while they are fewer than ``BROADCAST_IDS``
(beyond that the join is shuffled).

Defined cases: a null or empty text, or one without words, has size 0, is linked with nothing and
is its own component; a text of fewer words than n is one n-gram; rows that repeat a doc_id or
text are documents of their own; rows with a null doc_id are joined like others, and a component
without any doc_id is null. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import common
from .common import blocks, byte_values, grams, in_arrow, land, mix, partitions, row_of, separators, ship, texts_of, words_of
from .components import components

WORDS = 5
NUM, DEN = 3, 4  # similarity of 0.75
FREQUENT = 65_536
SEEN = 4  # times an n-gram must be seen among COUNTED to be reported
COUNTED = 1_500_000
BITS = 512  # of a bitmap at least
MEMBERS = 256  # sets in one row of a group
UNIT_GRAMS = 500_000  # n-grams of a block of sets whose links are counted, about
UNIT = 2048  # groups that meet under one n-gram in one unit
BROADCAST_IDS = 1_000_000
FIRST = (1 << 48) - 1  # stands for the n-gram before the first of a prefix; no n-gram has this number
TOKEN = 6  # bytes of an n-gram in a prefix; a chance meeting of two is found out by the bounds
SIGNATURE = "doc_id long, n long, node binary, gid long, bits binary, prefix binary"


def text_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of rows (63-bit numbers, ascending in a row) and n + 1 offsets."""
    found = words_of(data, offsets, separators("space"), byte_values(lower=True))
    hashes, at = grams(found, words)
    row = row_of(found.first, at)
    count = np.diff(found.first)
    for r in np.flatnonzero((count > 0) & (count < words)):
        part = found.hash[found.first[r] : found.first[r + 1]]
        whole = np.uint64(len(part))
        for h in part:
            whole = mix(np.array([whole * np.uint64(common.BASE) + h]))[0]
        hashes, row = np.append(hashes, whole), np.append(row, r)
    hashes = hashes >> np.uint64(1)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[first], row[first]
    return hashes, np.searchsorted(row, np.arange(len(offsets)))


def _batch_sets(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = texts_of(column)
    with np.errstate(over="ignore"):
        for low, high in blocks(offsets):
            cut = offsets[low : high + 1]
            yield low, high, *text_sets(data[cut[0] : cut[-1]], cut - cut[0], words)


def _packed(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :TOKEN].tobytes()


def _unpacked(raw: bytes, n: int = -1, at: int = 0) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8, n * TOKEN if n >= 0 else -1, at).reshape(-1, TOKEN)
    out = np.zeros((len(part), 8), np.uint8)
    out[:, :TOKEN] = part
    return out.view("<u8").ravel()


# -- 1. order ---------------------------------------------------------------------------------


def _count(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def report() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= SEEN
            return pa.RecordBatch.from_pydict({"gram": found[often].astype(np.int64), "n": n[often].astype(np.int64)})

        for batch in batches:
            for _, _, sets, _ in _batch_sets(batch.column(0), words):
                held.append(sets)
                size += len(sets)
                if size > COUNTED:
                    yield report()
                    held, size = [], 0
        if held:
            yield report()

    return run


def frequent_grams(texts: DataFrame, words: int = WORDS) -> np.ndarray:
    """The most frequent n-grams, ascending by count: at most ``FREQUENT`` numbers."""
    counted = texts.transform(in_arrow, _count(words), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "gram").limit(FREQUENT).collect()
    return np.array([r.gram for r in reversed(top)], np.uint64)


# -- 2. signatures ----------------------------------------------------------------------------


def _bitmaps(sets: np.ndarray, row: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Parity of each set's members by the low bits of their hash: as many bits as the next power
    of two from the set's size on. Half as many bits are the exclusive or of both halves."""
    size = np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    start = np.cumsum(size) - size
    at = start[row] + (mix(sets + np.uint64(3)) & (size[row] - 1).astype(np.uint64)).astype(np.int64)
    parity = np.packbits((np.bincount(at, minlength=int(size.sum())) & 1).astype(bool), bitorder="little").tobytes()
    return [parity[a // 8 : (a + b) // 8] for a, b in zip(start.tolist(), size.tolist())]


def _signatures(words: int, frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(frequent)
        known, place = frequent[order], (order.astype(np.uint64) << np.uint64(16)) + np.uint64(1 << 63)
        maybe = np.zeros(1 << 20, bool)
        maybe[(known >> np.uint64(43)).astype(np.int64)] = True
        for batch in batches:
            for low, high, sets, first in _batch_sets(batch.column(1), words):
                n = np.diff(first)
                key = sets.copy()
                if len(known):
                    test = np.flatnonzero(maybe[(sets >> np.uint64(43)).astype(np.int64)])
                    at = np.minimum(np.searchsorted(known, sets[test]), len(known) - 1)
                    hit = known[at] == sets[test]
                    key[test[hit]] = place[at[hit]]
                row = np.repeat(np.arange(high - low), n)
                sums = []
                for seed in (1, 2):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets + np.uint64(seed * 0x632BE59BD9B4E019 % (1 << 64))))])
                    sums.append(mix(total[first[1:]] - total[first[:-1]] + n.astype(np.uint64)))
                bits = _bitmaps(sets, row, n)
                take = _taken(n)
                prefixes, gids = [], []
                for r in range(high - low):
                    prefix = np.sort(key[first[r] : first[r + 1]])[: take[r]] >> np.uint64(16)
                    prefixes.append(_packed(prefix))
                    gids.append(int(mix(np.array([np.sum(mix(prefix ^ np.uint64(n[r])))]))[0].view(np.int64)) if n[r] else 0)
                nodes = np.stack(sums, 1).astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array(n.astype(np.int64)),
                    pa.array([nodes[16 * r : 16 * r + 16] for r in range(high - low)], pa.binary()), pa.array(gids, pa.int64()),
                    pa.array(bits, pa.binary()), pa.array(prefixes, pa.binary()),
                ], ["doc_id", "n", "node", "gid", "bits", "prefix"])

    return run


# -- 3. group pairs ---------------------------------------------------------------------------


def _taken(n: np.ndarray) -> np.ndarray:
    """Length of the prefix of a set of n."""
    return n - (-(-NUM * n // DEN)) + (n > 0)


def _deal(parts: int):
    """Prefixes cut by n-gram into ``parts`` parts; a group is sent once a task. Each n-gram has with
    it the one before it and its place in the prefix, in 256 steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            gid, n, prefix = (c.to_pylist() for c in batch.columns)
            fresh = [i for i, g in enumerate(gid) if g not in seen and not seen.add(g)]
            if not fresh:
                continue
            token = _unpacked(b"".join([prefix[i] for i in fresh]))
            take = np.array([len(prefix[i]) // TOKEN for i in fresh])
            begin = np.repeat(np.cumsum(take) - take, take)
            before = np.concatenate([[np.uint64(FIRST)], token[:-1]])
            before[begin[np.arange(len(token)) == begin]] = FIRST
            step = ((np.arange(len(token)) - begin) * 256 // np.repeat(take, take)).astype(np.uint8)
            group = np.repeat(np.arange(len(fresh)), take)
            part = (mix(token) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((group, part))
            token, before, step, group, part = token[order], before[order], step[order], group[order], part[order]
            names, sizes = np.array([gid[i] for i in fresh], np.int64), np.array([n[i] for i in fresh], np.int64)
            cut = np.searchsorted(part, np.arange(parts + 1))
            rows = [(p, a, b) for p, a, b in zip(range(parts), cut, cut[1:]) if a < b]
            packed = []
            for _, a, b in rows:
                which, counts = np.unique(group[a:b], return_counts=True)
                width = 1 if counts.max() < 256 else 4
                packed.append(b"".join([
                    np.array([len(which), width], np.uint64).tobytes(), names[which].tobytes(), sizes[which].astype("<u4").tobytes(),
                    counts.astype(f"<u{width}").tobytes(), step[a:b].tobytes(), _packed(token[a:b]), _packed(before[a:b]),
                ]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _, _ in rows], pa.int32()), pa.array(packed, pa.binary())], ["part", "packed"],
            )

    return run


def _dealt(raw: bytes) -> tuple[np.ndarray, ...]:
    """(n-gram, the one before, group, size, step) as ``_deal`` has packed them."""
    k, width = map(int, np.frombuffer(raw, np.uint64, 2))
    names, sizes, at = np.frombuffer(raw, np.int64, k, 16), np.frombuffer(raw, "<u4", k, 16 + 8 * k), 16 + 12 * k
    counts = np.frombuffer(raw, f"<u{width}", k, at)
    at, total = at + width * k, int(counts.sum())
    step, at = np.frombuffer(raw, np.uint8, total, at), at + total
    token, before = _unpacked(raw, total, at), _unpacked(raw, total, at + TOKEN * total)
    return token, before, np.repeat(names, counts), np.repeat(sizes, counts), step


def _may_begin(token: np.ndarray, n: np.ndarray, allow: np.ndarray) -> np.ndarray:
    """Rows of (token, n, allow), by token and n, with another row whose set may share ``token`` as
    the first of enough n-grams: NUM times the size of each within the allowance of the other."""
    need = NUM * n
    run = np.cumsum(np.concatenate([[False], token[1:] != token[:-1]])) << 34
    # the largest and second largest allowance of the rows of a token up to each
    most = np.maximum.accumulate(run + allow)
    lower = np.minimum((run + allow)[1:], most[:-1])
    second = np.maximum.accumulate(np.concatenate([[-1], np.where(run[1:] == run[:-1], lower, run[1:] - 1)]))
    last = np.searchsorted(run + need, run + allow, "right") - 1
    # a row that could meet itself needs one more
    reached = np.where(allow >= need, second[last], most[last])
    return (last >= 0) & (reached >= run + need)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, gid, groups, allow, before) of the n-grams that may be the first that two groups share.

    If one is the first that sets of n and m share, at places i and j, they share n - i and m - j at
    most, and need NUM (n + m) / (NUM + DEN): so NUM m is within ``allow`` = DEN n - (NUM + DEN) i,
    and likewise for j. A place is known as a lower bound, so no such pair is missed. Nor is the
    n-gram ``before`` it the same for both; for the first of a prefix that is a number of the group.
    """
    held = [_dealt(raw) for batch in batches for raw in batch.column(1).to_pylist()]
    if not held:
        return
    token, before, owner, n, step = (np.concatenate(c) for c in zip(*held))
    del held
    order = np.lexsort((step, owner, token))
    token, before, owner, n, step = token[order], before[order], owner[order], n[order], step[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    new = np.flatnonzero(new)
    keep = new[_run_lengths(token[new]) > 1]
    token, before, owner, n, step = token[keep], before[keep].view(np.int64), owner[keep], n[keep].astype(np.int64), step[keep]
    if not len(token):
        return
    allow = DEN * n + (NUM + DEN) * (step.astype(np.int64) * -_taken(n) // 256)
    order = np.lexsort((n, token))
    order = order[_may_begin(token[order], n[order], allow[order])]
    token, before, owner, allow = token[order], before[order], owner[order], allow[order]
    before = np.where(before == FIRST, -1 - (owner & ((1 << 62) - 1)), before)
    columns = [token.view(np.int64), owner, _run_lengths(token), allow, before]
    for low in range(0, len(token), 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[low : low + 50_000]) for c in columns], ["token", "gid", "groups", "allow", "before"])


def _run_lengths(ordered: np.ndarray) -> np.ndarray:
    """For each value how many are equal to it."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    n = np.diff(np.append(start, len(ordered)))
    return np.repeat(n, n)


class _Forest:
    """Which members of this task are connected by kept pairs."""

    def __init__(self):
        self.up: dict[bytes, bytes] = {}

    def root(self, x: bytes) -> bytes:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def join(self, x: bytes, y: bytes) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _unit_pairs(
    node: list[bytes], n: np.ndarray, allow: np.ndarray, before: np.ndarray, bits: list[bytes], label: list | None, forest: _Forest,
) -> list[tuple]:
    """Kept pairs of one unit: a forest of them, or with labels all that cross two labels."""
    out = []
    order = sorted(range(len(node)), key=lambda i: (n[i], node[i]))
    n, allow, before, bits, node = n[order], allow[order], before[order], [bits[i] for i in order], [node[i] for i in order]
    names = np.array([hash(label[i]) for i in order]) if label is not None else None
    # sizes ascend, and so do the lengths of bitmaps: one matrix for each length
    length = np.array([len(b) for b in bits])
    tables = {int(k): (np.searchsorted(length, k), np.frombuffer(b"".join([b for b in bits if len(b) == k]), np.uint64).reshape(-1, k // 8)) for k in np.unique(length)}
    lengths = sorted(tables)
    for i in range(1, len(node)):
        low = int(np.searchsorted(n[:i], -(-NUM * n[i] // DEN)))
        if low == i:
            continue
        mine, size, near = np.frombuffer(bits[i], np.uint64), len(bits[i]), []
        for k in reversed(lengths):
            start, table = tables[k]
            if k > length[i] or start + len(table) <= low:
                continue
            while size > k:
                mine, size = mine[: len(mine) // 2] ^ mine[len(mine) // 2 :], size // 2
            a, b = max(low, start), min(i, start + len(table))
            if a >= b:
                continue
            differ = np.bitwise_count(table[a - start : b - start] ^ mine).sum(1, dtype=np.int64)
            near.append(a + np.flatnonzero((DEN + NUM) * differ <= (DEN - NUM) * (n[a:b] + n[i])))
        near = np.sort(np.concatenate(near))
        near = near[(before[near] != before[i]) & (allow[near] >= NUM * n[i]) & (allow[i] >= NUM * n[near])]
        if names is not None:
            near = near[names[near] != names[i]]
            out += [(node[j], node[i]) for j in near.tolist() if node[j] != node[i]]
        else:
            out += [(node[j], node[i]) for j in near.tolist() if node[j] != node[i] and forest.join(node[j], node[i])]
    return out


def _pairs(labelled: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, held, now = _Forest(), [], None

        def flush() -> list[tuple]:
            if len(held) < 2 and (not held or len(held[0][3]) < 2):
                return []
            once = {}
            for n, allow, before, group in held:
                for m in group:
                    # a group by itself: every pair is to meet
                    once[m["node"]] = n, allow, before if before is not None else -(1 << 62) - 1 - len(once), m
            n, allow, before, members = zip(*once.values())
            sizes, allowed, befores = (np.array(c, np.int64) for c in (n, allow, before))
            labels = [m["label"] for m in members] if labelled else None
            return _unit_pairs(list(once), sizes, allowed, befores, [m["bits"] for m in members], labels, forest)

        for batch in batches:
            out = []
            for *key, n, allow, before, group in zip(*[c.to_pylist() for c in batch.columns]):
                if key != now:
                    out += flush()
                    held, now = [], key
                held.append((n, allow, before, group))
            if out:
                yield _edges(out)
        if out := flush():
            yield _edges(out)

    return run


def _edges(pairs: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*[(min(p), max(p)) for p in pairs])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _kept_pairs(shared: DataFrame, members: DataFrame, parts: int, labelled: bool = False) -> DataFrame:
    """``shared``: (token, gid, groups, allow, before); ``members``: (gid, n, node, bits[, label])."""
    fields = ["node", "bits", *(["label"] if labelled else [])]
    chunk = F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.ceil(F.col("_members") / MEMBERS)))
    counted = members.join(members.groupBy("gid").agg(F.count(F.lit(1)).alias("_members")), "gid")
    grouped = counted.groupBy("gid", "n", chunk.alias("_chunk"), "_members").agg(F.collect_list(F.struct(*fields)).alias("members"))
    alone = grouped.filter("_members > 1").select(F.xxhash64("gid").alias("token"), F.lit(0).cast("long").alias("p"), F.lit(0).cast("long").alias("q"), "n", (DEN * F.col("n")).alias("allow"), F.lit(None).cast("long").alias("before"), "members")
    blocks_of = F.when(F.col("groups") > UNIT, F.ceil(F.col("groups") / (UNIT // 2))).otherwise(F.lit(1))
    own = F.pmod(F.xxhash64("gid"), F.col("_blocks"))
    met = (
        shared.withColumn("_blocks", blocks_of.cast("long")).withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .select("token", "gid", "allow", "before", F.least("_own", "_other").alias("p"), F.greatest("_own", "_other").alias("q"))
        .join(grouped, "gid").select("token", "p", "q", "n", "allow", "before", "members")
    )
    units = met.unionByName(alone).repartition(parts, "token", "p", "q").sortWithinPartitions("token", "p", "q")
    return units.transform(in_arrow, _pairs(labelled), "a binary, b binary").distinct()


# -- 4. verify --------------------------------------------------------------------------------


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for batch in batches:
            for low, high, sets, first in _batch_sets(batch.column(1), words):
                part = batch.slice(low, high - low)
                keys = [n for b in _signatures(words, none)(iter([part])) for n in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys, pa.binary()),
                    pa.array([sets[a:b].tobytes() for a, b in zip(first, first[1:])], pa.binary()),
                ], ["node", "grams"])

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(DEN * both >= NUM * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])


def _verified(docs: DataFrame, pairs: DataFrame, owners: DataFrame, words: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """(a, b, linked) for every pair, and the sets (node, grams) of all nodes of pairs, some of them
    more than once; ``owners``: (node, doc_id) with one document of each node."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    ids = land(wanted.join(owners, "node"), "jaccard-wanted")
    few = ids.count() <= BROADCAST_IDS
    picked = ids.select(F.col("doc_id").alias("_id")).distinct()
    texts = docs.join(F.broadcast(picked) if few else picked, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    grams_of = texts.select("doc_id", "text").transform(in_arrow, _sets(words), "node binary, grams binary")
    found = land(grams_of.join(F.broadcast(wanted) if few else wanted, "node", "left_semi"), "jaccard-sets")
    sets = found.dropDuplicates(["node"])
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("x")), "a")
    full = left.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("y")), "b")
    return land(full.select("a", "b", "x", "y").transform(in_arrow, _verify, "a binary, b binary, linked boolean"), "jaccard-verified"), found


# -- link counts ------------------------------------------------------------------------------


def _links_of(own: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], across: bool) -> np.ndarray:
    """Documents with other sets that each set of a unit is linked with; ``across``: of the other block."""
    n = np.array([len(x) for x in sets])
    order = np.argsort(n, kind="stable")
    n, own, copies = n[order], own[order], copies[order]
    first = np.concatenate([[0], np.cumsum(n)])
    grams, ids = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    mark, links = np.zeros(len(grams), np.uint8), np.zeros(len(n), np.int64)
    for i in range(1, len(n)):
        low = int(np.searchsorted(n[:i], -(-NUM * n[i] // DEN)))
        if low == i:
            continue
        mine = ids[first[i] : first[i + 1]]
        mark[mine] = 1
        both = np.add.reduceat(mark[ids[first[low] : first[i]]], first[low:i] - first[low], dtype=np.int64)
        mark[mine] = 0
        linked = DEN * both >= NUM * (n[low:i] + n[i] - both)
        if across:
            linked &= own[low:i] != own[i]
        links[i] += copies[low:i][linked].sum()
        links[low:i][linked] += copies[i]
    out = np.empty_like(links)
    out[order] = links
    return out


def _unit_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(root, p, q, own, node, copies, grams), by unit -> (node, links) of each unit."""
    held, now = {}, None

    def flush() -> Iterator[pa.RecordBatch]:
        if len(held) > 1:
            own, copies, sets = zip(*held.values())
            links = _links_of(np.array(own), np.array(copies, np.int64), list(sets), now[1] != now[2])
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(links)], ["node", "links"])

    for batch in batches:
        for *key, own, node, copies, grams in zip(*[c.to_pylist() for c in batch.columns]):
            if key != now:
                yield from flush()
                held, now = {}, key
            held[node] = (own, copies, np.frombuffer(grams, np.uint64))
    yield from flush()


def _link_counts(to_root: DataFrame, sets: DataFrame, parts: int) -> DataFrame:
    """(node, links): documents with other sets that the documents of a node are linked with."""
    whole = to_root.groupBy("root").agg(F.count(F.lit(1)).alias("_nodes"), F.sum("n").alias("_grams")).filter("_nodes > 1")
    blocks_of = F.ceil(F.col("_grams") / UNIT_GRAMS).cast("long")
    dealt = to_root.join(whole, "root").select("node", "root", "copies", blocks_of.alias("_blocks"))
    dealt = land(dealt.withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks"))), "jaccard-dealt")
    few = dealt.count() <= BROADCAST_IDS
    units = (
        sets.join(F.broadcast(dealt) if few else dealt, "node")
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
        .select("root", F.least("_own", "_other").alias("p"), F.greatest("_own", "_other").alias("q"), "_own", "node", "copies", "grams")
        .repartition(parts, "root", "p", "q").sortWithinPartitions("root", "p", "q")
    )
    return units.transform(in_arrow, _unit_links, "node binary, links long").groupBy("node").agg(F.sum("links").alias("links"))


# -- all --------------------------------------------------------------------------------------


def _components(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, n, node, ...), then (node, doc_id, n, copies, root) of the nodes with n-grams,
    and the sets of all nodes that have a link."""
    spark = docs.sparkSession
    ship(spark)
    parts = partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    frequent = frequent_grams(docs.select("text"), words)
    signatures = land(docs.transform(in_arrow, _signatures(words, frequent), SIGNATURE), "jaccard-signatures")
    filled = signatures.filter("n > 0")
    dealt = filled.select("gid", "n", "prefix").transform(in_arrow, _deal(parts), "part int, packed binary")
    shared = land(dealt.repartitionById(parts, "part").transform(in_arrow, _shared, "token long, gid long, groups long, allow long, before long"), "jaccard-shared")
    nodes = land(
        filled.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("gid").alias("gid"), F.max("n").alias("n"), F.max("bits").alias("bits"), F.count(F.lit(1)).alias("copies")),
        "jaccard-nodes",
    )
    owners = nodes.select("node", "doc_id")
    members = nodes.select("gid", "n", "node", "bits")
    pairs = land(_kept_pairs(shared, members, parts), "jaccard-pairs")
    checked, sets = _verified(docs, pairs, owners, words, parts)
    links = checked.filter("linked").select("a", "b")
    failed = checked.filter("not linked").select("a", "b")
    roots = components(links, "jaccard-roots")
    if not failed.isEmpty():
        links = links.union(_crossing(docs, shared, members, owners, pairs, failed, roots, words, parts))
        roots = components(links, "jaccard-roots")
    to_root = nodes.join(land(roots, "jaccard-root"), "node", "left").select("node", "doc_id", "n", "copies", F.coalesce("root", "node").alias("root"))
    return signatures, to_root, sets


def jaccard_components(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of (doc_id, text)."""
    signatures, to_root, _ = _components(docs, words)
    lowest = to_root.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    component = to_root.join(lowest, "root").select("node", "component_id")
    return signatures.join(component, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def jaccard_links(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for every row of (doc_id, text); ``n_links`` counts
    the other rows that this row is linked with, those with an equal set among them."""
    signatures, to_root, sets = _components(docs, words)
    to_root = land(to_root, "jaccard-rooted")
    lowest = to_root.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    counted = to_root.join(_link_counts(to_root, sets, partitions(docs.sparkSession)), "node", "left")
    per_node = counted.join(lowest, "root").select("node", "component_id", links.alias("n_links"))
    return signatures.join(per_node, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def keep_representatives(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One document of each component, with all its columns: the smallest doc_id, nulls last, then
    the smallest key of its set. Documents without words all stay. Rows that agree in id and set
    are one document.

    Where ids are unique, the ids to drop suffice and texts are not shuffled while those may be
    broadcast; otherwise rows are told apart by id and set.
    """
    signatures, to_root, _ = _components(docs, words)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    filled = signatures.filter("n > 0").select("doc_id", "node").distinct()
    rooted = land(filled.join(to_root.select("node", "root"), "node").select("root", order.alias("key")), "jaccard-rooted")
    kept = rooted.groupBy("root").agg(F.min("key").alias("key"))
    lost = rooted.join(kept.select("key"), "key", "left_anti").select("key.doc_id", "key.node")
    rows = signatures.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("ids")).first()
    if rows.n == rows.ids:
        ids = land(lost.select(F.col("doc_id").alias("_id")), "jaccard-lost")
        ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        return docs.join(ids, docs["doc_id"].cast("long") == ids["_id"], "left_anti")
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
    )
    schema = T.StructType([packed.schema["row"], T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType())])
    keyed = packed.transform(in_arrow, _keyed(words), schema)
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("_lost.doc_id")) & (F.col("node") == F.col("_lost.node"))
    left = keyed.filter("n > 0").join(lost.select(F.struct("doc_id", "node").alias("_lost")), same, "left_anti")
    once = left.withColumn("_id", F.col("row.doc_id")).dropDuplicates(["_id", "node"])
    return once.select("row.*").unionByName(keyed.filter("n = 0").select("row.*"))


def _keyed(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node = [], []
            for part in _signatures(words, np.zeros(0, np.uint64))(iter([batch.select([1, 2])])):
                n += part.column(1).to_pylist()
                node += part.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary())], ["row", "n", "node"])

    return run


def _crossing(
    docs: DataFrame, shared: DataFrame, members: DataFrame, owners: DataFrame, pairs: DataFrame, failed: DataFrame,
    roots: DataFrame, words: int, parts: int,
) -> DataFrame:
    """Links among kept pairs that cross two components, where a written pair has failed."""
    kept = components(pairs, "jaccard-kept")
    broken = failed.select(F.col("a").alias("node")).join(kept, "node").select("root").distinct()
    open_nodes = land(kept.join(broken, "root", "left_semi").select("node"), "jaccard-open")
    label = F.coalesce("root", "node").alias("label")
    labelled = land(members.join(open_nodes, "node").join(roots, "node", "left").select("gid", "n", "node", "bits", label), "jaccard-labels")
    more = _kept_pairs(shared.join(labelled.select("gid").distinct(), "gid", "left_semi"), labelled, parts, labelled=True)
    more = land(more.join(failed, ["a", "b"], "left_anti"), "jaccard-more")
    return _verified(docs, more, owners, words, parts)[0].filter("linked").select("a", "b")
