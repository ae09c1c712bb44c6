"""Suffix-array removal of repeated passages.

A byte is removed if a string of ``width`` bytes that covers it also starts earlier (in a smaller
doc_id, or before in the same document). The suffixes, cut to ``width`` bytes, are put in order so
that equal ones are neighbours: sampled splitters range-partition them by their leading tokens,
each bucket sorts its own by multikey quicksort (token by token, only ties go on to the next
token), neighbours are compared, and what stands at the boundaries of buckets is compared across
them. Only the first of equal suffixes stays.

Suffixes are not sorted one by one. The tokens of a suffix are hashes: its *leading token* is the
least hash of the K-grams inside it, which neighbouring suffixes share, so a *run* of suffixes
with one leading token is one record; its second token is the hash of the whole run's bytes, then
come document and position. Records that agree in both tokens are equal runs, and all but the
first are removed whole. A leading token with one run only is unique. The rest, runs that agree in
the leading token alone (passages that begin or end inside), go to the next *level* with a larger
K, hence shorter runs; at the last level K is the width and a run is one suffix, so the result is
exact. Equal strings always have equal tokens; different ones differ in 128 bits of hashes.

A hot passage is spread over buckets, since splitters go on to document and position. Texts are
scanned once for records, and shuffled (compressed) twice: to cut out the runs that need another
level, and for the result. Nothing is broadcast but the splitters and, while they are fewer than
``BROADCAST_IDS``, the ids of documents to look at again.

Defined cases: a null text is empty; matches never cross documents; texts shorter than the width
lose nothing; a null doc_id sorts before all others; rows with one doc_id are ordered by a hash of
their text, and rows that agree in both are one document, each with its result; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import blocks, in_arrow, land, mix, partitions, powers, random_table, ship, texts_of

WIDTH = 100
LEVELS = (32, 80, 100)  # K of each level; the last is the width
PIECE = 1 << 18  # bytes hashed at once
SAMPLE_ONE_IN = 50  # rows that are sampled for splitters
SAMPLE_KEYS = 200  # sampled keys for each bucket, at most
BROADCAST_IDS = 1_000_000
KEY = "v long, h long, d long, t long, pos long"
RECORDS = f"kind int, {KEY}, n long"
REMOVED, OPEN, EDGE = 0, 1, 2


# -- records ----------------------------------------------------------------------------------


def pieces(offsets: np.ndarray, width: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row behind the last, begin, end) of stretches of about ``PIECE`` bytes: whole
    rows, or a part of a longer one. Parts overlap, so each suffix lies whole in one of them."""
    for low, high in blocks(offsets, PIECE, 1 << 30):
        begin, end = int(offsets[low]), int(offsets[high])
        if high - low > 1 or end - begin <= PIECE:
            yield low, high, begin, end
        else:
            for at in range(begin, max(begin + 1, end - width + 1), PIECE):
                yield low, high, at, min(at + PIECE + width - 1, end)


def runs(data: np.ndarray, offsets: np.ndarray, width: int, k: int) -> tuple[np.ndarray, ...] | None:
    """(leading token, hash of the bytes, first suffix, suffixes) of the runs of some rows."""
    n = len(data)
    if n < width:
        return None
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(random_table(5)[data] * up[:n], out=sums[1:])
    grams = mix((sums[k:] - sums[:-k]) * down[: n - k + 1])
    least, size, w = grams, 1, width - k + 1
    while size * 2 <= w:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if size < w:
        least = np.minimum(least[: len(least) - (w - size)], least[w - size :])
    total = len(least)
    # suffixes that would reach into the next row are none
    crossing = np.zeros(total + 1, np.int64)
    np.add.at(crossing, np.minimum(np.maximum(offsets[:-1], offsets[1:] - width + 1), total), 1)
    np.add.at(crossing, np.minimum(offsets[1:], total), -1)
    real = np.cumsum(crossing[:-1]) == 0
    new = np.ones(total, bool)
    # a run ends where its least K-gram changes or is left behind, so no suffix occurs twice in it
    new[1:] = (least[1:] != least[:-1]) | (grams[: total - 1] == least[:-1])
    new[offsets[:-1][offsets[:-1] < total]] = True
    first = np.flatnonzero(new & real)
    ends = np.append(np.flatnonzero(new | ~real), total)
    stop = ends[np.searchsorted(ends, first, "right")]
    return least[first], mix((sums[stop + width - 1] - sums[first]) * down[first]), first, stop - first


def _records(batch: pa.RecordBatch, width: int, k: int) -> tuple[np.ndarray, ...] | None:
    """v, h, index of the row, position, suffixes of all runs of a batch (d, t, base, raw)."""
    data, offsets = texts_of(batch.column(3).cast(pa.large_binary()).view(pa.large_string()))
    base = batch.column(2).to_numpy()
    out = []
    with np.errstate(over="ignore"):
        for low, high, begin, end in pieces(offsets, width):
            cut = np.clip(offsets[low : high + 1] - begin, 0, end - begin)
            if (got := runs(data[begin:end], cut, width, k)) is None:
                continue
            v, h, first, n = got
            row = low + np.searchsorted(cut, first, "right") - 1
            out.append((v, h, row, base[row] + first + begin - offsets[row], n))
    return tuple(map(np.concatenate, zip(*out))) if out else None


def _sampled(width: int, k: int, one_in: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if (got := _records(batch, width, k)) is None:
                continue
            v, h, row, pos, _ = got
            keep = np.flatnonzero(mix(h + np.uint64(17)) % np.uint64(one_in) == 0)
            d, t = batch.column(0).to_numpy()[row[keep]], batch.column(1).to_numpy()[row[keep]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v[keep].view(np.int64)), pa.array(h[keep].view(np.int64)), pa.array(d), pa.array(t), pa.array(pos[keep])],
                ["v", "h", "d", "t", "pos"],
            )

    return run


def splitters(texts: DataFrame, width: int, k: int, parts: int) -> list[tuple]:
    """Keys that cut the records into ``parts`` buckets of about equal size. A bounded sample."""
    chosen = texts.filter(F.pmod(F.xxhash64("d", "t", "base"), F.lit(SAMPLE_ONE_IN)) == 0)
    keys = chosen.transform(in_arrow, _sampled(width, k, 1), KEY)
    limit = SAMPLE_KEYS * parts
    # the order of v is that of unsigned numbers
    got = keys.orderBy(F.xxhash64("v", "pos", "d")).limit(limit).collect()
    flat = sorted((r.v % (1 << 64), r.h % (1 << 64), r.d, r.t, r.pos) for r in got)
    return [flat[i * len(flat) // parts] for i in range(1, parts)] if flat else []


def bucket_of(cuts: list[tuple], v, h, d, t, pos) -> np.ndarray:
    """Number of cuts that are at or below each key."""
    cut_v = np.array([c[0] for c in cuts], np.uint64)
    low, high = np.searchsorted(cut_v, v, "left"), np.searchsorted(cut_v, v, "right")
    tied = np.flatnonzero(high > low)
    for i in tied.tolist():
        key = (int(h[i]), int(d[i]), int(t[i]), int(pos[i]))
        while low[i] < high[i] and cuts[low[i]][1:] <= key:
            low[i] += 1
    return low


def _deal(width: int, k: int, cuts: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if (got := _records(batch, width, k)) is None:
                continue
            v, h, row, pos, n = got
            ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            part = bucket_of(cuts, v, h, ids[row], ties[row], pos)
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(len(cuts) + 2))
            numbers, packed = [], []
            for p, a, b in zip(range(len(cuts) + 1), ends, ends[1:]):
                if a < b:
                    at = order[a:b]
                    rows, index = np.unique(row[at], return_inverse=True)
                    numbers.append(p)
                    packed.append(_pack(ids[rows], ties[rows], v[at], h[at], pos[at], n[at], index))
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())], ["part", "packed"])

    return run


def _pack(d, t, v, h, pos, n, index) -> bytes:
    wide = "<u8" if len(pos) and pos.max() >= 1 << 32 else "<u4"
    ids = zlib.compress(np.diff(d, prepend=np.int64(0)).tobytes(), 1)
    head = np.array([len(d), len(v), len(ids), wide == "<u8"], "<u8").tobytes()
    return b"".join([
        head, ids, t.astype("<i8").tobytes(), v.tobytes(), h.tobytes(), pos.astype(wide).tobytes(),
        n.astype("<u2").tobytes(), index.astype("<u4" if len(d) > 65_536 else "<u2").tobytes(),
    ])


def _unpack(raw: bytes) -> tuple[np.ndarray, ...]:
    docs, size, ids, wide = np.frombuffer(raw, "<u8", 4).astype(int).tolist()
    d = np.cumsum(np.frombuffer(zlib.decompress(raw[32 : 32 + ids]), np.int64))
    at, out = 32 + ids, []
    for kind, n in (("<i8", docs), ("<u8", size), ("<u8", size), ("<u8" if wide else "<u4", size), ("<u2", size), ("<u4" if docs > 65_536 else "<u2", size)):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    t, v, h, pos, n, index = out
    return v, h, d[index], t[index].astype(np.int64), pos.astype(np.int64), n.astype(np.int64)


# -- buckets ----------------------------------------------------------------------------------


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order by the first column; only rows that tie in it are ordered by the next, and so on."""
    order = np.argsort(columns[0], kind="stable")
    group = _groups(columns[0][order])
    for column in columns[1:]:
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        rows = order[tied]
        inner = np.lexsort((column[rows], group[tied]))
        order[tied] = rows[inner]
        # groups keep their places; equal neighbours of a group stay one group
        value = column[order]
        new = np.ones(len(order), bool)
        new[1:] = (group[1:] != group[:-1]) | (value[1:] != value[:-1])
        group = np.cumsum(new) - 1
    return order


def _groups(sorted_: np.ndarray) -> np.ndarray:
    new = np.ones(len(sorted_), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    return np.cumsum(new) - 1


def _sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed and open runs of a bucket; the first runs of its outer leading tokens are marked
    as edges, since other buckets may hold the same token."""
    parts = [_unpack(raw) for batch in batches for raw in batch.column(1).to_pylist()]
    if not parts:
        return
    columns = list(map(np.concatenate, zip(*parts)))
    del parts
    order = multikey_order(columns[:5])
    v, h, d, t, pos, n = (c[order] for c in columns)
    del columns
    lead = np.ones(len(v), bool)
    lead[1:] = v[1:] != v[:-1]
    head = lead.copy()
    head[1:] |= h[1:] != h[:-1]
    group = np.cumsum(lead) - 1
    several = np.bincount(group, head)[group] > 1
    outer = (group == 0) | (group == group[-1])
    again = np.zeros(len(v), bool)  # the same run of the same document, from a row that repeats
    again[1:] = ~head[1:] & (d[1:] == d[:-1]) & (t[1:] == t[:-1]) & (pos[1:] == pos[:-1])
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    again |= ~head & (d == d[first]) & (t == t[first]) & (pos == pos[first])
    kind = np.where(~head & ~again, REMOVED, np.where(head & outer, EDGE, np.where(head & several, OPEN, -1)))
    chosen = np.flatnonzero(kind >= 0)
    for low in range(0, len(chosen), 20_000):
        at = chosen[low : low + 20_000]
        yield pa.RecordBatch.from_arrays([
            pa.array(kind[at].astype(np.int32)), pa.array(v[at].view(np.int64)), pa.array(h[at].view(np.int64)), pa.array(d[at]),
            pa.array(t[at].astype(np.int64)), pa.array(pos[at]), pa.array(n[at]),
        ], ["kind", "v", "h", "d", "t", "pos", "n"])


def sort_level(texts: DataFrame, width: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(removed, open) runs (d, t, pos, n) of ``texts`` (d, t, base, raw)."""
    parts = partitions(texts.sparkSession)
    cuts = splitters(texts, width, k, parts)
    dealt = texts.transform(in_arrow, _deal(width, k, cuts), "part int, packed binary").repartitionById(parts, "part")
    sorted_ = land(dealt.transform(in_arrow, _sort_bucket, RECORDS), "suffix-runs")
    run = ["d", "t", "pos", "n"]
    edges = sorted_.filter(F.col("kind") == EDGE)
    place = F.struct("d", "t", "pos")
    firsts = edges.groupBy("v", "h").agg(F.min(F.struct("d", "t", "pos", "n")).alias("first"))
    firsts = land(firsts, "suffix-firsts")
    late = edges.join(firsts, ["v", "h"]).filter(place > F.struct("first.d", "first.t", "first.pos"))
    several = firsts.groupBy("v").agg(F.count(F.lit(1)).alias("_runs")).filter("_runs > 1")
    open_edges = firsts.join(several, "v", "left_semi").select("first.*")
    removed = sorted_.filter(F.col("kind") == REMOVED).select(*run).unionByName(land(late.select(*run), "suffix-late"))
    open_ = sorted_.filter(F.col("kind") == OPEN).select(*run).unionByName(land(open_edges.select(*run), "suffix-open"))
    return removed, open_


# -- texts and runs together ------------------------------------------------------------------


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        raw = [press.compress(x) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], ["d", "t", "raw"])


def _beside(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Runs of each document, then its (compressed) text, in one partition, in order."""
    packed = texts.select("d", "t", "raw").transform(in_arrow, _squeeze, "d long, t long, raw binary")
    null = F.lit(None)
    both = found.select("d", "t", "pos", "n", null.cast("binary").alias("raw")).unionByName(
        packed.select("d", "t", null.cast("long").alias("pos"), null.cast("long").alias("n"), "raw")
    )
    ordered = both.repartition(partitions(texts.sparkSession), "d", "t").sortWithinPartitions("d", "t", F.col("pos").asc_nulls_last())
    return ordered.select("d", "t", "pos", "n", "raw")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(d, t, bytes, positions, suffixes) of each text of ``_beside``."""
    import zstandard

    open_, now, pos, n = zstandard.ZstdDecompressor(), None, [], []
    for batch in batches:
        for d, t, p, k, raw in zip(*[c.to_pylist() for c in batch.columns]):
            if (d, t) != now:
                now, pos, n = (d, t), [], []
            if raw is None:
                pos.append(p)
                n.append(k)
            else:
                yield d, t, open_.decompress(raw), np.array(pos, np.int64), np.array(n, np.int64)


def _cut(width: int):
    """Bytes of each run; overlapping and touching runs become one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def flush() -> pa.RecordBatch:
            d, t, base, raw = zip(*held)
            return pa.RecordBatch.from_arrays(
                [pa.array(d, pa.int64()), pa.array(t, pa.int64()), pa.array(base, pa.int64()), pa.array(raw, pa.binary())], ["d", "t", "base", "raw"],
            )

        for d, t, text, pos, n in _documents(batches):
            if not len(pos) or (d, t) == last:  # a row that repeats adds nothing
                continue
            last = (d, t)
            new = np.ones(len(pos), bool)
            new[1:] = pos[1:] > np.maximum.accumulate(pos + n)[:-1]
            starts = np.flatnonzero(new)
            ends = np.maximum.reduceat(pos + n, starts)
            for a, b in zip(pos[starts].tolist(), ends.tolist()):
                held.append((d, t, a, text[a : b + width - 1]))
                size += b - a + width
            if size > 1 << 22:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


def segments(texts: DataFrame, open_: DataFrame, width: int) -> DataFrame:
    """(d, t, base, raw): the bytes of open runs. Documents without one are left out before the
    shuffle while the ids of the others may be broadcast."""
    ids = land(open_.select("d").distinct(), "suffix-ids")
    if ids.count() <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(ids), "d", "left_semi")
    return land(_beside(texts, open_).transform(in_arrow, _cut(width), "d long, t long, base long, raw binary"), "suffix-segments")


def _result(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 4 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["d", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

        for d, _, text, pos, n in _documents(batches):
            kept, gone, spans = text, 0, 0
            if len(pos):
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, pos, 1)
                np.add.at(edge, pos + n + width - 1, -1)
                covered = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
                gone, spans = int(covered.sum()), int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
            rows.append((d, len(text), gone, spans, hashlib.sha256(kept).hexdigest()))
            if len(rows) >= 2000:
                yield flush()
                rows = []
        if rows:
            yield flush()

    return run


def dedup_passages(docs: DataFrame, width: int = WIDTH, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of (doc_id, text)."""
    if levels[-1] != width or width > 65_535:
        raise ValueError("the last level must be the width, of 65,535 bytes at most")
    ship(docs.sparkSession)
    no_id = -(1 << 63)
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(no_id)).alias("d"), F.xxhash64(raw).alias("t"), F.lit(0).cast("long").alias("base"), raw.alias("raw"),
    )
    gone, source = None, texts
    for k in levels:
        removed, open_ = sort_level(source, width, k)
        gone = removed if gone is None else gone.unionByName(removed)
        if k == width:
            break
        source = segments(texts, open_, width) if source is texts else _narrow(source, open_, width)
    done = _beside(texts, gone).transform(in_arrow, _result(width), "d long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    doc_id = F.when(F.col("d") != no_id, F.col("d")).alias("doc_id")
    return done.select(doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _narrow(source: DataFrame, open_: DataFrame, width: int) -> DataFrame:
    """Open runs of the next level, cut from the segments of this one."""
    spans = source.select("d", "t", "base", (F.col("base") + F.length("raw") - width).alias("_last"), "raw")
    wanted = open_.select(F.col("d").alias("_d"), F.col("t").alias("_t"), "pos", "n")
    inside = (F.col("d") == F.col("_d")) & (F.col("t") == F.col("_t")) & (F.col("pos") >= F.col("base")) & (F.col("pos") <= F.col("_last"))
    piece = F.substring(F.col("raw"), (F.col("pos") - F.col("base") + 1).cast("int"), (F.col("n") + width - 1).cast("int"))
    return land(wanted.join(spans, inside).select("d", "t", F.col("pos").alias("base"), piece.alias("raw")), "suffix-segments")
