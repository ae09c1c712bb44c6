"""Exact top-k search: tiles of queries and shards, partial selection, tree merging.

Vectors become integers, floor(64 * x). Candidates are dealt by hash into shards of about
``SHARD_ROWS`` rows and packed into matrices; queries are packed into blocks of ``QUERY_ROWS``.
Each (block, shard) pair is one row of work: one matrix product and a partial selection that keeps
k candidates of the shard for each query of the block. The lists are merged in rounds of
``FAN_IN`` shards; Spark cuts each list to k below the shuffle as well (group limit).

A tile holds a bounded number of rows, so memory does not follow the data. The stated query set is
scored against all rows, in blocks; nothing is broadcast or collected.

Defined cases: a vector that is null, or holds a null or a non-finite component, or has a null
vec_id, takes no part; an empty vector scores 0 against empty vectors; only vectors of one length
are compared; rows that share the query's vec_id are its own row and no candidates for it; a query
that is repeated row for row is answered once; a repeated candidate counts as often as it occurs.
Scores beyond a long stop at its ends. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import in_arrow, ship

K = 20
SCALE = 64
SHARD_ROWS = 4096
QUERY_ROWS = 512
FAN_IN = 8
PACKED = "no long, dim int, n int, ids binary, vectors binary"
HITS = "query_id long, query_no long, shard long, vec_id long, score long"
LONG = np.iinfo(np.int64)


def valid(vector: Column) -> Column:
    """True for vectors that take part."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector.cast("array<double>"), fine), F.lit(False))


def _pack(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with one number and length, as matrices of ``limit`` rows at most."""
    names = ["no", "dim", "n", "ids", "vectors"]
    for batch in batches:
        if not batch.num_rows:
            continue
        no, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        lists = batch.column(2)
        width = np.diff(lists.offsets.to_numpy())
        flat, begin = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(width)])
        cut = np.flatnonzero((np.diff(no) != 0) | (np.diff(width) != 0)) + 1
        for low, high in zip([0, *cut], [*cut, len(no)]):
            for a in range(low, high, limit):
                b = min(a + limit, high)
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(no[a])], pa.int64()), pa.array([int(width[a])], pa.int32()), pa.array([b - a], pa.int32()),
                    pa.array([ids[a:b].astype("<i8").tobytes()], pa.binary()),
                    pa.array([flat[begin[a] : begin[b]].astype("<f8").tobytes()], pa.binary()),
                ], names)


def _integers(raw: bytes, n: int, dim: int) -> np.ndarray:
    return np.floor(np.frombuffer(raw, "<f8").reshape(n, dim) * SCALE)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of rows. Exact: in doubles while every partial sum stays below
    2 ** 53, in longs below 2 ** 63, else in Python's integers."""
    bound = (np.abs(q).max(initial=0) or 1) * (np.abs(c).max(initial=0) or 1) * max(1, q.shape[1])
    if bound < 2.0**53:
        return (q @ c.T).astype(np.int64)
    if bound < 2.0**62:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    return np.clip(whole(q) @ whole(c).T, LONG.min, LONG.max).astype(np.int64) if q.shape[1] else np.zeros((len(q), len(c)), np.int64)


def select(score: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row the columns of its k best scores (ties: the first columns), not its own."""
    out, n = [], score.shape[1]
    for row, mine in zip(score, own):
        open_ = np.flatnonzero(~mine) if mine.any() else np.arange(n)
        s = row[open_]
        if len(s) > k:
            least = -np.partition(-s.astype(np.float64), k - 1)[k - 1] if np.abs(s).max() < 2**53 else np.sort(s)[-k]
            above = np.flatnonzero(s > least)
            level = np.flatnonzero(s == least)[: k - len(above)]
            open_ = open_[np.concatenate([above, level])]
        out.append(open_)
    return out


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in HITS.split(", ")]
        for batch in batches:
            for shard, block, dim, qn, qids, qv, cn, cids, cv in zip(*[c.to_pylist() for c in batch.columns]):
                qi, ci = np.frombuffer(qids, "<i8"), np.frombuffer(cids, "<i8")
                order = np.argsort(ci, kind="stable")
                ci, c = ci[order], _integers(cv, cn, dim)[order]
                score = scores(_integers(qv, qn, dim), c)
                best = select(score, qi[:, None] == ci[None, :], k)
                n = [len(b) for b in best]
                cols, rows = np.concatenate(best), np.repeat(np.arange(qn), n)
                yield pa.RecordBatch.from_arrays([
                    pa.array(qi[rows]), pa.array(block * QUERY_ROWS + rows), pa.array(np.full(len(cols), shard)),
                    pa.array(ci[cols]), pa.array(score[rows, cols]),
                ], names)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of (vec_id, embedding) rows against all ``vectors``."""
    spark = vectors.sparkSession
    ship(spark)

    def taking_part(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
        ).filter(F.col("vec_id").isNotNull() & valid(F.col("embedding")))

    def packed(df: DataFrame, rows: int, limit: int, key: Column) -> DataFrame:
        parts = max(1, -(-rows // limit))
        return (
            df.select(F.pmod(key, F.lit(parts)).alias("no"), "vec_id", "embedding")
            .repartition(parts, "no").sortWithinPartitions("no", F.size("embedding"), "vec_id")
            .transform(in_arrow, lambda batches: _pack(batches, limit), PACKED)
        )

    candidates, asked = taking_part(vectors), taking_part(queries).distinct()
    n, m = candidates.count(), asked.count()
    shards = packed(candidates, n, SHARD_ROWS, F.xxhash64("vec_id", "embedding")).alias("c")
    blocks = packed(asked, m, QUERY_ROWS, F.xxhash64("vec_id", "embedding"))
    # a number for each block, so that equal queries of different length stay apart
    blocks = blocks.withColumn("block", F.xxhash64("ids", "vectors") % (1 << 40))
    shard_numbers = F.sequence(F.lit(0).cast("long"), F.lit(max(1, -(-n // SHARD_ROWS)) - 1).cast("long"))
    asked_of = blocks.withColumn("shard", F.explode(shard_numbers)).alias("q")
    tiles = shards.join(asked_of, (F.col("c.no") == F.col("q.shard")) & (F.col("c.dim") == F.col("q.dim"))).select(
        F.col("c.no").alias("shard"), "q.block", F.col("q.dim"), F.col("q.n").alias("qn"), F.col("q.ids").alias("qids"),
        F.col("q.vectors").alias("qv"), F.col("c.n").alias("cn"), F.col("c.ids").alias("cids"), F.col("c.vectors").alias("cv"),
    )
    hits = tiles.repartition(max(1, -(-n // SHARD_ROWS) * -(-m // QUERY_ROWS)), "shard", "block").transform(in_arrow, _tiles(k), HITS)
    left, best = max(1, -(-n // SHARD_ROWS)), (F.desc("score"), "vec_id")
    while True:
        window = Window.partitionBy("query_id", "query_no", "shard").orderBy(*best)
        hits = hits.withColumn("shard", F.floor(F.col("shard") / FAN_IN)).withColumn("rank", F.row_number().over(window))
        hits, left = hits.filter(F.col("rank") <= k), -(-left // FAN_IN)
        if left == 1:
            return hits.select("query_id", "rank", "vec_id", "score")
