"""Balanced label propagation: documents to shards of equal bytes. DataFrame functions only.

``shard_documents`` links documents of one group (equal texts, or any key the caller names) and cuts
as few of those links as it can while the shards' bytes stay equal.

1. Linked documents start in shards by hash. Each round joins them to the counts of their group's
   members by shard: a document wishes to move to the shard that holds most of them, among those
   with room (of shards that hold equally many, all wish for the same one). A shard takes what it gives to another in exchange, and beyond that what it has room
   for; large gains go first. Rounds end when no one wishes to move, or after ``rounds``.
2. What a shard holds beyond its fair share (and ``slack``) is let go.
3. Documents without links, and those let go, fill the shards up to one level: large ones first,
   then the others, each by its place in a running total of bytes.
4. Slots number a shard's documents from 0.

Wishes and links are counted by group and shard, never as pairs; a group with a third of all
documents is summed before it is shuffled, and its documents stay where they are while the counts
are broadcast (measured), else adaptive execution splits its join. Running totals go in two steps
over ranges of ``RANGE_ROWS`` rows by hash. The driver sees one row for each shard. Every round's
labels are written to the shared folder.

Defined cases: a null text has no bytes (size 1, crc32 0) and is equal to the empty text; null and repeated
ids are documents like any other, each row by itself; a document larger than a shard's share makes
its shard larger; with fewer documents than shards some stay empty; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import attach
from .common import land

SHARDS = 16
ROUNDS = 12
SLACK = 0.01
OPEN = 0.002  # of a fair share: a shard with less room takes no one in but in exchange
LARGE = 0.001  # of a fair share: documents that are dealt before the others
RANGE_ROWS = 20_000
STEPS = 1 << 24


def text_key() -> Column:
    """Group of a document: its text."""
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _hash(modulus: int | Column, *of) -> Column:
    return F.pmod(F.xxhash64(*of), F.lit(modulus) if isinstance(modulus, int) else modulus)


def _loads(rows: DataFrame, shards: int) -> list[int]:
    """Bytes of each shard: one row a shard comes to the driver."""
    got = {r["shard"]: r["bytes"] for r in rows.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
    return [int(got.get(t) or 0) for t in range(shards)]


def running(rows: DataFrame, by: Sequence[str], value: Column, count: int) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over the rows of the same ``by`` that come
    earlier in hash order. ``count`` is about their number."""
    ranges = max(1, count // RANGE_ROWS)
    placed = rows.withColumn("_range", _hash(ranges, "row")).withColumn("_value", value)
    sums = placed.groupBy(*by, "_range").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*by, "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, "_range").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    met = attach(summed, offsets, [*by, "_range"])
    return met.withColumn("before", F.col("_inside") + F.col("_offset")).drop("_range", "_value", "_inside", "_offset")


# -- rounds -----------------------------------------------------------------------------------


def _wishes(state: DataFrame, open_shards: list[int]) -> DataFrame:
    """Linked documents with the shard they wish for (``to``, else null) and the gain's size."""
    counts = state.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"))
    is_open = F.col("shard").isin(open_shards).alias("open")
    pull = F.struct("n", is_open, F.xxhash64("grp", "shard").alias("tie"), "shard")
    pulls = counts.groupBy("grp").agg(F.collect_list(pull).alias("pulls")).filter(F.size("pulls") > 1)
    met = attach(state, pulls, ["grp"])
    best = F.array_max(F.filter("pulls", lambda p: p["open"]))
    own = F.array_max(F.filter("pulls", lambda p: p["shard"] == F.col("shard")))
    judged = met.withColumn("_best", best).withColumn("_own", own)
    better = F.col("_best") > F.col("_own")
    return judged.select(
        "row", "grp", "size", "shard", F.when(better, F.col("_best.shard")).alias("to"),
        F.when(better, F.floor(F.log2(F.col("_best.n") - F.col("_own.n") + 1))).cast("int").alias("gain"),
    )


def _admitted(wishes: DataFrame, room: list[int]) -> DataFrame:
    """(shard, to, gain, share): the part of these wishes that is granted. At most one row for each
    pair of shards and power of two of the gain."""
    asked = wishes.filter("to is not null").groupBy("shard", "to", "gain").agg(F.sum("size").alias("bytes"))
    pairs = asked.groupBy("shard", "to").agg(F.sum("bytes").alias("out"))
    back = pairs.select(F.col("shard").alias("to"), F.col("to").alias("shard"), F.col("out").alias("in"))
    both = pairs.join(back, ["shard", "to"], "left").withColumn("swap", F.least("out", F.coalesce("in", F.lit(0))))
    free = F.element_at(F.array(*[F.lit(float(max(0, r))) for r in room]), F.col("to") + 1)
    beyond = F.sum(F.col("out") - F.col("swap")).over(Window.partitionBy("to"))
    allowed = both.select(
        "shard", "to", (F.col("swap") + (F.col("out") - F.col("swap")) * F.least(F.lit(1.0), free / F.greatest(beyond, F.lit(1)))).alias("allowed"),
    )
    larger = Window.partitionBy("shard", "to").orderBy(F.desc("gain")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("bytes").over(larger), F.lit(0))
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("allowed") - F.col("_ahead")) / F.col("bytes")))
    return asked.withColumn("_ahead", ahead).join(allowed, ["shard", "to"]).select("shard", "to", "gain", share.alias("share"))


def propagate(linked: DataFrame, shards: int, fair: float, rounds: int = ROUNDS, slack: float = SLACK) -> DataFrame:
    """Labels of linked documents (row, grp, size): the same rows with ``shard``."""
    state = land(linked.select("row", "grp", "size", _hash(shards, "row").cast("int").alias("shard")), "shard-labels")
    loads = _loads(state, shards)
    for nth in range(rounds):
        room = [int(fair * (1 + slack) - x) for x in loads]
        open_shards = [t for t in range(shards) if room[t] >= fair * OPEN]
        if not open_shards:
            break
        wishes = land(_wishes(state, open_shards), "shard-wishes")
        if wishes.filter("to is not null").isEmpty():
            break
        judged = attach(wishes, _admitted(wishes, room), ["shard", "to", "gain"])
        granted = _hash(STEPS, "row", F.lit(nth)) < F.coalesce("share", F.lit(0.0)) * STEPS
        state = land(judged.select("row", "grp", "size", F.when(granted, F.col("to")).otherwise(F.col("shard")).alias("shard")), "shard-labels")
        loads = _loads(state, shards)
    return state


# -- balance ----------------------------------------------------------------------------------


def levels(loads: Sequence[int], free: int) -> list[int]:
    """What each shard takes of ``free`` bytes so that the lowest shards reach one level."""
    order = sorted(loads)
    height, lower = order[0], 0
    for k in range(1, len(order) + 1):
        upper = order[k] if k < len(order) else None
        if upper is None or lower + (upper - height) * k >= free:
            height += (free - lower) / k
            break
        lower += (upper - height) * k
        height = upper
    takes, given, exact = [], 0, 0.0
    for x in loads:  # whole bytes that sum up to ``free``
        exact += max(0.0, height - x)
        takes.append(round(exact) - given)
        given += takes[-1]
    takes[takes.index(max(takes))] += free - given
    return takes


def _deal(rows: DataFrame, loads: Sequence[int], shards: int) -> tuple[DataFrame, list[int]]:
    """``rows`` (row, size) with a shard each, and what the shards then hold."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    takes, ends = levels(loads, int(total["bytes"])), []
    for take in takes[:-1]:
        ends.append((ends[-1] if ends else 0) + take)
    at = running(rows.withColumn("_one", F.lit(0)), ["_one"], F.col("size"), total["n"])
    # a document belongs where its middle lies
    middle = F.col("before") + F.floor(F.col("size") / 2)
    bounds = F.array(*[F.lit(x).cast("long") for x in ends]) if ends else F.array().cast("array<bigint>")
    shard = F.size(F.filter(bounds, lambda end: end <= middle)).cast("int")
    dealt = land(at.select("row", "size", shard.alias("shard")), "shard-dealt")
    more = _loads(dealt, shards)
    return dealt, [a + b for a, b in zip(loads, more)]


def _let_go(state: DataFrame, loads: list[int], limit: int, shards: int, count: int) -> DataFrame:
    """(row, size, shard): shard is null for what lies beyond ``limit`` bytes of its shard."""
    full = [t for t in range(shards) if loads[t] > limit]
    if not full:
        return state.select("row", "size", "shard")
    over = running(state.filter(F.col("shard").isin(full)), ["shard"], F.col("size"), count)
    kept = over.select("row", "size", F.when(F.col("before") < limit, F.col("shard")).alias("shard"))
    return land(kept.unionByName(state.filter(~F.col("shard").isin(full)).select("row", "size", "shard")), "shard-kept")


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, group: Column | None = None, rounds: int = ROUNDS, slack: float = SLACK,
) -> DataFrame:
    """(doc_id, size, text_crc32, grp, shard, slot) for every row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = (group if group is not None else text_key()).cast("string")
    rows = land(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("grp"), F.monotonically_increasing_id().alias("row"),
    ), "shard-rows")
    whole = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    fair, count = whole["bytes"] / shards, whole["n"]
    groups = rows.filter("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("grp", F.lit(True).alias("linked"))
    known = land(attach(rows.select("row", "grp", "size"), groups, ["grp"]), "shard-links")
    state = propagate(known.filter("linked"), shards, fair, rounds, slack)
    kept = _let_go(state, _loads(state, shards), int(fair * (1 + slack)), shards, count)
    placed = kept.filter("shard is not null")
    loads = _loads(placed, shards)
    rest = known.filter("linked is null").select("row", "size").unionByName(kept.filter("shard is null").select("row", "size"))
    for part in (F.col("size") > int(fair * LARGE), F.col("size") <= int(fair * LARGE)):
        dealt, loads = _deal(rest.filter(part), loads, shards)
        placed = placed.unionByName(dealt)
    labels = running(land(placed, "shard-placed"), ["shard"], F.lit(1).cast("long"), count)
    joined = rows.join(labels.select("row", "shard", F.col("before").alias("slot")), "row")
    return joined.select("doc_id", "size", "text_crc32", "grp", "shard", "slot")


def cut_links(sharded: DataFrame) -> DataFrame:
    """One row: ``links`` between documents of one group, and how many of them are ``cut``. Counted
    from group sizes, not from pairs."""
    counts = sharded.filter("grp is not null").groupBy("grp", "shard").agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("n"))
    groups = counts.groupBy("grp").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("together"))
    pairs = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return groups.agg(
        pairs(F.col("n") * (F.col("n") - 1) / 2).alias("links"), pairs((F.col("n") * F.col("n") - F.col("together")) / 2).alias("cut"),
    )
