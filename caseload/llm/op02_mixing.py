"""Mixing sources to target weights with a low-discrepancy schedule. DataFrame functions only.

``mix_targets`` gives each source its share of all words: by weight, at most ``epochs`` times its
own size, the excess shared again by weight until no source is above its limit. ``mix_schedule``
cuts the mix into slots of ``block_words`` words: slot j takes point j of the golden-ratio
sequence, the cumulative targets map it to a source, and its rank among the source's slots names
the block it takes. ``mix_words`` lays each source's documents end to end in a shuffled order,
cuts that stream into blocks of equal size, joins slots to blocks and sums what each document
gives.

The golden-ratio sequence is kept in integers, so reruns and other engines agree to the last bit:
multiples of a Fibonacci number modulo the next one, whose ratio has only ones in its continued
fraction, so that no number of slots leaves a wide gap. Running totals go in two steps (chunks of
slots, ranges of the shuffled order whose number follows the source's rows), so a source with a third
of all rows is spread over many tasks; windows without a chunk see one row for each source.

Defined cases: a null text has size 0 and gives no words; a null source is a source of its own,
last in order; repeated rows each count and a null doc_id is a document like any other; a source
without words has target 0; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import land

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)  # by source in code point order, repeating
EPOCHS = 3
BLOCK_WORDS = 32
FIBONACCI = (2971215073, 1836311903)  # points and step, F(47) and F(46); their product is below 2 ** 63
CELLS = 4096  # cells of the unit interval that slots and sources meet in
BROADCAST_ROWS = 1_000_000
CHUNK = 1 << 14  # slots that are ranked in one window
RANGE_ROWS = 2_000  # documents of a source whose running total is taken in one window


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of each document."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def mix_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, rows, source_size, weight, target). One row for each source.

    A source reaches its limit the earlier, the smaller limit / weight is: in that order the first
    sources are full, and the others share the rest by weight.
    """
    totals = sized.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    nth = (F.row_number().over(order) - 1) % len(weights)
    weighed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), nth + 1).cast("long"))
    limit = F.col("source_size") * epochs
    by_level = Window.orderBy(F.col("_limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = (
        weighed.withColumn("_limit", limit)
        .withColumn("_full", F.coalesce(F.sum("_limit").over(before), F.lit(0)))
        .withColumn("_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("_all", F.sum("source_size").over(everything))
        .withColumn("_rest", F.col("_all") - F.col("_full"))
        .withColumn("_above", F.col("_limit") * F.col("_weight") <= F.col("_rest") * F.col("weight"))
    )
    rest = F.min(F.when(~F.col("_above"), F.struct(F.col("_full"), F.col("_rest"), F.col("_weight")))).over(everything)
    share = F.col("_open._rest").cast("double") * F.col("weight") / F.col("_open._weight")
    target = F.when(F.col("_above"), F.col("_limit").cast("double")).otherwise(share)
    return filled.withColumn("_open", rest).select("source", "rows", "source_size", "weight", target.alias("target"))


def _bounds(targets: DataFrame, points: int) -> DataFrame:
    """Each source's part [low, high) of the points."""
    order = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, 0)
    whole = targets.withColumn("_target", F.floor("target"))
    ends = whole.withColumn("_end", F.sum("_target").over(order)).withColumn("_all", F.sum("_target").over(Window.partitionBy()))
    place = lambda c: F.floor(c.cast("double") / F.greatest(F.col("_all"), F.lit(1)).cast("double") * float(points))
    return ends.select("source", place(F.col("_end") - F.col("_target")).alias("low"), place(F.col("_end")).alias("high"))


def _slot_count(targets: DataFrame, block_words: int) -> int:
    got = targets.agg(F.ceil(F.sum(F.floor("target")) / block_words).alias("n")).first()
    return int(got.n or 0)


def mix_schedule(
    targets: DataFrame, block_words: int = BLOCK_WORDS, sequence: tuple[int, int] = FIBONACCI,
) -> DataFrame:
    """(source, slot, rank): the source of each slot, and how many of its slots came before."""
    points, step = sequence
    spark = targets.sparkSession
    slots = spark.range(_slot_count(targets, block_words)).select(
        F.col("id").alias("slot"), (F.col("id") % points * step % points).alias("_point"),
    )
    width = points // CELLS
    bounds = _bounds(targets, points).filter("high > low")
    cells = F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width)))
    dealt = slots.withColumn("_cell", F.floor(F.col("_point") / width)).join(
        bounds.withColumn("_cell", cells), "_cell",
    ).filter("_point >= low and _point < high").select("source", "slot", F.floor(F.col("slot") / CHUNK).alias("_chunk"))
    counts = dealt.groupBy("source", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    same = F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d._chunk") == F.col("o._chunk"))
    inside = F.row_number().over(Window.partitionBy("source", "_chunk").orderBy("slot")) - 1
    ranked = dealt.withColumn("_inside", inside)
    return ranked.alias("d").join(offsets.alias("o"), same).select(
        F.col("d.source").alias("source"), "slot", (F.col("_inside") + F.col("_offset")).alias("rank"),
    )


def shuffle_key(doc_id: Column) -> Column:
    """The order a source's documents are taken in: by the digest of the id."""
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def _streams(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with their place in the source's shuffled stream of words."""
    key = shuffle_key(F.col("doc_id"))
    per_source = targets.select(F.col("source").alias("_source"), "rows")
    part = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    ranges = F.ceil(F.col("rows") / RANGE_ROWS)
    placed = (
        sized.withColumn("_key", key)
        .join(per_source, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_range", F.floor(part * ranges / float(1 << 32)))
        .drop("_source")
    )
    sums = placed.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("_source"), F.col("_range").alias("_in"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
    )
    inside = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_in")))
        .select("doc_id", "source", "size", (F.col("_before") + F.col("_offset")).alias("begin"))
    )


def mix_words(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, block_words: int = BLOCK_WORDS,
    sequence: tuple[int, int] = FIBONACCI,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs``.

    ``taken`` counts words, repeats included. A slot whose block lies beyond the last epoch of its
    source stays empty, so no document gives more than ``epochs`` times its size.
    """
    sized = land(sizes(docs), "mix-sizes")
    targets = land(mix_targets(sized, weights, epochs), "mix-targets")
    streams = _streams(sized, targets)
    per_source = targets.select("source", F.ceil(F.col("source_size") / block_words).alias("_blocks"))
    taken_blocks = (
        mix_schedule(targets, block_words, sequence).alias("s")
        .join(per_source.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")))
        .filter(F.col("rank") < F.col("_blocks") * epochs)
        .groupBy(F.col("s.source").alias("_source"), (F.col("rank") % F.col("_blocks")).alias("_taken_block"))
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    filled = streams.filter("size > 0").select("doc_id", "source", "size", "begin")
    reach = F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("begin") + F.col("size") - 1) / block_words))
    pieces = filled.withColumn("_block", F.explode(reach))
    words = (
        F.least(F.col("begin") + F.col("size"), (F.col("_block") + 1) * block_words)
        - F.greatest(F.col("begin"), F.col("_block") * block_words)
    )
    on_block = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_block") == F.col("_taken_block"))
    # a document with words is known by its place in its source's stream
    taken = (
        pieces.join(taken_blocks, on_block, "left")
        .groupBy("source", "begin", "doc_id", "size")
        .agg(F.sum(words * F.coalesce(F.col("_times"), F.lit(0))).alias("taken"))
        .select("doc_id", "source", "size", "taken")
    )
    empty = sized.filter("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken"))
    ends = targets.select(F.col("source").alias("_source"), "source_size", "target")
    return taken.unionByName(empty).join(ends, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target", "taken",
    )


def mix_documents(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The mix in whole documents, with all their columns: each stays as often as its words are
    taken, rounded half up. Rows that agree in id, source and size share what is taken of them.

    What is taken is broadcast while it has ``BROADCAST_ROWS`` rows at most, else joined by key.
    """
    key = ["doc_id", "source", "size"]
    times = F.floor(F.sum("taken") / F.sum("size") + 0.5)
    taken = mix_words(docs, weights, epochs, block_words).filter("size > 0").groupBy(*key).agg(times.cast("int").alias("times"))
    taken = land(taken.filter("times > 0").select(F.struct(*key, "times").alias("_taken")), "mix-times")
    taken = F.broadcast(taken) if taken.count() <= BROADCAST_ROWS else taken
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    size = F.coalesce(F.regexp_count(F.col("_row.text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    same = (
        F.col("_row.doc_id").cast("long").eqNullSafe(F.col("_taken.doc_id"))
        & F.col("_row.source").cast("string").eqNullSafe(F.col("_taken.source")) & (F.col("_size") == F.col("_taken.size"))
    )
    matched = whole.withColumn("_size", size).join(taken, same)
    copies = F.explode(F.sequence(F.lit(1), F.col("_taken.times")))
    return matched.select("_row", copies.alias("_copy")).select("_row.*")
