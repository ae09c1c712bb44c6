"""Joins.

Three situations, three ways:

* a lookup table read from files: plain join, Spark broadcasts it only if its
  size on disk is below ``spark.sql.autoBroadcastJoinThreshold``;
* a side this package has just aggregated: ``attach`` measures it and broadcasts
  it only under a row and byte limit, otherwise it stays a shuffled join;
* two large tables: ``join_facts`` treats keys that hold more than their share
  of rows apart from the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.text import fips5, normalise_county, state_name
from ..session import settle
from .grouping import sum_by
from .ranking import top_n
from .shape import explode_counties, first_per_key, union_states

# What may be broadcast, measured before it is: rows, and bytes of their values.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def pick_key(left: DataFrame, right: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate both frames have."""
    return next((c for c in candidates if c in left.columns and c in right.columns), None)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: 16 per column, and what its texts and arrays hold."""
    held = [F.lit(16 * len(df.columns))]
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            held.append(F.coalesce(F.octet_length(f.name), F.lit(0)))
        elif isinstance(f.dataType, T.ArrayType):
            held.append(F.greatest(F.size(f.name), F.lit(0)) * 16)
    return reduce(add, held).cast("bigint")


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the frame's rows and bytes are within limits."""
    measured = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes")
    )
    found = measured.first()
    return found["rows"] <= max_rows and found["bytes"] <= max_bytes


def small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The frame marked for broadcast if its rows and bytes are within limits."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    columns: dict[str, str],
    dim_key: str | None = None,
    counted: bool = False,
) -> DataFrame:
    """Left join to a lookup table; ``columns`` maps its columns to new names.

    Spark broadcasts the table if its estimated size is small. ``counted`` has
    its rows counted instead, for tables whose estimate is likely too high.
    """
    dim_key = dim_key or key
    side = dim.select(
        F.col(dim_key).alias(key), *[F.col(c).alias(name) for c, name in columns.items()]
    )
    return df.join(small(side) if counted else side, key, "left")


def attach(
    df: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    null_safe: bool = False,
) -> DataFrame:
    """Join a computed side with at most one row per key.

    With ``null_safe`` a null key meets a null key.

    The side is computed once into the shared folder and measured. Up to
    ``max_rows`` rows (and 64 MB) it is broadcast, so the large frame is not shuffled at all.
    Above, both are shuffled; a hot key then sits on the large frame's side,
    which adaptive execution splits for inner and left joins.
    """
    if not null_safe:
        return df.join(small(settle(side), max_rows), list(on), how)
    named = side.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return df.join(small(settle(named), max_rows), same, how).drop(*[f"_on_{c}" for c in on])


def hot_keys(df: DataFrame, on: Sequence[str], share: float | None = None) -> list[int]:
    """Hashes of the keys holding more than ``share`` of the rows.

    One pass over the key columns into a heavy-hitter sketch of fixed size; at
    most 1/share hashes come back. The default share is one shuffle partition,
    however many there are. Hashes only say where to look: they depend on the
    columns' types, and different keys may share one.
    """
    return hot_keys_of({"": (df, on)}, share)[""]


def hot_keys_of(
    frames: Mapping[str, tuple[DataFrame, Sequence[str]]], share: float | None = None
) -> dict[str, list[int]]:
    """``hot_keys`` of several frames and key columns by one job; a frame is read once for all its keys."""
    if not frames:
        return {}
    spark = next(iter(frames.values()))[0].sparkSession
    if share is None:
        share = 1 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    k = int(1 / share) + 1
    wanted: dict[int, list[str]] = {}
    for name, (df, _) in frames.items():
        wanted.setdefault(id(df), []).append(name)
    keys = union_states([_key_hashes(frames[names[0]][0], {n: frames[n][1] for n in names}) for names in wanted.values()])
    found = keys.groupBy("name").agg(
        F.expr(f"approx_top_k(h, {k}, {max(20_000, 4 * k)})").alias("top"),
        F.count(F.lit(1)).alias("n"),
    ).collect()  # one row for each frame
    hot = {r["name"]: [t["item"] for t in r["top"] or [] if t["count"] > share * r["n"]] for r in found}
    return {name: hot.get(name, []) for name in frames}


def _key_hashes(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """(name, h): a row for every key of every row that has it."""
    if len(keys) == 1:
        ((name, on),) = keys.items()
        return df.filter(_present(on)).select(F.lit(name).alias("name"), F.xxhash64(*on).alias("h"))
    each = [F.struct(F.lit(n).alias("name"), F.when(_present(on), F.xxhash64(*on)).alias("h")) for n, on in keys.items()]
    return df.select(F.inline(F.array(*each))).filter("h is not null")


def join_facts(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    share: float | None = None,
    max_rows: int = BROADCAST_ROWS,
    probe: tuple[DataFrame, Sequence[str]] | bool | None = None,
    sparse: bool = False,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Left join of two large frames that keeps hot keys out of single tasks.

    * Keys hot on the right are joined apart, told by their values in the type
      both sides are compared in. Every left row with such a key has a match,
      so an inner join is enough, and the few left rows are broadcast to where
      the right rows lie (counted first; if they are many the inner join is
      shuffled, and adaptive execution splits either side).
    * Keys hot on the left only are split by adaptive execution.
    * With ``sparse``, left rows with a null key, which cannot match, are spread
      over the partitions instead of meeting in one.

    ``probe`` names a stored table and columns without whose hot values the
    right side cannot have a hot key, or says whether it has any. With it, derived
    sides are computed once into the shared folder, and only when the probe finds
    something. ``hot`` are the hot keys of the right side where they are known
    (``hot_keys_of``); with it, or with ``probe=False``, building the join runs no job
    unless there is a hot key.
    """
    on = list(on)
    kinds = {c: left.schema[c].dataType for c in on}
    same_types = all(left.schema[c].dataType == right.schema[c].dataType for c in on)
    left, right = common_keys(left, right.filter(_present(on)), on)
    if probe is not None:
        if not (hot_keys(*probe, share) if isinstance(probe, tuple) else probe):
            return _typed(_left_join(left, right, on, sparse), kinds)
        left, right = settle(left), settle(right)
    # hashes are of one type only
    found = list(hot) if hot is not None and same_types else hot_keys(right, on, share)
    if not found:
        return _typed(_left_join(left, right, on, sparse), kinds)
    # the keys themselves, as they occur on the right: hashes alone never decide
    hot = small(settle(right.filter(F.xxhash64(*on).isin(*found)).select(*on).distinct()), max_rows)
    matched = small(left.join(hot, on, "left_semi"), max_rows).join(right.join(hot, on, "left_semi"), on, "inner")
    rest = _left_join(left.join(hot, on, "left_anti"), right.join(hot, on, "left_anti"), on, sparse)
    return _typed(union_states([rest, matched]), kinds)


def common_keys(left: DataFrame, right: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames with their keys in the type Spark would compare them in."""
    changed = [c for c in on if left.schema[c].dataType != right.schema[c].dataType]
    for c in changed:
        kind = left.select(c).union(right.select(c)).schema[c].dataType
        left, right = left.withColumn(c, F.col(c).cast(kind)), right.withColumn(c, F.col(c).cast(kind))
    return left, right


def _typed(df: DataFrame, kinds: dict[str, T.DataType]) -> DataFrame:
    """Keys back in the left frame's types."""
    changed = {c: F.col(c).cast(k) for c, k in kinds.items() if df.schema[c].dataType != k}
    return df.withColumns(changed) if changed else df


def _present(on: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in on])


def _left_join(left: DataFrame, right: DataFrame, on: list[str], sparse: bool) -> DataFrame:
    if not sparse:
        return left.join(right, on, "left")
    # the right side's zero is written so that it stays a join key: a constant
    # would be turned into a filter and the null keys would meet again
    zero = F.pmod(F.xxhash64(*on), F.lit(1))
    spread = F.when(_present(on), F.lit(0)).otherwise(
        1 + F.pmod(F.xxhash64(*left.columns), F.lit(100_000))
    )
    return (
        left.withColumn("_spread", spread.cast("bigint"))
        .join(right.withColumn("_spread", zero), [*on, "_spread"], "left")
        .drop("_spread")
    )


def join_unique(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to a large frame with one row per key."""
    return left.join(right, key, "left")


def join_first(
    left: DataFrame,
    right: DataFrame,
    key: str,
    order_by: Sequence[Column | str],
    columns: Sequence[str],
) -> DataFrame:
    """Left join to the first right row per key, so left rows never multiply."""
    first = first_per_key(right.filter(F.col(key).isNotNull()), [key], order_by)
    return join_unique(left, first.select(key, *columns), key)


def keep_top_groups(
    df: DataFrame, by: str, n: int, weight: str | None = None
) -> DataFrame:
    """Rows of the n largest groups; the kept list has n rows. Null is no group."""
    df = df.filter(F.col(by).isNotNull())
    if weight is None:
        totals = df.groupBy(by).agg(F.count(F.lit(1)).alias("_w"))
    else:
        totals = sum_by(df, by, column=weight, name="_w")
    kept = top_n(totals, "_w", n, ties=[by]).select(by)
    return df.join(F.broadcast(kept), by, "left_semi")


def attach_fips(
    df: DataFrame,
    fips: DataFrame,
    multi: str = "none",
    keep_unmatched: bool = False,
    state: str = "state",
    county: str = "county",
    ambiguous: str = "refuse",
) -> DataFrame:
    """Add the five-digit county code by normalised state and county name.

    ``multi``: ``'none'`` takes the county text whole, ``'first'`` the first
    county of a list, ``'explode'`` makes a row for each.

    ``ambiguous`` is for a name that stands for several codes (Fairfax County and Fairfax City):
    ``'refuse'`` gives it none, as if it were unknown, ``'first'`` the smallest code, ``'all'`` a
    row for each. ``ambiguous_fips`` lists such names.
    """
    if ambiguous not in ("refuse", "first", "all"):
        raise ValueError(f"unknown policy for ambiguous names: {ambiguous}")
    if multi == "explode":
        df = explode_counties(df, county)
    elif multi not in ("none", "first"):
        raise ValueError(f"unknown multi-county policy: {multi}")
    part = "first" if multi == "first" else "none"
    codes = _codes(fips)
    if ambiguous == "all":
        codes = codes.distinct()
    else:
        codes = codes.groupBy("_state", "_county").agg(F.min("fips").alias("fips"), F.max("fips").alias("_last"))
        codes = codes.filter("fips = _last").drop("_last") if ambiguous == "refuse" else codes.drop("_last")
    named = df.withColumns(
        {"_state": state_name(state), "_county": normalise_county(county, part)}
    )
    how = "left" if keep_unmatched else "inner"
    return named.join(codes, ["_state", "_county"], how).drop("_state", "_county")


def _codes(fips: DataFrame) -> DataFrame:
    return fips.select(
        state_name("state_name").alias("_state"),
        normalise_county("county_name").alias("_county"),
        fips5("fips").alias("fips"),
    ).filter("fips is not null and fips <> '00000'")


def ambiguous_fips(fips: DataFrame) -> DataFrame:
    """(state, county, codes): normalised names that stand for more than one code."""
    named = _codes(fips).filter("_state is not null and _county is not null")
    codes = F.sort_array(F.collect_set("fips")).alias("codes")
    found = named.groupBy("_state", "_county").agg(codes).filter(F.size("codes") > 1)
    return found.select(F.col("_state").alias("state"), F.col("_county").alias("county"), "codes")


def predictions_by_fips(
    predictions: DataFrame, heatmap: DataFrame, column: str = "hotspot_probability"
) -> DataFrame:
    """Mean probability per county with its code; counties without one drop."""
    codes = heatmap.select("state", "county", "fips").distinct()
    means = predictions.groupBy("state", "county").agg(F.avg(column).alias(column))
    return means.join(codes, ["state", "county"], "inner")
