"""Raw fact tables written once, bucketed by incident, and extraction from them.

Every fact gets the incident it belongs to, once, when it is written; from then on all facts of an
incident lie in the bucket of the same number. ``extract_stored`` joins them bucket by bucket: no
fact crosses a shuffle, however often it is extracted, and building the plan reads no fact.

An incident that holds more than a bucket's share of a fact's rows would make its bucket large, so
such incidents (and those without an id) are written apart, unbucketed, and joined as large tables
with hot keys are. Which they are is found by one job over the key columns when writing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import as_number
from ..operators.joins import common_keys, hot_keys_of, join_facts, small
from ..operators.shape import first_per_key, project_ordered, union_states
from ..schemas import FLAT_COLUMNS
from ..session import fresh_path, sibling_session
from .extract import (
    Profile, Tables, agencies, describe, first_offender, persons, type_key, with_agency, with_type,
)

KEY = "incident_id"
Join = Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]


@dataclass(frozen=True)
class StoredFacts:
    """Facts by name, each with ``incident_id``: bucketed ones, and those of hot incidents."""

    folder: str
    buckets: int
    even: Mapping[str, DataFrame]
    hot: Mapping[str, DataFrame]


def keyed_facts(
    tables: Tables, share: float | None = None, kept: Callable[[str, DataFrame], Sequence[DataFrame]] = lambda _, df: [df],
) -> dict[str, DataFrame]:
    """The facts of an extraction with the incident of each row.

    Links take it from the victim, weapons from the offense. What belongs to no incident
    can't be met from one and is left out; incidents themselves all stay. ``kept`` takes each fact as
    soon as it is made; it gives frames, no two with rows of one incident, from which others take theirs.
    """
    incident = tables["incident"].select(KEY, "agency_id", "incident_date", as_number("incident_hour").alias("incident_hour"))
    kind = incident.schema[KEY].dataType

    def own(df: DataFrame) -> DataFrame:
        return df.withColumn(KEY, F.col(KEY).cast(kind)).filter(F.col(KEY).isNotNull())

    def of_parent(df: DataFrame, parent: Sequence[DataFrame], key: str) -> DataFrame:
        # one row for each key and incident, so no key is hot on the right; buckets by incident need no shuffle for it
        owner = union_states([part.select(key, KEY).distinct() for part in parent])
        return join_facts(df.drop(KEY), owner, [key], probe=False).filter(F.col(KEY).isNotNull())

    victim = own(persons(tables["victim"], "victim", ["victim_id", KEY, "victim_type_id"]))
    link = project_ordered(tables["victim_offense_link"], ["victim_id", "offense_id"])
    keys = ["offense_type_id", "offense_code", "location_id"]
    offense = own(project_ordered(tables["offense"], [KEY, "offense_id", *keys]))
    if "offense_id" in link.columns:
        link, offense = common_keys(link, offense, ["offense_id"])
    link, victim = common_keys(link, victim, ["victim_id"])
    facts = {"incident": incident, "offense": offense, "victim": victim}
    parents = {name: kept(name, df) for name, df in facts.items()}

    def keep(name: str, df: DataFrame) -> None:
        facts[name] = df
        kept(name, df)

    keep("victim_offense_link", of_parent(link, parents["victim"], "victim_id"))
    if "weapon_link" in tables and "weapon_type" in tables:
        weapons, _ = common_keys(tables["weapon_link"].select("offense_id", "weapon_id"), offense, ["offense_id"])
        keep("weapon_link", of_parent(weapons.filter("offense_id is not null"), parents["offense"], "offense_id"))
    if "victim_offender_rel" in tables and "offender" in tables:
        hot = hot_keys_of({"offender": (tables["offender"], ["offender_id"])}, share)
        first, _ = common_keys(first_offender(tables, Profile(hot_share=share), hot), victim, ["victim_id"])
        keep("first_offender", of_parent(first, parents["victim"], "victim_id"))
    return facts


def store_facts(
    tables: Tables, folder: str | None = None, buckets: int | None = None, hot_share: float | None = None,
) -> StoredFacts:
    """Write the facts of ``tables`` below ``folder`` (by default one of the shared folder).

    ``buckets`` follows the data: a bucket of every fact should fit into a task (default: the
    session's shuffle partitions). ``hot_share`` makes an incident hot, by default one bucket.
    """
    spark = tables["incident"].sparkSession
    folder = (folder or fresh_path(spark, "facts")).rstrip("/")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = {n: ([KEY], tables[n]) for n in ("incident", "offense", "victim") if n in tables}
    kind = tables["incident"].schema[KEY].dataType
    typed = {n: (df.withColumn(KEY, F.col(KEY).cast(kind)), on) for n, (on, df) in stored.items()}
    hashes = sorted({h for found in hot_keys_of(typed, hot_share or 1 / buckets).values() for h in found})
    apart = F.col(KEY).isNull()
    if hashes:
        apart = apart | F.xxhash64(KEY).isin(hashes)
    stem = f"facts_{uuid.uuid4().hex}"

    def write(name: str, df: DataFrame) -> list[DataFrame]:
        even = df.filter(~apart).repartition(buckets, KEY)
        even.write.bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{folder}/even/{name}").saveAsTable(f"{stem}_{name}")
        if hashes or name == "incident":
            df.filter(apart).write.parquet(f"{folder}/hot/{name}")
        hot = [spark.read.schema(df.schema).parquet(f"{folder}/hot/{name}")] if hashes else []
        return [spark.table(f"{stem}_{name}"), *hot]

    facts = keyed_facts(tables, hot_share, write)
    layout = [(name, stem, buckets, bool(hashes) or name == "incident") for name in facts]
    spark.createDataFrame(layout, "name string, stem string, buckets int, hot boolean").coalesce(1).write.parquet(f"{folder}/layout")
    return open_facts(spark, folder)


def open_facts(spark: SparkSession, folder: str) -> StoredFacts:
    """Facts written before, also by another session: its catalog learns their buckets anew.

    They are opened in a sibling session that lets a join rely on its sides being dealt by one of its
    keys: buckets are by incident, joins are by incident and offense or victim.
    """
    folder = folder.rstrip("/")
    spark = sibling_session(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"})
    layout = spark.read.parquet(f"{folder}/layout").collect()  # one row for each fact
    even = {}
    for row in layout:
        table, path = f"{row.stem}_{row.name}", f"{folder}/even/{row.name}"
        if not spark.catalog.tableExists(table):
            schema = spark.read.parquet(path).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(
                f"create table {table} ({columns}) using parquet clustered by ({KEY}) sorted by ({KEY}) "
                f"into {row.buckets} buckets location '{path}'"
            )
        even[row.name] = spark.table(table)
    hot = {row.name: spark.read.schema(even[row.name].schema).parquet(f"{folder}/hot/{row.name}") for row in layout if row.hot}
    return StoredFacts(folder, layout[0].buckets, even, hot)


def forget(stored: StoredFacts) -> None:
    """Take the tables out of the session's catalog; their files stay."""
    spark = stored.even["incident"].sparkSession
    for row in spark.read.parquet(f"{stored.folder}/layout").collect():
        spark.sql(f"drop table if exists {row.stem}_{row.name}")


def extract_stored(stored: StoredFacts, lookups: Tables, profile: Profile = Profile()) -> DataFrame:
    """The flat incident table, as ``extract_incidents`` makes it from the raw tables.

    ``lookups`` holds the tables of names (agencies, offense_type, ...).
    """
    def plain(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
        # buckets meet buckets: a broadcast would have Spark read the other side without its buckets
        return left.join(right.hint("merge"), list(on), "left")

    def spread(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
        return join_facts(left, right, on, profile.hot_share)

    tables = {**lookups, "offense": stored.even["offense"]}
    key = type_key(tables, profile)
    known = small(agencies(lookups))
    even, hot = ({**f, "incident": with_agency(f["incident"], known)} if f else {} for f in (stored.even, stored.hot))
    rows = _cases(even, tables, key, plain)
    if set(hot) == {"incident"}:
        # only incidents without an id lie apart: nothing can meet them
        rows = union_states([rows, hot["incident"]], allow_missing=True)
    elif hot:
        rows = union_states([rows, _cases(hot, tables, key, spread)])
    return project_ordered(describe(rows, tables, profile), FLAT_COLUMNS)


def _cases(facts: Mapping[str, DataFrame], t: Tables, key: str | None, join: Join) -> DataFrame:
    """Incidents with their offenses, victims and first offenders: every join has the incident in
    its key, so buckets meet buckets."""
    offenses = project_ordered(facts["offense"], [KEY, "offense_id", "location_id", *([key] if key else [])])
    if "weapon_link" in facts:
        of = [KEY, "offense_id"]
        offenses = join(offenses, first_per_key(facts["weapon_link"], of, ["weapon_id"]), of)
    offenses = with_type(offenses, t, key)
    of = [KEY, "victim_id"]
    victims = join(facts["victim_offense_link"], facts["victim"].withColumn("_known", F.lit(True)), of)
    victims = victims.filter("_known").drop("_known")
    if "first_offender" in facts:
        victims = join(victims, facts["first_offender"], of)
    shared = [c for c in (KEY, "offense_id") if c in victims.columns]
    if len(shared) == 2:
        return join(facts["incident"], join(offenses, victims, shared), [KEY])
    return join(join(facts["incident"], offenses, [KEY]), victims, [KEY])
