"""The test tables seen as incidents.

Column expressions are written once and understood by Spark and by the SQL
that checks it. On the Spark side a query names the columns it wants and only
the tables behind them are joined; the join strategy is left to Spark, which
knows the table sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.joins import BROADCAST_ROWS
from ..sources.readers import read_table


def _choose(index: str, *values: str | None) -> str:
    """CASE over index 0, 1, 2, ...; the last value is the rest."""
    quoted = ["null" if v is None else f"'{v}'" for v in values]
    arms = " ".join(f"when {i} then {v}" for i, v in enumerate(quoted[:-1]))
    return f"case {index} {arms} else {quoted[-1]} end"


# tables behind a column, nearest first; each knows the table it hangs on
_ON = {
    "orders": ("l_orderkey = o_orderkey", None),
    "customer": ("o_custkey = c_custkey", "orders"),
    "nation": ("c_nationkey = n_nationkey", "customer"),
    "region": ("n_regionkey = r_regionkey", "nation"),
    "part": ("l_partkey = p_partkey", None),
    "supplier": ("l_suppkey = s_suppkey", None),
}

CATEGORY = _choose(
    "l_partkey % 12",
    "Assault Offenses", "Robbery", "Larceny/Theft Offenses", "Homicide Offenses",
    "Fraud Offenses", "Sex Offenses", "Burglary/Breaking & Entering", "Kidnapping/Abduction",
    "Human Trafficking", "Motor Vehicle Theft", "Sex Offenses, Non-forcible", "Arson",
)
WEAPON = _choose(
    "l_suppkey % 12",
    None, "Unknown", "Other", "Handgun", "Rifle", "Shotgun", "Personal Weapons",
    "Knife/Cutting Instrument", "Blunt Object", "", "Firearm", "UNKNOWN",
)
LOCATION = _choose(
    "(l_partkey + l_linenumber) % 14",
    "Residence/Home", "Highway/Road/Alley/Street/Sidewalk", "Bar/Nightclub", "Field/Woods",
    "School-College/University", "School-Elementary/Secondary", "Other/Unknown",
    "Air/Bus/Train Terminal", "Bank/Savings and Loan", "Church/Synagogue/Temple/Mosque",
    "Park/Playground", "Shopping Mall", "Commercial/Office Building", "Lake/Waterway/Beach",
)
# name: (expression, table it needs besides lineitem)
INC = {
    "offense_id": ("l_orderkey", None),
    "line_no": ("l_linenumber", None),
    "victim_id": ("l_orderkey * 10 + l_linenumber", None),
    "state": ("r_name", "region"),
    "county": ("n_name", "nation"),
    "agency_name": ("s_name", "supplier"),
    "population": ("cast(floor(1000 + abs(s_acctbal)) as bigint)", "supplier"),
    "population_gaps": (
        "case when l_suppkey % 9 = 0 then null else cast(floor(abs(s_acctbal)) as bigint) end",
        "supplier",
    ),
    "location_name": (LOCATION, None),
    "incident_date": ("cast(o_orderdate as date)", "orders"),
    "year": ("cast(year(o_orderdate) as int)", "orders"),
    "month": ("cast(month(o_orderdate) as int)", "orders"),
    "incident_hour": (
        "case when l_tax = 0 then null else cast((l_orderkey + l_linenumber) % 25 as int) end",
        None,
    ),
    "offense_name": ("concat('Offense ', l_returnflag, l_linestatus)", None),
    "offense_category": (CATEGORY, None),
    "weapon_name": (WEAPON, None),
    "victim_type": (
        "case p_type when 'STANDARD' then 'Individual' when 'MEDIUM' then 'Business' "
        "when 'PROMO' then 'Society/Public' when 'LARGE' then 'Law Enforcement Officer' "
        "when 'SMALL' then 'Government' else 'Unknown' end",
        "part",
    ),
    "victim_sex": (
        "case when l_returnflag = 'A' then 'F' when l_returnflag = 'N' then 'M' "
        "when l_linestatus = 'O' then 'U' else 'Unknown' end",
        None,
    ),
    "victim_age": (
        "case when l_quantity = 1 then -1 when l_quantity = 50 then 185 "
        "when l_quantity = 49 then null else cast(l_quantity * 2 as int) end",
        None,
    ),
    "victim_age_group": (
        "case when l_quantity = 1 then '-1' when l_quantity = 50 then '185' "
        "when l_quantity = 49 then null when l_quantity = 48 then '25-34' "
        "when l_quantity = 47 then 'Not Specified' when l_quantity = 46 then 'Over 98 Years Old' "
        "else concat(cast(cast(l_quantity as int) as string), ' Years Old') end",
        None,
    ),
    "victim_race": (
        "case c_mktsegment when 'HOUSEHOLD' then 'White' "
        "when 'BUILDING' then 'Black or African American' when 'AUTOMOBILE' then 'Asian' "
        "when 'MACHINERY' then 'Unknown' else null end",
        "customer",
    ),
    "victim_resident_status": ("nullif(l_linestatus, 'O')", None),
    "offender_sex": (
        "case o_orderstatus when 'P' then 'M' when 'F' then 'F' else 'Unknown' end", "orders"),
    "relationship": (
        _choose("l_suppkey % 7", "Victim Was Stranger", "Relationship Unknown", None,
                "Victim Was Acquaintance"),
        None,
    ),
    "offender_age": (
        "case when p_size = 50 then -1 when p_size = 49 then null else p_size * 2 end", "part"),
    "offender_race": (
        "case o_orderpriority when '1-URGENT' then 'White' when '2-HIGH' then 'Asian' "
        "when '3-MEDIUM' then 'Unknown' else null end",
        "orders",
    ),
}

EV = {
    "event_id": "event_id",
    "state": "r_name",
    "county": "n_name",
    "offense_category": "event_type",
    "incident_date": "cast(ts as date)",
    "incident_hour": "case when event_id % 17 = 0 then null when event_id % 101 = 0 then 24 "
    "else cast(hour(ts) as int) end",
    "victim_age": "cast(user_id % 100 as int) - 1",
}
_EV_FROM = (
    "events join customer on user_id = c_custkey join nation on c_nationkey = n_nationkey "
    "join region on n_regionkey = r_regionkey"
)

# raw tables of the extraction; plain SQL both engines read
STAR = {
    "incident": "select o_orderkey as incident_id, o_custkey as agency_id, "
    "cast(cast(o_orderdate as date) as string) as incident_date, "
    "cast(o_orderkey % 24 as string) as incident_hour from orders",
    "agencies": "select c_custkey as agency_id, c_name as ucr_agency_name, n_name as county_name, "
    "cast(cast(floor(abs(c_acctbal)) as bigint) as string) as population "
    "from customer join nation on c_nationkey = n_nationkey",
    "offense": "select l_orderkey * 10 + l_linenumber as offense_id, l_orderkey as incident_id, "
    "l_partkey as offense_type_id, l_suppkey as location_id from lineitem",
    "victim": "select l_orderkey * 10 + l_linenumber as victim_id, l_orderkey as incident_id, "
    "min(l_suppkey % 25) as victim_type_id, min(l_partkey % 5) as age_id, "
    "cast(min(l_quantity) as string) as age_num, min(l_partkey % 25) as race_id, "
    "min(l_returnflag) as sex_code, min(l_linestatus) as resident_status_code "
    "from lineitem group by l_orderkey * 10 + l_linenumber, l_orderkey",
    "victim_offense_link": "select distinct l_orderkey * 10 + l_linenumber as victim_id, "
    "case when l_discount = 0 then null else l_orderkey * 10 + l_linenumber end as offense_id "
    "from lineitem",
    "offender": "select p_partkey as offender_id, "
    "case p_size % 3 when 0 then 'M' when 1 then 'F' else 'U' end as sex_code, "
    "p_size % 5 as age_id, p_partkey % 25 as race_id, cast(p_size as string) as age_num from part",
    "victim_offender_rel": "select l_orderkey * 10 + l_linenumber as victim_id, "
    "l_partkey as offender_id, l_suppkey % 5 as relationship_id from lineitem",
    "weapon_link": "select l_orderkey * 10 + l_linenumber as offense_id, "
    "l_suppkey as weapon_id from lineitem",
    "offense_type": "select p_partkey as offense_type_id, p_name as offense_name, "
    "p_type as offense_category_name from part",
    "location_type": "select s_suppkey as location_id, s_name as location_name from supplier",
    "weapon_type": "select s_suppkey as weapon_id, s_name as weapon_name from supplier",
    "age": "select r_regionkey as age_id, case r_name when 'AFRICA' then 'Age in Years' "
    "when 'AMERICA' then 'AGE IN YEARS' when 'ASIA' then 'Unknown' "
    "when 'EUROPE' then 'Over 98 Years Old' else 'Not Specified' end as age_name from region",
    "race": "select n_nationkey as race_id, n_name as race_desc from nation",
    "relationship": "select r_regionkey as relationship_id, r_name as relationship_name "
    "from region",
    "victim_type": "select n_nationkey as victim_type_id, n_name as victim_type_name from nation",
}

# county codes for the test counties; the first has code 0, meaning none
FIPS = (
    "select cast(n_nationkey * 7 as string) as fips, concat(n_name, ' County') as county_name, "
    "r_name as state_name from nation join region on n_regionkey = r_regionkey"
)


_SCHEMAS: dict[str, StructType] = {}
HASHED_ROWS = 2_000_000  # orders of a shuffle partition that one task may hash


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    frame = read_table(spark, path, _SCHEMAS.get(path))
    _SCHEMAS.setdefault(path, frame.schema)
    return frame


def _tables_for(columns: Sequence[str]) -> list[str]:
    wanted: set[str] = set()
    for c in columns:
        t = INC[c][1]
        while t is not None:
            wanted.add(t)
            t = _ON[t][1]
    return [t for t in _ON if t in wanted]


def incidents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The wanted incident columns (all of them by default).

    What hangs on orders is joined to the orders, which are fewer and narrower; the lines are
    joined once to what comes of it. Of many orders each task hashes its share and streams the
    lines past it: sorted, the lines of a task would all be held at once. Of more orders than tasks
    can hash both sides are sorted, which can spill.
    """
    columns = columns or tuple(INC)
    wanted = _tables_for(columns)
    frame = table(spark, sf_dir, "lineitem")
    if "orders" in wanted:
        orders = table(spark, sf_dir, "orders")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # counted from the files' footers; what is beyond the limit could not be hashed in memory
        many = BROADCAST_ROWS < orders.count() <= HASHED_ROWS * parts
        for t in (t for t in wanted if _ON[t][1]):
            orders = orders.join(table(spark, sf_dir, t), F.expr(_ON[t][0]))
        orders = orders.hint("shuffle_hash") if many else orders
        frame = frame.join(orders, F.expr(_ON["orders"][0]))
    for t in (t for t in wanted if t != "orders" and not _ON[t][1]):
        frame = frame.join(table(spark, sf_dir, t), F.expr(_ON[t][0]))
    return frame.select(*[F.expr(INC[c][0]).alias(c) for c in columns])


def events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    columns = columns or tuple(EV)
    frame = table(spark, sf_dir, "events")
    if {"state", "county"} & set(columns):
        frame = (
            frame.join(table(spark, sf_dir, "customer"), F.expr("user_id = c_custkey"))
            .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        )
    return frame.select(*[F.expr(EV[c]).alias(c) for c in columns])


def from_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A binding written as SQL, over the tables it names."""
    names = [t for t in ("lineitem", *_ON) if f" {t}" in text]
    marked = text
    for n in names:
        for word in ("from", "join"):
            marked = marked.replace(f"{word} {n}", f"{word} {{{n}}}")
    return spark.sql(marked, **{n: table(spark, sf_dir, n) for n in names})


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: from_sql(spark, sf_dir, text) for name, text in STAR.items()}


def fips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_sql(spark, sf_dir, FIPS)


def views_sql(wanted: Callable[[str], bool]) -> str:
    """The views as common table expressions, those the predicate asks for."""
    joins = " ".join(f"join {t} on {on}" for t, (on, _) in _ON.items())
    views = {
        "inc": f"select {', '.join(f'{e} as {n}' for n, (e, _) in INC.items())} "
        f"from lineitem {joins}",
        "ev": f"select {', '.join(f'{e} as {n}' for n, e in EV.items())} from {_EV_FROM}",
        "fips": FIPS,
        **{f"raw_{n}": text for n, text in STAR.items()},
    }
    return ", ".join(f"{n} as ({text})" for n, text in views.items() if wanted(n))
