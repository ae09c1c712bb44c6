from __future__ import annotations

import pytest

from caseload import sources
from caseload.schemas import DISPLAY_NAMES, FLAT_SCHEMA, INCIDENT_SCHEMA

HEADER = ",".join(list(DISPLAY_NAMES.values())[:20])
LINE = "{id},PD,KING,100.0,Residence/Home,2020-01-02,5.0,Robbery,Robbery,,Individual,F,33,White,R,M,Stranger,20,7,White"


def write(path, *ids):
    path.write_text("\n".join([HEADER, *[LINE.format(id=i) for i in ids]]) + "\n")


def test_state_and_year_from_file_names(spark, tmp_path, rows):
    write(tmp_path / "new_mexico_2021.csv", 1, 2)
    write(tmp_path / "texas_2020.csv", 3)
    write(tmp_path / "texas_merged.csv", 4)
    df = sources.read_state_years(spark, f"{tmp_path}/*.csv")
    assert rows(df, "offense_id", "state", "year") == [
        (1, "New Mexico", 2021), (2, "New Mexico", 2021), (3, "Texas", 2020), (4, "Texas", None),
    ]
    assert df.columns == [*FLAT_SCHEMA.fieldNames(), "state", "year"]


def test_header_must_match(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="header|schema|conform"):
        sources.read_incidents(spark, str(path)).collect()


def test_bad_rows(spark, tmp_path):
    path = tmp_path / "texas_2020.csv"
    write(path, 1, "bad")
    lenient = sources.read_incidents(spark, str(path), FLAT_SCHEMA)
    assert sorted(r[0] or 0 for r in lenient.select("offense_id").collect()) == [0, 1]
    with pytest.raises(Exception):
        sources.read_incidents(spark, str(path), FLAT_SCHEMA, strict=True).collect()


def test_absent_state_files(spark, tmp_path, rows):
    write(tmp_path / "a.csv", 1, 2)
    write(tmp_path / "b.csv", 3)
    paths = [str(tmp_path / n) for n in ("a.csv", "none.csv", "b.csv")]
    df, per_file = sources.read_states(spark, paths, FLAT_SCHEMA)
    assert df.count() == 3
    assert rows(per_file) == [("a.csv", 2), ("b.csv", 1)]
    with pytest.raises(FileNotFoundError):
        sources.read_states(spark, [paths[1]])


def test_cleaned_table_is_partitioned(spark, tmp_path, rows):
    values = [(i, *[None] * 19, s, y) for i, (s, y) in enumerate([("TX", 2020), ("TX", 2021), ("NY", 2020)])]
    df = spark.createDataFrame(values, INCIDENT_SCHEMA)
    sources.write_cleaned(df, f"{tmp_path}/clean")
    back = sources.read_incidents(spark, f"{tmp_path}/clean", INCIDENT_SCHEMA, "parquet")
    assert rows(back, "offense_id", "state", "year") == rows(df, "offense_id", "state", "year")
    plan = back.filter("state = 'NY'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(state" in plan
    sources.write_cleaned(df, f"{tmp_path}/csv", "csv")
    assert rows(sources.read_incidents(spark, f"{tmp_path}/csv"), "offense_id", "state", "year") == rows(df, "offense_id", "state", "year")


def test_marts_required_and_optional(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        sources.read_marts(spark, str(tmp_path))


def test_county_codes_stay_text(spark, tmp_path):
    (tmp_path / "fips.csv").write_text("fips,county_name,state\n01001,Autauga County,AL\n", encoding="latin-1")
    row = sources.read_fips(spark, f"{tmp_path}/fips.csv").first()
    assert tuple(row) == ("01001", "Autauga County", "AL")


def test_csv_files_are_bounded(spark, tmp_path, monkeypatch):
    from caseload.sources import writers

    monkeypatch.setattr(writers, "CSV_ROWS", 10)
    path = tmp_path / "t"
    writers.write_result(spark.range(25).coalesce(1).selectExpr("id", "concat('a\n', id) as text"), str(path))
    assert len(list(path.glob("*.csv"))) == 3
    assert spark.read.option("header", True).option("multiLine", True).csv(str(path)).count() == 25


def test_state_and_year_come_from_the_end_of_a_path(spark):
    """Only the last two parts of a path are tried, and give what the whole path would."""
    cases = {
        "file:/a=b/c_1999/new_mexico_2021.csv": ("New Mexico", 2021), "/x/_file=middle_east_1994/part-0-1.c000.csv": ("Middle East", 1994),
        "/x/texas_2020.csv/part-00001.csv": ("Texas", 2020), "texas_2020.csv": ("Texas", 2020), "/x/new%20york_2020/part-1": ("New York", 2020),
        "/x/y=/part-7_8": ("Part-7", 8), "/x/a=ohio_2000.csv": ("Ohio", 2000), None: (None, None),
    }
    df = spark.createDataFrame([(p,) for p in cases], "_path string")
    found = sources.readers.with_state_year(df)
    assert {r["_path"]: (r["state"], r["year"]) for r in found.collect()} == cases
    assert "substring_index(_path" in found._jdf.queryExecution().optimizedPlan().toString()


def test_texts_of_raw_files_are_parsed_once(spark):
    """The extraction reads its tables more than once, but no CSV file."""
    from caseload.catalogue import QUERIES

    plan = QUERIES["extract_from_csv"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan csv" not in plan


def test_csv_files_may_be_packed(spark, tmp_path, rows):
    values = [(i, *[None] * 9, 'a "b", c', *[None] * 9, "TX", 2020) for i in range(50)]
    df = spark.createDataFrame(values, INCIDENT_SCHEMA)
    for name, how in (("packed", "gzip"), ("plain", None)):
        sources.write_cleaned(df, f"{tmp_path}/{name}", "csv", how)
        back = sources.read_incidents(spark, f"{tmp_path}/{name}", INCIDENT_SCHEMA)
        assert rows(back, "offense_id", "victim_type", "state", "year") == rows(df, "offense_id", "victim_type", "state", "year")
    assert list((tmp_path / "packed").glob("*.csv.gz")) and not list((tmp_path / "packed").glob("*.csv"))


def test_raw_files_and_their_copies_are_packed(spark):
    """The CSV files of the extraction are gzip, the Parquet copies of their texts zstd."""
    import os

    from caseload.catalogue import QUERIES
    from caseload.session import _made

    before = len(_made.get(spark.sparkContext.applicationId, []))
    QUERIES["extract_from_csv"](spark, "/root/testdata/sf0.001")
    folders = _made[spark.sparkContext.applicationId][before:]
    files = [f for folder in folders for _, _, names in os.walk(folder) for f in names if f.startswith("part-")]
    assert {f.split(".", 1)[1] for f in files} == {"csv.gz", "zstd.parquet"}
