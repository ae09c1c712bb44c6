"""Readers. Schemas are stated, never inferred: no extra pass, stable types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import coerce_key, fips5, text_key
from ..operators.grouping import count_by

_LATIN = "ISO-8859-1"
BAD = "_bad_row"


def _csv(spark: SparkSession, multi_line: bool = False) -> DataFrameReader:
    """CSV with a header; a quote inside a quoted text is doubled.

    Line breaks inside quotes need ``multi_line``, and then a file is read by one task.
    """
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def _display_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(schemas.DISPLAY_NAMES.get(f.name, f.name), f.dataType) for f in schema]
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table; the preferred form of every stored table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_incidents(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = schemas.INCIDENT_SCHEMA,
    fmt: str = "csv",
    strict: bool = False,
    multi_line: bool = False,
    keep_bad: bool = False,
) -> DataFrame:
    """Incident table under internal names.

    A CSV must carry the display names as header; with ``strict`` a bad row
    stops the job, otherwise its bad fields are null. ``keep_bad`` adds the text
    of bad rows as ``_bad_row``, for ``bad_row_count``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(*paths)
    header = _display_schema(schema)
    names = schema.fieldNames()
    reader = _csv(spark, multi_line).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if keep_bad:
        header, names = header.add(BAD, T.StringType()), [*names, BAD]
        reader = reader.option("columnNameOfCorruptRecord", BAD)
    frame = reader.schema(header).option("enforceSchema", False).csv(paths)
    return frame.toDF(*names)


def bad_row_count(df: DataFrame) -> DataFrame:
    """(rows, bad_rows) of a table read with ``keep_bad``."""
    # the parser finds bad fields only in columns that are read, so the count reads all
    every = F.hash(*[c for c in df.columns if c != BAD]) >= -(1 << 31)
    return df.agg(F.count(F.when(every, 1)).alias("rows"), F.count(BAD).alias("bad_rows"))


def read_raw(
    spark: SparkSession, path: str, table: str, multi_line: bool = False, bad_rows: str = "keep"
) -> DataFrame:
    """One raw table: Latin-1 CSV, lower-case names, keys as bigint, codes as text without '.0'.

    Of the columns known for the table, those in the file are kept; the rest of
    the file, such as the year column, is never parsed.

    A row with too few or too many fields is a bad one. ``bad_rows``: ``'keep'`` takes what can
    be read of it, ``'drop'`` leaves it out, ``'fail'`` stops the job, ``'mark'`` adds the text of
    bad rows as ``_bad_row``, for ``bad_row_count``. All but the first parse every field.
    """
    if bad_rows not in ("keep", "drop", "fail", "mark"):
        raise ValueError(f"unknown policy for bad rows: {bad_rows}")
    frame = _csv(spark, multi_line).option("encoding", _LATIN).csv(path)
    if bad_rows != "keep":
        header = T.StructType([*frame.schema.fields, T.StructField(BAD, T.StringType())])
        reader = _csv(spark, multi_line).option("encoding", _LATIN).schema(header)
        frame = reader.option("columnNameOfCorruptRecord", BAD).csv(path)
        # the parser finds bad rows only where fields are read, so the test reads all of them
        whole = F.hash(*[c for c in frame.columns if c != BAD]) >= -(1 << 31)
        if bad_rows == "drop":
            frame = frame.filter(whole & F.col(BAD).isNull())
        elif bad_rows == "fail":
            told = F.concat(F.lit(f"bad row in {path}: "), F.col(BAD))
            frame = frame.filter(whole & F.when(F.col(BAD).isNotNull(), F.raise_error(told).cast("boolean")).otherwise(True))
    frame = frame.toDF(*[c.strip().lower() for c in frame.columns])
    known = [c for c in schemas.RAW_TABLES[table] if c in frame.columns]
    if not known:
        raise ValueError(f"no column of table {table} in {path}")
    kept = {c: coerce_key(c) for c in schemas.KEY_COLUMNS} | {c: text_key(c) for c in schemas.TEXT_KEYS}
    marks = [BAD] if bad_rows == "mark" else []
    return frame.select(*[kept.get(c, F.col(c)).alias(c) for c in known], *marks)


def read_raw_set(
    spark: SparkSession,
    folder: str,
    files: Mapping[str, str] = schemas.RAW_FILES,
    on_missing: str = "fail",
    on_unreadable: str = "fail",
    bad_rows: str = "keep",
) -> dict[str, DataFrame]:
    """All raw tables of one state and year.

    ``on_missing='fail'`` stops at the first absent file, ``'skip'`` leaves
    that table out. ``bad_rows`` goes to ``read_raw``. ``on_unreadable`` says the same for files that are there but
    have no header that Spark can read, or none of the table's columns.
    """
    for policy in (on_missing, on_unreadable):
        if policy not in ("fail", "skip"):
            raise ValueError(f"unknown policy for missing or unreadable files: {policy}")
    tables = {}
    for table, name in files.items():
        try:
            tables[table] = read_raw(spark, f"{folder.rstrip('/')}/{name}", table, bad_rows=bad_rows)
        except (PySparkException, ValueError) as error:
            absent = isinstance(error, AnalysisException) and _missing(error)
            if (on_missing if absent else on_unreadable) == "fail":
                raise
    return tables


def with_state_year(df: DataFrame, path_column: str = "_path") -> DataFrame:
    """State and Year from a path such as '.../new_mexico_2021.csv'.

    A name without a number at its end gives a null year. A folder of that name
    holding part files works as well.
    """
    # no match begins before the last two parts of a path, and each place before them costs a try a row
    tail = F.substring_index(path_column, "/", -2)
    stem = F.regexp_extract(tail, r"([^/=]+?)(?:\.csv)?(?:/part-[^/]*)?$", 1)
    pieces = F.split(F.url_decode(stem), "_")
    last = F.element_at(pieces, -1)
    return df.withColumns(
        {
            "state": F.initcap(F.array_join(F.slice(pieces, 1, F.size(pieces) - 1), " ")),
            "year": F.when(last.rlike(r"^\d+$"), last).try_cast("int"),
        }
    )


def read_state_years(
    spark: SparkSession, pattern: str, schema: T.StructType = schemas.FLAT_SCHEMA
) -> DataFrame:
    """Yearly files of one or more states in one read, with state and year."""
    frame = read_incidents(spark, pattern, schema).select("*", "_metadata.file_path")
    return with_state_year(frame, "file_path").drop("file_path")


def read_states(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType = schemas.INCIDENT_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """Merged state files, absent ones left out, and the row count per file."""
    present = []
    for path in paths:
        try:
            read_incidents(spark, path, schema)
            present.append(path)
        except AnalysisException as error:
            if not _missing(error):
                raise
    if not present:
        raise FileNotFoundError(f"none of the files exists: {list(paths)}")
    frame = read_incidents(spark, present, schema)
    per_file = count_by(frame.select(F.col("_metadata.file_name").alias("file_name")), "file_name")
    return frame, per_file


def read_marts(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The dashboard tables. Optional ones are taken only if they exist.

    Columns are found by their name in the file, whatever their order, and get
    the stated types; those that a table does not state follow as they are.
    Tables without stated columns are small and have their types inferred.
    """
    marts = {}
    for name, (schema, required) in schemas.MART_SCHEMAS.items():
        path = f"{folder.rstrip('/')}/{name}" + (".csv" if fmt == "csv" else "")
        reader = spark.read
        if fmt == "csv":
            reader = _csv(spark).option("inferSchema", schema is None)
        try:
            frame = reader.format(fmt).load(path)
        except AnalysisException as error:
            if required or not _missing(error):
                raise
            continue
        marts[name] = stated_mart(frame, name)
    return marts


def stated_mart(frame: DataFrame, name: str) -> DataFrame:
    """A mart as read, with its stated columns first and in their types."""
    schema = schemas.MART_SCHEMAS[name][0]
    if "fips" in frame.columns:
        frame = frame.withColumn("fips", fips5("fips"))
    if schema is None:
        return frame
    if absent := [c for c in schema.fieldNames() if c not in frame.columns]:
        raise ValueError(f"columns are missing in {name}: {absent}")
    rest = [c for c in frame.columns if c not in schema.fieldNames()]
    return frame.select(*[F.col(f.name).cast(f.dataType) for f in schema], *rest)


def read_fips(spark: SparkSession, path: str) -> DataFrame:
    """County codes as text: leading zeros matter."""
    frame = _csv(spark).option("encoding", _LATIN).csv(path)
    frame = frame.toDF(*[c.strip().lower() for c in frame.columns])
    state = "state_name" if "state_name" in frame.columns else "state"
    return frame.select("fips", "county_name", F.col(state).alias("state_name"))
