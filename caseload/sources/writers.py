"""Writers. Overwrite is the mode everywhere; file sizes are left to Spark, but for CSV files: one
with line breaks inside its texts is read by one task, so a file holds at most ``CSV_ROWS`` rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.shape import display
from ..schemas import PREDICTION_COLUMNS


CSV_ROWS = 250_000


def write_result(df: DataFrame, path: str, fmt: str = "csv", compression: str | None = None) -> None:
    """``compression`` of the files, such as ``gzip``; None leaves it to Spark: none for CSV."""
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if fmt == "csv":
        # quotes inside a text are doubled, as other readers expect
        writer = writer.option("header", True).option("escape", '"').option("maxRecordsPerFile", CSV_ROWS)
    writer.format(fmt).save(path)


def write_cleaned(df: DataFrame, path: str, fmt: str = "parquet", compression: str | None = None) -> None:
    """The cleaned incident table, partitioned by state and year.

    The rebalance hint gives each partition folder files of even size: adaptive
    execution splits the large state over many tasks and joins small ones.
    """
    if fmt == "csv":
        write_result(display(df), path, "csv", compression)
        return
    writer = df.hint("rebalance", F.col("state"), F.col("year")).write.mode("overwrite").partitionBy("state", "year")
    if compression:
        writer = writer.option("compression", compression)
    writer.format(fmt).save(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str] = ("state", "year"), fmt: str = "parquet") -> None:
    """Write the partitions that ``df`` has rows of; all others below ``path`` keep their files.

    For one more state-year, or one that came again: the work follows the new rows, not the
    table. Rows must not be read from the partitions they replace. A null in ``by`` is a partition.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .format(fmt)
        .save(path)
    )


def write_marts(marts: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """One output per mart. Marts are aggregates; adaptive execution already
    shrinks them to one file, without forcing their work into one task."""
    for name, mart in marts.items():
        suffix = ".csv" if fmt == "csv" else ""
        write_result(mart, f"{folder.rstrip('/')}/{name}{suffix}", fmt)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv") -> None:
    write_result(df.select(*PREDICTION_COLUMNS), path, fmt)
