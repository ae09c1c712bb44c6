"""The query of the run detection. SQL would compare all pairs of words of a text, so it has none;
tests/llm/test_runs.py holds it against brute force."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import op12_runs
from .common import table
from .registry import query


def planted(doc_id: Column, text: Column) -> Column:
    """The text in which some documents repeat a stretch of words up to their end."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))
    rewritten = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(cycle, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), rewritten).otherwise(text)


@query("op12_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = op12_runs.collapse_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"),
    )))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    counted = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    length, period = F.col("best.length"), -F.col("best.shorter")
    return counted.select(
        "doc_id", "n_runs", (-F.col("best.before")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(F.lit(1000) * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
