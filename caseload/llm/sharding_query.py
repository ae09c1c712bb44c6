"""The query of the sharding. Rounds of moves under quotas have no SQL; tests/llm/test_sharding.py holds
it against the best of all placements on small data and checks its law on large."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import op13_sharding
from .common import table
from .registry import query


@query("op13_sharding")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = op13_sharding.shard_documents(table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
