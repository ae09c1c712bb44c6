"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

toxicity -> n-gram Jaccard join -> benchmark decontamination -> mixing -> token ids.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and
read again as the next one's documents. All but the last return the columns of ``documents``, and
columns that only some callers have pass through.

* ``toxicity`` drops documents whose score reaches the threshold of the classifier.
* ``near_duplicates`` keeps one document of each component of the Jaccard join: the one with the
  smallest doc_id (rows that agree in id and in their set of n-grams are one document).
  Documents without words are no one's duplicates and stay.
* ``decontaminate`` drops documents that hold a test item.
* ``mix`` repeats or drops whole documents: each stays as often as the mix takes its words, rounded
  (half up). A document without words is in no mix and goes.
* ``token_ids`` writes the token store and returns its rows: doc_id, start, n_tokens, ids_crc32.

Empty input gives empty output in every stage; null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseload.llm import (
    op01_token_store, op02_mixing, op05_decontaminate, op09_toxicity, op10_jaccard,
)
from caseload.llm.common import land, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = op09_toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return op09_toxicity.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op10_jaccard.keep_representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op05_decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op02_mixing.mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op01_token_store.read_tokens(spark, op01_token_store.write_tokens(docs))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_ids", token_ids),
]

#: a learned classifier and a tokenizer have no SQL; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
