"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import op01_token_store, op02_mixing, op03_chat, op04_topk, op05_decontaminate, op06_language, op07_suffix_dedup, op08_quality, op09_toxicity, op10_jaccard
from .common import table
from .registry import query


@query("op1_token_store")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = op01_token_store.write_tokens(table(spark, sf_dir, "documents"))
    return op01_token_store.read_tokens(spark, path)


MIX_SQL = r"""
with sized as (
  select doc_id, source, case when text is null then 0 else len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) end::bigint as size
  from documents
), totals as (
  select source, sum(size)::bigint as source_size from sized group by source
), weighed as (
  select *, (case (row_number() over (order by source is null, source) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end)::bigint as weight
  from totals
), levels as (
  select *, source_size * 3 as lim, coalesce(sum(source_size * 3) over before, 0)::bigint as ful,
    (sum(weight) over () - coalesce(sum(weight) over before, 0))::bigint as w,
    (sum(source_size) over () - coalesce(sum(source_size * 3) over before, 0))::bigint as rest
  from weighed
  window before as (order by (source_size * 3)::double / weight, source is null, source
                    rows between unbounded preceding and 1 preceding)
), above as (
  select *, lim * w <= rest * weight as full_ from levels
), targets as (
  select source, source_size,
    case when full_ then lim::double
         else (select arg_min(rest, ful) from above where not full_)::double * weight
              / (select arg_min(w, ful) from above where not full_)::double end as target
  from above
), ends as (
  select *, floor(target)::bigint as t,
    (sum(floor(target)::bigint) over (order by source is null, source rows unbounded preceding))::bigint as e,
    (sum(floor(target)::bigint) over ())::bigint as a
  from targets
), bounds as (
  select *, floor((e - t)::double / greatest(a, 1)::double * 2971215073.0)::bigint as low,
    floor(e::double / greatest(a, 1)::double * 2971215073.0)::bigint as high
  from ends
), slots as (
  select (range % 2971215073 * 1836311903) % 2971215073 as point
  from range((select ceil(sum(floor(target)) / 32)::bigint from targets))
), used as (
  select b.source, count(*) as k from slots s join bounds b on s.point >= b.low and s.point < b.high group by 1
), streams as (
  select doc_id, source, size, coalesce(sum(size) over (partition by source
      order by md5(coalesce(doc_id::varchar, '')), doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as b0
  from sized
), placed as (
  select s.doc_id, s.size, t.source_size, t.target, s.b0, ceil(t.source_size / 32.0)::bigint as nb,
    least(coalesce(u.k, 0), 3 * ceil(t.source_size / 32.0)::bigint) as k
  from streams s join targets t on s.source is not distinct from t.source
  left join used u on s.source is not distinct from u.source
)
select doc_id, size, source_size, target,
  case when size = 0 then 0
       else (k // nb) * size + greatest(0, least(size, (k % nb) * 32 - b0)) end::bigint as taken
from placed
"""


@query("op2_mixing", MIX_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = op02_mixing.mix_words(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


# marks: '### User: ' and ' </turn>\n'; a text grows by one for each control string in it
CHAT_SQL = r"""
with extra as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from extra
), counted as (
  select *, length(text) + (length(text) - length(replace(text, '\', '')))
    + (length(text) - length(replace(text, '###', ''))) / 3
    + (length(text) - length(replace(text, ':', '')))
    + (length(text) - length(replace(text, '</turn>', ''))) / 7 + 4 + length(role) + 2 + 9 as chars
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from counted group by conv_id
"""
HARD_TEXT = r"\### Assistant: </turn> ok"


@query("op3_chat_format", CHAT_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame(
        [(-7, 0, "user", HARD_TEXT), (-7, 1, "assistant", HARD_TEXT)], "conv_id long, turn long, role string, text string",
    )
    read = op03_chat.read_chats(op03_chat.format_chats(chats.unionByName(hard)))
    return read.drop("valid")


TOP_K_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.e::double[], c.e::double[])::bigint as score
  from (select * from v where vec_id % 20 = 0) q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e)
)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
) where rank <= 20
"""


@query("op4_top_k", TOP_K_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return op04_topk.top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query("op10_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_jaccard.jaccard_links(table(spark, sf_dir, "documents"))


@query("op5_decontaminate")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op05_decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_language")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op06_language.label_languages(docs, op06_language.fit_language(docs)).drop("spans")


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op07_suffix_dedup.dedup_passages(table(spark, sf_dir, "documents"))


@query("op8_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return op08_quality.score_quality(docs, op08_quality.fit_quality(docs, labels))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return op09_toxicity.score_toxicity(docs, op09_toxicity.fit_toxicity(docs, labels))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
