"""The query of the Merkle manifest and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import op11_merkle
from .common import table
from .registry import query

MERKLE_SQL = r"""
with recursive crc_table as (
  select list(list_reduce(list_prepend(b, range(8)), lambda c, i: case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as t
  from range(256) x(b)
), rows_ as (
  select row_number() over () as r, d.*, xor(list_reduce(list_prepend(4294967295, list_transform(
      string_split(doc_id::varchar, ''), lambda s: ascii(s)::bigint)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) as crc
  from documents d, crc_table
), leaves as (
  select r, doc_id, source,
    sha256(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')
      || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    case when crc % 2 = 0 then replace(text, chr(10), '') else text end as shown, lang, n_chars
  from rows_
), placed as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf, r) - 1 as pos, count(*) over (partition by source) as n,
    sha256(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')
      || coalesce(strlen(shown) || ':' || shown, '-')) as held
  from leaves
), tree as (
  select source, 0 as lvl, pos, n, leaf as h from placed
  union all
  select source, lvl + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' order by pos)) from tree where n > 1 group by source, lvl, pos // 3
), subroots as (
  select source, h as subroot, row_number() over (order by source is not null, source) - 1 as pos, count(*) over () as n from tree where n = 1
), top as (
  select 0 as lvl, pos, n, subroot as h from subroots
  union all
  select lvl + 1, pos // 3, (max(n) + 2) // 3, sha256(string_agg(h, '' order by pos)) from top where n > 1 group by lvl, pos // 3
), sides as (
  select p.r, t.lvl, coalesce(string_agg(t.h, '' order by t.pos) filter (t.pos < p.pos // pow(3, t.lvl)::bigint), '') as a,
    coalesce(string_agg(t.h, '' order by t.pos) filter (t.pos > p.pos // pow(3, t.lvl)::bigint), '') as b
  from placed p join tree t on p.source is not distinct from t.source and t.n > 1 and t.pos // 3 = p.pos // pow(3, t.lvl + 1)::bigint
  group by p.r, t.lvl
  union all
  select p.r, 1000 + t.lvl, coalesce(string_agg(t.h, '' order by t.pos) filter (t.pos < s.pos // pow(3, t.lvl)::bigint), ''),
    coalesce(string_agg(t.h, '' order by t.pos) filter (t.pos > s.pos // pow(3, t.lvl)::bigint), '')
  from placed p join subroots s on p.source is not distinct from s.source
  join top t on t.n > 1 and t.pos // 3 = s.pos // pow(3, t.lvl + 1)::bigint
  group by p.r, t.lvl
), paths as (
  select r, string_agg(a || b, '' order by lvl) as proof, list(a || '.' || b order by lvl) as path from sides group by r
), folded as (
  select p.doc_id, p.leaf, s.subroot, (select h from top where n = 1) as root, sha256(coalesce(x.proof, '')) as proof_sha256,
    list_reduce(list_prepend(p.held, coalesce(x.path, [])), lambda h, y: sha256(split_part(y, '.', 1) || h || split_part(y, '.', 2))) as folded_root
  from placed p join subroots s on p.source is not distinct from s.source left join paths x on p.r = x.r
)
select *, folded_root = root as verified from folded
"""


@query("op11_merkle", MERKLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    claimed = F.when(tampered, op11_merkle.leaf(F.replace("text", F.lit("\n"), F.lit(""))))
    manifest = op11_merkle.write_manifest(docs, claimed)
    path, root = F.col("path"), F.lit(manifest.root)
    proved = op11_merkle.prove(manifest).select(
        "doc_id", "leaf", "subroot", root.alias("root"), op11_merkle.path_digest(path).alias("proof_sha256"),
        op11_merkle.fold(F.coalesce("claimed", "leaf"), path).alias("folded_root"),
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))
