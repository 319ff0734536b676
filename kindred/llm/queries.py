"""The document operators' queries and, where SQL can say it, what they must return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import attribution, audit, exact_dedup, media, mixing, near_dup, packing, passages, pii, quality, secret_scan, sharding, whitening
from kindred.llm.common import documents


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir)).drop("copies")


def op2_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op3_find_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, sf_dir))


def op4_score_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op6_store_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_media(documents(spark, sf_dir), keep=False)


def op7_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.section_tokens(documents(spark, sf_dir))


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_classes(documents(spark, sf_dir))


def op9_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir), words=4)


def op11_audit_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_find_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(documents(spark, sf_dir))


def op13_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_pack_documents, op3_find_personal_data, op4_score_quality, op5_exact_duplicates, op6_store_media, op7_section_tokens, op8_repeated_passages, op9_shard_documents, op10_near_duplicates, op11_audit_filters, op12_find_secrets, op13_whiten_embeddings)}

ORACLE_SQL = {
    "op1_mix_sources": r"""
with rows as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         substr(md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 16) as h
  from documents
), per as (
  select source, sum(size)::bigint as source_size, [5, 2, 1][(row_number() over (order by source asc nulls last) - 1) % 3 + 1]::bigint as weight
  from rows group by source
), ranked as (
  select *, (sum(source_size * 3) over w - source_size * 3)::bigint as cap_before,
         (sum(weight) over () - sum(weight) over w + weight)::bigint as weight_left, (sum(source_size) over ())::bigint as total
  from per window w as (order by source_size::double / weight, source asc nulls last)
), capped as (
  select *, source_size * 3 * weight_left <= (total - cap_before) * weight as is_capped from ranked
), targets as (
  select source, source_size, case when is_capped then (source_size * 3)::double
    else ((total - coalesce(sum(case when is_capped then source_size * 3 end) over (), 0)::bigint) * weight)::double
         / (sum(case when not is_capped then weight end) over ())::bigint end as target
  from capped
), plan as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as passes from targets
), placed as (
  select r.doc_id, r.size, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size as remainder,
         (sum(r.size) over (partition by r.source order by r.h rows unbounded preceding))::bigint as run
  from rows r join plan p on r.source is not distinct from p.source
)
select doc_id, size, source_size, target, size * (passes + case when run <= remainder then 1 else 0 end) as taken from placed""",
    "op5_exact_duplicates": r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from n""",
    "op10_near_duplicates": r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), s as (
  select doc_id, case when len(w) = 0 then []::varchar[] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end as s from d
), n as (
  select doc_id, len(s) as n from s
), u as (
  select doc_id, hash(g) as g from (select doc_id, unnest(s) as g from s)
), p as (
  select a.doc_id as a, b.doc_id as b, count(*) as i from u a join u b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), l as (
  select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 80 * (x.n + y.n - i)
), c as (
  select doc_id as node, doc_id as comp from n
  union
  select e.b, c.comp from c join (select a, b from l union all select b, a from l) e on c.node = e.a
)
select n.doc_id, n.n as n_shingles, min(c.comp) as component_id, n.doc_id = min(c.comp) as kept
from n join c on c.node = n.doc_id group by n.doc_id, n.n""",
    "op11_audit_filters": r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), l as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id
), m as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
         (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::int
           + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(d.doc_id > min(d.doc_id) over (partition by t), false)::int as mask
  from d left join l on d.doc_id = l.doc_id
), c as (
  select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from m group by part, mask
), f as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as c
), o as (
  select a.c || b.c || d.c || e.c || g.c as filter_order from f a, f b, f d, f e, f g
  where len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5
), s as (
  select filter_order, step::int as step, 1 << (ascii(substr(filter_order, step::int, 1)) - 65) as own,
         coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, i::int, 1)) - 65))), 0)::int as before
  from o, range(1, 6) r(step)
), x as (
  select part, filter_order, step, own, sum(case when mask & (own | before) = 0 then n else 0 end)::bigint as kept, sum(case when mask & own > 0 and mask & before = 0 then n else 0 end)::bigint as removed,
         sum(case when mask & own > 0 and mask & before > 0 then n else 0 end)::bigint as redundant, sum(case when mask = own then n else 0 end)::bigint as unique_fails,
         sum(case when mask & own > 0 and mask & before = 0 then good else 0 end)::bigint as good_lost, sum(case when mask & own > 0 and mask & before = 0 then toxic else 0 end)::bigint as toxic_lost
  from c, s group by part, filter_order, step, own
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) over (partition by part, own)::bigint as shapley from x""",
}
