"""All queries over the test tables: ``QUERIES`` builds them, ``ORACLE_SQL`` says the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import functions as K
from kindred.operators import features, labels, models, populations, reports, selection
from kindred.plans import runs, scenarios
from kindred.plans.bindings import DIMS, IDS, Tables, sql
from kindred.plans.latest import update_latest
from kindred.sources.files import latest_partition, partitions
from kindred.sources.tables import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(names: str, text: str):
    """Register a function of the test tables with its SQL."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if text:
            ORACLE_SQL[f.__name__] = sql(names, text) if names else text
        return f

    return add


# Predicates


@query("bid", "select year, month, day, count(*) as n from bid where year = '2024' and month = '01' and cast(day as int) <= 20 group by all")
def q_period_filter(t: Tables) -> DataFrame:
    return t.bid.where(K.period("2024-01-01", "2024-01-20")).groupBy("year", "month", "day").agg(F.count("*").alias("n"))


@query("orders_log", "select year, month, count(*) as n from orders_log where year = '1996' and (month in ('01', '02') or (month = '03' and cast(day as int) <= 15)) or year = '1998' and (month in ('05') or (month = '06' and cast(day as int) <= 30)) group by all")
def q_multi_period_filter(t: Tables) -> DataFrame:
    return t.orders_log.where(K.periods([("1996-01-01", "1996-03-15"), ("1998-05-01", "1998-06-30")])).groupBy("year", "month").agg(F.count("*").alias("n"))


def _candidates(t: Tables) -> DataFrame:
    return populations.compliant(t.bid, K.period("2024-01-01", "2024-01-20"))


@query("bid keep", "select device_ifa, count(*) as n from keep group by all")
def q_compliance_filter(t: Tables) -> DataFrame:
    return _candidates(t).groupBy("device_ifa").agg(F.count("*").alias("n"))


@query("nu seed_a seed_x", "select distinct seed_id from (select seed_id from seed_a union all select upper(seed_id) from seed_x union all select 'x' || seed_id from seed_a) where regexp_matches(seed_id, '^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$')")
def q_seed_source(t: Tables) -> DataFrame:
    a = t.seed("a")
    return populations.seed_source(a.union(t.seed("x").select(F.upper("seed_id"))).union(a.select(F.concat(F.lit("x"), "seed_id"))), "seed_id")


@query("", r"select distinct seed_id from (select c_name as seed_id from customer union all select case c_custkey % 3 when 0 then null when 1 then ' ' else chr(9) end from customer) where regexp_matches(seed_id, '\S')")
def q_seed_source_nonuuid(t: Tables) -> DataFrame:
    c = t.read("customer")
    blank = c.select(F.when(F.col("c_custkey") % 3 == 1, " ").when(F.col("c_custkey") % 3 == 2, "\t"))
    return populations.seed_source(c.select(F.col("c_name").alias("seed_id")).union(blank), "seed_id", uuid_only=False)


@query("", """with p as (select o_custkey % 40 as k, strftime(o_orderdate, '%Y') as y, o_orderstatus as f, min(strftime(o_orderdate, '%Y-%m-%d')) as s, max(strftime(o_orderdate, '%Y-%m-%d')) as e from orders group by 1, 2, 3)
select a.k as a, a.y as a_year, a.f as a_status, count(*) as n, count(*) filter (where a.s <= b.e and b.s <= a.e) as n_overlap from p a join p b on (a.k, a.y, a.f) < (b.k, b.y, b.f) group by 1, 2, 3""")
def q_periods_overlap(t: Tables) -> DataFrame:
    """Each period, of a group of customers, a year and a status, against all after it: a small list by construction."""
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    p = t.read("orders").groupBy((F.col("o_custkey") % 40).alias("k"), F.date_format("o_orderdate", "yyyy").alias("y"), F.col("o_orderstatus").alias("f")).agg(F.min(d).alias("s"), F.max(d).alias("e"))
    a, b = (p.select(F.struct("k", "y", "f").alias(f"{n}_of"), F.col("s").alias(f"{n}_start"), F.col("e").alias(f"{n}_end")) for n in "ab")
    both = a.join(F.broadcast(b), F.col("a_of") < F.col("b_of"))
    met = K.overlap(F.col("a_start"), F.col("a_end"), F.col("b_start"), F.col("b_end"))
    return both.groupBy(F.col("a_of.k").alias("a"), F.col("a_of.y").alias("a_year"), F.col("a_of.f").alias("a_status")).agg(F.count("*").alias("n"), F.count_if(met).alias("n_overlap"))


# Sampling. DuckDB has no crc32, so its bits are worked out in SQL.

_CRC = "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({0}, ''), lambda x: ascii(x)::bigint)), lambda a, x: list_reduce(list_prepend(xor(a, x), [1, 2, 3, 4, 5, 6, 7, 8]), lambda r, i: case when (r & 1) = 1 then xor(r >> 1, 3988292384) else r >> 1 end)), 4294967295::bigint)"


@query("", f"select c_custkey from customer where {_CRC.format('c_name')} % 10000 < 500")
def q_hash_sample(t: Tables) -> DataFrame:
    return t.read("customer").where(K.hash_sample(F.col("c_name"), 5.0)).select("c_custkey")


@query("", "select c_custkey from customer where " + _CRC.format("(c_name || ':s1')") + " % 10000 < 1250")
def q_hash_sample_salted(t: Tables) -> DataFrame:
    return t.read("customer").where(K.hash_sample(F.col("c_name"), 12.5, "s1")).select("c_custkey")


@query("", f"select c_custkey from customer where {_CRC.format('c_name')} % 1000 < 50")
def q_hash_sample_legacy(t: Tables) -> DataFrame:
    return t.read("customer").where(F.crc32(F.col("c_name").cast("binary")) % 1000 < 50).select("c_custkey")


@query("", "select count(*) as n, count(*) filter (where k % 100 < 5) as signed_n, count(*) filter (where (k % 100 + 100) % 100 < 5) as pmod_n from (select (c_custkey * 7919) % 20011 - 10005 as k from customer)")
def q_signed_mod_guard(t: Tables) -> DataFrame:
    k = (F.col("c_custkey") * 7919) % 20011 - 10005
    return t.read("customer").select(k.alias("k")).agg(F.count("*").alias("n"), F.count_if(F.col("k") % 100 < 5).alias("signed_n"), F.count_if(F.pmod("k", F.lit(100)) < 5).alias("pmod_n"))


# Populations


@query("snapshots latest", "select * from latest")
def q_latest_segments(t: Tables) -> DataFrame:
    return populations.latest_segments(t.snapshots)


@query("nu snapshots latest seed_a", "select * from latest where device_ifa in (select seed_id from seed_a)")
def q_seed_segments(t: Tables) -> DataFrame:
    return populations.latest_segments(t.snapshots).join(t.seed("a").select(F.col("seed_id").alias("device_ifa")), "device_ifa", "left_semi")


@query("bid keep snapshots latest", "select distinct device_ifa from keep where device_ifa in (select device_ifa from latest)")
def q_population(t: Tables) -> DataFrame:
    return populations.population(_candidates(t), populations.latest_segments(t.snapshots)).select("device_ifa")


def _group(g: str) -> str:
    ids = "[" + ", ".join(f"'{i}'" for i in IDS[g]) + "]"
    return f"list_filter(l, lambda x, i: list_contains({ids}, x) and list_position(l, x) = i)"


_FEATURES = f"""select device_ifa, case when len(g) = 0 then 0.0::double else list_sum(list_transform(g, lambda x: case x when '26455' then 1.0 when '26456' then 0.5 when '26457' then -1.0 else -0.5 end::double)) / len(g) end as gender_score,
  array_to_string(a, ';') as age_bracket_ids, array_to_string(r, ';') as residence_ids, array_to_string(p, ';') as product_interest_ids, array_to_string(c, ';') as content_interest_ids, array_to_string(e, ';') as etc_segment_ids
from (select device_ifa, {_group('gender')} as g, {_group('age')} as a, {_group('residence')} as r, {_group('product')} as p, {_group('content')} as c, {_group('etc')} as e
  from (select device_ifa, string_split(segments, ';') as l from {{0}}))"""


@query("bid keep snapshots latest", _FEATURES.format("(select * from latest where device_ifa in (select device_ifa from keep))"))
def q_population_features(t: Tables) -> DataFrame:
    return features.segment_features(populations.population(_candidates(t), populations.latest_segments(t.snapshots)), IDS)


@query("nu crosswalk seed_x", "select distinct ad_id as device_ifa from crosswalk where platform_ad_id in (select seed_id from seed_x)")
def q_crosswalk(t: Tables) -> DataFrame:
    return populations.crosswalked(t.seed("x"), t.crosswalk, "platform_ad_id")


@query("nu snapshots latest seed_a", "select device_ifa from latest where device_ifa not in (select seed_id from seed_a)")
def q_pool_anti(t: Tables) -> DataFrame:
    return populations.without(populations.latest_segments(t.snapshots).select("device_ifa"), t.seed("a"))


@query("nu snapshots latest seed_a seed_b", "select device_ifa from latest where device_ifa not in (select seed_id from seed_a union select seed_id from seed_b)")
def q_seed_exclusion(t: Tables) -> DataFrame:
    return populations.without(populations.latest_segments(t.snapshots).select("device_ifa"), t.seed("a"), t.seed("b"))


@query("nu seed_a seed_b", "select seed_id as device_ifa from seed_a union select seed_id from seed_b")
def q_seed_union(t: Tables) -> DataFrame:
    return populations.union_ids(t.seed("a"), t.seed("b"))


@query("nu seed_b z", "select device_ifa, z[1] as z_0, z[2] as z_1 from z where device_ifa in (select seed_id from seed_b)")
def q_embeddings_semi(t: Tables) -> DataFrame:
    return t.z.join(t.seed("b").select(F.col("seed_id").alias("device_ifa")), "device_ifa", "left_semi").select("device_ifa", F.col("z")[0].alias("z_0"), F.col("z")[1].alias("z_1"))


@query("z", "select a.device_ifa, a.z[1] as z_0, b.z[2] as z_1 from z a join z b using (device_ifa) where b.label % 2 = 0")
def q_embed_merge(t: Tables) -> DataFrame:
    return populations.merge_embeddings([t.z.select("device_ifa", F.col("z")[0].alias("z_0")), t.z.where("label % 2 = 0").select("device_ifa", F.col("z")[1].alias("z_1"))])


@query("z", "select device_ifa, label from z where label >= 5")
def q_append_dedup(t: Tables) -> DataFrame:
    return populations.append_new(t.z.where("label < 5"), t.z.union(t.z.where("label = 7")).select("device_ifa", "label"))


@query("", "select device_ifa, v from (select device_ifa, v, row_number() over (partition by device_ifa order by f, v) as rn from (select c_mktsegment as device_ifa, c_custkey as v, 0 as f from customer where c_acctbal < 0 union all select c_mktsegment, c_custkey, 1 from customer)) where rn = 1")
def q_keep_first(t: Tables) -> DataFrame:
    c = t.read("customer").select(F.col("c_mktsegment").alias("device_ifa"), F.col("c_custkey").alias("v"), "c_acctbal")
    return populations.keep_first([c.where("c_acctbal < 0").drop("c_acctbal"), c.drop("c_acctbal")], "v")


# ID spaces

_SPACE = """select (select count(*) from s) as n_seed, (select count(*) from s where regexp_matches(seed_id, '^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$')) as n_uuid,
  (select min(length(seed_id)) from s) as min_len, (select max(length(seed_id)) from s) as max_len,
  (select count(*) from s where seed_id in (select device_ifa from latest)) as n_snapshot_direct, (select count(*) from s where seed_id in (select ad_id from crosswalk)) as n_crosswalk_ad_id,
  (select count(*) from s where seed_id in (select uuid from crosswalk)) as n_crosswalk_uuid, (select count(*) from s where seed_id in (select platform_ad_id from crosswalk)) as n_crosswalk_platform_ad_id,
  (select count(*) from s where seed_id in (select device_ifa from bid)) as n_log_direct"""


def _space(t: Tables, name: str) -> DataFrame:
    return populations.id_space(t.seed(name).distinct(), populations.latest_segments(t.snapshots), t.crosswalk, t.bid)


@query("nu snapshots latest crosswalk bid seed_a seed_x", "select 'a' as seed, * from (" + _SPACE.replace(" s)", " seed_a)").replace(" s where", " seed_a where") + ") union all select 'x', * from (" + _SPACE.replace(" s)", " seed_x)").replace(" s where", " seed_x where") + ")")
def q_id_space(t: Tables) -> DataFrame:
    """Two lists in one pass."""
    lists = reduce(DataFrame.union, [t.seed(k).distinct().select(F.lit(k).alias("label"), "seed_id") for k in "ax"])
    return populations.id_spaces(lists, populations.latest_segments(t.snapshots), t.crosswalk, t.bid).withColumnRenamed("label", "seed")


@query("nu snapshots latest crosswalk bid seed_x", """select case when d >= 0.1 and c < 0.1 then 'direct' when d < 0.1 and c >= 0.1 then 'crosswalk' else 'ambiguous' end as mode, case when p >= u then 'platform_ad_id' else 'uuid' end as crosswalk_col,
  round(d, 6) as direct_rate, round(c, 6) as crosswalk_rate from (select greatest(n_snapshot_direct, n_crosswalk_ad_id)::double / n_seed as d, greatest(n_crosswalk_uuid, n_crosswalk_platform_ad_id)::double / n_seed as c, n_crosswalk_platform_ad_id as p, n_crosswalk_uuid as u from (""" + _SPACE.replace(" s)", " seed_x)").replace(" s where", " seed_x where") + "))")
def q_id_space_decision(t: Tables) -> DataFrame:
    return populations.id_space_decision(_space(t, "x"))


@query("nu crosswalk seed_x", "select count(*) as n_seed, count(*) filter (where seed_id in (select platform_ad_id from crosswalk)) as n_matched from (select distinct seed_id from seed_x)")
def q_crosswalk_coverage(t: Tables) -> DataFrame:
    mark = t.crosswalk.select(F.col("platform_ad_id").alias("seed_id"), F.lit(1).alias("m")).distinct()
    return t.seed("x").distinct().join(mark, "seed_id", "left").agg(F.count("*").alias("n_seed"), F.count("m").alias("n_matched"))


@query("nu seed_a", "select length(id) as len, count(*) as n, count(*) filter (where regexp_matches(id, '^[0-9a-f]{8}-')) as n_uuid from (select seed_id as id from seed_a union all select c_name from customer) group by 1")
def q_id_census(t: Tables) -> DataFrame:
    return t.seed("a").union(t.read("customer").select("c_name")).toDF("id").groupBy(F.length("id").alias("len")).agg(F.count("*").alias("n"), F.count_if(F.col("id").rlike("^[0-9a-f]{8}-")).alias("n_uuid"))


@query("nu snapshots latest seed_b", """select count(*) filter (where device_ifa in (select case when ascii(seed_id) % 2 = 0 then upper(seed_id) else seed_id end from seed_b)) as n_exact,
  count(*) filter (where lower(device_ifa) in (select lower(seed_id) from seed_b)) as n_any_case from latest""")
def q_case_join(t: Tables) -> DataFrame:
    ids = t.seed("b").select(F.when(F.ascii("seed_id") % 2 == 0, F.upper("seed_id")).otherwise(F.col("seed_id")).alias("s"))
    latest = populations.latest_segments(t.snapshots).select("device_ifa")
    exact = latest.join(ids, F.col("device_ifa") == F.col("s"), "left_semi").select("device_ifa", F.lit("e").alias("k"))
    loose = latest.join(ids, F.lower("device_ifa") == F.lower("s"), "left_semi").select("device_ifa", F.lit("l").alias("k"))
    return exact.union(loose).agg(F.count_if(F.col("k") == "e").alias("n_exact"), F.count_if(F.col("k") == "l").alias("n_any_case"))


# Features


@query("snapshots latest", f"select device_ifa, array_to_string({_group('age')}, ';') as age, array_to_string({_group('product')}, ';') as product, len({_group('etc')}) as n_etc from (select device_ifa, string_split(segments, ';') as l from latest)")
def q_segment_groups(t: Tables) -> DataFrame:
    return features.segment_groups(populations.latest_segments(t.snapshots), IDS).select("device_ifa", F.array_join("age_ids", ";").alias("age"), F.array_join("product_ids", ";").alias("product"), F.size("etc_ids").cast("bigint").alias("n_etc"))


@query("snapshots latest", "select device_ifa, gender_score from (" + _FEATURES.format("latest") + ")")
def q_gender_score(t: Tables) -> DataFrame:
    return features.segment_features(populations.latest_segments(t.snapshots), IDS).select("device_ifa", "gender_score")


@query("nu snapshots latest seed_b", _FEATURES.format("(select * from latest where device_ifa in (select seed_id from seed_b))"))
def q_segment_features(t: Tables) -> DataFrame:
    latest = populations.latest_segments(t.snapshots).join(t.seed("b").select(F.col("seed_id").alias("device_ifa")), "device_ifa", "left_semi")
    return features.segment_features(latest, IDS)


_LOOKUP = {i: k + 1 for k, i in enumerate(IDS["product"] + IDS["residence"])}
_PRODUCT = f"[{', '.join(repr(i) for i in _LOOKUP)}]"


@query("snapshots", f"select device_ifa, array_to_string(list_transform(list_filter(string_split(segments, ';')[-2:], lambda x: list_contains({_PRODUCT}, x)), lambda x: list_position({_PRODUCT}, x)), ';') as idx from (select ad_id || year || month || day as device_ifa, max(segments) as segments from snapshots group by 1)")
def q_bag_indices(t: Tables) -> DataFrame:
    rows = t.snapshots.groupBy(F.concat("ad_id", "year", "month", "day").alias("device_ifa")).agg(F.max("segments").alias("segments"))
    return features.bag_indices(rows, "segments", _LOOKUP, 2).select("device_ifa", F.array_join(F.col("idx").cast("array<string>"), ";").alias("idx"))


_VOCAB = "vocab as (select token, cnt, row_number() over (order by cnt desc, token) + 1 as idx from (select nullif(trim(string_split(segments, ';')[1]), '') as token, count(*) as cnt from snapshots group by 1) where token is not null)"


def _first_tokens(t: Tables) -> DataFrame:
    return t.snapshots.select("ad_id", K.first_id(F.col("segments")).alias("token"))


@query("", sql("snapshots", "").rstrip() + ", " + _VOCAB + " select token, cnt, idx from vocab where idx < 42")
def q_age_vocab(t: Tables) -> DataFrame:
    return features.vocabulary(_first_tokens(t), max_size=40)


@query("", sql("snapshots", "").rstrip() + ", " + _VOCAB + """ select s.ad_id, s.token, case when s.token is null then 0 else coalesce(v.idx, 1) end as idx
  from (select ad_id, nullif(trim(string_split(segments, ';')[1]), '') as token from snapshots) s left join (select * from vocab where idx < 42) v on s.token = v.token""")
def q_age_encode(t: Tables) -> DataFrame:
    return features.encode_tokens(_first_tokens(t), "token", features.vocabulary(_first_tokens(t), max_size=40))


@query("", "select c_custkey, case when c_custkey % 7 = 0 then null when x = floor(x) then x::bigint::varchar else x::varchar end as token from (select c_custkey, c_custkey / 4 as x from customer)")
def q_vocab_normalize(t: Tables) -> DataFrame:
    x = F.when(F.col("c_custkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("c_custkey") / 4)
    return t.read("customer").select("c_custkey", K.plain_number(x).alias("token"))


@query("", "select p_partkey, concat_ws('>', nullif(trim(split_part(p_type, ' ', 1)), ''), case when p_partkey % 3 > 0 then nullif(trim(p_brand), '') end, nullif(trim(split_part(p_type, ' ', 3)), ''), nullif(trim(p_name), '')) as path from part")
def q_taxonomy_path(t: Tables) -> DataFrame:
    kind = F.split("p_type", " ")
    depth = F.when(F.col("p_partkey") % 3 == 1, F.col("p_brand")).when(F.col("p_partkey") % 3 == 2, F.concat(F.lit(" "), "p_brand")).otherwise(" ")
    return t.read("part").select("p_partkey", K.path_text(kind[0], depth, F.get(kind, F.lit(2)), F.col("p_name")).alias("path"))


_DAYS = ("year", "month", "day")


@query("snapshots", "select max(year || '-' || month || '-' || day) as latest, count(distinct year || month || day) as n_partitions from snapshots")
def q_partition_snapshot(t: Tables) -> DataFrame:
    """Of a partitioned table's folders; its rows are written, and none is read."""
    at = scratch(t.spark, "snapshots")
    t.snapshots.write.partitionBy(*_DAYS).parquet(at)
    return latest_partition(partitions(t.spark, at))


@query("snapshots latest", "select device_ifa, segments from latest")
def q_latest_incremental(t: Tables) -> DataFrame:
    """As q_latest_segments, from a table that is carried on as partitions arrive: a first build, and two updates."""
    at, root, day = scratch(t.spark, "snapshots"), scratch(t.spark, "latest"), F.col("day").cast("int")
    for arrived in (day % 3 == 1, (day % 3 != 1) & (day > 20), (day % 3 != 1) & (day <= 20)):
        t.snapshots.where(arrived).write.mode("append").partitionBy(*_DAYS).parquet(at)
        out = update_latest(t.spark, at, root)
    return out.select("device_ifa", "segments")


# Encoding and scoring, with fixed weights

_W = [[((i * DIMS + j) * 37 % 101 - 50) / 100 for j in range(DIMS)] for i in range(4)]
_B = [0.1, -0.2, 0.3, 0.0]


def _linear(z: str, w: list[float], b: float) -> str:
    return f"(list_sum(list_transform([{', '.join(f'{z}[{j + 1}] * {v}::double' for j, v in enumerate(w))}], lambda x: x)) + {b}::double)"


@query("z", "select device_ifa, " + ", ".join(f"round({_linear('z', w, b)}, 6) as o_{i}" for i, (w, b) in enumerate(zip(_W, _B))) + " from z")
def q_project(t: Tables) -> DataFrame:
    return features.project(t.z, "z", _W, _B).select("device_ifa", *[F.round(F.col("out")[i], 6).alias(f"o_{i}") for i in range(4)])


@query("snapshots latest z", f"""select l.device_ifa, d.d, round(coalesce(avg(v.z[d.d + 1]), 0), 6) as v from (select device_ifa, unnest(case when len(i) = 0 then [null] else i end) as i
  from (select device_ifa, coalesce(list_transform(list_filter(string_split(segments, ';'), lambda x: list_contains({_PRODUCT}, x)), lambda x: list_position({_PRODUCT}, x)), []) as i from latest)) l
  left join (select vec_id as i, embedding::double[] as z from embeddings) v on l.i = v.i cross join (select unnest(range({DIMS}))::int as d) d group by 1, 2""")
def q_bag_mean(t: Tables) -> DataFrame:
    bags = features.bag_indices(populations.latest_segments(t.snapshots), "segments", _LOOKUP, features.MAX_LEN["residence"])
    vectors = t.read("embeddings").select(F.col("vec_id").alias("idx"), F.col("embedding").cast("array<double>").alias("vector"))
    return features.bag_means(bags, vectors, DIMS).select("device_ifa", F.posexplode("v").alias("d", "v")).withColumn("v", F.round("v", 6))


_HEAD = [0.7, -0.4, 0.9, 0.5]
_RELU = "list_transform(h, lambda x: greatest(x, 0))"
_HIDDEN = "[" + ", ".join(_linear("z", w, b) for w, b in zip(_W, _B)) + "]"


@query("z", f"select device_ifa, round(h[1], 6) as z_0, round(h[2], 6) as z_1 from (select device_ifa, [{', '.join(_linear('h', [0.1 * (j + 1) * (1 if i else -1) for j in range(4)], 0.05) for i in range(2))}] as h from (select device_ifa, {_RELU} as h from (select device_ifa, {_HIDDEN} as h from z)))")
def q_encode_z(t: Tables) -> DataFrame:
    second = np.array([[0.1 * (j + 1) * (1 if i else -1) for j in range(4)] for i in range(2)]).T
    out = features.dense_layers(t.z, "z", [(np.array(_W).T, np.array(_B)), (second, np.array([0.05, 0.05]))])
    return out.select("device_ifa", F.round(F.col("out")[0], 6).alias("z_0"), F.round(F.col("out")[1], 6).alias("z_1"))


@query("z", f"select device_ifa, round(1 / (1 + exp(-({_linear('h', _HEAD, -0.1)}))), 6) as score from (select device_ifa, {_RELU} as h from (select device_ifa, {_HIDDEN} as h from z))")
def q_score_mlp(t: Tables) -> DataFrame:
    out = features.dense_layers(t.z, "z", [(np.array(_W).T, np.array(_B)), (np.array([_HEAD]).T, np.array([-0.1]))])
    return out.select("device_ifa", F.round(K.sigmoid(F.col("out")[0]), 6).alias("score"))


@query("z", f"select device_ifa, round(1 / (1 + exp(-({_linear('h', _HEAD, -0.1)}))), 6) as score_a, round(1 / (1 + exp(-({_linear('h', _HEAD[::-1], 0.2)}))), 6) as score_b from (select device_ifa, {_RELU} as h from (select device_ifa, {_HIDDEN} as h from z))")
def q_score_multilabel(t: Tables) -> DataFrame:
    out = features.dense_layers(t.z, "z", [(np.array(_W).T, np.array(_B)), (np.array([_HEAD, _HEAD[::-1]]).T, np.array([-0.1, 0.2]))])
    return out.select("device_ifa", *[F.round(K.sigmoid(F.col("out")[i]), 6).alias(f"score_{k}") for i, k in enumerate("ab")])


# Labels and splits

_Y = "y as (select device_ifa, (label <= 1)::int as y_a, (label in (1, 2))::int as y_b from z)"


def _seeds(t: Tables) -> dict[str, DataFrame]:
    return {"a": t.z.where("label <= 1").select("device_ifa"), "b": t.z.where("label in (1, 2)").select("device_ifa")}


def _matrix(t: Tables) -> DataFrame:
    return labels.label_matrix(t.z.select("device_ifa"), _seeds(t))


def _code(t: Tables) -> DataFrame:
    return _matrix(t).select("device_ifa", labels.label_code(["a", "b"]).alias("code"))


def _binary(t: Tables) -> DataFrame:
    return labels.binary_labels(t.z.select("device_ifa"), _seeds(t)["a"])


@query("z", "select device_ifa, case when label <= 1 then 1.0::double else 0.0::double end as label from z")
def q_label_binary(t: Tables) -> DataFrame:
    return _binary(t)


def _y(text: str) -> str:
    return sql("z", "").rstrip() + ", " + _Y + " " + text


@query("", _y("select sum(y_a)::bigint as n_a, sum(y_b)::bigint as n_b, sum((y_a + y_b > 1)::int)::bigint as n_many, count(*) as n from y"))
def q_label_matrix(t: Tables) -> DataFrame:
    return _matrix(t).agg(F.sum("y_a").alias("n_a"), F.sum("y_b").alias("n_b"), F.count_if(F.col("y_a") + F.col("y_b") > 1).alias("n_many"), F.count("*").alias("n"))


@query("", _y("select (y_a + 2 * y_b)::bigint as code, count(*) as n from y group by 1"))
def q_label_combo(t: Tables) -> DataFrame:
    return _code(t).groupBy("code").agg(F.count("*").alias("n"))


@query("", _y("select sum(y_a)::bigint as n_pos, sum(1 - y_a)::bigint as n_neg, sum(1 - y_a)::double / greatest(sum(y_a), 1) as pos_weight from y"))
def q_pos_weight(t: Tables) -> DataFrame:
    return labels.class_counts(_binary(t))


@query("", _y("select y_a::double as label, count(*) as n, round(1.0 / count(*), 9)::double as weight from y group by 1"))
def q_class_weights(t: Tables) -> DataFrame:
    return labels.class_weights(_binary(t)).groupBy("label").agg(F.count("*").alias("n"), F.round(F.max("weight"), 9).alias("weight"))


@query("", _y("select device_ifa, label from (select device_ifa, y_a::double as label, sum(y_a) over () * 2 as most, row_number() over (partition by y_a order by md5(device_ifa || ':42'), device_ifa) as rn from y) where label = 1 or rn <= most"))
def q_undersample(t: Tables) -> DataFrame:
    return labels.undersample(_binary(t), ratio=2)


@query("", _y("select device_ifa, case when rn <= floor(n * 0.05) then 'val' else 'train' end as split from (select device_ifa, row_number() over (order by md5(device_ifa || ':42'), device_ifa) as rn, count(*) over () as n from y)"))
def q_random_split(t: Tables) -> DataFrame:
    return labels.random_split(t.z.select("device_ifa"), 0.05)


_STRATA = "(select device_ifa, (y_a + 2 * y_b)::bigint as code, row_number() over (partition by y_a, y_b order by md5(device_ifa || ':42'), device_ifa) as rn, count(*) over (partition by y_a, y_b) as n from y)"


@query("", _y(f"select device_ifa, code, case when rn <= round_even(n * 0.1, 0) then 'val' else 'train' end as split from {_STRATA}"))
def q_stratified_split(t: Tables) -> DataFrame:
    return labels.stratified_split(_code(t), "code", 0.1)


@query("", _y(f"select device_ifa, code, case when rn <= floor(n * 0.1) then 'test' when rn <= 2 * floor(n * 0.1) then 'val' else 'train' end as split from {_STRATA}"))
def q_three_way_split(t: Tables) -> DataFrame:
    return labels.three_way_split(_code(t), "code")


@query("z", "select device_ifa from (select device_ifa, row_number() over (order by md5(device_ifa || ':42'), device_ifa) as rn from z) where rn <= 100")
def q_subsample_max_rows(t: Tables) -> DataFrame:
    return labels.subsample(t.z.select("device_ifa"), 100)


# Selection

_KS = ["a", "b", "c"]


def _ranks(t: Tables) -> DataFrame:
    return selection.ranked(t.scores, _KS)


@query("z scores", "select device_ifa, score_a from scores where score_a >= (select quantile_cont(score_a, 0.9) from scores)")
def q_top_pct(t: Tables) -> DataFrame:
    return selection.top_share(t.scores.select("device_ifa", "score_a"), "score_a", 10)


_M = "round_even(n * {0} / 100.0, 0)"


@query("z scores ranks", "select device_ifa, " + ", ".join(f"(r_{k} <= {_M.format(7)})::int as in_{k}" for k in _KS) + " from ranks")
def q_top_masks(t: Tables) -> DataFrame:
    return selection.top_masks(_ranks(t), _KS, 7).select("device_ifa", *[f"in_{k}" for k in _KS])


@query("z scores ranks", f"select count(*) filter (where least(r_a, r_b, r_c) <= {_M.format(10)}) as n_union, count(*) as n from ranks")
def q_union_at_pct(t: Tables) -> DataFrame:
    r = _ranks(t)
    return r.agg(F.count_if(F.least("r_a", "r_b", "r_c") <= selection.places(r.count(), 10)).alias("n_union"), F.count("*").alias("n"))


_GRID = "g as (select i, i * 0.001::double as pct from range(10, 100001) t(i)), sized as (select round(pct, 3) as pct, (select count(*) from ranks where least(r_a, r_b, r_c) <= round_even((select max(n) from ranks) * pct / 100, 0)) as n_union from g) "


def _grid(text: str) -> str:
    return sql("z scores ranks", "").rstrip() + ", " + _GRID + text


@query("", _grid("select * from sized order by abs(n_union - 60), pct limit 1"))
def q_pct_for_union(t: Tables) -> DataFrame:
    return selection.percent_for_union(_ranks(t), _KS, 60)


@query("", _grid("select * from sized where n_union >= 100 order by pct limit 1"))
def q_pct_for_union_atleast(t: Tables) -> DataFrame:
    return selection.percent_for_union(_ranks(t), _KS, 100, at_least=True)


@query("z scores ranks", f"select * from (select device_ifa, score_a, score_b, score_c, " + ", ".join(f"(r_{k} <= {_M.format(5)})::int as in_{k}" for k in _KS) + " from ranks) where in_a + in_b + in_c > 0")
def q_union_output(t: Tables) -> DataFrame:
    return selection.union_output(selection.top_masks(_ranks(t), _KS, 5), _KS).select("device_ifa", *[f"score_{k}" for k in _KS], *[f"in_{k}" for k in _KS])


@query("z scores ranks", f"select device_ifa, score_b as score from ranks where r_b <= {_M.format(5)}")
def q_top_per_label(t: Tables) -> DataFrame:
    return selection.top_masks(_ranks(t), _KS, 5).where("in_b = 1").select("device_ifa", F.col("score_b").alias("score"))


@query("z scores ranks", " union all ".join(f"select {p}::double as top_pct, '{a}' as seed_a, '{b}' as seed_b, count(*) filter (where x) as n_a, count(*) filter (where y) as n_b, count(*) filter (where x and y) as intersection, count(*) filter (where x or y) as \"union\", round(count(*) filter (where x and y)::double / count(*) filter (where x), 6) as inter_over_a, count(*) as n_scored from (select r_{a} <= {_M.format(p)} as x, r_{b} <= {_M.format(p)} as y from ranks)" for p in (2, 4, 6, 8, 10) for a, b in (("a", "b"), ("a", "c"), ("b", "c"))))
def q_overlap_by_pct(t: Tables) -> DataFrame:
    return selection.overlaps(_ranks(t), _KS, [2, 4, 6, 8, 10])


# Metrics and reports

_LABELLED = "l as (select d.n_chars::double as s, l.quality as y, l.toxic as x from documents d join labels l using (doc_id)), "
_AUC = "round((sum(case when {1} > 0 then r end) - count(*) filter (where {1} > 0) * (count(*) filter (where {1} > 0) + 1) / 2.0) / (count(*) filter (where {1} > 0) * count(*) filter (where {1} <= 0))::double, 6)"
_RANK = "(rank() over (order by {0}) + (count(*) over (partition by {0}) - 1) / 2.0)"


def _labelled(t: Tables) -> DataFrame:
    return t.read("documents").join(t.read("labels"), "doc_id").select(F.col("n_chars").cast("double").alias("s"), F.col("quality").alias("y"), F.col("toxic").alias("x"))


@query("", f"with {_LABELLED} k as (select y, {_RANK.format('s')} as r from l) select (count(*) filter (where y > 0)) as n_pos, (count(*) filter (where y <= 0)) as n_neg, {_AUC.format('s', 'y')} as auc from k")
def q_auc(t: Tables) -> DataFrame:
    return labels.auc(_labelled(t), "s", "y")


@query("z", f"select (count(*) filter (where y > 0)) as n_pos, (count(*) filter (where y <= 0)) as n_neg, {_AUC.format('', 'y')} as auc from (select y, {_RANK.format('d')} as r from (select (label <= 1)::int as y, z[1] - z[2] as d from z))")
def q_auc_relative(t: Tables) -> DataFrame:
    return labels.auc(t.z.select((F.col("z")[0] - F.col("z")[1]).alias("d"), (F.col("label") <= 1).cast("int").alias("y")), "d", "y")


@query("z scores", f"select round(corr(x, y), 6) as spearman from (select {_RANK.format('round(score_a, 1)')} as x, {_RANK.format('round(score_b, 1)')} as y from scores)")
def q_spearman(t: Tables) -> DataFrame:
    return labels.spearman(t.scores.select(F.round("score_a", 1).alias("a"), F.round("score_b", 1).alias("b")), "a", "b")


@query("", f"with {_LABELLED} c as (select quantile_cont(s, 0.8) as c from l) select count(*) filter (where s >= c) as n_top, round(avg(y) filter (where s >= c), 6) as top_rate, round(avg(y), 6) as base_rate, round(avg(y) filter (where s >= c) / avg(y), 6) as lift from l, c")
def q_lift(t: Tables) -> DataFrame:
    return labels.lift(_labelled(t), "s", "y", 20)


_DIST = """dist as (select feature_group, segment_id, device_cnt, round(device_cnt::double / (select count(distinct device_ifa) from latest) * 100, 6) as pct_of_total_devices
  from (select segment_id, count(distinct device_ifa) as device_cnt from (select device_ifa, unnest(list_distinct(string_split(segments, ';'))) as segment_id from latest) group by 1) join taxonomy using (segment_id)) """


def _dist(text: str) -> str:
    return sql("snapshots latest taxonomy", "").rstrip() + ", " + _DIST + text


def _distribution(t: Tables) -> DataFrame:
    return reports.segment_distribution(populations.latest_segments(t.snapshots), t.taxonomy)


@query("", _dist("select * from dist"))
def q_segment_distribution(t: Tables) -> DataFrame:
    return _distribution(t)


@query("", _dist("""select feature_group, count(*) as id_count, sum(device_cnt)::bigint as sum_device_cnt, round(avg(device_cnt), 4) as mean, round(median(device_cnt), 4) as median, round(coalesce(stddev_samp(device_cnt), 0), 4) as std,
  round(coalesce(stddev_samp(device_cnt), 0) / avg(device_cnt), 4) as cv, round(sqrt(count(*)), 4) as cv_ceiling, round(coalesce(stddev_samp(device_cnt), 0) / avg(device_cnt) / sqrt(count(*)), 4) as cv_normalized, min(device_cnt) as min, max(device_cnt) as max,
  round(max(device_cnt)::double / sum(device_cnt), 6) as top1_share, round(1.0::double / count(*), 6) as fair_share, round(max(device_cnt)::double / sum(device_cnt) * count(*), 4) as concentration, first(segment_id order by device_cnt desc, segment_id) as top_segment_id
  from dist group by feature_group"""))
def q_segment_group_stats(t: Tables) -> DataFrame:
    return reports.group_stats(_distribution(t))


@query("", _dist("""select feature_group, segment_id, round(row_number() over w::double / count(*) over (partition by feature_group), 6) as rank_share,
  round(sum(device_cnt) over (partition by feature_group order by device_cnt desc, segment_id rows unbounded preceding)::double / sum(device_cnt) over (partition by feature_group), 6) as cum_share from dist window w as (partition by feature_group order by device_cnt desc, segment_id)"""))
def q_lorenz(t: Tables) -> DataFrame:
    return reports.lorenz(_distribution(t))


@query("nu bid snapshots latest seed_b", """select count(*) as n, count(*) filter (where s) as n_segment, count(*) filter (where b) as n_log, count(*) filter (where s and b) as n_both, count(*) filter (where s or b) as n_either,
  round(100.0::double * count(*) filter (where s and b) / count(*), 6) as pct_both from (select seed_id in (select device_ifa from latest) as s, seed_id in (select device_ifa from bid where req_ext_allow_user_data_collection = '1') as b from seed_b)""")
def q_coverage(t: Tables) -> DataFrame:
    marks = populations.latest_segments(t.snapshots).select("device_ifa", F.lit("s").alias("k")).union(t.bid.where("req_ext_allow_user_data_collection = '1'").select("device_ifa", F.lit("b")).distinct())
    wide = marks.groupBy("device_ifa").agg(F.bool_or(F.col("k") == "s").alias("s"), F.bool_or(F.col("k") == "b").alias("b"))
    s, b = F.coalesce("s", F.lit(False)), F.coalesce("b", F.lit(False))
    return t.seed("b").join(wide, F.col("seed_id") == F.col("device_ifa"), "left").agg(
        F.count("*").alias("n"), F.count_if(s).alias("n_segment"), F.count_if(b).alias("n_log"), F.count_if(s & b).alias("n_both"), F.count_if(s | b).alias("n_either"), F.round(100.0 * F.count_if(s & b) / F.count("*"), 6).alias("pct_both")
    )


_CONFIGS = {"plain": (1.0, 0.0), "weighted": (0.5, 0.5), "inverse": (-1.0, 0.2)}
_REPEATED = "reps as (select c.config, r.rep, z.label <= 1 as y, c.a * z.z[1] + c.b * z.z[2 + r.rep] as d from z cross join (values " + ", ".join(f"('{k}', {a}::double, {b}::double)" for k, (a, b) in _CONFIGS.items()) + ") c(config, a, b) cross join (select unnest(range(3))::int as rep) r)"


@query("", sql("z", "").rstrip() + ", " + _REPEATED + f""", areas as (select config, rep, {_AUC.format('', 'y::int')} as auc from (select config, rep, y, rank() over (partition by config, rep order by d) + (count(*) over (partition by config, rep, d) - 1) / 2.0 as r from reps) group by 1, 2)
select config, count(*) as reps, round(avg(auc), 6) as mean_auc, round(stddev_pop(auc), 6) as std_auc from areas group by 1""")
def q_rep_summary(t: Tables) -> DataFrame:
    """Areas of fixed scores, over three repeats of each configuration."""
    parts = []
    for k, (a, b) in _CONFIGS.items():
        for rep in range(3):
            scored = t.z.select((F.lit(a) * F.col("z")[0] + F.lit(b) * F.col("z")[1 + rep]).alias("d"), (F.col("label") <= 1).cast("int").alias("y"))
            parts.append(labels.auc(scored, "d", "y").select(F.lit(k).alias("config"), F.lit(rep).alias("rep"), "auc"))
    return models.repeat_summary(reduce(DataFrame.unionByName, parts))


@query("z", f"select device_ifa, round(1 / (1 + exp(-({_linear('h', _HEAD, -0.1)}))), 6) as score from (select device_ifa, {_RELU} as h from (select device_ifa, {_HIDDEN} as h from z))")
def q_score_saved(t: Tables) -> DataFrame:
    """As q_score_mlp, by a model that was written as a table and read again."""
    params = {"w0": np.array(_W).T, "b0": np.array(_B), "w1": np.array([_HEAD]).T, "b1": np.array([-0.1])}
    at = scratch(t.spark, "model")
    models.save_model(t.spark, models.Classifier(params, ["a"]), at)
    return models.load_model(t.spark, at).score(t.z).select("device_ifa", F.round("score_a", 6).alias("score"))


# A run from end to end, with fixed weights

_AGES = [i * 37 % 11 / 10 for i in range(12)]
_PARTS = {"residence": (0.3, -0.2, 0.1), "product": (-0.4, 0.25, 0.0), "content": (0.15, 0.35, -0.1), "etc": (0.05, -0.3, 0.2)}
_IN = [[(i * 7 + j * 5) % 11 / 10 - 0.45 for j in range(2)] for i in range(6)]
_OUT, _TOP = [[0.8, -0.5], [0.3, 0.9]], [[1.1, -0.7], [0.6, 0.4]]
_AGE_SET = "[" + ", ".join(f"'{i}'" for i in IDS["age"]) + "]"
_X = ["g", "a", *[f"p_{k}" for k in _PARTS]]


def _fixed_run(t: Tables) -> scenarios.Seeds:
    """A seed run whose encoder and classifier are given; direct seeds, candidates of 20 days."""
    spark, root = t.spark, scratch(t.spark, "run")
    layout = runs.Layout(root)
    taxonomy = t.taxonomy.select("segment_id", "feature_group", K.path_text(F.col("depth1"), F.col("depth2"), F.col("name")).alias("path"))
    inputs = scenarios.Inputs(t.bid, t.snapshots, t.crosswalk, taxonomy, lambda texts: np.array([[len(x) % 5, len(x) % 3] for x in texts], float))
    pool = scenarios.Pool(spark, layout, "fixed", runs.PoolSpec((("2023-12-01", "2023-12-31"),)), inputs, "fixed")
    ages = features.segment_features(inputs.latest, IDS).select(K.first_id(F.col("age_bracket_ids")).alias("token"))
    features.vocabulary(ages).write.parquet(f"{pool.encoder}/vocabulary")
    features.lookup(taxonomy, inputs.provider).write.parquet(f"{pool.encoder}/lookup")
    params = {"age": np.array(_AGES)[:, None], "w0": np.array(_IN), "b0": np.array([0.2, -0.1]), "w1": np.array(_OUT), "b1": np.array([0.05, -0.05])}
    for g, (x, y, shift) in _PARTS.items():
        params |= {f"project_{g}": np.array([[x], [y]]), f"shift_{g}": np.array([shift])}
    models.save_model(spark, models.Autoencoder(params, list(_PARTS), len(_AGES)), f"{pool.encoder}/model")
    models.save_model(spark, models.Classifier({"w0": np.array(_TOP), "b0": np.array([0.1, -0.2])}, ["a", "b"]), f"{root}/given")
    seeds = {k: populations.seed_source(t.seed(k), "seed_id") for k in "ab"}
    return scenarios.Seeds(spark, layout, "fixed", pool, seeds, [("2024-01-01", "2024-01-20")], "direct", 30.0, model=f"{root}/given")


def _dot(names: list[str], weights: list[float], bias: float) -> str:
    return " + ".join([f"{n} * {w}::double" for n, w in zip(names, weights)]) + f" + {bias}::double"


_RUN = sql("nu seed_a seed_b bid keep snapshots latest taxonomy", "").rstrip() + f""", lists as (select device_ifa, list_distinct(string_split(segments, ';')) as s, list_filter(string_split(segments, ';'), lambda x: list_contains({_AGE_SET}, x))[1] as token from latest),
vocab as (select token, row_number() over (order by count(*) desc, token) + 1 as idx from lists where token is not null group by token),
vectors as (select segment_id, feature_group, length(p) % 5 as v1, length(p) % 3 as v2 from (select *, concat_ws('>', nullif(trim(depth1), ''), nullif(trim(depth2), ''), nullif(trim(name), '')) as p from taxonomy)),
chosen as (select l.*, coalesce(v.idx, 0) as idx from lists l left join vocab v using (token) where device_ifa in (select device_ifa from keep) and device_ifa not in (select seed_id from seed_a union select seed_id from seed_b)),
means as (select device_ifa, feature_group, avg(v1) as m1, avg(v2) as m2 from (select device_ifa, unnest(s) as segment_id from chosen) join vectors using (segment_id) group by 1, 2),
wide as (select device_ifa, any_value([{', '.join(f'{a}::double' for a in [0.0, *_AGES[1:]])}][idx + 1]) as a, """ + ", ".join(f"coalesce(max(case when feature_group = '{k}' then m1 * {x}::double + m2 * {y}::double end), 0) + {z}::double as p_{k}" for k, (x, y, z) in _PARTS.items()) + f""" from chosen left join means using (device_ifa) group by device_ifa),
genders as (select device_ifa, coalesce(gender_score, 0) as g from ({_FEATURES.format("latest")})),
hidden as (select device_ifa, greatest(0, {_dot(_X, [w[0] for w in _IN], 0.2)}) as h1, greatest(0, {_dot(_X, [w[1] for w in _IN], -0.1)}) as h2 from wide join genders using (device_ifa)),
codes as (select device_ifa, ({_dot(['h1', 'h2'], [_OUT[0][0], _OUT[1][0]], 0.05)})::float::double as z1, ({_dot(['h1', 'h2'], [_OUT[0][1], _OUT[1][1]], -0.05)})::float::double as z2 from hidden),
scored as (select device_ifa, 1 / (1 + exp(-({_dot(['z1', 'z2'], [_TOP[0][0], _TOP[1][0]], 0.1)}))) as score_a, 1 / (1 + exp(-({_dot(['z1', 'z2'], [_TOP[0][1], _TOP[1][1]], -0.2)}))) as score_b from codes),
placed as (select *, row_number() over (order by score_a desc, device_ifa) as r_a, row_number() over (order by score_b desc, device_ifa) as r_b, count(*) over () as n from scored),
taken as (select device_ifa, round(score_a, 5) as score_a, round(score_b, 5) as score_b, (r_a <= {_M.format(30)})::int as in_a, (r_b <= {_M.format(30)})::int as in_b, r_a, r_b, n from placed) """


@query("", _RUN + "select device_ifa, score_a, score_b, in_a, in_b from taken")
def q_run_scores(t: Tables) -> DataFrame:
    """Scores and choices of a whole run: seeds resolved and left out, candidates, features, encoding, scoring, shares."""
    return _fixed_run(t).run("score").select("device_ifa", F.round("score_a", 5).alias("score_a"), F.round("score_b", 5).alias("score_b"), "in_a", "in_b")


@query("", _RUN + f"""select p::double as top_pct, count(*) filter (where r_a <= m) as n_a, count(*) filter (where r_b <= m) as n_b, count(*) filter (where r_a <= m and r_b <= m) as intersection, max(n) as n_scored
  from (select *, round_even(n * p / 100.0, 0) as m from taken cross join (select unnest([6, 12, 18, 24, 30]) as p)) group by p""")
def q_run_overlap(t: Tables) -> DataFrame:
    """The overlap report that such a run leaves."""
    run = _fixed_run(t)
    run.run()
    return t.spark.read.parquet(f"{run.root}/overlap").select("top_pct", "n_a", "n_b", "intersection", "n_scored")
