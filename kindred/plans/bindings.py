"""The operators' inputs, derived from the test tables, as DataFrames and as the same in SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the first segment IDs of each group
_IDS = {
    "gender": "26455 26456 26457 26458",
    "age": "10003 10004 10005 10006 10007 10008 10009",
    "residence": "10406 10407 10408 10409 10410 10411 10412 10413 10414 10415 10416 10417 10418 11704 11705 11706 11707 11708 11709 11710 11711 11712 11713 11714 11715",
    "product": "10010 10011 10012 10013 10014 10021 10022 10023 10024 10025 10026 10027 10028 10029 10030 10031 10032 10033 10034 20484 49688 49689 49690 10047 10048",
    "content": "26280 26281 26282 26284 26285 26286 26287 26288 26289 26290 26291 26292 26293 26294 26295 26299 26306 26308 26309 26310 26311 26312 26313 26314 26425",
    "etc": "26937 26941 26946 49386 49387 26948 26949 26950 26952 26957 27009 26610 27151 27209 27699",
}
IDS = {g: s.split() for g, s in _IDS.items()}
ALL = [i for s in IDS.values() for i in s] + ["99990", "99991", "99992", "99993"]
DIMS = 64


def uuid(x) -> F.Column:
    return F.regexp_replace(F.md5(x.cast("string").cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def _uuid(x: str) -> str:
    return rf"regexp_replace(md5(({x})::varchar), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\1-\2-\3-\4-\5')"


class Tables:
    """DataFrames by name; each is built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @staticmethod
    def _keys(ts: str) -> list:
        return [F.date_format(ts, p).alias(n) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))]

    @property
    def bid(self) -> DataFrame:
        u = F.col("user_id")
        return self.read("events").select(
            uuid(u).alias("device_ifa"), *self._keys("ts"), F.when(F.col("event_type") == "error", "0").otherwise("1").alias("req_ext_allow_user_data_collection"),
            F.when(u % 7 == 0, "1").when(u % 7 != 1, "0").alias("device_lmt"), F.when(u % 5 == 0, "US-CA").otherwise("KR-11").alias("device_geo_region"),
            F.when(u % 3 == 2, "17.1.2").otherwise("14").alias("device_osv"),
        )

    @property
    def orders_log(self) -> DataFrame:
        return self.read("orders").select("o_orderkey", *self._keys("o_orderdate"))

    @property
    def snapshots(self) -> DataFrame:
        t, e = F.array(*map(F.lit, ALL)), F.col("event_id")
        k = F.get_json_object("props", "$.k").cast("int")
        at = lambda x: F.get(t, x)
        return self.read("events").select(
            uuid(F.col("user_id")).alias("ad_id"), F.when(e % 10 == 0, "1").otherwise("2").alias("id_type"),
            F.when(e % 89 == 0, None).when(e % 97 == 0, "").otherwise(F.concat_ws(";", at(k), at((k * 7 + 3) % 100), at((k * 13 + 29) % 100))).alias("segments"), *self._keys("ts"),
        )

    @cached_property
    def users(self) -> int:
        return self.read("events").agg(F.countDistinct("user_id")).first()[0]

    @property
    def crosswalk(self) -> DataFrame:
        return self.read("orders").select(
            uuid(F.col("o_orderkey") % (2 * self.users)).alias("ad_id"), uuid(F.concat(F.lit("p"), "o_custkey")).alias("platform_ad_id"), uuid(F.concat(F.lit("u"), "o_orderkey")).alias("uuid")
        )

    def seed(self, name: str) -> DataFrame:
        c = self.read("customer")
        if name == "x":
            return c.where("c_mktsegment = 'MACHINERY'").select(uuid(F.concat(F.lit("p"), "c_custkey")).alias("seed_id"))
        return c.where(F.col("c_custkey") < 2 * self.users).where("c_mktsegment = 'BUILDING'" if name == "a" else "c_acctbal > 4000").select(uuid(F.col("c_custkey")).alias("seed_id"))

    @property
    def z(self) -> DataFrame:
        """Embeddings: a device, its vector, its class."""
        return self.read("embeddings").select(uuid(F.col("vec_id")).alias("device_ifa"), F.col("embedding").cast("array<double>").alias("z"), "label")

    @property
    def scores(self) -> DataFrame:
        return self.z.select("device_ifa", *[F.col("z")[i].alias(f"score_{k}") for i, k in enumerate("abc")])

    @property
    def taxonomy(self) -> DataFrame:
        rows = [(i, g, g, str(j % 3) if j % 4 else " ", None if j % 5 == 0 else f"n{j}") for g, s in IDS.items() for j, i in enumerate(s)]
        return self.spark.createDataFrame(rows, "segment_id string, feature_group string, depth1 string, depth2 string, name string")


_T = "[" + ", ".join(f"'{i}'" for i in ALL) + "]"
_KEYS = "strftime({0}, '%Y') as year, strftime({0}, '%m') as month, strftime({0}, '%d') as day"
SQL = {
    "nu": "nu as (select count(distinct user_id) as n from events)",
    "bid": f"""bid as (select {_uuid('user_id')} as device_ifa, {_KEYS.format('ts')}, case when event_type = 'error' then '0' else '1' end as req_ext_allow_user_data_collection,
      case user_id % 7 when 0 then '1' when 1 then null else '0' end as device_lmt, case when user_id % 5 = 0 then 'US-CA' else 'KR-11' end as device_geo_region,
      case when user_id % 3 = 2 then '17.1.2' else '14' end as device_osv from events)""",
    "orders_log": f"orders_log as (select o_orderkey, {_KEYS.format('o_orderdate')} from orders)",
    "snapshots": f"""snapshots as (select {_uuid('user_id')} as ad_id, case when event_id % 10 = 0 then '1' else '2' end as id_type,
      case when event_id % 89 = 0 then null when event_id % 97 = 0 then '' else {_T}[k + 1] || ';' || {_T}[(k * 7 + 3) % 100 + 1] || ';' || {_T}[(k * 13 + 29) % 100 + 1] end as segments,
      {_KEYS.format('ts')} from (select *, json_extract_string(props, '$.k')::int as k from events))""",
    "latest": """latest as (select ad_id as device_ifa, segments from (select *, row_number() over (partition by ad_id order by year desc, month desc, day desc, segments desc nulls last) as rn
      from snapshots where not (year = '2024' and month = '12' and day = '31') and id_type = '2' and trim(ad_id) <> '') where rn = 1)""",
    "crosswalk": f"crosswalk as (select {_uuid('o_orderkey % (2 * (select n from nu))')} as ad_id, {_uuid(chr(39) + 'p' + chr(39) + ' || o_custkey')} as platform_ad_id, {_uuid(chr(39) + 'u' + chr(39) + ' || o_orderkey')} as uuid from orders)",
    "seed_a": f"seed_a as (select {_uuid('c_custkey')} as seed_id from customer where c_custkey < 2 * (select n from nu) and c_mktsegment = 'BUILDING')",
    "seed_b": f"seed_b as (select {_uuid('c_custkey')} as seed_id from customer where c_custkey < 2 * (select n from nu) and c_acctbal > 4000)",
    "seed_x": f"seed_x as (select {_uuid(chr(39) + 'p' + chr(39) + ' || c_custkey')} as seed_id from customer where c_mktsegment = 'MACHINERY')",
    "z": f"z as (select {_uuid('vec_id')} as device_ifa, embedding::double[] as z, label from embeddings)",
    "scores": "scores as (select device_ifa, z[1] as score_a, z[2] as score_b, z[3] as score_c from z)",
    "ranks": "ranks as (select *, row_number() over (order by score_a desc, device_ifa) as r_a, row_number() over (order by score_b desc, device_ifa) as r_b, row_number() over (order by score_c desc, device_ifa) as r_c, count(*) over () as n from scores)",
    "taxonomy": "taxonomy as (select * from (values " + ", ".join(f"('{i}', '{g}', '{g}', '{j % 3 if j % 4 else ' '}', {'null' if j % 5 == 0 else chr(39) + f'n{j}' + chr(39)})" for g, s in IDS.items() for j, i in enumerate(s)) + ") t(segment_id, feature_group, depth1, depth2, name))",
    "keep": """keep as (select * from bid where year = '2024' and month = '01' and cast(day as int) <= 20 and trim(device_ifa) <> '' and req_ext_allow_user_data_collection = '1'
      and (device_lmt is null or device_lmt <> '1') and device_geo_region like 'KR%' and regexp_matches(device_osv, '^[0-9]+$'))""",
}


def sql(names: str, query: str) -> str:
    """``query`` after the named parts."""
    return "with " + ",\n".join(SQL[n] for n in names.split()) + "\n" + query
