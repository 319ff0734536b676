"""Longest-processing-time sharding of groups that must stay together.

Rows with equal texts form a group. LPT gives the largest item to the least-loaded shard, through a heap. The heap's
input is bounded whatever the corpus: groups above ``total / (shards * grain)`` bytes are items of their own (there can
be no more than ``shards * grain`` of them), all smaller groups ride in ``shards * bundles`` hash bundles. Places
within a shard come from counts by (shard, part), so that no task holds a whole shard.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import cut, text_of


def lpt(sizes: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Longest first, each to the shard with the least load; ties by name and by shard number."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for size, name in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, s = heapq.heappop(heap)
        out[name] = s
        heapq.heappush(heap, (load + size, s))
    return out


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8, grain: int = 64, bundles: int = 256, part_rows: int = 2_000) -> DataFrame:
    """One row for each input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus ``overhead``; null text has no bytes, and is in one group with empty text. Law
    ``bytes``: shard sizes are as near as whole groups allow. Rows that repeat an id are rows of their own; null ids
    are kept. slot counts from 0 without gaps in each shard. grown_shard is null under this law. An empty table gives
    an empty result; other columns, whatever their names, are not read."""
    spark = docs.sparkSession
    text = text_of(text_col).cast("binary")
    keys = cut(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            (F.octet_length(text) + F.lit(overhead)).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    total, rows = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    groups = keys.groupBy("digest").agg(F.sum("size").alias("bytes"))
    large = F.col("bytes") * shards * grain > total
    bundle = F.concat(F.lit("b"), F.pmod(F.xxhash64("digest"), F.lit(shards * bundles)).cast("string"))
    item = F.when(large, F.concat(F.lit("g"), F.hex("digest"))).otherwise(bundle)
    # at most shards * (grain + bundles) rows come to the driver
    items = [(r["bytes"], r["item"]) for r in groups.groupBy(item.alias("item")).agg(F.sum("bytes").alias("bytes")).collect()]
    placed = lpt(items, shards)
    alone = spark.createDataFrame([(bytearray.fromhex(k[1:]), s) for k, s in placed.items() if k[0] == "g"], "digest binary, own int")
    riding = spark.createDataFrame([(k, s) for k, s in placed.items() if k[0] == "b"], "bundle string, theirs int")
    parts = max(16, -(-rows // (shards * part_rows)))
    dealt = keys.withColumn("bundle", bundle).join(F.broadcast(riding), "bundle", "left").join(F.broadcast(alone), "digest", "left").select(
        "doc_id", "size", "text_crc32", "row", F.coalesce("own", "theirs").alias("shard"), F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part")
    )
    before = dealt.groupBy("shard", "part").agg(F.count("*").alias("n")).select(
        "shard", "part", (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before")
    )
    place = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row"))
    return dealt.withColumn("place", place).join(before, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("place") - 1).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
