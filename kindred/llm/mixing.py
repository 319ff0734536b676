"""Mixing sources to target weights with hash-threshold histograms, natively.

Words are summed by source and leading hash digits; the budget's boundary falls in one bucket of each source, and only
that bucket is summed again by the next digits, down to whole hashes. A hash is of a document's id and text; rows that
repeat both go on with digits of their place in the scan, so that no two rows share a hash. The mix is then a filter: a
document gets its source's whole passes, and one more if its hash lies below the source's threshold. Nothing is sorted,
and a hot source is pre-summed to at most 16**digits rows an input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import WORD, cut, text_of, with_rows

#: Leading hash digits that each histogram adds. The first 16 are of id and text, the rest of the row.
LEVELS = (3, 6, 16, 19, 22, 32)
#: Sources whose thresholds are broadcast, counted first; beyond, rows and thresholds are dealt by source and a salt.
BROADCAST_SOURCES, SALTS = 100_000, 16


def words_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, target) from a row a source (source, source_size).

    Sources by code point, null last, take ``weights`` in turn and share the whole size; a target stops at ``most``
    times its source's size and the excess is shared anew by weight. A capped source stays capped while the rest's
    share grows, so the capped ones are a prefix of the order by size for weight."""
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cap = F.col("source_size") * most
    by_ratio = Window.orderBy((F.col("source_size").cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (n - 1) % len(weights) + 1).cast("bigint")).select(
        "*",
        (F.sum(cap).over(by_ratio) - cap).alias("cap_before"),
        (F.sum("weight").over(whole) - F.sum("weight").over(by_ratio) + F.col("weight")).alias("weight_left"),
        F.sum("source_size").over(whole).alias("total"),
    )
    capped = cap * F.col("weight_left") <= (F.col("total") - F.col("cap_before")) * F.col("weight")
    return ranked.withColumn("capped", capped).select(
        "source",
        "source_size",
        F.when(F.col("capped"), cap.cast("double"))
        .otherwise(
            ((F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), cap)).over(whole), F.lit(0))) * F.col("weight")).cast("double")
            / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole)
        )
        .alias("target"),
    )


def _boundary(hist: DataFrame, key: str) -> DataFrame:
    """Of a histogram (source, left, key, words): the first bucket where the running sum goes over ``left``, and what
    is left of the budget before it."""
    run = F.sum("words").over(Window.partitionBy("source").orderBy(key))
    over = hist.withColumn("run", run).where(F.col("run") > F.col("left"))
    first = F.min(F.struct(F.col(key), (F.col("left") - F.col("run") + F.col("words")).alias("left")))
    return over.groupBy("source").agg(first.alias("b")).select("source", f"b.{key}", "b.left")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each input row: doc_id, size, source_size, target, taken, copies.

    size counts words (null or empty text: 0); null is a source of its own, the last. A document is taken ``copies``
    times: its source's whole passes plus one more if its hash is within the source's threshold. Ids may repeat or be
    null: rows of one id and text are taken one by one, too. The words taken of a source lie below its target by less
    than the words of the next hash. An empty table gives an empty result; other columns, whatever their names, are not
    read."""
    rows = cut(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            words_in(text_of(text_col)).alias("size"),
            _hash(id_col, text_col, F.monotonically_increasing_id()).alias("h"),
        ),
        "words",
    )
    copies = _copies(F.col("h"))
    return _on_rows(rows, *thresholds(rows, weights, most)).select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))


def _hash(id_col: str, text_col: str, row: Column) -> Column:
    of = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(text_of(text_col).cast("binary")))
    return F.concat(F.substring(F.md5(of.cast("binary")), 1, 16), F.substring(F.md5(row.cast("string").cast("binary")), 1, 16))


def _on(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join by source, null with null; ``right`` has a row a source and is broadcast."""
    named = right.withColumnRenamed("source", "its")
    return left.join(F.broadcast(named), left["source"].eqNullSafe(named["its"]), how).drop("its")


def _on_rows(rows: DataFrame, plan: DataFrame, few: bool) -> DataFrame:
    """As ``_on`` for all rows: with many sources the rows of each are dealt by a salt, so that a hot one is split."""
    if few:
        return _on(rows, plan)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALTS)))
    named = plan.withColumnRenamed("source", "its").withColumn("its_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(named.hint("merge"), salted["source"].eqNullSafe(named["its"]) & (salted["salt"] == named["its_salt"])).drop("its", "salt", "its_salt")


def thresholds(rows: DataFrame, weights: tuple[int, ...], most: int) -> tuple[DataFrame, bool]:
    """(source, source_size, target, passes, below) from (source, size, h): whole passes, and the hash below which a
    document gets one more; and whether the sources are few enough to be broadcast."""
    top = cut(rows.groupBy("source", F.substring("h", 1, LEVELS[0]).alias("b")).agg(F.sum("size").alias("words")), "histogram")
    targets = source_targets(top.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    plan = cut(targets.withColumn("passes", passes).withColumn("left", F.col("target") - F.col("passes") * F.col("source_size")), "targets")
    few = plan.count() <= BROADCAST_SOURCES
    found = _boundary(_on_rows(top.withColumnRenamed("b", "h"), plan.select("source", "left"), few), "h")
    for n, m in zip(LEVELS, LEVELS[1:]):
        # the boundary bucket alone is summed by more digits
        found = cut(found, "boundary")
        inside = _on_rows(rows, found.withColumnRenamed("h", "at"), few).where(F.substring("h", 1, n) == F.col("at"))
        found = _boundary(inside.groupBy("source", "left", F.substring("h", 1, m).alias("h")).agg(F.sum("size").alias("words")), "h")
    below = found.select("source", F.col("h").alias("below"))
    return cut(_on(plan, below, "left") if few else plan.join(below.withColumnRenamed("source", "its"), F.col("source").eqNullSafe(F.col("its")), "left").drop("its"), "thresholds"), few


def _copies(h: Column) -> Column:
    return F.col("passes") + F.coalesce((h < F.col("below")).cast("bigint"), F.lit(0))


def take_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix_sources`` takes it, rows taken 0 times left out.

    Rows are numbered in one scan, whose written copy is then filtered by its source's threshold; it is not shuffled."""
    tagged = with_rows(docs)
    named = tagged.select("r", F.col(f"r.{source_col}").cast("string").alias("source"), words_in(text_of(f"r.{text_col}")).alias("size"), _hash(f"r.{id_col}", f"r.{text_col}", F.col("row")).alias("h"))
    plan, few = thresholds(cut(named.drop("r"), "words"), weights, most)
    copies = _copies(F.col("h"))
    return _on_rows(named.drop("size"), plan, few).where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).select("r.*")
