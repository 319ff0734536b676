"""Labelled frames, splits, class weights and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.ranking import counted, percentile, running, tied_places


def shuffled(seed: int, id_col: str = "device_ifa") -> list[Column]:
    """A fixed random order."""
    return [F.md5(F.concat(F.col(id_col), F.lit(f":{seed}")).cast("binary")), F.col(id_col)]


def binary_labels(rows: DataFrame, seeds: DataFrame) -> DataFrame:
    """label 1 for seeds, 0 for the rest."""
    mark = seeds.select("device_ifa", F.lit(1.0).alias("label")).distinct()
    return rows.join(mark, "device_ifa", "left").fillna(0.0, ["label"])


def label_matrix(rows: DataFrame, seeds: dict[str, DataFrame]) -> DataFrame:
    """y_<label> 0/1 by membership, all seed lists in one join."""
    tagged = None
    for k, s in seeds.items():
        own = s.select("device_ifa", F.lit(k).alias("k"))
        tagged = own if tagged is None else tagged.union(own)
    wide = tagged.groupBy("device_ifa").agg(*[F.max((F.col("k") == k).cast("int")).alias(f"y_{k}") for k in seeds])
    return rows.join(wide, "device_ifa", "left").fillna(0, [f"y_{k}" for k in seeds])


def label_code(labels: list[str]) -> Column:
    return sum(F.col(f"y_{k}") * (1 << i) for i, k in enumerate(labels)).cast("bigint")


def class_counts(rows: DataFrame, column: str = "label") -> DataFrame:
    pos = F.count_if(F.col(column) > 0)
    return rows.agg(pos.alias("n_pos"), F.count_if(F.col(column) <= 0).alias("n_neg"), (F.count_if(F.col(column) <= 0) / F.greatest(pos, F.lit(1))).alias("pos_weight"))


def class_weights(rows: DataFrame, column: str = "label") -> DataFrame:
    """Adds weight, the inverse of the class's size."""
    sizes = rows.groupBy(column).agg((1 / F.count("*")).alias("weight"))
    return rows.join(F.broadcast(sizes), column)  # a row a class


def random_places(rows: DataFrame, seed: int, by: list[str]) -> DataFrame:
    """Adds rn, the place in a fixed random order within ``by``, counted by parts of the hash so that no task holds all."""
    part = F.substring(shuffled(seed)[0], 1, 3)
    tagged = rows.withColumn("_part", part)
    w = Window.partitionBy(*by).orderBy("_part") if by else Window.orderBy("_part")
    sizes = tagged.groupBy(*by, "_part").count().select(*by, "_part", (F.sum("count").over(w) - F.col("count")).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*shuffled(seed)))
    # the rows are dealt by these keys already; the counts come to them, and are not copied to all tasks
    return tagged.withColumn("_n", own).join(sizes.hint("merge"), [*by, "_part"]).withColumn("rn", F.col("_before") + F.col("_n")).drop("_part", "_n", "_before")


def random_split(rows: DataFrame, share: float, seed: int = 42) -> DataFrame:
    n = int(rows.count() * share)
    return random_places(rows, seed, []).withColumn("split", F.when(F.col("rn") <= n, "val").otherwise("train")).drop("rn")


def stratified_split(rows: DataFrame, code: str, share: float, seed: int = 42) -> DataFrame:
    """Validation takes each stratum's share, halves to even."""
    sizes = rows.groupBy(code).agg(F.bround(F.count("*") * share).cast("bigint").alias("_v"))
    return random_places(rows, seed, [code]).join(F.broadcast(sizes), code).withColumn("split", F.when(F.col("rn") <= F.col("_v"), "val").otherwise("train")).drop("rn", "_v")


def three_way_split(rows: DataFrame, code: str, val: float = 0.1, test: float = 0.1, seed: int = 42) -> DataFrame:
    """Whole parts of each stratum, rounded down, to test, then validation; the rest trains."""
    n = F.count("*")
    sizes = rows.groupBy(code).agg(F.floor(n * test).alias("_t"), F.floor(n * val).alias("_v"))
    split = F.when(F.col("rn") <= F.col("_t"), "test").when(F.col("rn") <= F.col("_t") + F.col("_v"), "val").otherwise("train")
    return random_places(rows, seed, [code]).join(F.broadcast(sizes), code).withColumn("split", split).drop("rn", "_t", "_v")


def undersample(rows: DataFrame, ratio: int = 20, seed: int = 42, column: str = "label") -> DataFrame:
    """All positives and at most ``ratio`` negatives for each, in a fixed random order."""
    most = rows.where(F.col(column) > 0).count() * ratio
    return rows.where(F.col(column) > 0).unionByName(random_places(rows.where(F.col(column) <= 0), seed, []).where(F.col("rn") <= most).drop("rn"))


def subsample(rows: DataFrame, most: int, seed: int = 42) -> DataFrame:
    """At most ``most`` rows, 0 for all."""
    return rows if most <= 0 else random_places(rows, seed, []).where(F.col("rn") <= most).drop("rn")


def average_ranks(rows: DataFrame, column: str, alias: str) -> DataFrame:
    """(value, rank): the mean place of each value; ties are counted before places are, which then run over distinct
    values."""
    return counted(rows, column).select("value", (F.col("run") - (F.col("cnt") - 1) / 2).alias(alias))


def auc(rows: DataFrame, score: str, label: str) -> DataFrame:
    """One row n_pos, n_neg, auc (null for a single class): rank sum with averaged ties."""
    counts = rows.groupBy(F.col(score).alias("value")).agg(F.count_if(F.col(label) > 0).alias("p"), F.count("*").alias("c"))
    s = running(counts, [F.col("value")], "c", "run").select("p", "c", (F.col("run") - (F.col("c") - 1) / 2).alias("r")).agg(F.sum("p").alias("n_pos"), (F.sum("c") - F.sum("p")).alias("n_neg"), F.sum(F.col("p") * F.col("r")).alias("s"))
    return s.select("n_pos", "n_neg", F.round(F.try_divide(F.col("s") - F.col("n_pos") * (F.col("n_pos") + 1) / 2, F.col("n_pos") * F.col("n_neg")), 6).alias("auc"))


def spearman(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row (spearman): the correlation of mean places, null where a column has one value. Rows with a null in either
    are left out.

    Equal pairs are counted before anything is ordered. A value that many rows share lies in as many runs of the order as it
    fills; its place is worked out over runs, and each run's rows meet it by run and value."""
    pairs = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("w"))
    both = tied_places(tied_places(pairs, "a", "b", "w", "ra"), "b", "a", "w", "rb")
    n = both.agg(F.sum("w").alias("n")).select(((F.col("n") + 1) / 2).alias("mid"))
    x, y, w = F.col("ra") - F.col("mid"), F.col("rb") - F.col("mid"), F.col("w")
    sums = both.join(F.broadcast(n)).agg(F.sum(w * x * y).alias("xy"), F.sum(w * x * x).alias("xx"), F.sum(w * y * y).alias("yy"))  # a row joins
    return sums.select(F.round(F.try_divide("xy", F.sqrt(F.col("xx") * F.col("yy"))), 6).alias("spearman"))


def lift(rows: DataFrame, score: str, label: str, percent: float) -> DataFrame:
    """Rate among the top share, ties at the cut included, over the rate of all."""
    cut = percentile(rows, score, 1 - percent / 100).select(F.col("value").alias("_cut"))
    top = F.col(score) >= F.col("_cut")
    s = rows.join(F.broadcast(cut)).agg(F.count_if(top).alias("n_top"), F.avg(F.when(top, F.col(label))).alias("t"), F.avg(label).alias("a"))
    return s.select("n_top", F.round("t", 6).alias("top_rate"), F.round("a", 6).alias("base_rate"), F.round(F.try_divide("t", "a"), 6).alias("lift"))
