"""Who is chosen: top shares by score, the share that gives a union of a size, overlaps."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.operators.ranking import percentile, placed


def ranked(scores: DataFrame, labels: list[str]) -> DataFrame:
    """Adds r_<label>, the place by score, then device."""
    for k in labels:
        scores = placed(scores, [F.desc(f"score_{k}"), F.col("device_ifa")], f"r_{k}")
    return scores


def places(total: Column | int, percent: Column | float) -> Column:
    """How many a share is, halves to even."""
    total, percent = (c if isinstance(c, Column) else F.lit(c) for c in (total, percent))
    return F.bround(total * percent / 100).cast("bigint")


def top_share(scores: DataFrame, column: str, percent: float) -> DataFrame:
    """Rows at or above the interpolated percentile; ties at the cut stay."""
    cut = percentile(scores, column, 1 - percent / 100).select(F.col("value").alias("_cut"))
    return scores.join(F.broadcast(cut)).where(F.col(column) >= F.col("_cut")).drop("_cut")  # the cut is one row


def top_masks(ranks: DataFrame, labels: list[str], percent: float) -> DataFrame:
    m = places(ranks.count(), percent)
    return ranks.select("*", *[(F.col(f"r_{k}") <= m).cast("int").alias(f"in_{k}") for k in labels])


def percent_for_union(ranks: DataFrame, labels: list[str], target: int, step: float = 0.001, at_least: bool = False, least: float = 0.01) -> DataFrame:
    """One row (pct, n_union): on the grid of ``step`` from ``least`` to 100, the smallest share whose union is nearest to ``target``, or with
    ``at_least`` the smallest that reaches it, 100 if none does.

    Each row is counted at the first share of the grid that takes it by any label; a union is the sum up to a share."""
    spark, total, first, last = ranks.sparkSession, ranks.count(), round(least / step), round(100 / step)
    best = F.least(*[F.col(f"r_{k}") for k in labels]) if len(labels) > 1 else F.col(f"r_{labels[0]}")
    near = F.ceil((best - F.lit(0.5)) * (100 / (max(total, 1) * step))).cast("bigint")
    taken = [F.when((near + i >= 1) & (places(total, (near + i) * F.lit(step)) >= best), near + i) for i in range(-2, 3)]
    counts = ranks.groupBy(F.greatest(F.coalesce(*taken), F.lit(first)).alias("i")).agg(F.count("*").alias("n"))
    ends = spark.createDataFrame([(first, 0), (last, 0)], "i bigint, n bigint")
    grid = counts.union(ends).groupBy("i").agg(F.sum("n").alias("n"))
    # a row a share of the grid at most
    sized = grid.select((F.col("i") * F.lit(step)).alias("pct"), F.sum("n").over(Window.orderBy("i")).alias("n_union"))
    if at_least:
        order = [(F.col("n_union") < target).cast("int"), F.when(F.col("n_union") >= target, F.col("pct")).otherwise(-F.col("pct"))]
    else:
        order = [F.abs(F.col("n_union") - target), F.col("pct")]
    return sized.orderBy(*order).limit(1).select(F.round("pct", 3).alias("pct"), "n_union")


def union_output(masks: DataFrame, labels: list[str]) -> DataFrame:
    """Rows that any label takes, with flags, best first."""
    return masks.where(sum(F.col(f"in_{k}") for k in labels) > 0).orderBy(*[F.desc(f"score_{k}") for k in labels], "device_ifa")


def overlaps(ranks: DataFrame, labels: list[str], percents: list[float]) -> DataFrame:
    """Pairwise overlap at each share, all in one pass."""
    total = ranks.count()
    sums, rows = [], []
    for i, p in enumerate(percents):
        m = places(total, p)
        for a, b in combinations(labels, 2):
            x, y = F.col(f"r_{a}") <= m, F.col(f"r_{b}") <= m
            sums += [F.count_if(c).alias(f"{n}_{i}_{a}_{b}") for n, c in (("a", x), ("b", y), ("i", x & y), ("u", x | y))]
            rows.append(F.struct(F.lit(float(p)).alias("top_pct"), F.lit(a).alias("seed_a"), F.lit(b).alias("seed_b"), F.col(f"a_{i}_{a}_{b}").alias("n_a"), F.col(f"b_{i}_{a}_{b}").alias("n_b"), F.col(f"i_{i}_{a}_{b}").alias("intersection"), F.col(f"u_{i}_{a}_{b}").alias("union")))
    flat = ranks.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return flat.withColumn("inter_over_a", F.round(F.try_divide(F.col("intersection"), F.col("n_a")), 6)).withColumn("n_scored", F.lit(total))
