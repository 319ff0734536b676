"""Places, running sums and percentiles over a whole table, without a task that holds it.

Rows are dealt to partitions by ranges of the order, sorted within them and written with their numbers; what lies before
a partition is a sum over a row a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.sources.tables import cut

_WITHIN = (1 << 33) - 1


def _dealt(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Adds _part and _own, a partition and a row's number in it, both in ``order``."""
    t = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    return cut(t, "dealt").withColumns({"_part": F.shiftright("_at", 33), "_own": F.col("_at").bitwiseAND(_WITHIN)}).drop("_at")


def _before(t: DataFrame, weight: Column) -> DataFrame:
    """(_part, _before): the weight of all partitions before; a row a partition."""
    sizes = t.groupBy("_part").agg(weight.alias("_size"))
    return F.broadcast(sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before")))


def placed(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``, the place from 1 in ``order``, which must tell any two rows apart for places to repeat."""
    t = _dealt(rows, order)
    return t.join(_before(t, F.count("*")), "_part").withColumn(name, F.col("_before") + F.col("_own") + 1).drop("_part", "_own", "_before")


def running(rows: DataFrame, order: list[Column], weight: str, name: str) -> DataFrame:
    """Adds ``name``, the sum of ``weight`` up to each row in ``order``, the row included."""
    t = _dealt(rows, order)
    own = F.sum(weight).over(Window.partitionBy("_part").orderBy("_own").rowsBetween(Window.unboundedPreceding, 0))
    return t.join(_before(t, F.sum(weight)), "_part").withColumn(name, F.col("_before") + own).drop("_part", "_own", "_before")


def tied_places(rows: DataFrame, column: str, then: str, weight: str, name: str) -> DataFrame:
    """Adds ``name``, the mean place of each value of ``column`` when every row stands for ``weight`` rows.

    Rows are dealt by ``column``, then ``then``, so that a frequent value fills several runs. Counts by run and value tell
    what each value starts from and how often it comes; they are joined by run and value, so that its rows stay spread."""
    t = _dealt(rows, [F.col(column), F.col(then)])
    runs = t.groupBy("_part", column).agg(F.sum(weight).alias("_c")).join(_before(t, F.sum(weight)), "_part")
    run = Window.partitionBy("_part")
    # a value's rows within a run follow those of lesser values there
    low = F.sum("_c").over(run.orderBy(column)) - F.col("_c") + F.col("_before")
    runs = cut(runs.select("_part", column, "_c", low.alias("_low"), ((F.col(column) == F.min(column).over(run)) | (F.col(column) == F.max(column).over(run))).alias("_edge")), "runs")
    # a value in several runs ends or begins each of them: two rows a partition at most
    over = F.broadcast(runs.where("_edge").groupBy(column).agg(F.min("_low").alias("_l"), F.sum("_c").alias("_n")))
    places = runs.join(over, column, "left").select("_part", column, (F.coalesce("_l", "_low") + (F.coalesce("_n", "_c") + 1) / 2).alias(name))
    return t.join(places, ["_part", column]).drop("_part", "_own")


def counted(rows: DataFrame, column: str) -> DataFrame:
    """(value, cnt, run): how often each value comes, and how many rows have it or a lesser one. Nulls are left out."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("cnt"))
    return running(counts, [F.col("value")], "cnt", "run")


def percentile(rows: DataFrame, column: str, share: float) -> DataFrame:
    """One row (value): the percentile, interpolated between the two values around it; null without any."""
    counts = counted(rows, column)
    at = counts.agg(((F.max("run") - 1) * F.lit(share)).alias("_h"))
    value = F.col("value").cast("double")
    low, high = (F.min(F.when(F.col("run") > f(F.col("_h")), value)) for f in (F.floor, F.ceil))
    both = counts.join(F.broadcast(at)).agg(low.alias("low"), high.alias("high"), F.first("_h").alias("h"))  # a row joins
    return both.select((F.col("low") + (F.col("high") - F.col("low")) * (F.col("h") - F.floor("h"))).alias("value"))
