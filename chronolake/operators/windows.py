"""Rolling and ranked measures over time series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.sources.scratch import new_path


def by_time(keys: list[str], date: str = "d"):
    return Window.partitionBy(*keys).orderBy(date)


def percent_change(value: str, keys: list[str], date: str = "d") -> Column:
    """Change against the previous row in percent; null without one, on a null or on zero."""
    before = F.lag(value).over(by_time(keys, date))
    return F.try_divide(F.col(value) - before, before) * 100


def trailing_coverage(spine: DataFrame, keys: list[str], value: str, rows: int = 60, ratio: float = 0.8, date: str = "d") -> DataFrame:
    """On a full calendar spine: observed, coverage (null until rows sessions passed), eligible (covered and observed today)."""
    w = by_time(keys, date)
    seen = spine.withColumn("observed", F.col(value).isNotNull())
    # how many were seen so far, less those before the window: no row looks at a whole window
    seen = seen.withColumns({"__seen": F.sum(F.col("observed").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)), "__n": F.row_number().over(w)})
    count = F.col("__seen") - F.lag("__seen", rows, 0).over(w)
    seen = seen.withColumn("coverage", F.when(F.col("__n") >= rows, count / F.lit(float(rows)))).drop("__seen", "__n")
    return seen.withColumn("eligible", F.coalesce((F.col("coverage") >= ratio) & F.col("observed"), F.lit(False)))


def endpoints(spine: DataFrame, keys: list[str], value: str, lags: tuple[int, ...] = (20, 60), date: str = "d") -> DataFrame:
    """Whether the value is there now and each lag of sessions ago."""
    w = by_time(keys, date)
    now = F.col(value).isNotNull()
    return spine.select(*keys, date, *((now & F.lag(value, k).over(w).isNotNull()).alias(f"endpoint_{k}") for k in lags))


def session_rank(rows: DataFrame, key: str, listed: str, traded: str, date: str = "d") -> DataFrame:
    """Add post_rank: rank of traded sessions since listing, only where the listing date itself was traded."""
    live = F.col(traded) & (F.col(date) >= F.col(listed))
    first = F.min(F.when(live, F.col(date))).over(Window.partitionBy(key))
    rank = F.sum(live.cast("int")).over(by_time([key], date).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("first_traded", first).withColumn("post_rank", F.when(live & (F.col("first_traded") == F.col(listed)), rank))


def first_sessions(rows: DataFrame, key: str, n: int, date: str = "d") -> DataFrame:
    return rows.withColumn("rn", F.row_number().over(by_time([key], date))).where(F.col("rn") <= n)


def latest_row(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole last row of each key, by one aggregation without a sort."""
    rest = [c for c in rows.columns if c not in keys]
    top = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, *(c for c in rest if c not in order))).alias("r"))
    return top.select(*keys, "r.*")


def spread_sample(rows: DataFrame, group: str, order: str, k: int) -> DataFrame:
    """k evenly spaced rows of each group by order, ends included."""
    w = Window.partitionBy(group)
    n = F.count("*").over(w)
    rn = F.row_number().over(w.orderBy(order)) - 1
    numbered = rows.withColumn("n", n).withColumn("rn", rn)
    picks = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (F.col("n") - 1) / F.lit(max(k - 1, 1))).cast("int"))
    return numbered.where(F.array_contains(picks, F.col("rn"))).drop("n", "rn")


def numbered(rows: DataFrame, order: list[str], out: str = "rn") -> DataFrame:
    """Number all rows from 1 by a total order without one task seeing them all.

    Rows are dealt by range and written with the number of their range, so that later reads agree; each range is numbered
    on its own and starts after the rows of the ranges before it.
    """
    path = new_path(rows.sparkSession, "ranges")
    rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()).write.parquet(path)
    dealt = rows.sparkSession.read.parquet(path)
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    starts = sizes.select("__range", before.alias("__before"))
    return dealt.join(starts, "__range").withColumn(out, F.col("__before") + local).drop("__range", "__before")


def modulo_shards(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Add shard: the place of a key in the sorted scope modulo n."""
    return numbered(rows, [key]).withColumn("shard", F.pmod(F.col("rn") - 1, F.lit(n))).drop("rn")
