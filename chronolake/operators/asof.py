"""As-of joins: one exchange, one sort, one window, instead of a search for each row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def backward(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str], strict: bool = False) -> DataFrame:
    """left with the values of the last right row at (or, if strict, before) its time; nulls without one.

    Both sides go into one sorted stream a key; right rows come first at equal times unless strict.
    The right side must have one row for each key and time.
    """
    first, second = (1, 0) if strict else (0, 1)
    extra = [c for c in left.columns if c not in keys]
    a = right.select(*keys, F.col(right_time).alias("__t"), F.lit(first).alias("__o"), F.struct(F.col(right_time).alias("__asof"), *values).alias("__v"), *(F.lit(None).cast(left.schema[c].dataType).alias(c) for c in extra))
    b = left.select(*keys, F.col(left_time).alias("__t"), F.lit(second).alias("__o"), F.lit(None).cast(a.schema["__v"].dataType).alias("__v"), *extra)
    w = Window.partitionBy(*keys).orderBy("__t", "__o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = a.unionByName(b).withColumn("__last", F.last("__v", ignorenulls=True).over(w))
    return both.where(F.col("__o") == second).select(*keys, *extra, F.col("__last.__asof").alias("asof_time"), *(F.col(f"__last.{v}").alias(v) for v in values))


def forward(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """left with the values of the first right row strictly after its time."""
    extra = [c for c in left.columns if c not in keys]
    a = right.select(*keys, F.col(right_time).alias("__t"), F.lit(1).alias("__o"), F.struct(F.col(right_time).alias("__asof"), *values).alias("__v"), *(F.lit(None).cast(left.schema[c].dataType).alias(c) for c in extra))
    b = left.select(*keys, F.col(left_time).alias("__t"), F.lit(0).alias("__o"), F.lit(None).cast(a.schema["__v"].dataType).alias("__v"), *extra)
    w = Window.partitionBy(*keys).orderBy(F.col("__t").desc(), F.col("__o")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # walking backwards, left rows of a time come before right rows of that time, so equal times do not match
    both = a.unionByName(b).withColumn("__next", F.last("__v", ignorenulls=True).over(w))
    return both.where("__o = 0").select(*keys, *extra, F.col("__next.__asof").alias("asof_time"), *(F.col(f"__next.{v}").alias(v) for v in values))


def chosen_versions(facts: DataFrame, keys: list[str], order: list[str], value: str, version: str) -> DataFrame:
    """The version that wins for each key: the top rows by order; equal values collapse to the least version, others conflict.

    Returns keys, value (null in conflict), version, conflict, ties.
    """
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    top = facts.withColumn("__rank", F.rank().over(w)).where("__rank = 1")
    out = top.groupBy(*keys).agg(F.count_distinct(value).alias("__n"), F.count("*").alias("ties"), F.min(value).alias("__value"), F.min(version).alias(version))
    return out.select(*keys, F.when(F.col("__n") == 1, F.col("__value")).alias(value), version, (F.col("__n") > 1).alias("conflict"), "ties")


def version_timeline(facts: DataFrame, keys: list[str], available: str, value: str, version: str) -> DataFrame:
    """For each key and availability date the value known from then on: keys, available, value, conflict, until."""
    at = chosen_versions(facts, [*keys, available], [available], value, version)
    w = Window.partitionBy(*keys).orderBy(available)
    return at.withColumn("until", F.date_sub(F.lead(available).over(w), 1))
