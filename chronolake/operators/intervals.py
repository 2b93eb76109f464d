"""Validity intervals: stabbing, joins, clipping, compaction, overlap checks.

Bounds are inclusive unless a name says half_open; a null end is open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def end_of(e: Column) -> Column:
    return F.coalesce(e, F.lit(OPEN_END).cast("date"))


def covers(start: Column, end: Column, date: Column) -> Column:
    return (F.coalesce(start, F.lit("0001-01-01").cast("date")) <= date) & (end_of(end) >= date)


def covers_half_open(start: Column, end: Column, date: Column) -> Column:
    return (start <= date) & (end_of(end) > date)


def interval_join(rows: DataFrame, intervals: DataFrame, key: str, date: str, start: str = "s", end: str = "e", how: str = "inner") -> DataFrame:
    """Rows with the intervals of their key that cover their date. The key is the hash key, the range a residual."""
    other = intervals.withColumnRenamed(key, "__key")
    return rows.join(other, (F.col(key) == F.col("__key")) & covers(F.col(start), F.col(end), F.col(date)), how).drop("__key")


def member_days(intervals: DataFrame, cal: DataFrame, key: str = "sym") -> DataFrame:
    """One row for each session of each interval: (key, d). The calendar is small; intervals are expanded through its slots."""
    # each interval unfolds its own days within the calendar's; the calendar, a row a session, says which are sessions
    ends = cal.agg(F.min("d").alias("__lo"), F.max("d").alias("__hi"))
    bounds = intervals.crossJoin(F.broadcast(ends)).select(key, F.greatest("s", "__lo").alias("__s"), F.least(end_of(F.col("e")), F.col("__hi")).alias("__e"))
    days = bounds.where("__s <= __e").select(key, F.explode(F.sequence("__s", "__e", F.expr("interval 1 day"))).alias("d"))
    return days.join(F.broadcast(cal.select("d", "slot")), "d").select(key, "d", "slot")


def clip(intervals: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Intervals inside a window; what lies outside goes."""
    out = intervals.withColumn("s", F.greatest("s", lo)).withColumn("e", F.least(end_of(F.col("e")), hi))
    return out.where("s <= e")


def half_open_to_inclusive(intervals: DataFrame) -> DataFrame:
    return intervals.withColumn("e", F.date_sub("e", 1)).where("e is null or s <= e")


def compact(intervals: DataFrame, key: str = "sym") -> DataFrame:
    """Merge intervals of a key that overlap or touch on the calendar: gaps and islands."""
    w = Window.partitionBy(key).orderBy("s", "e")
    reach = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = intervals.withColumn("e", end_of(F.col("e")))
    rows = rows.withColumn("fresh", F.when(reach.isNull() | (F.col("s") > F.date_add(reach, 1)), 1).otherwise(0))
    rows = rows.withColumn("island", F.sum("fresh").over(w))
    return rows.groupBy(key, "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island")


def overlaps(intervals: DataFrame, key: str = "sym", touching: bool = True) -> DataFrame:
    """Neighbouring intervals of a key that overlap (or touch), and reversed ones: key, s, e, prev_e, problem."""
    w = Window.partitionBy(key).orderBy("s", "e")
    reach = F.max(end_of(F.col("e"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = intervals.withColumn("prev_e", reach)
    limit = F.date_add(F.col("prev_e"), 1) if touching else F.col("prev_e")
    problem = F.when(end_of(F.col("e")) < F.col("s"), "REVERSED").when(F.col("s") <= limit, "OVERLAP")
    return rows.withColumn("problem", problem).where("problem is not null").select(key, "s", "e", "prev_e", "problem")


def snapshots_to_intervals(snapshots: DataFrame, lo: Column, hi: Column, key: str = "sym", date: str = "d") -> DataFrame:
    """Each snapshot is valid until the day before the next one; clipped to a window."""
    dates = snapshots.select(F.col(date).alias("s")).distinct()
    ranges = dates.withColumn("e", F.date_sub(F.lead("s").over(Window.orderBy("s")), 1))
    return clip(snapshots.select(key, F.col(date).alias("s")).join(F.broadcast(ranges), "s"), lo, hi)
