"""Index membership rebuilt from an anchor and dated adjustments, without a loop over dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reconstruct(anchor: DataFrame, adjustments: DataFrame, start: Column, end: Column) -> DataFrame:
    """Membership intervals (sym, s, e) over [start, end].

    anchor: sym, the members at end. adjustments: ed, sym, side ('in'/'out'); a symbol that goes out on a
    date was a member until the day before. Events before start do not count. Per symbol the events alternate, so each
    'in' closes at the next 'out', a first 'out' opens at start, a last 'in' closes at end, and an anchor
    symbol without events spans the window.
    """
    live = adjustments.where(F.col("ed") >= start)
    w = Window.partitionBy("sym").orderBy("ed", F.col("side").desc())
    rows = live.withColumn("next_ed", F.lead("ed").over(w)).withColumn("prev_side", F.lag("side").over(w))
    entered = rows.where("side = 'in'").select("sym", F.col("ed").alias("s"), F.coalesce(F.date_sub("next_ed", 1), end).alias("e"))
    before = rows.where("side = 'out' and prev_side is null").select("sym", start.alias("s"), F.date_sub("ed", 1).alias("e"))
    still = anchor.select("sym").join(live.select("sym").distinct(), "sym", "left_anti").select("sym", start.alias("s"), end.alias("e"))
    return entered.unionByName(before).unionByName(still).where("s <= e")


def inconsistent(anchor: DataFrame, adjustments: DataFrame, start: Column) -> DataFrame:
    """Symbols whose sides do not alternate, or whose last side disagrees with the anchor: sym, problem."""
    live = adjustments.where(F.col("ed") >= start)
    w = Window.partitionBy("sym").orderBy("ed", F.col("side").desc())
    repeated = live.withColumn("p", F.lag("side").over(w)).where("p = side").select("sym", F.lit("SIDES_DO_NOT_ALTERNATE").alias("problem")).distinct()
    last = live.groupBy("sym").agg(F.max_by("side", F.struct("ed", F.when(F.col("side") == "in", 1).otherwise(0))).alias("side"))
    both = last.join(anchor.select("sym", F.lit(True).alias("held")), "sym", "left")
    wrong = both.where((F.col("side") == "in") != F.coalesce("held", F.lit(False))).select("sym", F.lit("ANCHOR_DISAGREES").alias("problem"))
    return repeated.unionByName(wrong)


def sizes_backwards(anchor: DataFrame, adjustments: DataFrame) -> DataFrame:
    """ed, size_before: number of members just before each adjustment date, from the anchor backwards.

    One row a date enters the global window; dates are few.
    """
    net = adjustments.groupBy("ed").agg(F.sum(F.when(F.col("side") == "in", 1).otherwise(-1)).alias("net"))
    later = F.sum("net").over(Window.orderBy(F.col("ed").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return net.withColumn("change", later).crossJoin(F.broadcast(anchor.agg(F.count_distinct("sym").alias("n")))).select("ed", (F.col("n") - F.col("change")).alias("size_before"))


def daily_counts(intervals: DataFrame, cal: DataFrame, expected: int | None = None) -> DataFrame:
    """d, members: distinct members on each session, days without any included; with expected also ok.

    Counted from the interval ends (+1, -1) in one running sum, so no member-day is made. Intervals of a symbol
    must not overlap: compact them first.
    """
    ends = intervals.select(F.col("s").alias("x"), F.lit(1).alias("step")).unionByName(intervals.where("e is not null").select(F.date_add("e", 1).alias("x"), F.lit(-1).alias("step")))
    steps = ends.groupBy("x").agg(F.sum("step").alias("step"), F.lit(False).alias("session"))
    sessions = cal.select(F.col("d").alias("x"), F.lit(0).cast("long").alias("step"), F.lit(True).alias("session"))
    run = F.sum("step").over(Window.orderBy("x", "session").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = steps.unionByName(sessions).withColumn("members", run).where("session").select(F.col("x").alias("d"), "members")
    return out if expected is None else out.withColumn("ok", F.col("members") == expected)


def effective_version(manifest: DataFrame, target: Column) -> DataFrame:
    """The manifest row with the latest effective_date at or before target, and all supplements up to it."""
    live = manifest.where(F.col("effective_date") <= target)
    return live.agg(F.max_by("anchor", "effective_date").alias("anchor"), F.max("effective_date").alias("effective_date"), F.array_sort(F.collect_set("supplement")).alias("supplements"))
