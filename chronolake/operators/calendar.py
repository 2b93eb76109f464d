"""Trading calendars: slots, the dense day dimension, calendar lags and availability dates."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.functions.scalars import has_clock

from . import spread


def slots(dates: DataFrame, date: str = "d") -> DataFrame:
    """d, slot: distinct dates numbered from 1. A calendar is a small dimension, so one window holds it."""
    return dates.select(F.col(date).alias("d")).where("d is not null").distinct().withColumn("slot", F.row_number().over(Window.orderBy("d")))


def identity(cal: DataFrame) -> DataFrame:
    """One row: number of sessions and the hash of their list."""
    listed = F.array_join(F.sort_array(F.collect_list(F.col("d").cast("string"))), ",")
    return cal.agg(F.count("*").alias("n"), F.sha2(listed, 256).alias("identity"))


def dense_days(cal: DataFrame, before: int = 31) -> DataFrame:
    """day, is_session, next_session (strictly later), prev_session (at or before) for every day around the calendar."""
    ends = cal.agg(F.date_sub(F.min("d"), before).alias("lo"), F.max("d").alias("hi"))
    days = ends.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    days = days.join(F.broadcast(cal.select("d")), F.col("day") == F.col("d"), "left")
    back = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.orderBy("day").rowsBetween(1, Window.unboundedFollowing)
    return days.select("day", F.col("d").isNotNull().alias("is_session"), F.first("d", ignorenulls=True).over(ahead).alias("next_session"), F.last("d", ignorenulls=True).over(back).alias("prev_session"))


def tail(cal: DataFrame, date: Column, sessions: int) -> DataFrame:
    """The last sessions up to a date; empty unless the date is a session itself."""
    end = cal.where(F.col("d") == date).select(F.col("slot").alias("end_slot"))
    return cal.join(F.broadcast(end), (F.col("slot") > F.col("end_slot") - sessions) & (F.col("slot") <= F.col("end_slot"))).select("d", "slot")


def available(rows: DataFrame, publication: str, cal: DataFrame) -> DataFrame:
    """Add available (first session that may use a publication) and basis (why).

    publication is text. With a clock time up to 15:00:00 on a session the day itself counts; a date
    alone, a later time or another day waits for the next session; without one, available is null.
    """
    text = F.trim(F.col(publication))
    at = F.try_to_timestamp(text)
    rows = rows.withColumn("__at", at).withColumn("__precise", has_clock(text)).withColumn("__day", F.col("__at").cast("date"))
    rows = rows.join(F.broadcast(dense_days(cal)), F.col("__day") == F.col("day"), "left")
    # days before the calendar wait for its first session
    first = cal.agg(F.min("d").alias("__first"))
    rows = rows.crossJoin(F.broadcast(first))
    session = F.coalesce("is_session", F.lit(False))
    intime = F.col("__precise") & (F.date_format("__at", "HH:mm:ss") <= "15:00:00")
    later = F.when(F.col("__day") < F.col("__first"), F.col("__first")).otherwise(F.col("next_session"))
    day = F.when(session & intime, F.col("__day")).otherwise(later)
    why = (
        F.when(day.isNull(), "NO_LATER_SESSION")
        .when(session & intime, "PRE_OR_AT_CLOSE_TIMESTAMP_SAME_TRADE_DATE")
        .when(~F.col("__precise"), "DATE_ONLY_NEXT_TRADE_DATE")
        .when(session, "AFTER_CLOSE_NEXT_TRADE_DATE")
        .otherwise("NON_TRADING_DAY_NEXT_TRADE_DATE")
    )
    return rows.withColumn("available", day).withColumn("basis", why).drop("__at", "__precise", "__day", "__first", "day", "is_session", "next_session", "prev_session")


def on_spine(rows: DataFrame, cal: DataFrame, keys: list[str], date: str = "d") -> DataFrame:
    """Every key on every session, without filling: columns of rows are null where it has none.

    Only rows are shuffled, by key: each gives its own session and the empty ones up to the next row of its key, the
    first of a key those before it too. The spine is made in the tasks that hold its keys, so windows by key follow
    without another exchange.
    """
    values = [c for c in rows.columns if c not in (*keys, date)]
    sessions = F.broadcast(cal.select(F.col("d").alias(date), "slot"))
    last = cal.agg(F.coalesce(F.max("slot"), F.lit(0)).alias("__last"))
    # rows off the calendar and rows without a whole key stand before the first session: they only name their key
    own = functools.reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    placed = rows.join(sessions, date, "left").withColumn("__at", F.coalesce(F.when(own, F.col("slot")), F.lit(0))).crossJoin(F.broadcast(last))
    w = Window.partitionBy(*keys).orderBy("__at")
    placed = spread.by_key(placed, *keys).select(*keys, *values, "__at", F.coalesce(F.lead("__at").over(w), F.col("__last") + 1).alias("__next"), F.row_number().over(w).alias("__n"))
    low = F.when(F.col("__n") == 1, 1).otherwise(F.greatest("__at", F.lit(1)))
    high = F.greatest(F.col("__next") - 1, F.col("__at"))
    filled = placed.select(*keys, *values, "__at", F.explode(F.when(low <= high, F.sequence(low, high))).alias("slot"))
    filled = filled.select(*keys, "slot", *(F.when(F.col("slot") == F.col("__at"), F.col(c)).alias(c) for c in values))
    return filled.join(sessions, "slot").select(*keys, date, "slot", *values)


def calendar_lag(rows: DataFrame, cal: DataFrame, keys: list[str], value: str, lag: int, out: str, date: str = "d") -> DataFrame:
    """The value exactly lag sessions earlier on the calendar; null if that session has no row. Not a row shift."""
    numbered = rows.join(F.broadcast(cal.select(F.col("d").alias(date), "slot")), date)
    old = numbered.select(*keys, (F.col("slot") + lag).alias("slot"), F.col(value).alias(out))
    return numbered.join(old, [*keys, "slot"], "left")
