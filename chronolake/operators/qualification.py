"""Qualification of inputs: archives, readiness over trailing windows, schedules, shards, capital inputs, revisions, membership of events.

Each function gives rows that say what is there, what is missing and which rule fails; nothing is dropped in silence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import by_time, endpoints, trailing_coverage


def archive_audit(spine: DataFrame, key: str, value: str, rows: int = 60, least: float = 0.8, date: str = "d", digits: int = 6) -> DataFrame:
    """key, sessions, observed, raw_coverage, first_observed, last_observed, gap_before, gap_after, latest_trailing, status of each archive on its full calendar.

    Gaps are sessions before the first and after the last observation; an empty archive has only a gap before. latest_trailing:
    share of the last rows sessions, null on a shorter calendar. Status: EMPTY, PARTIAL_PREHISTORY, INSUFFICIENT_COVERAGE, AUDITED.
    """
    covered = trailing_coverage(spine, [key], value, rows, least, date)
    seen = F.when(F.col("observed"), F.col(date))
    span = Window.partitionBy(key)
    marked = covered.withColumn("__first", F.min(seen).over(span)).withColumn("__last", F.max(seen).over(span))
    g = marked.groupBy(key).agg(
        F.count("*").alias("sessions"), F.count_if("observed").alias("observed"), F.round(F.avg(F.col("observed").cast("int")), digits).alias("raw_coverage"), F.min("__first").alias("first_observed"), F.min("__last").alias("last_observed"),
        F.count_if(F.coalesce(F.col(date) < F.col("__first"), F.lit(True))).alias("gap_before"), F.count_if(F.coalesce(F.col(date) > F.col("__last"), F.lit(False))).alias("gap_after"), F.round(F.max_by("coverage", F.when(F.col("coverage").isNotNull(), F.col(date))), digits).alias("latest_trailing"),
    )
    status = F.when(F.col("observed") == 0, "EMPTY").when(F.col("gap_before") > 0, "PARTIAL_PREHISTORY").when(F.col("observed") < least * F.col("sessions"), "INSUFFICIENT_COVERAGE").otherwise("AUDITED")
    return g.withColumn("status", status)


def trailing_readiness(spine: DataFrame, key: str, value: str, rows: int = 60, least: float = 0.8, lags: tuple[int, int] = (20, 60), date: str = "d") -> DataFrame:
    """key, mature_days, state: QUALIFIED_INPUT if the first session is observed and every session after the first rows ones is eligible with both endpoints.

    DATA_INSUFFICIENT without any observation, PARTIAL_COVERAGE otherwise, a calendar of rows sessions or fewer included.
    """
    ends = endpoints(spine, [key], value, lags, date)
    days = trailing_coverage(spine, [key], value, rows, least, date).join(ends, [key, date])
    days = days.withColumn("__n", F.row_number().over(by_time([key], date)))
    good = F.col("eligible")
    for lag in lags:
        good = good & F.coalesce(F.col(f"endpoint_{lag}"), F.lit(False))
    mature = F.col("__n") > rows
    g = days.groupBy(key).agg(F.count_if(mature).alias("mature_days"), F.bool_and(F.when(mature, good)).alias("__all"), F.bool_or("observed").alias("__any"), F.bool_or((F.col("__n") == 1) & F.col("observed")).alias("__first"))
    state = F.when(~F.col("__any"), "DATA_INSUFFICIENT").when(F.coalesce(F.col("__all") & F.col("__first"), F.lit(False)), "QUALIFIED_INPUT").otherwise("PARTIAL_COVERAGE")
    return g.select(key, "mature_days", state.alias("state"))


def schedule_faults(periods: DataFrame, rows: DataFrame) -> DataFrame:
    """period, n_rows, broken, complete of every expected period, and of periods that nobody expects.

    periods: period (yyyy-MM). rows: period, effective, change, kind, url, status, all text. broken lists what an evidence row
    breaks: DUPLICATE, MISSING, UNEXPECTED, STATUS, and of complete rows CHANGE, DATE, DATE_OUTSIDE, KIND, URL. A period is complete
    if a row says so; a search that found nothing is no evidence of no change.
    """
    empty = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    done = F.coalesce(F.col("status") == "complete", F.lit(False))
    day = F.try_to_date("effective")
    rules = {
        "STATUS": ~F.coalesce(F.col("status").isin("complete", "pending"), F.lit(False)),
        "CHANGE": done & ~F.coalesce(F.col("change").isin("changed", "no_change"), F.lit(False)),
        "DATE": done & day.isNull(),
        "DATE_OUTSIDE": done & (F.date_format(day, "yyyy-MM") != F.col("period")),
        "KIND": done & empty("kind"),
        "URL": done & ~F.coalesce(F.trim("url").rlike("^https?://"), F.lit(False)),
    }
    broken = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())))
    g = rows.withColumn("__b", broken).groupBy("period").agg(F.count("*").alias("n"), F.array_distinct(F.flatten(F.collect_list("__b"))).alias("own"), F.bool_or(done).alias("done"))
    both = periods.select("period").distinct().withColumn("__e", F.lit(True)).join(g, "period", "full_outer")
    wide = {"DUPLICATE": F.col("n") > 1, "MISSING": F.col("n").isNull(), "UNEXPECTED": F.col("__e").isNull()}
    every = F.concat(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in wide.items()))), F.coalesce("own", F.array().cast("array<string>")))
    return both.select("period", F.coalesce("n", F.lit(0)).alias("n_rows"), F.array_join(F.array_sort(every), ",").alias("broken"), F.coalesce("done", F.lit(False)).alias("complete"))


def shard_faults(scope: DataFrame, shards: DataFrame, key: str = "sym") -> DataFrame:
    """rule, n of every fault of shards (shard, shards, key): their counts differ, an index is missing or out of range, a key lies in two, is lost, or is out of scope."""
    counts = shards.agg(F.count_distinct("shards").alias("kinds"), F.max("shards").alias("n"), F.count_distinct(F.when((F.col("shard") >= 0) & (F.col("shard") < F.col("shards")), F.col("shard"))).alias("held"), F.count_distinct(F.when((F.col("shard") < 0) | (F.col("shard") >= F.col("shards")), F.col("shard"))).alias("outside"))
    zero = F.lit(0).cast("long")
    one = lambda name, n: F.struct(F.lit(name).alias("rule"), F.coalesce(n, zero).cast("long").alias("n"))
    heads = counts.select(F.explode(F.array(one("COUNTS_DIFFER", F.greatest(F.col("kinds") - 1, zero)), one("INDEX_MISSING", F.greatest(F.col("n") - F.col("held"), zero)), one("INDEX_OUTSIDE", F.col("outside")))).alias("x")).select("x.*")
    per_key = shards.groupBy(key).agg(F.count_distinct("shard").alias("in_shards"))
    both = scope.select(key).distinct().withColumn("__s", F.lit(True)).join(per_key, key, "full_outer")
    keys = both.agg(F.count_if(F.col("in_shards") > 1).alias("two"), F.count_if(F.col("in_shards").isNull()).alias("lost"), F.count_if(F.col("__s").isNull()).alias("extra"))
    keys = keys.select(F.explode(F.array(one("IN_TWO_SHARDS", F.col("two")), one("LOST", F.col("lost")), one("OUT_OF_SCOPE", F.col("extra")))).alias("x")).select("x.*")
    return heads.unionByName(keys).where("n > 0")


def capital_summary(cal: DataFrame, turnover: DataFrame, financing: DataFrame, target: Column, errors: Column, date: str = "d") -> DataFrame:
    """One row: sessions, turnover_missing, financing_missing, older_missing, future_rows, lag_sessions, ready.

    cal: d, slot. Turnover must have every session up to the target; financing may lack the target alone, as it is published
    later. Rows after the target make it unready, as does any error of a fresh capture.
    """
    days = cal.where(F.col("d") <= target)
    have = lambda rows, name: rows.select(F.col(date).alias("d")).distinct().withColumn(name, F.lit(True))
    g = days.join(have(turnover, "t"), "d", "left").join(have(financing, "f"), "d", "left").agg(
        F.count("*").alias("sessions"), F.count_if(F.col("t").isNull()).alias("turnover_missing"), F.count_if(F.col("f").isNull()).alias("financing_missing"),
        F.count_if(F.col("f").isNull() & (F.col("d") < target)).alias("older_missing"), (F.max("slot") - F.max(F.when(F.col("f"), F.col("slot")))).cast("long").alias("lag_sessions"), F.bool_or(F.col("d") == target).alias("__is_session"),
    )
    ahead = turnover.select(date).unionByName(financing.select(date)).where(F.col(date) > target).agg(F.count("*").alias("future_rows"))
    g = g.join(F.broadcast(ahead), F.lit(True))
    ready = F.coalesce("__is_session", F.lit(False)) & (F.col("turnover_missing") == 0) & (F.col("older_missing") == 0) & (F.col("future_rows") == 0) & F.coalesce(F.col("lag_sessions").isin(0, 1), F.lit(False)) & (errors == 0)
    return g.select("sessions", "turnover_missing", "financing_missing", "older_missing", "future_rows", "lag_sessions", ready.alias("ready"))


def canonical_revisions(rows: DataFrame, identity: list[str], volatile: list[str], available: str, ident: str, state: str | None = None, removable: str = "DATA_INSUFFICIENT") -> DataFrame:
    """rows with revision (KEPT, REDUNDANT, CONFLICT, NOT_REMOVABLE) over one explicit identity.

    Rows of an identity that agree in every column that is not volatile are one revision: the first to become available
    stays (ties: the least ident). Rows that differ anywhere else are a conflict, all of them. With state, only rows in the
    removable state may go.
    """
    values = [c for c in rows.columns if c not in volatile and c not in identity]
    group = Window.partitionBy(*identity)
    content = F.struct(*values) if values else F.lit(0)
    marked = rows.withColumn("__content", F.xxhash64(F.to_json(F.struct(content.alias("c")))))
    differ = F.min("__content").over(group) != F.max("__content").over(group)
    place = F.row_number().over(group.orderBy(F.col(available).asc_nulls_last(), ident))
    kept = F.when(differ, "CONFLICT").when(place == 1, "KEPT")
    late = F.when(F.coalesce(F.col(state) == removable, F.lit(False)), "REDUNDANT").otherwise("NOT_REMOVABLE") if state else F.lit("REDUNDANT")
    return marked.withColumn("revision", F.coalesce(kept, late)).drop("__content")


def events_in_membership(events: DataFrame, members: DataFrame, key: str, day: str, ident: str) -> DataFrame:
    """events that were members on their day, with the interval s..e they fell in; an event that two intervals hold is an error of the intervals.

    members: key, s, e (null: open), any other columns, which travel along.
    """
    held = events.join(members, key).where((F.col("s") <= F.col(day)) & (F.coalesce(F.col("e") >= F.col(day), F.lit(True))))
    n = F.count("*").over(Window.partitionBy(ident))
    return held.withColumn("__n", n).withColumn(ident, F.when(F.col("__n") > 1, F.raise_error(F.lit("two membership intervals hold one event")).cast(events.schema[ident].dataType)).otherwise(F.col(ident))).drop("__n")


def event_interval_counts(events: DataFrame, members: DataFrame, key: str, day: str, ident: str) -> DataFrame:
    """ident, intervals: how many intervals hold each event; more than one is what `events_in_membership` refuses."""
    held = events.select(ident, key, day).join(members.select(key, "s", "e"), key, "left")
    inside = (F.col("s") <= F.col(day)) & F.coalesce(F.col("e") >= F.col(day), F.lit(True))
    return held.groupBy(ident).agg(F.count_if(F.coalesce(inside, F.lit(False))).alias("intervals"))
