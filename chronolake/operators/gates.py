"""Coverage, readiness and audit gates: aggregates over given frames that say what is there and what is missing.

Columns are named by the caller. Null keys form groups of their own unless a docstring says otherwise; repeated rows
count as often as they come; empty frames give no groups, and whole-table gates give one row of zeros or nulls.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merged_snapshots(rows: DataFrame, key: str, tag: str, label: str) -> DataFrame:
    """key, tags, label, n: one row a key over snapshots of several indexes; tags distinct and sorted, the least label stays."""
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(tag)), ",").alias("tags"), F.min(label).alias(label), F.count("*").alias("n"))


def universe_diagnostics(rows: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """n_rows, symbols, point_in_time: whether every row starts and ends no earlier (an open end is no fault)."""
    sound = F.col(start).isNotNull() & F.coalesce(F.col(end) >= F.col(start), F.lit(True))
    return rows.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("symbols"), F.bool_and(sound).alias("point_in_time"))


def cardinality(rows: DataFrame, segment: Column, key: str, expected: int) -> DataFrame:
    """segment, members, as_expected: distinct members of each segment against the number it must have."""
    return rows.groupBy(segment.alias("segment")).agg(F.count_distinct(key).alias("members")).withColumn("as_expected", F.col("members") == expected)


def eligible_coverage(rows: DataFrame, by: str, eligible: Column, digits: int = 6) -> DataFrame:
    """by, rows_observed, rows_eligible, coverage: share of rows that meet a condition; a null condition is not met."""
    met = F.count_if(eligible)
    return rows.groupBy(by).agg(F.count("*").alias("rows_observed"), met.alias("rows_eligible"), F.round(met / F.count("*"), digits).alias("coverage"))


def median_scale(rows: DataFrame, feed: Column, value: str, base: str, most: float) -> DataFrame:
    """feed, two exact medians and whether their ratio is plausible: a feed in another unit stands out."""
    m = rows.groupBy(feed.alias("feed")).agg(F.median(value).alias(f"median_{value}"), F.median(base).alias(f"median_{base}"))
    return m.withColumn("plausible", F.col(f"median_{value}") / F.col(f"median_{base}") <= most)


def revision_ambiguity(rows: DataFrame, keys: list[str], version: str, value: str) -> DataFrame:
    """keys, revisions, value_conflict, versions: keys that more than one version claims at the same time."""
    g = rows.groupBy(*keys).agg(F.count_distinct(version).alias("revisions"), (F.count_distinct(value) > 1).alias("value_conflict"), F.array_join(F.array_sort(F.collect_set(version)), ",").alias("versions"))
    return g.where("revisions > 1")


def field_coverage(rows: DataFrame, field: str, entity: str, scope: int, period: str, gap: Column, digits: int = 6) -> DataFrame:
    """field, n_rows, entities, ratio (of a scope of entities), first_period, last_period, gaps."""
    return rows.groupBy(field).agg(F.count("*").alias("n_rows"), F.count_distinct(entity).alias("entities"), F.round(F.count_distinct(entity) / F.lit(float(scope)), digits).alias("ratio"), F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.count_if(gap).alias("gaps"))


def distribution(rows: DataFrame, by: list[str], day: Column) -> DataFrame:
    """Counts with first and last day by every prefix of the given columns (a rollup)."""
    return rows.rollup(*by).agg(F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def probe_profile(rows: DataFrame, source: str, day: Column, code: str) -> DataFrame:
    """source, n, first_day, last_day, codes: what a probe of each source returned."""
    return rows.groupBy(source).agg(F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count_distinct(code).alias("codes"))


def bundle_quality(rows: DataFrame, scope: DataFrame, key: str, day: str, digits: int = 6) -> DataFrame:
    """latest, symbols, coverage of a bundle against its scope of keys; an empty scope gives null coverage."""
    scope = scope.select(key).distinct()
    inside = rows.join(scope, key, "left_semi").agg(F.max(day).alias("latest"), F.count_distinct(key).alias("symbols"))
    total = scope.agg(F.count("*").alias("total"))
    return inside.crossJoin(total).select("latest", "symbols", F.round(F.try_divide(F.col("symbols"), F.col("total")), digits).alias("coverage"))


def market_quality(bars: DataFrame, universe: DataFrame, key: str, day: str, floor: float = 0.95, start: str = "effective_start", end: str = "effective_end", digits: int = 6) -> DataFrame:
    """One row: latest, universe_symbols, seen_symbols, active_symbols, active_seen, both coverages, passed.

    Historical coverage: symbols of the universe with any bar. Active coverage: of the symbols whose membership holds the
    latest day of all bars, those with a bar on it. Both must reach floor; an empty side has coverage 0.
    """
    latest = bars.agg(F.max(day).alias("latest"))
    traded = bars.select(key, day).join(F.broadcast(latest), F.lit(True)).groupBy(key).agg(F.bool_or(F.col(day) == F.col("latest")).alias("__now"))
    held = universe.join(F.broadcast(latest), F.lit(True))
    inside = (F.col(start) <= F.col("latest")) & F.coalesce(F.col(end) >= F.col("latest"), F.lit(True))
    held = held.groupBy(key).agg(F.coalesce(F.bool_or(inside), F.lit(False)).alias("__active")).where(F.col(key).isNotNull())
    rows = held.join(traded, key, "left")
    now = F.col("__active") & F.coalesce("__now", F.lit(False))
    counts = rows.agg(F.count("*").alias("universe_symbols"), F.count("__now").alias("seen_symbols"), F.count_if("__active").alias("active_symbols"), F.count_if(now).alias("active_seen"))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    past, present = share("seen_symbols", "universe_symbols"), share("active_seen", "active_symbols")
    return latest.join(F.broadcast(counts), F.lit(True)).select("latest", "universe_symbols", "seen_symbols", "active_symbols", "active_seen", F.round(past, digits).alias("historical_coverage"), F.round(present, digits).alias("active_coverage"), ((past >= floor) & (present >= floor)).alias("passed"))


def bundle_faults(metadata: DataFrame, prices: DataFrame, status: DataFrame, key: str, columns: dict[str, list[str]], floor: float) -> DataFrame:
    """rule, n of every rule that a public bundle breaks; an empty result is a sound bundle.

    Schema equality (metadata, prices, status against columns), prices inside the metadata, coverage of its symbols by
    prices, and a status for exactly its symbols. n: the columns or symbols at fault.
    """
    spark, faults = metadata.sparkSession, []
    for name, df in (("metadata", metadata), ("prices", prices), ("status", status)):
        faults.append((f"{name.upper()}_COLUMNS", len(set(df.columns) ^ set(columns[name])) or int(df.columns != columns[name])))
    schema = spark.createDataFrame(faults, "rule string, n long")
    known, priced, stated = (df.select(key).where(F.col(key).isNotNull()).distinct() for df in (metadata, prices, status))
    count = lambda rows, name: rows.agg(F.lit(name).alias("rule"), F.count("*").alias("n"))
    seen = known.join(priced.withColumn("__p", F.lit(1)), key, "left").agg(F.count("*").alias("all"), F.count("__p").alias("priced"))
    short = seen.select(F.lit("PRICE_COVERAGE").alias("rule"), F.when(F.coalesce(F.try_divide("priced", "all"), F.lit(0.0)) < floor, F.greatest(F.col("all") - F.col("priced"), F.lit(1))).otherwise(0).alias("n"))
    rows = schema.unionByName(count(priced.join(known, key, "left_anti"), "PRICE_OUTSIDE_METADATA")).unionByName(short)
    rows = rows.unionByName(count(known.join(stated, key, "left_anti"), "SYMBOL_WITHOUT_STATUS")).unionByName(count(stated.join(known, key, "left_anti"), "STATUS_OUTSIDE_METADATA"))
    return rows.where("n > 0")


def scheduled(periods: DataFrame, rows: DataFrame, period: str, most: int) -> DataFrame:
    """period, n_rows, state of every scheduled period: MISSING without rows, DUPLICATE with more than most, else OK."""
    seen = rows.groupBy(period).agg(F.count("*").alias("n"))
    state = F.when(F.col("n").isNull(), "MISSING").when(F.col("n") > most, "DUPLICATE").otherwise("OK")
    return periods.join(seen, period, "left").select(period, F.coalesce("n", F.lit(0)).alias("n_rows"), state.alias("state"))


def blockers(rows: DataFrame, by: str, rules: dict[str, Column]) -> DataFrame:
    """by, blockers: names of the rules (aggregate conditions) that block a stage, in the order given; null conditions do not block."""
    return rows.groupBy(by).agg(F.concat_ws(",", *(F.when(rule, F.lit(name)) for name, rule in rules.items())).alias("blockers"))


def entity_readiness(scope: DataFrame, receipts: DataFrame, key: str, counted: dict[str, Column]) -> DataFrame:
    """key, receipts, state and conditional counts of every entity in scope; MISSING without a receipt."""
    g = receipts.groupBy(key).agg(F.count("*").alias("n"), *(F.count_if(c).alias(f"__{k}") for k, c in counted.items()))
    zero = lambda c: F.coalesce(c, F.lit(0))
    state = F.when(F.col("n").isNull(), "MISSING").otherwise("READY")
    return scope.join(g, key, "left").select(key, zero("n").alias("receipts"), state.alias("state"), *(zero(f"__{k}").alias(k) for k in counted))


def segments(rows: DataFrame, keys: list[str], day: Column) -> DataFrame:
    """keys, s, e: first and last day that each key covers."""
    return rows.groupBy(*keys).agg(F.min(day).alias("s"), F.max(day).alias("e"))


def spans(first: Column, last: Column) -> Column:
    """Whether a segment s..e covers a window; missing segments do not."""
    return F.coalesce((F.col("s") <= first) & (F.col("e") >= last), F.lit(False))


def window_complete(covered: DataFrame, entity: str, source: str, first: Column, last: Column, required: Iterable[str]) -> DataFrame:
    """entity, complete: whether segments of all required sources cover the window. covered: entity, source, s, e (one row each)."""
    need = list(required)
    met = F.count_distinct(F.when(F.col(source).isin(need) & spans(first, last), F.col(source)))
    return covered.groupBy(entity).agg((met == len(need)).alias("complete"))


def interval_evidence(candidates: DataFrame, intervals: DataFrame, key: str) -> DataFrame:
    """candidates, with_intervals, without_intervals, interval_rows over distinct candidates."""
    held = intervals.groupBy(key).agg(F.count("*").alias("n"))
    rows = candidates.select(key).distinct().join(held, key, "left")
    return rows.agg(F.count("*").alias("candidates"), F.count("n").alias("with_intervals"), F.count_if(F.col("n").isNull()).alias("without_intervals"), F.coalesce(F.sum("n"), F.lit(0)).alias("interval_rows"))


def envelope(rows: DataFrame, key: str, day: str, value: str, positive: Column, least: int) -> DataFrame:
    """key, n_rows, latest, positive_rows, latest value, deep_enough (n_rows of least or more): what a benchmark can carry."""
    g = rows.groupBy(key).agg(F.count("*").alias("n_rows"), F.max(day).alias("latest"), F.count_if(positive).alias("positive_rows"), F.max_by(value, day).alias(f"latest_{value}"))
    return g.withColumn("deep_enough", F.col("n_rows") >= least)


def publication_lag(rows: DataFrame, key: str, day: str, calendar: DataFrame, allowed: Iterable[int]) -> DataFrame:
    """key, last, lag_sessions, ready: sessions from the last row of a key to the end of the calendar (d, slot).

    Keys whose last row is no session get no lag and are not ready.
    """
    last = rows.groupBy(key).agg(F.max(day).alias("last"))
    end = calendar.agg(F.max("slot").alias("end"))
    placed = last.join(F.broadcast(calendar.select(F.col("d").alias("last"), "slot")), "last", "left").crossJoin(F.broadcast(end))
    lag = (F.col("end") - F.col("slot")).cast("long")
    return placed.select(key, "last", lag.alias("lag_sessions"), F.coalesce(lag.isin(*allowed), F.lit(False)).alias("ready"))


def orphans(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str], recent: DataFrame | None = None) -> DataFrame:
    """rule, n: rows of left without a key in right, and of right without a key in recent (left itself by default)."""
    count = lambda rows, name: rows.agg(F.lit(name).alias("rule"), F.count("*").alias("n"))
    return count(left.join(right, key, "left_anti"), names[0]).unionByName(count(right.join(left if recent is None else recent, key, "left_anti"), names[1]))


def reference_faults(rows: DataFrame, key: str, rules: dict[str, Column], twice: str) -> DataFrame:
    """key, n, rule: keys that come more than once under the rule named twice, and rows that break a rule (null: not broken)."""
    again = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").withColumn("rule", F.lit(twice))
    broken = F.filter(F.array(*(F.when(c, F.lit(name)) for name, c in rules.items())), lambda x: x.isNotNull())
    return again.unionByName(rows.select(key, F.lit(1).cast("long").alias("n"), F.explode(broken).alias("rule")))
