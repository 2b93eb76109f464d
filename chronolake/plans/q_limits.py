"""Price-limit queries: the bars stand for daily rows, shifted into the years of the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.operators import gates, limits

from . import fixtures as X
from .registry import query

#: Bars moved by 23 years, boards and listing dates by symbol.
DAILY = """daily AS (SELECT sym AS code, (d + 8401)::DATE AS d, CASE sym % 5 WHEN 0 THEN 'STAR' WHEN 1 THEN 'CHINEXT' WHEN 2 THEN 'SSE_MAIN' WHEN 3 THEN 'SZSE_MAIN' ELSE 'UNKNOWN' END AS board, vol >= 5 AS trading, sym % 7 = 0 AS is_st FROM v_bars),
life AS (SELECT code, CASE WHEN code % 3 = 0 THEN min(d) + 100 WHEN code % 3 = 1 THEN min(d) FILTER (trading) ELSE min(d) - 20 END AS listed, CASE WHEN code % 11 = 0 THEN max(d) - 200 END AS delisted FROM daily GROUP BY code),
j AS (SELECT daily.*, listed, delisted FROM daily JOIN life USING (code)),
r AS (SELECT *, min(d) FILTER (trading AND d >= listed) OVER (PARTITION BY code) AS first_traded, CASE WHEN trading AND d >= listed THEN sum((trading AND d >= listed)::INT) OVER (PARTITION BY code ORDER BY d) END AS rank0 FROM j),
k AS (SELECT *, CASE WHEN first_traded = listed THEN rank0 END AS post_rank FROM r),
sp AS (SELECT *, CASE WHEN code % 13 = 0 AND day(d) = 15 THEN 'no_limit'
  WHEN post_rank = 1 AND (board IN ('SSE_MAIN', 'SZSE_MAIN') OR (board = 'CHINEXT' AND listed < DATE '2020-08-24')) THEN 'unknown'
  WHEN ((board = 'STAR' AND listed >= DATE '2019-07-22') OR (board = 'CHINEXT' AND listed >= DATE '2020-08-24')) AND post_rank BETWEEN 1 AND 5 THEN 'no_limit'
  WHEN (board = 'STAR' OR (board = 'CHINEXT' AND listed >= DATE '2020-08-24')) AND first_traded <> listed AND first_traded <= listed + 14 AND d BETWEEN first_traded AND listed + 14 THEN 'unknown'
  WHEN d >= delisted THEN 'unknown' WHEN d < listed THEN 'unknown' WHEN board = 'UNKNOWN' THEN 'unknown' ELSE 'ordinary' END AS special_day_status FROM k),
li AS (SELECT *, CASE WHEN board = 'UNKNOWN' THEN NULL WHEN board = 'STAR' THEN CASE WHEN d >= DATE '2019-07-22' THEN 20.0 END WHEN board = 'CHINEXT' THEN CASE WHEN d >= DATE '2020-08-24' THEN 20.0 WHEN is_st THEN 5.0 ELSE 10.0 END
  WHEN is_st AND d < DATE '2026-07-06' THEN 5.0 ELSE 10.0 END::DOUBLE AS limit_pct FROM sp),
el AS (SELECT *, trading AND special_day_status = 'ordinary' AND limit_pct IS NOT NULL AS limit_eligible FROM li)"""


def daily(spark, sf):
    sym = F.col("sym") % 5
    board = F.when(sym == 0, "STAR").when(sym == 1, "CHINEXT").when(sym == 2, "SSE_MAIN").when(sym == 3, "SZSE_MAIN").otherwise("UNKNOWN")
    return X.bars(spark, sf).select(F.col("sym").alias("code"), F.date_add("d", 8401).alias("d"), board.alias("board"), (F.col("vol") >= 5).alias("trading"), (F.col("sym") % 7 == 0).alias("is_st"))


def special(spark, sf):
    rows = daily(spark, sf)
    k = F.col("code") % 3
    listed = F.when(k == 0, F.date_add(F.min("d"), 100)).when(k == 1, F.min(F.when(F.col("trading"), F.col("d")))).otherwise(F.date_sub(F.min("d"), 20))
    life = rows.groupBy("code").agg(listed.alias("listed"), F.when(F.col("code") % 11 == 0, F.date_sub(F.max("d"), 200)).alias("delisted"))
    overrides = rows.where("code % 13 = 0 and day(d) = 15").select("d", "code", F.lit("no_limit").alias("status"))
    return limits.special_days(rows, life, overrides)


@query("win_8_post_listing_rank", "v_bars", f", {DAILY} SELECT code, d, post_rank FROM k")
def post_listing_rank(spark, sf):
    return special(spark, sf).select("code", "d", "post_rank")


@query("jn_16_override_precedence", "v_bars", f", {DAILY} SELECT code, d, special_day_status FROM sp")
def override_precedence(spark, sf):
    return special(spark, sf).select("code", "d", "special_day_status")


@query("jn_17_lifecycle_join", "v_bars", f", {DAILY} SELECT code, d, listed, delisted, d < listed AS before_listing FROM j")
def lifecycle_join(spark, sf):
    return special(spark, sf).select("code", "d", "listed", "delisted", (F.col("d") < F.col("listed")).alias("before_listing"))


@query("nrm_22_limit_rule", "v_bars", f", {DAILY} SELECT code, d, limit_pct FROM li")
def limit_rule(spark, sf):
    return limits.limit_rows(special(spark, sf)).select("code", "d", "limit_pct")


@query("nrm_23_limit_enrichment", "v_bars", f", {DAILY} SELECT code, d, limit_pct, limit_eligible, CASE WHEN NOT trading THEN 'suspended_or_not_trading' WHEN special_day_status = 'no_limit' THEN 'explicit_no_limit_special_day' WHEN special_day_status = 'unknown' THEN 'special_day_status_not_evidenced' WHEN limit_pct IS NULL AND board = 'STAR' THEN 'STAR predates first trading date' WHEN limit_pct IS NULL THEN 'unsupported board' ELSE 'structural_rule_and_status_evidenced' END AS limit_rule_reason FROM el")
def limit_enrichment(spark, sf):
    return limits.limit_rows(special(spark, sf)).select("code", "d", "limit_pct", "limit_eligible", "limit_rule_reason")


@query("pit_16_limit_pipeline", "v_bars", f", {DAILY} SELECT d, count(*) AS n_rows, count(*) FILTER (limit_eligible) AS eligible, round(count(*) FILTER (limit_eligible) / count(*)::DOUBLE, 6) AS coverage, count(*) FILTER (limit_eligible) / count(*)::DOUBLE < 0.95 AS below_gate FROM el GROUP BY d")
def limit_pipeline(spark, sf):
    return limits.daily_limit_coverage(limits.limit_rows(special(spark, sf)))


@query("ag_15_scheduled_evidence", "v_bars", "SELECT p.period, coalesce(n, 0) AS n_rows, CASE WHEN n IS NULL THEN 'MISSING' WHEN n > 540 THEN 'DUPLICATE' ELSE 'OK' END AS state FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH))::DATE AS period) p LEFT JOIN (SELECT date_trunc('month', d)::DATE AS period, count(*) AS n FROM v_bars GROUP BY 1) e USING (period)")
def scheduled_evidence(spark, sf):
    periods = spark.range(1).select(F.explode(F.sequence(X.day("1995-01-01"), X.day("2001-12-01"), F.expr("interval 1 month"))).alias("period"))
    return gates.scheduled(periods, X.bars(spark, sf).withColumn("period", F.trunc("d", "MM")), "period", 540)
