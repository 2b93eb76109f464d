"""Series, breadth, coverage and versioned-fact queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.functions import scalars as S
from chronolake.operators import asof, breadth, calendar, combine, contracts, gates, intervals, valuation, windows
from chronolake.sources.scratch import new_path, saved
from chronolake.streaming import ingest

from . import fixtures as X
from .registry import query

W = "OVER (PARTITION BY sym ORDER BY d"
PREV = "lag(px) " + W + ")"
MEASURES = f"""m AS (SELECT sym, d, px,
  CASE WHEN {PREV} <> 0 THEN (px - {PREV}) / {PREV} * 100 END AS pct,
  CASE WHEN count(px) {W} ROWS 19 PRECEDING) >= 10 THEN avg(px) {W} ROWS 19 PRECEDING) END AS ma20,
  CASE WHEN count(px) {W} ROWS 59 PRECEDING) >= 30 THEN avg(px) {W} ROWS 59 PRECEDING) END AS ma60,
  CASE WHEN count(px) {W} ROWS 59 PRECEDING) >= 30 THEN min(px) {W} ROWS 59 PRECEDING) END AS low60,
  CASE WHEN count(px) {W} ROWS 251 PRECEDING) >= 100 THEN max(px) {W} ROWS 251 PRECEDING) END AS high252 FROM v_bars)"""
FLAGGED = """f AS (SELECT *, pct > 0 AS is_advance, pct < 0 AS is_decline, pct = 0 AS is_flat, px > ma20 AS above_ma20, px > ma60 AS above_ma60, px <= low60 * 1.001 AS new_low_60, px >= high252 * 0.999 AS new_high_252 FROM m)"""
BREADTH = ", ".join(f"round(avg({c}::INT), 6) AS {c}_ratio, count({c}) AS {c}_n" for c in breadth.FLAGS) + ", " + ", ".join(f"count(*) FILTER ({c}) AS {c}_count" for c in ("is_advance", "is_decline", "is_flat")) + ", round(avg(pct), 6) AS equal_weight_return"


def px(spark, sf):
    return X.bars(spark, sf).select("sym", "d", "px")


@query("win_1_percent_change", "v_bars", f"SELECT sym, d, round(CASE WHEN {PREV} <> 0 THEN (px - {PREV}) / {PREV} * 100 END, 6) AS pct FROM v_bars")
def percent_change(spark, sf):
    return px(spark, sf).select("sym", "d", F.round(windows.percent_change("px", ["sym"]), 6).alias("pct"))


@query("win_2_rolling_mean", "v_bars", f", {MEASURES} SELECT sym, d, round(ma20, 8) AS ma20, round(ma60, 8) AS ma60 FROM m")
def rolling_mean(spark, sf):
    return breadth.measures(px(spark, sf)).select("sym", "d", F.round("ma20", 8).alias("ma20"), F.round("ma60", 8).alias("ma60"))


@query("win_3_rolling_extrema", "v_bars", f", {MEASURES} SELECT sym, d, low60, high252 FROM m")
def rolling_extrema(spark, sf):
    return breadth.measures(px(spark, sf)).select("sym", "d", "low60", "high252")


SPINE = "sp AS (SELECT k.sym, c.d, b.px FROM (SELECT DISTINCT sym FROM v_bars) k CROSS JOIN v_cal c LEFT JOIN v_bars b ON b.sym = k.sym AND b.d = c.d)"
COVERAGE = f"""{SPINE}, cv AS (SELECT *, px IS NOT NULL AS observed, CASE WHEN row_number() {W}) >= 60 THEN sum((px IS NOT NULL)::INT) {W} ROWS 59 PRECEDING) / 60.0::DOUBLE END AS coverage FROM sp)"""


def spine(spark, sf):
    return calendar.on_spine(px(spark, sf), X.calendar(spark, sf), ["sym"]).drop("slot")


@query("win_4_trailing_coverage", "v_bars", f", {COVERAGE} SELECT sym, d, observed, round(coverage, 6) AS coverage, coalesce(coverage >= 0.2 AND observed, false) AS eligible FROM cv")
def trailing_coverage(spark, sf):
    return windows.trailing_coverage(spine(spark, sf), ["sym"], "px", 60, 0.2).select("sym", "d", "observed", F.round("coverage", 6).alias("coverage"), "eligible")


@query("win_5_endpoints", "v_bars", f", {SPINE} SELECT sym, d, px IS NOT NULL AND lag(px, 20) {W}) IS NOT NULL AS endpoint_20, px IS NOT NULL AND lag(px, 60) {W}) IS NOT NULL AS endpoint_60 FROM sp")
def endpoints(spark, sf):
    return windows.endpoints(spine(spark, sf), ["sym"], "px")


@query("ag_14_archive_coverage", "v_bars", f", {COVERAGE} SELECT sym, count(*) AS sessions, count(px) AS observed, min(d) FILTER (observed) AS first_observed, max(d) FILTER (observed) AS last_observed, round(arg_max(coverage, d), 6) AS latest_coverage FROM cv GROUP BY sym")
def archive_coverage(spark, sf):
    rows = windows.trailing_coverage(spine(spark, sf), ["sym"], "px")
    seen = F.when(F.col("observed"), F.col("d"))
    return rows.groupBy("sym").agg(F.count("*").alias("sessions"), F.count("px").alias("observed"), F.min(seen).alias("first_observed"), F.max(seen).alias("last_observed"), F.round(F.max_by("coverage", "d"), 6).alias("latest_coverage"))


@query("ag_24_trailing_readiness", "v_bars", f", {COVERAGE} SELECT sym, coalesce(bool_and(coalesce(coverage >= 0.15, false)) FILTER (coverage IS NOT NULL), false) AS ready, count(coverage) AS mature_days FROM cv GROUP BY sym")
def trailing_readiness(spark, sf):
    rows = windows.trailing_coverage(spine(spark, sf), ["sym"], "px", 60, 0.15)
    good = F.when(F.col("coverage").isNotNull(), F.col("coverage") >= 0.15)
    return rows.groupBy("sym").agg(F.coalesce(F.bool_and(good), F.lit(False)).alias("ready"), F.count("coverage").alias("mature_days"))


@query("ag_5_market_breadth", "v_bars v_member", f", {MEASURES}, {FLAGGED} SELECT d, count(*) AS securities, {BREADTH} FROM f WHERE EXISTS (SELECT 1 FROM v_member k WHERE k.sym = f.sym AND f.d BETWEEN k.s AND k.e) GROUP BY d")
def market_breadth(spark, sf):
    """Breadth of every session over point-in-time members: measures over all bars, then the membership join."""
    rows = breadth.flags(breadth.measures(px(spark, sf)))
    inside = intervals.interval_join(rows, intervals.compact(X.member(spark, sf)), "sym", "d")
    return breadth.breadth(inside, ["d"])


@query("str_6_breadth_of_touched_sessions", "v_bars", f", {MEASURES}, {FLAGGED} SELECT d, count(*) AS securities, {BREADTH} FROM f GROUP BY d")
def breadth_touched(spark, sf):
    """Bars land year by year for the last years, the stream starting again each time; every session is refreshed once."""
    path, out = new_path(spark, "landing"), new_path(spark, "stream")
    bars, year = px(spark, sf), F.least(F.greatest(F.year("d"), F.lit(1996)), F.lit(1998))
    bars = saved(bars.withColumn("year", year), "bars")
    for y in (1996, 1997, 1998):
        bars.where(F.col("year") == y).drop("year").write.mode("append").parquet(path)
        rows = ingest.refreshed_breadth(ingest.landing(spark, path), out)
    return rows


@query("str_6_breadth_after_late_bars", "v_bars", f", {MEASURES}, {FLAGGED} SELECT d, count(*) AS securities, {BREADTH} FROM f GROUP BY d")
def breadth_late(spark, sf):
    """Some bars of known symbols land late, some first with a wrong price: every session they reach is right in the end."""
    path, out = new_path(spark, "landing"), new_path(spark, "stream")
    bars = saved(px(spark, sf), "bars")
    late, wrong = (F.col("sym") % 4 == 1) & (F.dayofyear("d") % 40 == 3), (F.col("sym") % 4 == 2) & (F.dayofyear("d") % 50 == 7)
    first = bars.where(~late).withColumn("px", F.when(wrong, F.col("px") * 3).otherwise(F.col("px")))
    for batch in (first.where("d < date'1997-01-01'"), first.where("d >= date'1997-01-01'"), bars.where(late | wrong)):
        batch.write.mode("append").parquet(path)
        rows = ingest.refreshed_breadth(ingest.landing(spark, path), out)
    return rows


@query("ag_6_daily_coverage", "v_bars", "SELECT d, count(*) AS rows_observed, count(*) FILTER (vol >= 20) AS rows_eligible, round(count(*) FILTER (vol >= 20) / count(*)::DOUBLE, 6) AS coverage FROM v_bars GROUP BY d")
def daily_coverage(spark, sf):
    return gates.eligible_coverage(X.bars(spark, sf), "d", F.col("vol") >= 20)


@query("ag_7_strict_daily_coverage", "v_bars v_member", ", g AS (SELECT m.sym, c.d FROM v_member m JOIN v_cal c ON c.d BETWEEN m.s AND m.e) SELECT g.d, count(*) AS expected, count(b.px) AS observed, round(count(b.px) / count(*)::DOUBLE, 6) AS coverage FROM g LEFT JOIN v_bars b USING (sym, d) GROUP BY g.d")
def strict_daily_coverage(spark, sf):
    grid = intervals.member_days(X.member(spark, sf), X.calendar(spark, sf)).select("sym", "d")
    rows = grid.join(px(spark, sf), ["sym", "d"], "left")
    return rows.groupBy("d").agg(F.count("*").alias("expected"), F.count("px").alias("observed"), F.round(F.count("px") / F.count("*"), 6).alias("coverage"))


@query("ag_8_median_scale", "v_bars", "SELECT sym % 5 AS feed, median(px) AS median_px, median(vol) AS median_vol, median(px) / median(vol) <= 2000 AS plausible FROM v_bars GROUP BY 1")
def median_scale(spark, sf):
    return gates.median_scale(X.bars(spark, sf), F.col("sym") % 5, "px", "vol", 2000)


@query("jn_7_rail_attach", "v_bars", "SELECT b.sym, b.d, b.px, r.rail FROM v_bars b LEFT JOIN (SELECT d, max(px) AS rail FROM v_bars WHERE vol >= 30 GROUP BY d) r USING (d)")
def rail_attach(spark, sf):
    rail = X.bars(spark, sf).where("vol >= 30").groupBy("d").agg(F.max("px").alias("rail"))
    return combine.attach_rail(px(spark, sf), rail, ["d"]).select("sym", "d", "px", "rail")


@query("jn_8_bilateral_combine", "v_bars", "SELECT d, a.vol + b.vol AS total, a.vol AS one, b.vol AS two FROM (SELECT d, sum(vol) AS vol FROM v_bars WHERE sym % 2 = 0 GROUP BY d) a JOIN (SELECT d, sum(vol) AS vol FROM v_bars WHERE sym % 2 = 1 GROUP BY d) b USING (d) WHERE a.vol + b.vol > 0")
def bilateral_combine(spark, sf):
    return combine.both_sides(X.bars(spark, sf), "d", F.col("sym") % 2, "vol", ("one", "two"))


@query("jn_9_calendar_spine", "v_bars", "SELECT c.d, a.px AS one, b.px AS two, a.px IS NOT NULL AND b.px IS NOT NULL AS bilateral_complete FROM v_cal c LEFT JOIN (SELECT d, max(px) AS px FROM v_bars WHERE vol >= 60 GROUP BY d) a ON a.d = c.d LEFT JOIN (SELECT d, max(px) AS px FROM v_bars WHERE vol < 4 GROUP BY d) b ON b.d = c.d")
def calendar_spine(spark, sf):
    b = X.bars(spark, sf)
    feed = lambda rule: b.where(rule).groupBy("d").agg(F.max("px").alias("px"))
    return combine.on_spine(X.calendar(spark, sf), "d", {"one": feed("vol >= 60"), "two": feed("vol < 4")}, "bilateral_complete")


@query("jn_20_tolerance_check", "v_bars", "SELECT a.sym, a.d, a.px AS one, b.px AS two, abs(a.px - b.px) > 20000 AS mismatch FROM v_bars a JOIN v_bars b ON b.d = a.d AND b.sym = a.sym + 1")
def tolerance_check(spark, sf):
    b = px(spark, sf)
    return combine.within_tolerance(b, b.withColumn("sym", F.col("sym") - 1), ["sym", "d"], "px", 20000)


@query("ag_22_benchmark_envelope", "v_bars", "SELECT sym, count(*) AS n_rows, max(d) AS latest, count(*) FILTER (vol > 30) AS positive_rows, arg_max(px, d) AS latest_px, count(*) >= 350 AS deep_enough FROM v_bars GROUP BY sym")
def benchmark_envelope(spark, sf):
    return gates.envelope(X.bars(spark, sf), "sym", "d", "px", F.col("vol") > 30, 350)


@query("ag_23_publication_lag", "v_bars", ", l AS (SELECT sym, max(d) AS last FROM v_bars GROUP BY sym), e AS (SELECT max(slot) AS slot FROM v_cal) SELECT sym, last, e.slot - c.slot AS lag_sessions, e.slot - c.slot IN (0, 1) AS ready FROM l JOIN v_cal c ON c.d = l.last, e")
def publication_lag(spark, sf):
    return gates.publication_lag(px(spark, sf), "sym", "d", X.calendar(spark, sf), (0, 1))


@query("tk_1_latest_row", "v_bars", "SELECT sym, max(d) AS d, arg_max(px, d) AS px, arg_max(vol, d) AS vol FROM v_bars GROUP BY sym")
def latest_row(spark, sf):
    return windows.latest_row(X.bars(spark, sf), ["sym"], ["d"]).select("sym", "d", "px", "vol")


@query("tk_2_first_sessions", "v_bars v_member", "SELECT sym, d, px FROM (SELECT b.sym, b.d, b.px, row_number() OVER (PARTITION BY b.sym ORDER BY b.d) AS rn FROM v_bars b JOIN (SELECT sym, min(s) AS listed FROM v_member GROUP BY sym) l ON l.sym = b.sym AND b.d >= listed) WHERE rn <= 120")
def first_sessions(spark, sf):
    listed = X.member(spark, sf).groupBy("sym").agg(F.min("s").alias("listed"))
    return windows.first_sessions(px(spark, sf).join(listed, "sym").where("d >= listed"), "sym", 120).select("sym", "d", "px")


@query("tk_3_spread_sample", "v_bars", "SELECT sym, d FROM (SELECT sym, d, row_number() OVER (PARTITION BY sym ORDER BY d) - 1 AS rn, count(*) OVER (PARTITION BY sym) AS n FROM v_bars) WHERE rn IN (0, (n - 1) // 4, 2 * (n - 1) // 4, 3 * (n - 1) // 4, n - 1)")
def spread_sample(spark, sf):
    return windows.spread_sample(px(spark, sf), "sym", "d", 5).select("sym", "d")


# --- versioned facts ----------------------------------------------------------------------------------

KNOWN = "k AS (SELECT ent, pe, ft, av, CASE WHEN count(DISTINCT val) = 1 THEN min(val) END AS val, min(ver) AS ver, count(DISTINCT val) > 1 AS conflict FROM v_facts GROUP BY ent, pe, ft, av)"
CLEAN = "c AS (SELECT ent, pe, ft, av, max(val) AS val FROM v_facts GROUP BY ent, pe, ft, av)"


@query("win_9_latest_version", "v_facts", """
, r AS (SELECT *, rank() OVER (PARTITION BY ent, pe, ft ORDER BY av DESC) AS rk FROM v_facts WHERE av <= DATE '1998-06-30')
SELECT ent, pe, ft, CASE WHEN count(DISTINCT val) = 1 THEN min(val) END AS val, min(ver) AS ver, count(DISTINCT val) > 1 AS conflict, count(*) AS ties FROM r WHERE rk = 1 GROUP BY ent, pe, ft""")
def latest_version(spark, sf):
    known = X.facts(spark, sf).where(F.col("av") <= X.day("1998-06-30"))
    return asof.chosen_versions(known, ["ent", "pe", "ft"], ["av"], "val", "ver")


@query("win_9_version_timeline", "v_facts", f", {KNOWN} SELECT ent, pe, ft, av, val, conflict, lead(av) OVER (PARTITION BY ent, pe, ft ORDER BY av) - 1 AS until FROM k")
def version_timeline(spark, sf):
    return asof.version_timeline(X.facts(spark, sf), ["ent", "pe", "ft"], "av", "val", "ver").select("ent", "pe", "ft", "av", "val", "conflict", "until")


TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def asked(spark, sf):
    """Bars that ask for one fact type of one entity each; all types and entities are asked for."""
    kind = F.element_at(F.array(*(F.lit(t) for t in TYPES)), (F.col("sym") % 5 + 1).cast("int"))
    return px(spark, sf).withColumn("ent", F.col("sym") % 25).withColumn("ft", kind)


def clean(spark, sf):
    return X.facts(spark, sf).groupBy("ent", "pe", "ft", "av").agg(F.max("val").alias("val"))


LATEST = "l AS (SELECT ent, ft, av, arg_max(val, pe) AS val, max(pe) AS pe FROM c GROUP BY ent, ft, av), n AS (SELECT *, row_number() OVER (ORDER BY ft) - 1 AS k FROM (SELECT DISTINCT ft FROM c)), b AS (SELECT v_bars.*, sym % 25 AS ent, n.ft FROM v_bars JOIN n ON n.k = sym % 5)"


@query("jn_13_backward_asof", "v_bars v_facts", f", {CLEAN}, {LATEST} SELECT b.sym, b.d, b.ft, b.px, l.av AS asof_time, l.val, l.pe FROM b ASOF LEFT JOIN l ON b.ent = l.ent AND b.ft = l.ft AND b.d >= l.av")
def backward_asof(spark, sf):
    late = clean(spark, sf).groupBy("ent", "ft", "av").agg(F.max_by("val", "pe").alias("val"), F.max("pe").alias("pe"))
    return asof.backward(asked(spark, sf), late, ["ent", "ft"], "d", "av", ["val", "pe"]).select("sym", "d", "ft", "px", "asof_time", "val", "pe")


@query("jn_11_forward_asof", "v_bars v_facts", f", {CLEAN}, {LATEST} SELECT b.sym, b.d, b.ft, min(l.av) AS asof_time FROM b LEFT JOIN l ON l.ent = b.ent AND l.ft = b.ft AND l.av > b.d GROUP BY b.sym, b.d, b.ft")
def forward_asof(spark, sf):
    late = clean(spark, sf).groupBy("ent", "ft", "av").agg(F.max("val").alias("val"))
    return asof.forward(asked(spark, sf), late, ["ent", "ft"], "d", "av", ["val"]).select("sym", "d", "ft", "asof_time")


PRIOR = "p AS (SELECT a.ent, a.ft, a.pe, a.av, a.val, (SELECT arg_max(b.val, b.av) FROM c b WHERE b.ent = a.ent AND b.ft = a.ft AND b.pe = last_day(a.pe - INTERVAL 12 MONTH) AND b.av <= a.av) AS prior_value FROM c a)"


@query("jn_14_prior_comparable", "v_facts", f", {CLEAN}, {PRIOR} SELECT * FROM p")
def prior_comparable(spark, sf):
    return valuation.prior_comparable(clean(spark, sf), ["ent", "ft"], "pe", "av", "val").select("ent", "ft", "pe", "av", "val", "prior_value")


@query("pit_7_yearly_trend", "v_facts", f", {CLEAN}, {PRIOR} SELECT *, round((val - prior_value)::DOUBLE / abs(prior_value)::DOUBLE, 6) AS change FROM p WHERE prior_value <> 0")
def yearly_trend(spark, sf):
    return valuation.yearly_trend(clean(spark, sf), ["ent", "ft"], "pe", "av", "val").select("ent", "ft", "pe", "av", "val", "prior_value", "change")


TTM = f"""{CLEAN}, {LATEST},
t AS (SELECT ent, ft, av, max(max(pe)) OVER (PARTITION BY ent, ft ORDER BY av) AS latest FROM c GROUP BY ent, ft, av),
q AS (SELECT ent, ft, av, latest,
  (SELECT arg_max(val, u.av) FROM c u WHERE u.ent = t.ent AND u.ft = t.ft AND u.pe = latest AND u.av <= t.av) AS now,
  (SELECT arg_max(val, u.av) FROM c u WHERE u.ent = t.ent AND u.ft = t.ft AND u.pe = make_date(year(latest) - 1, 12, 31) AND u.av <= t.av) AS whole,
  (SELECT arg_max(val, u.av) FROM c u WHERE u.ent = t.ent AND u.ft = t.ft AND u.pe = last_day(latest - INTERVAL 12 MONTH) AND u.av <= t.av) AS comparable FROM t),
y AS (SELECT ent, ft, av, latest AS pe, CASE WHEN month(latest) = 12 THEN now ELSE whole + now - comparable END AS ttm FROM q)"""


def trailing(spark, sf):
    return valuation.trailing_value(clean(spark, sf), ["ent", "ft"], "pe", "av", "val")


@query("win_15_trailing_twelve_months", "v_bars v_facts", f", {TTM} SELECT * FROM y")
def trailing_twelve_months(spark, sf):
    return trailing(spark, sf)


@query("win_15_valuation_rail", "v_bars v_facts", f", {TTM} SELECT b.sym, b.d, b.ft, b.px, y.ttm, round(CASE WHEN y.ttm <> 0 THEN b.px / y.ttm::DOUBLE END, 9) AS multiple FROM b ASOF LEFT JOIN y ON b.ent = y.ent AND b.ft = y.ft AND b.d >= y.av")
def valuation_rail(spark, sf):
    rows = asof.backward(asked(spark, sf), trailing(spark, sf), ["ent", "ft"], "d", "av", ["ttm"])
    return rows.select("sym", "d", "ft", "px", "ttm", F.round(F.try_divide(F.col("px"), F.col("ttm").cast("double")), 9).alias("multiple"))


@query("pit_8_valuation_evidence", "v_bars v_facts", f", {TTM}, r AS (SELECT b.sym, b.d, b.ft, y.ttm, y.av FROM b ASOF JOIN y ON b.ent = y.ent AND b.ft = y.ft AND b.d >= y.av) SELECT sym, d, sha256(sym::VARCHAR || chr(31) || d::VARCHAR || chr(31) || ft || chr(31) || ttm::VARCHAR) AS evidence_id, 'TRAILING_VALUE' AS evidence_type, av AS known_since FROM r WHERE ttm > 0")
def valuation_evidence(spark, sf):
    rows = asof.backward(asked(spark, sf), trailing(spark, sf), ["ent", "ft"], "d", "av", ["ttm"]).where("ttm > 0")
    return rows.select("sym", "d", S.stable_hash(F.col("sym"), F.col("d"), F.col("ft"), F.col("ttm")).alias("evidence_id"), F.lit("TRAILING_VALUE").alias("evidence_type"), F.col("asof_time").alias("known_since"))


STATE = f"""{CLEAN}, cut AS (SELECT DISTINCT ent, pe, av AS cut FROM c),
s AS (SELECT ent, pe, cut, {', '.join(f"(SELECT arg_max(val, b.av) FROM c b WHERE b.ent = cut.ent AND b.pe = cut.pe AND b.ft = '{k}' AND b.av <= cut.cut) AS v{i}" for i, k in enumerate(TYPES))} FROM cut)"""


@query("win_16_state_at_knowledge_dates", "v_facts", f", {STATE} SELECT *, array_to_string(list_filter([{', '.join(f'CASE WHEN v{i} IS NULL THEN ' + chr(39) + k + chr(39) + ' END' for i, k in enumerate(TYPES))}], lambda x: x IS NOT NULL), ',') AS missing FROM s")
def state_at_knowledge_dates(spark, sf):
    return valuation.state_facts(clean(spark, sf), "ent", "pe", "ft", "av", "val", TYPES)


@query("nrm_24_accounting_state", "v_facts", f""", {STATE},
w AS (SELECT ent, pe, arg_max(v0, cut) AS r, arg_max(v1, cut) - 400000 AS p, arg_max(v2, cut) - 300000 AS c, arg_max(v3, cut) AS m FROM s GROUP BY ent, pe),
j AS (SELECT a.*, b.r AS r0, b.p AS p0, b.c AS c0, b.m AS m0 FROM w a JOIN w b ON b.ent = a.ent AND b.pe = last_day(a.pe - INTERVAL 12 MONTH))
SELECT ent, pe, CASE WHEN p < 0 THEN 'FUNDAMENTAL_FAIL' WHEN r < r0 AND p < p0 AND c < c0 AND m < m0 THEN 'FUNDAMENTAL_FAIL' WHEN p > 0 AND c < 0 AND c0 >= 0 AND c < c0 THEN 'FUNDAMENTAL_FAIL' WHEN p < p0 AND m < m0 AND c < c0 THEN 'FUNDAMENTAL_FAIL' WHEN p > 0 AND c >= 0 AND r >= r0 AND p >= p0 AND c >= c0 AND m >= m0 THEN 'FUNDAMENTAL_PASS' ELSE 'FUNDAMENTAL_WATCH' END AS state,
  CASE WHEN p < 0 THEN 'CURRENT_NET_LOSS' WHEN r < r0 AND p < p0 AND c < c0 AND m < m0 THEN 'BROAD_BASED_DETERIORATION' WHEN p > 0 AND c < 0 AND c0 >= 0 AND c < c0 THEN 'PROFIT_CASH_DIVERGENCE' WHEN p < p0 AND m < m0 AND c < c0 THEN 'PROFIT_MARGIN_CASH_DETERIORATION' WHEN p > 0 AND c >= 0 AND r >= r0 AND p >= p0 AND c >= c0 AND m >= m0 THEN 'ALL_CORE_DIMENSIONS_NON_DETERIORATING' ELSE 'QUALIFIED_MIXED_ACCOUNTING_STATE' END AS reason FROM j""")
def accounting_state(spark, sf):
    s = valuation.state_facts(clean(spark, sf), "ent", "pe", "ft", "av", "val", TYPES)
    # max_by drops cutoffs where the fact is not known yet, as they come earlier
    last = lambda i: F.max_by(f"v{i}", F.when(F.col(f"v{i}").isNotNull(), F.col("cut")))
    now = s.groupBy("ent", "pe").agg(last(0).alias("r"), (last(1) - 400000).alias("p"), (last(2) - 300000).alias("c"), last(3).alias("m"))
    old = now.select("ent", F.col("pe").alias("pe0"), *(F.col(x).alias(f"{x}0") for x in "rpcm"))
    both = now.withColumn("pe0", F.last_day(F.add_months("pe", -12))).join(old, ["ent", "pe0"])
    names = dict(zip(("revenue", "profit", "cash", "margin"), "rpcm"))
    state = S.accounting_state({k: F.col(v) for k, v in names.items()}, {k: F.col(v + "0") for k, v in names.items()})
    return both.select("ent", "pe", state.alias("x")).select("ent", "pe", "x.state", "x.reason")


@query("ag_10_revision_ambiguity", "v_facts", "SELECT ent, pe, ft, av, count(DISTINCT ver) AS revisions, count(DISTINCT val) > 1 AS value_conflict, string_agg(DISTINCT ver, ',' ORDER BY ver) AS versions FROM v_facts GROUP BY ent, pe, ft, av HAVING count(DISTINCT ver) > 1")
def revision_ambiguity(spark, sf):
    return gates.revision_ambiguity(X.facts(spark, sf), ["ent", "pe", "ft", "av"], "ver", "val")


@query("ag_11_field_coverage", "v_facts", "SELECT ft, count(*) AS n_rows, count(DISTINCT ent) AS entities, round(count(DISTINCT ent) / 25.0::DOUBLE, 6) AS ratio, min(pe) AS first_period, max(pe) AS last_period, count(*) FILTER (ver IS NULL) AS gaps FROM v_facts GROUP BY ft")
def field_coverage(spark, sf):
    return gates.field_coverage(X.facts(spark, sf), "ft", "ent", 25, "pe", F.col("ver").isNull())


@query("win_17_redundant_revisions", "v_facts", ", d AS (SELECT ent, pe, ft, val, av FROM v_facts UNION ALL SELECT ent, pe, ft, val, av + 10 FROM v_facts WHERE ent % 3 = 0), g AS (SELECT ent, pe, ft, count(DISTINCT val) AS n FROM d GROUP BY ALL) SELECT ent, pe, ft, n = 1 AS redundant, min(av) AS av, count(*) AS rows_seen FROM d JOIN g USING (ent, pe, ft) GROUP BY ent, pe, ft, n")
def redundant_revisions(spark, sf):
    f = X.facts(spark, sf).select("ent", "pe", "ft", "val", "av")
    rows = f.unionByName(f.where("ent % 3 = 0").withColumn("av", F.date_add("av", 10)))
    return combine.redundant_revisions(rows, ["ent", "pe", "ft"], "val", "av")


@query("win_18_variant_selection", "v_facts", ", p AS (SELECT *, CASE ver WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END AS pr FROM v_facts) SELECT ent, pe, ft, av, ver, val FROM p QUALIFY pr = max(pr) OVER (PARTITION BY ent, pe, ft, av)")
def variant_selection(spark, sf):
    priority = F.when(F.col("ver") == "F", 2).when(F.col("ver") == "O", 1).otherwise(0)
    return combine.preferred_variant(X.facts(spark, sf), ["ent", "pe", "ft", "av"], priority).select("ent", "pe", "ft", "av", "ver", "val")


@query("win_10_keep_last", "v_bars", "SELECT sym, d, px FROM (SELECT *, row_number() OVER (PARTITION BY sym, date_trunc('month', d) ORDER BY d DESC) AS rn FROM v_bars) WHERE rn = 1")
def keep_last(spark, sf):
    rows = px(spark, sf).withColumn("m", F.trunc("d", "MM"))
    return contracts.keep_last(rows, ["sym", "m"], [F.col("d").desc()]).select("sym", "d", "px")
