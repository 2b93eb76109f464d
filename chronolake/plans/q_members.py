"""Membership and interval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.operators import combine, contracts, gates, intervals, membership, sets

from . import fixtures as X
from .registry import query

IN_MEMBER = "FROM v_bars b JOIN v_member m ON m.sym = b.sym AND b.d BETWEEN m.s AND m.e"


@query("jn_1_interval_join", "v_bars v_member", f"SELECT b.sym, b.d, b.px, max(m.s) AS s, max(m.e) AS e {IN_MEMBER} GROUP BY ALL")
def interval_join(spark, sf):
    joined = intervals.interval_join(X.bars(spark, sf).select("d", "sym", "px"), X.member(spark, sf), "sym", "d")
    return contracts.keep_last(joined, ["d", "sym"], [F.col("s").desc(), F.col("e").desc()]).select("sym", "d", "px", "s", "e")


@query("jn_2_snapshot_filter", "v_bars", "SELECT b.sym, b.d, b.px, s_name FROM v_bars b JOIN supplier ON s_suppkey = b.sym WHERE s_acctbal > 0")
def snapshot_filter(spark, sf):
    snap = X.table(spark, sf, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("sym"), "s_name")
    return combine.snapshot_filter(X.bars(spark, sf), snap, "sym").select("sym", "d", "px", "s_name")


@query("jn_3_active_on", "v_member", "SELECT sym, s, e, DATE '1996-06-03' BETWEEN s AND e AS inclusive, s <= DATE '1996-06-03' AND e > DATE '1996-06-03' AS half_open FROM v_member WHERE DATE '1996-06-03' BETWEEN s AND e")
def active_on(spark, sf):
    on = X.day("1996-06-03")
    rows = X.member(spark, sf)
    return rows.withColumn("inclusive", intervals.covers(F.col("s"), F.col("e"), on)).withColumn("half_open", intervals.covers_half_open(F.col("s"), F.col("e"), on)).where("inclusive")


@query("jn_4_event_membership", "v_annc v_member", """
, ev AS (SELECT doc, ent % 10 + 1 AS sym, (CAST(pub AS DATE) - 9862)::DATE AS av FROM v_annc)
SELECT doc, ev.sym, av, s, e FROM ev JOIN v_member m ON m.sym = ev.sym AND av BETWEEN s AND e""")
def event_membership(spark, sf):
    return intervals.interval_join(_events(spark, sf), X.member(spark, sf), "sym", "av").select("doc", "sym", "av", "s", "e")


def _events(spark, sf):
    return X.announcements(spark, sf).select("doc", (F.col("ent") % 10 + 1).alias("sym"), F.expr("date_sub(cast(pub as date), 9862)").alias("av"))


@query("jn_5_excluded_with_reason", "v_annc v_member", """
, ev AS (SELECT doc, ent % 10 + 1 AS sym, (CAST(pub AS DATE) - 9862)::DATE AS av FROM v_annc)
SELECT doc, sym, av, CASE WHEN av > (SELECT max(e) FROM v_member) THEN 'AFTER_SCOPE_END' ELSE 'NOT_A_MEMBER' END AS reason FROM ev
WHERE NOT EXISTS (SELECT 1 FROM v_member m WHERE m.sym = ev.sym AND av BETWEEN s AND e)""")
def excluded_with_reason(spark, sf):
    events, m = _events(spark, sf), X.member(spark, sf)
    kept = intervals.interval_join(events, m, "sym", "av").select("doc")
    end = m.agg(F.max("e").alias("end"))
    return events.join(kept, "doc", "left_anti").crossJoin(F.broadcast(end)).select("doc", "sym", "av", F.when(F.col("av") > F.col("end"), "AFTER_SCOPE_END").otherwise("NOT_A_MEMBER").alias("reason"))


GRID = "g AS (SELECT m.sym, c.d FROM v_member m JOIN v_cal c ON c.d BETWEEN m.s AND m.e)"


@query("jn_6_member_day_grid", "v_bars v_member", f", {GRID} SELECT g.sym, g.d, b.px, b.px IS NOT NULL AS observed FROM g LEFT JOIN v_bars b USING (sym, d)")
def member_day_grid(spark, sf):
    grid = intervals.member_days(X.member(spark, sf), X.calendar(spark, sf)).select("sym", "d")
    return grid.join(X.bars(spark, sf).select("sym", "d", "px"), ["sym", "d"], "left").withColumn("observed", F.col("px").isNotNull())


@query("ag_2_universe_diagnostics", "v_member", "SELECT count(*) AS n_rows, count(DISTINCT sym) AS symbols, bool_and(s IS NOT NULL AND e >= s) AS point_in_time FROM v_member")
def universe_diagnostics(spark, sf):
    return gates.universe_diagnostics(X.member(spark, sf), "sym", "s", "e")


@query("ag_3_segment_cardinality", "v_member", "SELECT date_trunc('month', s)::DATE AS segment, count(DISTINCT sym) AS members, count(DISTINCT sym) = 7 AS as_expected FROM v_member GROUP BY 1")
def segment_cardinality(spark, sf):
    return gates.cardinality(X.member(spark, sf), F.trunc("s", "MM"), "sym", 7)


@query("ag_4_daily_member_count", "v_cal v_member", "SELECT c.d, count(DISTINCT m.sym) AS members, count(DISTINCT m.sym) = 60 AS ok FROM v_cal c LEFT JOIN v_member m ON c.d BETWEEN m.s AND m.e GROUP BY c.d")
def daily_member_count(spark, sf):
    return membership.daily_counts(intervals.compact(X.member(spark, sf)), X.calendar(spark, sf), 60)


@query("win_6_interval_compaction", "v_member", """
, w AS (SELECT sym, s, s + 300 AS e FROM v_member UNION ALL SELECT sym, s + 301, s + 400 FROM v_member UNION ALL SELECT sym, s + 350, s + 360 FROM v_member UNION ALL SELECT sym, s + 420, s + 430 FROM v_member),
d AS (SELECT DISTINCT sym, unnest(generate_series(s, e, INTERVAL 1 DAY))::DATE AS day FROM w),
i AS (SELECT sym, day, day - (row_number() OVER (PARTITION BY sym ORDER BY day))::INT AS island FROM d)
SELECT sym, min(day) AS s, max(day) AS e FROM i GROUP BY sym, island""")
def interval_compaction(spark, sf):
    m = X.member(spark, sf)
    part = lambda a, b: m.select("sym", F.expr(f"date_add(s, {a})").alias("s"), F.expr(f"date_add(s, {b})").alias("e"))
    return intervals.compact(part(0, 300).unionByName(part(301, 400)).unionByName(part(350, 360)).unionByName(part(420, 430)))


@query("win_7_interval_overlap", "v_member", """
, w AS (SELECT sym, s, e FROM v_member UNION ALL SELECT sym, s + 450, e + 30 FROM v_member WHERE sym % 5 = 0),
r AS (SELECT *, max(e) OVER (PARTITION BY sym ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_e FROM w)
SELECT sym, s, e, prev_e, CASE WHEN e < s THEN 'REVERSED' ELSE 'OVERLAP' END AS problem FROM r WHERE e < s OR s <= prev_e + 1""")
def interval_overlap(spark, sf):
    m = X.member(spark, sf)
    return intervals.overlaps(m.unionByName(m.where("sym % 5 = 0").select("sym", F.expr("date_add(s, 450)").alias("s"), F.expr("date_add(e, 30)").alias("e"))))


@query("win_11_snapshots_to_ranges", "", """
WITH snap AS (SELECT DISTINCT date_trunc('quarter', CAST(o_orderdate AS DATE))::DATE AS d, o_custkey % 97 AS sym FROM orders),
r AS (SELECT d, lead(d) OVER (ORDER BY d) - 1 AS e FROM (SELECT DISTINCT d FROM snap))
SELECT sym, greatest(snap.d, DATE '1995-02-15') AS s, least(coalesce(r.e, DATE '9999-12-31'), DATE '2000-11-30') AS e FROM snap JOIN r USING (d) WHERE greatest(snap.d, DATE '1995-02-15') <= least(coalesce(r.e, DATE '9999-12-31'), DATE '2000-11-30')""")
def snapshots_to_ranges(spark, sf):
    snap = X.table(spark, sf, "orders").select(F.expr("cast(date_trunc('QUARTER', cast(o_orderdate as date)) as date)").alias("d"), (F.col("o_custkey") % 97).alias("sym")).distinct()
    return intervals.snapshots_to_intervals(snap, X.day("1995-02-15"), X.day("2000-11-30"))


REBUILT = """
, span AS (SELECT DATE '1995-06-01' AS lo, DATE '1998-12-31' AS hi)
SELECT sym, greatest(s, lo) AS s, least(e, hi) AS e FROM v_member, span WHERE s <= hi AND e >= lo"""


@query("win_12_membership_reconstruct", "v_member", REBUILT)
def membership_reconstruct(spark, sf):
    lo, hi = X.day("1995-06-01"), X.day("1998-12-31")
    anchor = X.member(spark, sf).where((F.col("s") <= hi) & (F.col("e") >= hi)).select("sym")
    return membership.reconstruct(anchor, X.adjustments(spark, sf).where(F.col("ed") <= hi), lo, hi)


@query("win_12_reconstruct_checks", "v_member", "SELECT NULL::BIGINT AS sym, NULL::VARCHAR AS problem WHERE false")
def reconstruct_checks(spark, sf):
    hi = X.day("1998-12-31")
    anchor = X.member(spark, sf).where((F.col("s") <= hi) & (F.col("e") >= hi)).select("sym")
    return membership.inconsistent(anchor, X.adjustments(spark, sf).where(F.col("ed") <= hi), X.day("1995-06-01"))


@query("win_12_sizes_backwards", "v_adjust", """
SELECT ed, (SELECT count(DISTINCT sym) FROM v_member m WHERE ed - 1 BETWEEN m.s AND m.e) AS size_before FROM (SELECT DISTINCT ed FROM v_adjust WHERE ed <= DATE '1998-12-31')""")
def sizes_backwards(spark, sf):
    hi = X.day("1998-12-31")
    anchor = X.member(spark, sf).where((F.col("s") <= hi) & (F.col("e") >= hi)).select("sym")
    return membership.sizes_backwards(anchor, X.adjustments(spark, sf).where(F.col("ed") <= hi))


@query("win_13_production_universe", "v_member", """
, mani AS (SELECT * FROM (VALUES (DATE '1997-01-01', 'a'), (DATE '1998-12-31', 'b'), (DATE '2001-01-01', 'c')) t(effective_date, anchor)),
pick AS (SELECT max(effective_date) AS hi FROM mani WHERE effective_date <= DATE '1999-06-30'),
span AS (SELECT DATE '1996-01-01' AS lo, hi FROM pick)
SELECT sym, greatest(s, lo) AS s, least(e, hi) AS e FROM v_member, span WHERE s <= hi AND e >= lo""")
def production_universe(spark, sf):
    manifest = spark.createDataFrame([("1997-01-01", "a", None), ("1998-12-31", "b", "x.csv"), ("2001-01-01", "c", None)], "effective_date string, anchor string, supplement string")
    manifest = manifest.withColumn("effective_date", F.col("effective_date").cast("date"))
    pick = membership.effective_version(manifest, X.day("1999-06-30")).select(F.col("effective_date").alias("hi"))
    m = X.member(spark, sf).crossJoin(F.broadcast(pick))
    anchor = m.where("s <= hi and e >= hi").select("sym")
    ledger = X.adjustments(spark, sf).crossJoin(F.broadcast(pick)).where("ed <= hi")
    lo = X.day("1996-01-01")
    out = membership.reconstruct(anchor, ledger.select("ed", "sym", "side"), lo, F.lit("9999-12-31").cast("date"))
    return out.crossJoin(F.broadcast(pick)).select("sym", "s", F.least("e", "hi").alias("e"))


@query("win_14_interval_clipping", "v_member", "SELECT sym, greatest(s, DATE '1996-01-01') AS s, least(e - 1, DATE '1997-12-31') AS e FROM v_member WHERE greatest(s, DATE '1996-01-01') <= least(e - 1, DATE '1997-12-31')")
def interval_clipping(spark, sf):
    return intervals.clip(intervals.half_open_to_inclusive(X.member(spark, sf)), X.day("1996-01-01"), X.day("1997-12-31"))


@query("set_5_scope_union", "v_adjust", """
SELECT sym, string_agg(DISTINCT tag, ',' ORDER BY tag) AS scopes FROM (SELECT sym, side AS tag FROM v_adjust UNION ALL SELECT s_suppkey, 'anchor' FROM supplier) GROUP BY sym""")
def scope_union(spark, sf):
    adj, sup = X.adjustments(spark, sf), X.table(spark, sf, "supplier")
    return sets.scope([(adj, "sym", F.col("side")), (sup, "s_suppkey", F.lit("anchor"))])


@query("jn_22_alias_cut", "v_bars", "SELECT b.sym, b.d, b.px, CASE WHEN sym % 10 = 3 AND d >= DATE '1998-01-01' THEN sym + 1000 ELSE sym END AS code FROM v_bars b")
def alias_cut(spark, sf):
    aliases = X.table(spark, sf, "supplier").where("s_suppkey % 10 = 3").select(F.col("s_suppkey").alias("old"), (F.col("s_suppkey") + 1000).alias("new"), X.day("1998-01-01").alias("cut"))
    return combine.aliased(X.bars(spark, sf), aliases, "sym", "d", "code").select("sym", "d", "px", "code")


@query("jn_23_multivalued_filter", "", "SELECT p_partkey, p_name FROM part WHERE list_contains(string_split(p_name, ' '), (SELECT string_split(p_name, ' ')[1] FROM part WHERE p_partkey = 1))")
def multivalued_filter(spark, sf):
    part = X.table(spark, sf, "part")
    word = part.where("p_partkey = 1").select(F.split("p_name", " ")[0].alias("word"))
    return combine.holding(part, "p_name", word, "word").select("p_partkey", "p_name")
