"""Qualification queries: inputs with planted gaps, faults and repeats, so that every state occurs."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.operators import qualification as Q

from . import fixtures as X
from .registry import query


def thin_spine(spark, sf):
    """Six archives on the full calendar: dense ones, one that starts late, one with gaps, one that is empty."""
    cal = X.calendar(spark, sf)
    keys = X.table(spark, sf, "nation").where("n_nationkey < 6").select(F.col("n_nationkey").alias("sym"))
    rows = keys.join(F.broadcast(cal), F.lit(True))
    slot, k = F.col("slot"), F.col("sym")
    there = F.when(k == 0, F.lit(True)).when(k == 1, slot > 30).when(k == 2, slot % 3 != 2).when(k == 3, F.lit(False)).when(k == 4, slot <= 100).otherwise(slot % 50 != 7)
    return rows.select("sym", "d", F.when(there, slot.cast("double")).alias("v"))


SPINE = """, p AS (SELECT n_nationkey AS sym, d, slot, CASE n_nationkey WHEN 0 THEN true WHEN 1 THEN slot > 30 WHEN 2 THEN slot % 3 <> 2 WHEN 3 THEN false WHEN 4 THEN slot <= 100 ELSE slot % 50 <> 7 END AS seen FROM nation, v_cal WHERE n_nationkey < 6),
c AS (SELECT *, CASE WHEN row_number() OVER w >= 60 THEN sum(seen::INT) OVER (PARTITION BY sym ORDER BY d ROWS 59 PRECEDING) / 60.0::DOUBLE END AS cov, lag(seen, 20) OVER w AS e20, lag(seen, 60) OVER w AS e60 FROM p WINDOW w AS (PARTITION BY sym ORDER BY d))"""


@query("ag_14_archive_audit", "v_cal", SPINE + """, g AS (SELECT sym, count(*) AS sessions, count(*) FILTER (seen) AS observed, min(d) FILTER (seen) AS first_observed, max(d) FILTER (seen) AS last_observed, arg_max(cov, d) AS latest FROM c GROUP BY sym)
SELECT sym, sessions, observed, round(observed / sessions::DOUBLE, 6) AS raw_coverage, first_observed, last_observed, (SELECT count(*) FROM p WHERE p.sym = g.sym AND (first_observed IS NULL OR p.d < first_observed)) AS gap_before, (SELECT count(*) FROM p WHERE p.sym = g.sym AND p.d > last_observed) AS gap_after, round(latest, 6) AS latest_trailing,
  CASE WHEN observed = 0 THEN 'EMPTY' WHEN first_observed > (SELECT min(d) FROM v_cal) THEN 'PARTIAL_PREHISTORY' WHEN observed < 0.8 * sessions THEN 'INSUFFICIENT_COVERAGE' ELSE 'AUDITED' END AS status FROM g""")
def archive_audit(spark, sf):
    return Q.archive_audit(thin_spine(spark, sf), "sym", "v")


@query("ag_24_endpoint_readiness", "v_cal", SPINE + ", m AS (SELECT *, row_number() OVER (PARTITION BY sym ORDER BY d) AS n FROM c) SELECT sym, count(*) FILTER (n > 60) AS mature_days, CASE WHEN NOT bool_or(seen) THEN 'DATA_INSUFFICIENT' WHEN coalesce(bool_and(seen AND cov >= 0.8 AND e20 AND e60) FILTER (n > 60), false) AND bool_or(n = 1 AND seen) THEN 'QUALIFIED_INPUT' ELSE 'PARTIAL_COVERAGE' END AS state FROM m GROUP BY sym")
def endpoint_readiness(spark, sf):
    return Q.trailing_readiness(thin_spine(spark, sf), "sym", "v")


@query("ag_15_schedule_faults", "", """WITH r AS (SELECT o_orderkey AS k, strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS period, CAST(o_orderdate AS DATE) AS day FROM orders QUALIFY row_number() OVER (PARTITION BY period ORDER BY o_orderkey) <= CASE WHEN month(CAST(o_orderdate AS DATE)) = 5 THEN 2 ELSE 1 END),
e AS (SELECT DISTINCT strftime(CAST(l_shipdate AS DATE), '%Y-%m') AS period FROM lineitem WHERE month(CAST(l_shipdate AS DATE)) <> 9),
b AS (SELECT period, k % 4 <> 1 AS done, unnest(list_filter([CASE WHEN k % 11 = 3 THEN 'STATUS' END, CASE WHEN k % 11 <> 3 AND k % 4 <> 1 AND k % 5 = 2 THEN 'CHANGE' END, CASE WHEN k % 11 <> 3 AND k % 4 <> 1 AND k % 7 = 1 THEN 'DATE' END, CASE WHEN k % 11 <> 3 AND k % 4 <> 1 AND k % 7 = 2 THEN 'DATE_OUTSIDE' END, CASE WHEN k % 11 <> 3 AND k % 4 <> 1 AND k % 6 = 1 THEN 'KIND' END, CASE WHEN k % 11 <> 3 AND k % 4 <> 1 AND k % 9 = 4 THEN 'URL' END, CASE WHEN (SELECT count(*) FROM r x WHERE x.period = r.period) > 1 THEN 'DUPLICATE' END, CASE WHEN period NOT IN (FROM e) THEN 'UNEXPECTED' END], lambda x: x IS NOT NULL)) AS rule FROM r),
l AS (SELECT period, string_agg(DISTINCT rule, ',' ORDER BY rule) AS broken FROM b GROUP BY period), n AS (SELECT period, count(*) AS n, bool_or(k % 11 <> 3 AND k % 4 <> 1) AS done FROM r GROUP BY period)
SELECT coalesce(e.period, n.period) AS period, coalesce(n, 0) AS n_rows, CASE WHEN n IS NULL THEN 'MISSING' ELSE coalesce(broken, '') END AS broken, coalesce(done, false) AS complete FROM e FULL JOIN n ON e.period = n.period LEFT JOIN l ON l.period = n.period""")
def schedule_faults(spark, sf):
    """One evidence row a month (two in May) with faults by order number; September is not expected, and months of shipping without orders lack a row."""
    from pyspark.sql import Window

    day, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    o = X.table(spark, sf, "orders").select(k, day.alias("day"), F.date_format(day, "yyyy-MM").alias("period"))
    o = o.withColumn("n", F.row_number().over(Window.partitionBy("period").orderBy("o_orderkey"))).where("n <= if(month(day) = 5, 2, 1)")
    effective = F.when(k % 7 == 1, "soon").when(k % 7 == 2, F.add_months("day", 1).cast("string")).otherwise(F.col("day").cast("string"))
    rows = o.select("period", effective.alias("effective"), F.when(k % 5 == 2, "maybe").otherwise("no_change").alias("change"), F.when(k % 6 == 1, " ").otherwise("NOTICE").alias("kind"), F.when(k % 9 == 4, "ftp://x").otherwise("https://x/1").alias("url"), F.when(k % 11 == 3, "found").when(k % 4 == 1, "pending").otherwise("complete").alias("status"))
    ship = F.col("l_shipdate").cast("date")
    periods = X.table(spark, sf, "lineitem").where(F.month(ship) != 9).select(F.date_format(ship, "yyyy-MM").alias("period")).distinct()
    return Q.schedule_faults(periods, rows)


@query("ag_18_shard_faults", "", "WITH s AS (SELECT c_custkey % 8 AS shard, CASE WHEN c_custkey % 8 = 5 THEN 9 ELSE 8 END AS shards, c_custkey AS sym FROM customer WHERE c_custkey % 8 NOT IN (3) UNION ALL SELECT 12, 8, c_custkey FROM customer WHERE c_custkey % 40 = 0), k AS (SELECT sym, count(DISTINCT shard) AS n FROM s GROUP BY sym) SELECT * FROM (SELECT 'COUNTS_DIFFER' AS rule, 1::BIGINT AS n UNION ALL SELECT 'INDEX_MISSING', 2 UNION ALL SELECT 'INDEX_OUTSIDE', 1 UNION ALL SELECT 'IN_TWO_SHARDS', count(*) FROM k WHERE n > 1 UNION ALL SELECT 'LOST', count(*) FROM customer WHERE c_custkey % 10 <> 1 AND c_custkey NOT IN (SELECT sym FROM k) UNION ALL SELECT 'OUT_OF_SCOPE', count(*) FROM k WHERE sym % 10 = 1)")
def shard_faults(spark, sf):
    k = F.col("c_custkey")
    c = X.table(spark, sf, "customer").select(k)
    shards = c.where(k % 8 != 3).select((k % 8).alias("shard"), F.when(k % 8 == 5, 9).otherwise(8).alias("shards"), k.alias("sym"))
    shards = shards.unionByName(c.where(k % 40 == 0).select(F.lit(12).cast("long").alias("shard"), F.lit(8).alias("shards"), k.alias("sym")))
    return Q.shard_faults(c.where(k % 10 != 1).select(k.alias("sym")), shards)


@query("ag_23_capital_summary", "v_cal", """, z AS (SELECT max(d) AS z, max(slot) AS n FROM v_cal), x AS (SELECT * FROM (VALUES ('good', 0, 1, false), ('older gap', 5, 0, false), ('late', 0, 2, false), ('turnover gap', 0, 0, true)) v(case_, older, late, thin))
SELECT case_ AS input, n AS sessions, CASE WHEN thin THEN 1 ELSE 0 END::BIGINT AS turnover_missing, (late + CASE WHEN older > 0 THEN 1 ELSE 0 END)::BIGINT AS financing_missing, (CASE WHEN older > 0 THEN 1 ELSE 0 END + greatest(late - 1, 0))::BIGINT AS older_missing, 0::BIGINT AS future_rows, late::BIGINT AS lag_sessions, older = 0 AND late < 2 AND NOT thin AS ready FROM x, z""")
def capital_summary(spark, sf):
    """Four inputs: financing that lacks the last session, an older one, the last two, and turnover that lacks one."""
    cal = X.calendar(spark, sf)
    end = cal.agg(F.max("d").alias("d"), F.max("slot").alias("n")).first()
    out = None
    for name, older, late, thin in (("good", 0, 1, False), ("older gap", 5, 0, False), ("late", 0, 2, False), ("turnover gap", 0, 0, True)):
        turnover = cal.where(F.col("slot") != 7) if thin else cal
        financing = cal.where((F.col("slot") <= end["n"] - late) & (F.col("slot") != older))
        row = Q.capital_summary(cal, turnover, financing, F.lit(end["d"]), F.lit(0)).withColumn("input", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query("win_17_canonical_revisions", "v_facts", """, c AS (SELECT ent, pe, ft, min(val) AS val, min(av) AS av FROM v_facts GROUP BY ent, pe, ft),
r AS (SELECT *, 0 AS copy, CASE WHEN ent % 2 = 0 THEN 'DATA_INSUFFICIENT' ELSE 'COMPLETE' END AS state FROM c UNION ALL SELECT ent, pe, ft, CASE WHEN ent % 7 = 3 THEN val + 1 ELSE val END, av + 30, 1, CASE WHEN ent % 2 = 0 THEN 'DATA_INSUFFICIENT' ELSE 'COMPLETE' END FROM c WHERE ent % 3 = 0)
SELECT ent, pe, ft, copy, CASE WHEN ent % 3 = 0 AND ent % 7 = 3 THEN 'CONFLICT' WHEN copy = 0 THEN 'KEPT' WHEN state = 'DATA_INSUFFICIENT' THEN 'REDUNDANT' ELSE 'NOT_REMOVABLE' END AS revision FROM r""")
def canonical_revisions(spark, sf):
    f = X.facts(spark, sf).groupBy("ent", "pe", "ft").agg(F.min("val").alias("val"), F.min("av").alias("av"))
    f = f.withColumn("state", F.when(F.col("ent") % 2 == 0, "DATA_INSUFFICIENT").otherwise("COMPLETE")).withColumn("copy", F.lit(0))
    again = f.where("ent % 3 = 0").withColumns({"av": F.date_add("av", 30), "copy": F.lit(1), "val": F.when(F.col("ent") % 7 == 3, F.col("val") + 1).otherwise(F.col("val")).cast(f.schema["val"].dataType)})
    return Q.canonical_revisions(f.unionByName(again), ["ent", "pe", "ft"], ["av", "copy"], "av", "copy", "state").select("ent", "pe", "ft", "copy", "revision")


EVENTS = ", ev AS (SELECT doc, ent % 10 + 1 AS sym, (CAST(pub AS DATE) - 9862)::DATE AS av FROM v_annc)"


def _events(spark, sf):
    return X.announcements(spark, sf).select("doc", (F.col("ent") % 10 + 1).alias("sym"), F.expr("date_sub(cast(pub as date), 9862)").alias("av"))


@query("jn_4_events_in_membership", "v_annc v_member", EVENTS + " SELECT doc, ev.sym, av, s, e, 'M' || ev.sym AS scope FROM ev JOIN v_member m ON m.sym = ev.sym AND av BETWEEN s AND e")
def events_in_membership(spark, sf):
    m = X.member(spark, sf).withColumn("scope", F.concat(F.lit("M"), F.col("sym").cast("string")))
    return Q.events_in_membership(_events(spark, sf), m, "sym", "av", "doc").select("doc", "sym", "av", "s", "e", "scope")


@query("jn_4_interval_counts", "v_annc v_member", EVENTS + ", m AS (SELECT * FROM v_member UNION ALL SELECT sym, s + 100, NULL FROM v_member WHERE sym % 3 = 0) SELECT doc, count(m.sym) AS intervals FROM ev LEFT JOIN m ON m.sym = ev.sym AND av >= s AND (e IS NULL OR av <= e) GROUP BY doc")
def interval_counts(spark, sf):
    """Members of every third symbol hold an open interval besides, so some events lie in several."""
    m = X.member(spark, sf)
    m = m.unionByName(m.where("sym % 3 = 0").select("sym", F.date_add("s", 100).alias("s"), F.lit(None).cast("date").alias("e")))
    return Q.event_interval_counts(_events(spark, sf), m, "sym", "av", "doc")
