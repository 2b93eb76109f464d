"""Calendar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.operators import calendar as C

from . import fixtures as X
from .registry import query


@query("src_19_trading_calendar", "v_cal", "SELECT d, slot FROM v_cal")
def trading_calendar(spark, sf):
    return X.calendar(spark, sf)


@query("src_19_calendar_identity", "v_cal", "SELECT count(*) AS n, sha256(string_agg(d::VARCHAR, ',' ORDER BY d)) AS identity FROM v_cal")
def calendar_identity(spark, sf):
    return C.identity(X.calendar(spark, sf))


@query("src_20_calendar_tail", "v_cal", "SELECT d, slot FROM v_cal WHERE slot > (SELECT slot FROM v_cal WHERE d = DATE '1998-03-02') - 20 AND slot <= (SELECT slot FROM v_cal WHERE d = DATE '1998-03-02')")
def calendar_tail(spark, sf):
    return C.tail(X.calendar(spark, sf), X.day("1998-03-02"), 20)


@query("nrm_17_first_usable_session", "v_annc v_ecal", """
, p AS (SELECT doc, CASE doc % 3 WHEN 0 THEN strftime(pub, '%Y-%m-%d') WHEN 1 THEN strftime(pub, '%Y-%m-%d %H:%M:%S') ELSE strftime(pub, '%Y-%m-%d') || ' 15:00:00' END AS published FROM v_annc),
q AS (SELECT doc, published, published::TIMESTAMP AS t0, published LIKE '% %' AS precise FROM p),
r AS (SELECT q.*, c.d IS NOT NULL AS session, (SELECT min(d) FROM v_ecal WHERE d > CAST(q.t0 AS DATE)) AS later FROM q LEFT JOIN v_ecal c ON c.d = CAST(q.t0 AS DATE)),
s AS (SELECT *, session AND precise AND strftime(t0, '%H:%M:%S') <= '15:00:00' AS same FROM r)
SELECT doc, published, CASE WHEN same THEN CAST(t0 AS DATE) ELSE later END AS available,
  CASE WHEN NOT same AND later IS NULL THEN 'NO_LATER_SESSION' WHEN same THEN 'PRE_OR_AT_CLOSE_TIMESTAMP_SAME_TRADE_DATE' WHEN NOT precise THEN 'DATE_ONLY_NEXT_TRADE_DATE' WHEN session THEN 'AFTER_CLOSE_NEXT_TRADE_DATE' ELSE 'NON_TRADING_DAY_NEXT_TRADE_DATE' END AS basis FROM s""")
def first_usable_session(spark, sf):
    day = F.date_format("pub", "yyyy-MM-dd")
    text = F.when(F.col("doc") % 3 == 0, day).when(F.col("doc") % 3 == 1, F.date_format("pub", "yyyy-MM-dd HH:mm:ss")).otherwise(F.concat(day, F.lit(" 15:00:00")))
    return C.available(X.announcements(spark, sf).select("doc", text.alias("published")), "published", X.event_calendar(spark, sf))


@query("jn_10_calendar_reindex", "v_cal v_bars", "SELECT k.sym, c.d, c.slot, b.px FROM (SELECT DISTINCT sym FROM v_bars) k CROSS JOIN v_cal c LEFT JOIN v_bars b ON b.sym = k.sym AND b.d = c.d")
def calendar_reindex(spark, sf):
    return C.on_spine(X.bars(spark, sf).select("d", "sym", "px"), X.calendar(spark, sf), ["sym"]).select("sym", "d", "slot", "px")


@query("jn_11_next_session", "v_cal", "SELECT day, (SELECT min(d) FROM v_cal WHERE d > day) AS next_session, (SELECT max(d) FROM v_cal WHERE d <= day) AS prev_session FROM (SELECT unnest(generate_series((SELECT min(d) FROM v_cal) - 31, (SELECT max(d) FROM v_cal), INTERVAL 1 DAY))::DATE AS day)")
def next_session(spark, sf):
    return C.dense_days(X.calendar(spark, sf)).select("day", "next_session", "prev_session")


@query("jn_12_calendar_lag", "v_cal v_bars", "SELECT b.sym, b.d, b.px, o.px AS px_20 FROM v_bars b JOIN v_cal c USING (d) LEFT JOIN v_cal c0 ON c0.slot = c.slot - 20 LEFT JOIN v_bars o ON o.sym = b.sym AND o.d = c0.d")
def calendar_lag(spark, sf):
    return C.calendar_lag(X.bars(spark, sf).select("d", "sym", "px"), X.calendar(spark, sf), ["sym"], "px", 20, "px_20").select("sym", "d", "px", "px_20")


@query("jn_25_exact_calendar", "v_cal v_bars", "SELECT coalesce(c.d, b.d) AS d, CASE WHEN c.d IS NULL THEN 'right_only' ELSE 'left_only' END AS side FROM v_cal c FULL OUTER JOIN (SELECT DISTINCT d FROM v_bars WHERE vol > 80) b ON c.d = b.d WHERE c.d IS NULL OR b.d IS NULL")
def exact_calendar(spark, sf):
    from chronolake.operators.sets import reconcile

    return reconcile(X.calendar(spark, sf), X.bars(spark, sf).where("vol > 80"), ["d"]).where("side <> 'both'")


@query("tk_4_floor_dates", "v_cal", "SELECT DISTINCT (SELECT max(d) FROM v_cal WHERE d <= t) AS d FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS t FROM lineitem) WHERE (SELECT max(d) FROM v_cal WHERE d <= t) IS NOT NULL")
def floor_dates(spark, sf):
    targets = X.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("t")).distinct()
    days = C.dense_days(X.calendar(spark, sf))
    last = days.agg(F.max("day").alias("hi"))
    at = targets.crossJoin(F.broadcast(last)).withColumn("day", F.least("t", "hi"))
    return at.join(F.broadcast(days), "day").where("prev_session is not null").select(F.col("prev_session").alias("d")).distinct()


@query("pit_18_tail_cut", "v_annc v_ecal", """
, c AS (SELECT max(d) AS last FROM (SELECT d FROM v_ecal ORDER BY d DESC LIMIT 1000 OFFSET 5)),
p AS (SELECT doc, CASE doc % 2 WHEN 0 THEN strftime(pub, '%Y-%m-%d') ELSE strftime(pub, '%Y-%m-%d %H:%M:%S') END AS published FROM v_annc)
SELECT doc, published, CAST(published::TIMESTAMP AS DATE) < last OR (CAST(published::TIMESTAMP AS DATE) = last AND published LIKE '% %' AND strftime(published::TIMESTAMP, '%H:%M:%S') <= '15:00:00') AS keep FROM p, c""")
def tail_cut(spark, sf):
    from chronolake.operators.ledger import keep_available

    cal = X.event_calendar(spark, sf)
    cal = cal.crossJoin(F.broadcast(cal.agg(F.max("slot").alias("n")))).where("slot <= n - 5").select("d", "slot")
    text = F.when(F.col("doc") % 2 == 0, F.date_format("pub", "yyyy-MM-dd")).otherwise(F.date_format("pub", "yyyy-MM-dd HH:mm:ss"))
    return keep_available(X.announcements(spark, sf).select("doc", text.alias("published")), "published", cal)
