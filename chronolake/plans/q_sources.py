"""Source and publish queries: raw shapes are derived from the tables and read back through the normalisers."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.functions import fingerprint
from chronolake.functions import scalars as S
from chronolake.operators import combine, contracts, gates, membership, sets, windows
from chronolake.sources import injected, publish, readers
from chronolake.sources.scratch import new_path

from . import fixtures as X
from .registry import query


@query("src_1_anchor_scan", "", "SELECT lpad((s_suppkey % 90)::VARCHAR, 6, '0') AS symbol, count(*) AS n FROM supplier GROUP BY 1 HAVING count(*) > 1")
def anchor_scan(spark, sf):
    path = new_path(spark, "source")
    X.table(spark, sf, "supplier").select((F.col("s_suppkey") % 90).cast("string").alias("symbol"), F.lit("2024-01-01").alias("snapshot_date")).write.option("header", True).csv(path)
    return readers.anchor_snapshot(readers.read_csv(spark, path, "symbol string, snapshot_date string"))[1]


def pairs(spark, sf):
    s = F.col("s_suppkey")
    return X.table(spark, sf, "supplier").select(F.expr("cast(date_add(date'2020-01-01', cast(s_suppkey % 30 as int)) as string)").alias("effective_date"), F.when(s % 9 == 0, "").otherwise(s.cast("string")).alias("out_symbol"), F.when(s % 6 == 0, " ").when(s % 7 == 0, s.cast("string")).otherwise((s + 5000).cast("string")).alias("in_symbol"))


@query("src_2_adjustment_scan", "", """SELECT DATE '2020-01-01' + (s_suppkey % 30)::INT AS ed, lpad(s_suppkey::VARCHAR, 6, '0') AS sym, 'out' AS side FROM supplier WHERE s_suppkey % 9 <> 0
UNION ALL SELECT DATE '2020-01-01' + (s_suppkey % 30)::INT, lpad((CASE WHEN s_suppkey % 7 = 0 THEN s_suppkey ELSE s_suppkey + 5000 END)::VARCHAR, 6, '0'), 'in' FROM supplier WHERE s_suppkey % 6 <> 0""")
def adjustment_scan(spark, sf):
    path = new_path(spark, "source")
    pairs(spark, sf).write.option("header", True).csv(path)
    return readers.adjustment_ledger(readers.read_csv(spark, path, "effective_date string, out_symbol string, in_symbol string"))[0]


@query("src_2_adjustment_violations", "", "SELECT DATE '2020-01-01' + (s_suppkey % 30)::INT AS ed, CASE WHEN s_suppkey % 18 = 0 THEN 'BOTH_BLANK' ELSE 'SAME_SYMBOL' END AS broken FROM supplier WHERE s_suppkey % 18 = 0 OR (s_suppkey % 7 = 0 AND s_suppkey % 6 <> 0 AND s_suppkey % 9 <> 0)")
def adjustment_violations(spark, sf):
    return readers.adjustment_ledger(pairs(spark, sf))[1].select("ed", "broken")


@query("src_3_anchor_manifest", "", "SELECT arg_max(s_name, s_suppkey) AS anchor, max(effective_date) AS effective_date, string_agg(DISTINCT supplement, ',' ORDER BY supplement) AS supplements FROM (SELECT s_suppkey, s_name, DATE '1996-01-01' + (s_suppkey * 10)::INT AS effective_date, 'part-' || s_nationkey || '.csv' AS supplement FROM supplier) WHERE effective_date <= DATE '1996-03-31'")
def anchor_manifest(spark, sf):
    m = X.table(spark, sf, "supplier").select(F.expr("date_add(date'1996-01-01', cast(s_suppkey * 10 as int))").alias("effective_date"), F.col("s_name").alias("anchor"), F.concat(F.lit("part-"), F.col("s_nationkey").cast("string"), F.lit(".csv")).alias("supplement"))
    return membership.effective_version(m, X.day("1996-03-31")).withColumn("supplements", F.array_join("supplements", ","))


@query("src_4_universe_scan", "", "SELECT lpad(s_suppkey::VARCHAR, 6, '0') AS symbol, CASE WHEN lpad(s_suppkey::VARCHAR, 6, '0')[:1] IN ('4', '8') THEN 'beijing' ELSE 'main' END AS board, DATE '2020-01-01' + (s_suppkey % 30)::INT AS effective_start, 'point_in_time' AS universe_mode FROM supplier")
def universe_scan(spark, sf):
    path = new_path(spark, "source")
    X.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("symbol"), F.expr("date_add(date'2020-01-01', cast(s_suppkey % 30 as int))").alias("effective_start")).write.option("header", True).csv(path)
    return readers.normalize_universe(readers.read_csv(spark, path, "symbol string, effective_start string")).select("symbol", "board", "effective_start", "universe_mode")


@query("src_5_many_shards", "", "SELECT 'shard=' || c_nationkey AS shard, count(*) AS n FROM customer GROUP BY 1")
def many_shards(spark, sf):
    path = new_path(spark, "source")
    X.table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("shard")).write.option("header", True).partitionBy("shard").csv(path)
    rows = readers.read_many(spark, path, "*.csv", "c_custkey string, c_name string")
    return readers.file_counts(rows).groupBy(F.regexp_extract("source_file", "(shard=[^/]*)", 1).alias("shard")).agg(F.sum("n").alias("n"))


@query("src_6_stock_bars", "v_bars", "SELECT lpad(sym::VARCHAR, 6, '0') AS symbol, d AS date, px AS close, vol AS volume, round(CASE WHEN lag(px) OVER w <> 0 THEN (px - lag(px) OVER w) / lag(px) OVER w * 100 END, 6) AS pct_chg, 'p' AS provider FROM v_bars WINDOW w AS (PARTITION BY sym ORDER BY d)")
def stock_bars(spark, sf):
    raw = X.bars(spark, sf).select("sym", F.col("d").cast("string").alias("日期"), F.col("px").cast("string").alias("收盘"), F.col("vol").cast("string").alias("成交量"))
    rows = readers.normalize_bars(raw, S.normalize_symbol(F.col("sym")), "p")
    return rows.select("symbol", "date", "close", "volume", F.round("pct_chg", 6).alias("pct_chg"), "provider")


@query("src_7_index_bars", "v_bars", "SELECT lpad(sym::VARCHAR, 6, '0') AS symbol, d AS date, px + 1 AS close FROM v_bars WHERE d BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def index_bars(spark, sf):
    b = X.bars(spark, sf).select("sym", "d", "px")
    raw = b.unionByName(b.withColumn("px", F.col("px") + 1)).select("sym", F.col("d").alias("date"), F.col("px").alias("close"))
    rows = readers.normalize_bars(raw, S.normalize_symbol(F.col("sym")), "p")
    return readers.clip_rail(rows, X.day("1996-01-01"), X.day("1996-12-31"), [F.col("close").desc()]).select("symbol", "date", "close")


@query("src_8_positional_payload", "v_bars", "SELECT sym::VARCHAR AS code, d::VARCHAR AS date, px AS close FROM v_bars")
def positional_payload(spark, sf):
    b = X.bars(spark, sf)
    pages = b.groupBy("sym", F.year("d").alias("y")).agg(F.to_json(F.collect_list(F.array(F.col("d").cast("string"), F.col("sym").cast("string"), F.col("px").cast("string")))).alias("data"))
    rows = readers.positional_rows(pages, "data", {"date": 0, "code": 1, "close": 2})
    return rows.withColumn("close", F.expr("try_cast(close as double)")).select("code", "date", "close")


@query("src_9_columnar_payload", "v_bars", "SELECT sym, d AS date, px AS close, round(vol / 100, 6) AS change FROM v_bars")
def columnar_payload(spark, sf):
    b = X.bars(spark, sf)
    item = F.array(F.lit("ts"), F.lit("close"), F.lit("change"))
    row = F.array(F.unix_millis(F.to_utc_timestamp(F.col("d").cast("timestamp"), "Asia/Shanghai")).cast("double"), F.col("px"), F.col("vol") / 100)
    pages = b.groupBy("sym", F.year("d").alias("y")).agg(F.to_json(F.struct(F.first(item).alias("item"), F.collect_list(row).alias("data"))).alias("payload"))
    return readers.columnar_rows(pages, "payload", ["ts", "close", "change"], ("sym",)).select("sym", "date", "close", F.round("change", 6).alias("change"))


@query("src_10_announcement_pages", "", "SELECT event_id::VARCHAR AS code, min(event_type) AS title FROM events GROUP BY event_id")
def announcement_pages(spark, sf):
    e = X.table(spark, sf, "events")
    item = F.struct(F.col("event_id").cast("string").alias("code"), F.concat(F.lit("<em>"), F.col("event_type"), F.lit("</em>")).alias("title"))
    pages = e.unionByName(e.where("event_id % 5 = 0")).groupBy(F.floor(F.col("event_id") / 50).alias("page")).agg(F.to_json(F.struct(F.collect_list(item).alias("announcements"))).alias("body"))
    return readers.flatten_pages(pages, "body", "announcements", "code string, title string", ["code"])


@query("src_11_pagination_proof", "", "SELECT event_type, count(DISTINCT event_id) + CASE WHEN event_type = 'error' THEN 3 ELSE 0 END AS total, count(DISTINCT event_id) AS ids, CASE WHEN event_type = 'error' THEN 'SHORT_READ' ELSE 'COMPLETE' END AS state FROM events GROUP BY event_type")
def pagination_proof(spark, sf):
    e = X.table(spark, sf, "events").select("event_type", "event_id")
    n = e.groupBy("event_type").agg((F.count_distinct("event_id") + F.when(F.col("event_type") == "error", 3).otherwise(0)).alias("total"))
    return readers.pagination_proof(e.join(n, "event_type"), "event_type", "total", "event_id")


@query("src_12_registry_shapes", "", "SELECT CASE event_id % 3 WHEN 0 THEN 'flat' WHEN 1 THEN 'list' ELSE 'detail' END AS feed, event_id::VARCHAR AS record_id, user_id::VARCHAR AS applicant FROM events")
def registry_shapes(spark, sf):
    e, k = X.table(spark, sf, "events"), F.col("event_id") % 3
    text = lambda c: F.col(c).cast("string")
    flat = e.where(k == 0).select(F.lit("flat").alias("feed"), F.to_json(F.struct(text("event_id").alias("id"), text("user_id").alias("who"))).alias("j"))
    nested = e.where(k == 1).groupBy("user_id").agg(F.to_json(F.struct(F.first(text("user_id")).alias("who"), F.collect_list(F.struct(text("event_id").alias("id"))).alias("list"))).alias("j")).select(F.lit("list").alias("feed"), "j")
    detail = e.where(k == 2).select(F.lit("detail").alias("feed"), F.to_json(F.struct(text("event_id").alias("acceptance"))).alias("j"))
    shapes = {
        "flat": {"schema": "id string, who string", "record_id": "x.id", "applicant": "x.who"},
        "list": {"schema": "who string, list array<struct<id:string>>", "each": "list", "record_id": "i.id", "applicant": "x.who"},
        "detail": {"schema": "acceptance string", "record_id": "x.acceptance"},
    }
    details = e.select(text("event_id").alias("record_id"), text("user_id").alias("applicant"))
    return readers.registry_rows(flat.unionByName(nested).unionByName(detail), "feed", "j", shapes, details)


@query("src_13_exchange_overview", "v_bars", "SELECT d, sum(vol) FILTER (sym % 4 = 0) + sum(vol) FILTER (sym % 4 = 1) AS one, sum(vol) FILTER (sym % 4 = 2) - sum(vol) FILTER (sym % 4 = 3) AS two FROM v_bars GROUP BY d HAVING count(*) FILTER (sym % 4 = 0) > 0 AND count(*) FILTER (sym % 4 = 1) > 0 AND count(*) FILTER (sym % 4 = 2) > 0 AND count(*) FILTER (sym % 4 = 3) > 0")
def exchange_overview(spark, sf):
    return readers.overview_totals(X.bars(spark, sf), "d", F.col("sym") % 4, "vol", {"one": {0: 1, 1: 1}, "two": {2: 1, 3: -1}})


@query("src_14_share_snapshot", "v_bars", "SELECT lpad(sym::VARCHAR, 6, '0') AS fund_code, d AS date, vol AS fund_shares, 'SHARE' AS unit FROM v_bars JOIN supplier ON s_suppkey = sym WHERE vol > 0")
def share_snapshot(spark, sf):
    name = F.concat(F.lit("F"), F.lpad(F.col("sym").cast("string"), 6, "0"), F.lit(" fund"))
    wanted = X.table(spark, sf, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 6, "0").alias("fund_code"))
    return readers.share_snapshot(X.bars(spark, sf), name, "d", "vol", wanted, X.calendar(spark, sf))


@query("src_15_share_archive", "", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_custkey * 10000 + o_orderkey % 10000)::HUGEINT END::VARCHAR AS shares, CASE WHEN o_orderkey % 5 = 0 THEN 'NOT_A_NUMBER' WHEN o_orderkey % 7 = 0 THEN 'NOT_WHOLE' END AS reject FROM orders")
def share_archive(spark, sf):
    k = F.col("o_orderkey")
    text = F.when(k % 5 == 0, "n/a").when(k % 7 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".12345"))).otherwise(F.concat(F.format_number("o_custkey", 0), F.lit("."), F.lpad((k % 10000).cast("string"), 4, "0")))
    rows = readers.exact_shares(X.table(spark, sf, "orders").select("o_orderkey", text.alias("t")), "t")
    return rows.select("o_orderkey", F.col("shares").cast("string").alias("shares"), "reject")


@query("src_16_margin_balances", "v_bars", "SELECT d, sym % 2 AS exchange, round(sum(px), 2) AS balance, CASE sym % 2 WHEN 0 THEN 'CNY' ELSE 'CNY_100M' END AS source_unit FROM v_bars GROUP BY d, sym % 2")
def margin_balances(spark, sf):
    return readers.margin_balances(X.bars(spark, sf), "d", F.col("sym") % 2, "px", {0: "CNY", 1: "CNY_100M"})


@query("src_17_listing_metadata", "", "SELECT p_partkey, p_size, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY p_size DESC) AS rn FROM part WHERE p_retailprice > 0) WHERE rn = 1")
def listing_metadata(spark, sf):
    rows = X.table(spark, sf, "part").where("p_retailprice > 0")
    return contracts.keep_last(rows, ["p_partkey"], [F.col("p_size").desc()]).select("p_partkey", "p_size", "p_brand")


def raw_listings(spark, sf):
    """Parts as listings of a provider: codes of all boards and of none, dates and prices that are missing or bad, repeats that agree or not."""
    k = F.col("p_partkey")
    heads = F.array(*(F.lit(h) for h in ("688", "300", "600", "002", "430", "999")))
    code = F.concat(F.element_at(heads, (k % 6 + 1).cast("int")), F.lpad((k % 1000).cast("string"), 3, "0"))
    p = X.dealt(spark, sf, "part", "p_partkey").select(k.alias("k"), code.alias("证券代码"), F.when(k % 11 == 4, "-").otherwise(F.date_add(X.day("2015-01-01"), (k % 900).cast("int")).cast("string")).alias("上市日期"), F.when(k % 13 == 5, "0").when(k % 17 == 6, "n/a").otherwise((k % 90 + 1).cast("string")).alias("发行价格"), F.concat(F.lit(" Name "), k.cast("string")).alias("名称"), F.lit(1).alias("v"))
    again = p.where("k % 5 = 0").withColumns({"v": F.lit(2), "名称": F.lit("later")})
    other = p.where("k % 35 = 0").withColumns({"v": F.lit(3), "发行价格": F.lit("500.5")})
    return p.unionByName(again).unionByName(other)


LISTINGS = """WITH p AS (SELECT p_partkey AS k, ['688', '300', '600', '002', '430', '999'][p_partkey % 6 + 1] || lpad((p_partkey % 1000)::VARCHAR, 3, '0') AS symbol, ['STAR', 'CHINEXT', 'SSE_MAIN', 'SZSE_MAIN', 'BSE', NULL][p_partkey % 6 + 1] AS board, CASE WHEN p_partkey % 11 <> 4 THEN DATE '2015-01-01' + (p_partkey % 900)::INT END AS d, CASE WHEN p_partkey % 13 = 5 THEN 0 WHEN p_partkey % 17 <> 6 THEN p_partkey % 90 + 1 END::DOUBLE AS price FROM part),
r AS (SELECT *, 1 AS v FROM p UNION ALL SELECT *, 2 FROM p WHERE k % 5 = 0 UNION ALL SELECT k, symbol, board, d, 500.5, 3 FROM p WHERE k % 35 = 0), w AS (SELECT *, CASE WHEN board IS NULL THEN 'NO_BOARD' WHEN d IS NULL THEN 'NO_LISTING_DATE' WHEN coalesce(price, 0) <= 0 THEN 'NO_PRICE' END AS reason FROM r), g AS (SELECT symbol, count(DISTINCT (d, price)) > 1 AS differ, count(*) AS n FROM w WHERE reason IS NULL GROUP BY symbol)"""


@query("src_17_listings", "", LISTINGS + " SELECT symbol, CASE WHEN v = 2 THEN 'later' ELSE 'Name ' || k END AS name, board, d AS listing_date, price AS issue_price FROM w JOIN g USING (symbol) WHERE reason IS NULL AND NOT differ QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY v DESC, CASE WHEN v = 2 THEN 'later' ELSE 'Name ' || k END DESC) = 1")
def listings(spark, sf):
    return readers.listing_metadata(raw_listings(spark, sf), "p", "v")[0].select("symbol", "name", "board", "listing_date", "issue_price")


@query("src_17_rejected_listings", "", LISTINGS + " SELECT symbol, reason, count(*) AS n FROM w WHERE reason IS NOT NULL GROUP BY ALL UNION ALL SELECT symbol, 'CONFLICT', n FROM g WHERE differ")
def rejected_listings(spark, sf):
    return readers.listing_metadata(raw_listings(spark, sf), "p", "v")[1]


@query("src_25_search_payloads", "", """WITH e AS (SELECT event_id, CAST(ts AS DATE) AS d, CASE event_type WHEN 'click' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END AS own FROM events), h AS (SELECT *, own AS t FROM e UNION ALL SELECT *, own + 1 FROM e)
SELECT event_id AS notice_id, 'Notice ' || event_id AS title, d::VARCHAR AS published, 'T' AS theme, ['index', 'sample', 'change'][min(t) + 1] AS term FROM h WHERE t < 3 AND d BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND event_id % 19 <> 3 GROUP BY ALL""")
def search_payloads(spark, sf):
    """One payload a term and day; notices come under several terms, some ids are no numbers, one term is not asked for."""
    own = F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "purchase", 1).otherwise(2)
    e = X.table(spark, sf, "events").select("event_id", F.col("ts").cast("date").cast("string").alias("d"), own.alias("t"))
    e = e.unionByName(e.withColumn("t", F.col("t") + 1)).withColumn("term", F.element_at(F.array(*(F.lit(t) for t in ("index", "sample", "change", "other"))), F.col("t") + 1))
    ident = F.when(F.col("event_id") % 19 == 3, F.concat(F.lit("n"), F.col("event_id").cast("string"))).otherwise(F.concat(F.lit(" "), F.col("event_id").cast("string")))
    row = F.struct(ident.alias("id"), F.concat(F.lit("Notice  "), F.col("event_id").cast("string"), F.lit("\n")).alias("title"), F.col("d").alias("publishDate"), F.lit("T").alias("theme"))
    payloads = e.groupBy("term", "d").agg(F.to_json(F.struct(F.collect_list(row).alias("data"))).alias("payload"))
    return readers.search_notices(payloads, ["index", "sample", "change"], X.day("2024-01-05"), X.day("2024-01-20"))


@query("src_18_unlock_queue", "v_bars", ", l AS (SELECT sym, min(d) + 90 AS listed FROM v_bars GROUP BY sym) SELECT DISTINCT b.sym, b.d FROM v_bars b JOIN l USING (sym) WHERE b.d BETWEEN listed - 30 AND listed + 550")
def unlock_queue(spark, sf):
    b = X.bars(spark, sf).select("sym", "d")
    listings = b.groupBy("sym").agg(F.date_add(F.min("d"), 90).alias("listed"))
    return readers.window_around(b.unionByName(b), listings, "sym", "d", 30, 550).select("sym", "d").distinct()


@query("src_21_publish_manifest", "", "SELECT * FROM (SELECT 'nation' AS dataset, count(*) AS n, 'n_name,n_nationkey' AS columns FROM nation UNION ALL SELECT 'supplier', count(*), 's_name,s_suppkey' FROM supplier)")
def publish_manifest(spark, sf):
    sets_ = {"nation": X.table(spark, sf, "nation").select("n_nationkey", "n_name"), "supplier": X.table(spark, sf, "supplier").select("s_suppkey", "s_name")}
    return publish.publish(sets_, new_path(spark, "source")).select("dataset", "n", "columns")


@query("src_5_shard_fingerprints", "", "SELECT 'shard=' || c_nationkey AS shard, count(*) AS n, c_nationkey % 5 <> 0 AS same FROM customer GROUP BY c_nationkey")
def shard_fingerprints(spark, sf):
    """Shards against the table they should hold; in some, one row stands twice for another, so their sizes agree."""
    path = new_path(spark, "source")
    rows = X.table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("shard"))
    ends = rows.groupBy("shard").agg(F.min("c_custkey").alias("lo"), F.max("c_custkey").alias("hi"), F.max_by("c_name", "c_custkey").alias("last"))
    hit = (F.col("shard") % 5 == 0) & (F.col("c_custkey") == F.col("lo"))
    faulty = rows.join(ends, "shard").select(F.when(hit, F.col("hi")).otherwise(F.col("c_custkey")).alias("c_custkey"), F.when(hit, F.col("last")).otherwise(F.col("c_name")).alias("c_name"), "shard")
    faulty.write.option("header", True).partitionBy("shard").csv(path)
    found = readers.file_counts(readers.read_many(spark, path, "*.csv", "c_custkey string, c_name string"))
    found = fingerprint.merged(found.withColumn("shard", F.regexp_extract("source_file", "(shard=[^/]*)", 1)), ["shard"])
    want = fingerprint.content(rows.withColumn("shard", F.concat(F.lit("shard="), F.col("shard"))), ["shard"])
    odd = fingerprint.differing(found, want, ["shard"]).select("shard", F.lit(False).alias("__same"))
    return found.join(odd, "shard", "left").select("shard", "n", F.coalesce("__same", F.lit(True)).alias("same"))


@query("src_21_manifest_and_drift", "v_bars", "SELECT * FROM (SELECT 'bars' AS dataset, count(*) AS n, 'd,px,sym' AS columns, max(d)::VARCHAR AS latest, false AS same FROM v_bars UNION ALL SELECT 'supplier', count(*), 's_name,s_suppkey', NULL, true FROM supplier)")
def manifest_and_drift(spark, sf):
    """Figures come from the pass that writes; afterwards one dataset is replaced by as many other rows."""
    path = new_path(spark, "source")
    bars = X.bars(spark, sf).select("sym", "d", "px")
    sets_ = {"bars": bars, "supplier": X.table(spark, sf, "supplier").select("s_suppkey", "s_name")}
    manifest = publish.publish(sets_, path, {"bars": ["sym", "d", "px"], "supplier": ["s_suppkey", "s_name"]}, {"bars": "d"})
    bars.withColumn("px", F.when(F.col("sym") == 1, F.col("px") + 1).otherwise(F.col("px"))).write.mode("overwrite").parquet(f"{path}/bars")
    return manifest.join(publish.matches_manifest(path, manifest), "dataset").select("dataset", "n", "columns", "latest", "same")


@query("src_22_incremental_chunks", "v_bars", "SELECT date_trunc('month', d)::DATE AS month, count(*) AS n FROM v_bars GROUP BY 1 HAVING month >= DATE '1996-01-01'")
def incremental_chunks(spark, sf):
    b = X.bars(spark, sf).select("sym", "d", "px", F.trunc("d", "MM").alias("month")).where(F.col("month") >= X.day("1996-01-01"))
    path = new_path(spark, "source")
    early = F.col("month") < X.day("1998-01-01")
    publish.write_chunks(b.where(early), path, "month")
    done = spark.read.parquet(path).groupBy("month").agg(F.count("*").alias("n")).withColumn("complete", F.lit(True))
    todo = publish.missing_chunks(b.select("month").distinct(), done, ["month"])
    publish.write_chunks(b.join(F.broadcast(todo), "month", "left_semi"), path, "month")
    return spark.read.parquet(path).groupBy("month").agg(F.count("*").alias("n"))


@query("src_23_chunk_permanence", "v_bars", """
, ex AS (SELECT date_trunc('month', c.d)::DATE AS month, c.d, k.sym FROM v_cal c CROSS JOIN (SELECT DISTINCT sym FROM v_bars) k)
SELECT month, count(*) AS expected, count(*) FILTER (b.px IS NULL) AS missing, 0::BIGINT AS nulls, count(*) FILTER (b.px IS NULL) = 0 AS permanent FROM ex LEFT JOIN v_bars b ON b.sym = ex.sym AND b.d = ex.d GROUP BY month""")
def chunk_permanence(spark, sf):
    b = X.bars(spark, sf).select("sym", "d", "px")
    cal = X.calendar(spark, sf).select("d", F.trunc("d", "MM").alias("month"))
    expected = b.select("sym").distinct().crossJoin(F.broadcast(cal))
    return publish.permanent_chunks(b, expected, "month", ["sym", "d"], "px")


@query("src_24_provider_fallback", "v_bars", "SELECT lpad(sym::VARCHAR, 6, '0') AS symbol, CASE WHEN sym % 3 = 0 THEN 'b' ELSE 'a' END AS provider, count(*) AS n FROM v_bars GROUP BY ALL")
def provider_fallback(spark, sf):
    b = X.bars(spark, sf).select(S.normalize_symbol(F.col("sym")).alias("symbol"), "d", "px", "sym")
    both = b.where("sym % 3 <> 0").withColumn("provider", F.lit("a")).unionByName(b.withColumn("provider", F.lit("b")))
    won, _ = readers.first_provider(both, {"a": 1, "b": 2})
    return won.groupBy("symbol", "provider").agg(F.count("*").alias("n"))


@query("src_25_notice_search", "", "SELECT event_id, min(CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END) AS term FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY event_id")
def notice_search(spark, sf):
    term = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "purchase", 2).otherwise(3)
    e = X.table(spark, sf, "events").select("event_id", term.alias("term"), F.col("ts").cast("date").alias("d"))
    e = e.unionByName(e.withColumn("term", F.col("term") + 1)).where(F.col("d").between(X.day("2024-01-05"), X.day("2024-01-20")))
    return contracts.keep_last(e, ["event_id"], [F.col("term")]).select("event_id", "term")


@query("udf_1_injected_rows", "v_bars", "SELECT s_suppkey AS sym, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE i END AS page, s_suppkey % 7 <> 0 AS ok, CASE WHEN s_suppkey % 7 = 0 THEN 'ValueError: no route to ' || s_name END AS error FROM supplier, LATERAL (SELECT unnest(generate_series(0, CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE s_suppkey % 4 - 1 END)) AS i)")
def injected_rows(spark, sf):
    """A caller's fetcher gives pages for each supplier; for some it fails, which is a row of its own."""
    def fetch(request):
        if request["sym"] % 7 == 0:
            raise ValueError(f"no route to {request['s_name']}")
        return [{"sym": request["sym"], "page": k} for k in range(request["sym"] % 4)]

    return injected.fetched(X.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sym"), "s_name"), fetch, "sym long, page int")


@query("udf_2_injected_documents", "", "SELECT b.event_id AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'MISSING' WHEN coalesce(text, '') = '' THEN 'EMPTY' ELSE 'LOADED' END AS state, length(nullif(text, '')) AS n, sha256(nullif(text, '')) AS document_sha256 FROM (SELECT DISTINCT event_id FROM events) b LEFT JOIN documents d ON d.doc_id = b.event_id")
def injected_documents(spark, sf):
    """Documents come as a table keyed by id; events ask for them, and many ask for none that is there."""
    asked = X.table(spark, sf, "events").select(F.col("event_id").alias("doc_id"))
    return injected.loaded_documents(asked, X.table(spark, sf, "documents"), "doc_id", "text")


@query("udf_3_chunk_producer", "v_bars", "SELECT sym, year(d)::INT AS y, max(px) - min(px) AS px_range, count(*) AS n FROM v_bars GROUP BY ALL")
def chunk_producer(spark, sf):
    """A user's function for each chunk; a chunk is one symbol and year."""
    import pandas as pd

    def produce(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sym": [key[0]], "y": [key[1]], "px_range": [pdf["px"].max() - pdf["px"].min()], "n": [len(pdf)]})

    rows = X.bars(spark, sf).select("sym", F.year("d").alias("y"), "px")
    return injected.produced_chunks(rows, ["sym", "y"], produce, "sym long, y int, px_range double, n long")


@query("ag_13_bundle_quality", "v_bars v_member", "SELECT max(b.d) AS latest, count(DISTINCT b.sym) AS symbols, round(count(DISTINCT b.sym) / (SELECT count(DISTINCT sym) FROM v_member)::DOUBLE, 6) AS coverage FROM v_bars b WHERE b.sym IN (SELECT sym FROM v_member)")
def bundle_quality(spark, sf):
    return gates.bundle_quality(X.bars(spark, sf), X.member(spark, sf), "sym", "d")


MARKET_SQL = """, z AS (SELECT max(d) AS latest FROM v_bars), u AS (SELECT sym, bool_or(s <= latest AND e >= latest) AS active FROM v_member, z GROUP BY sym), p AS (SELECT sym, bool_or(d = latest) AS now FROM v_bars, z WHERE {where} GROUP BY sym),
k AS (SELECT count(*) AS universe_symbols, count(now) AS seen_symbols, count(*) FILTER (active) AS active_symbols, count(*) FILTER (active AND now) AS active_seen FROM u LEFT JOIN p USING (sym))
SELECT latest, k.*, round(seen_symbols / universe_symbols::DOUBLE, 6) AS historical_coverage, round(coalesce(active_seen / nullif(active_symbols, 0)::DOUBLE, 0), 6) AS active_coverage, seen_symbols >= 0.95 * universe_symbols AND active_symbols > 0 AND active_seen >= 0.95 * active_symbols AS passed FROM k, z"""


@query("ag_13_market_quality", "v_bars v_member", MARKET_SQL.format(where="true"))
def market_quality(spark, sf):
    return gates.market_quality(X.bars(spark, sf), X.member(spark, sf), "sym", "d", start="s", end="e")


@query("ag_13_market_quality_up_to", "v_bars v_member", """, c AS (SELECT unnest([DATE '1996-12-31', DATE '1998-02-27']) AS cut), z AS (SELECT cut, max(d) AS latest FROM v_bars JOIN c ON d <= cut GROUP BY cut), u AS (SELECT cut, sym, bool_or(s <= latest AND coalesce(e >= latest, true)) AS active FROM z, (SELECT sym, s, CASE WHEN sym % 4 = 0 THEN NULL ELSE e END AS e FROM v_member) GROUP BY cut, sym), p AS (SELECT cut, sym, bool_or(d > latest - 30) AS now FROM v_bars, z WHERE d <= cut GROUP BY cut, sym)
SELECT cut, count(*) AS universe_symbols, count(now) AS seen_symbols, count(*) FILTER (active) AS active_symbols, count(*) FILTER (active AND now) AS active_seen, count(now) >= 0.9 * count(*) AND count(*) FILTER (active AND now) >= 0.9 * count(*) FILTER (active) AS passed FROM u LEFT JOIN p USING (cut, sym) GROUP BY cut""")
def market_quality_up_to(spark, sf):
    """The gate at two dates, a bar of the last thirty days counting as one of the latest day; some memberships are open."""
    out = None
    members = X.member(spark, sf).withColumn("e", F.when(F.col("sym") % 4 != 0, F.col("e")))
    for cut in ("1996-12-31", "1998-02-27"):
        bars = X.bars(spark, sf).where(F.col("d") <= X.day(cut)).select("sym", "d")
        last = bars.agg(F.max("d").alias("last"))
        near = bars.join(F.broadcast(last), F.lit(True)).select("sym", F.when(F.col("d") > F.date_sub("last", 30), F.col("last")).otherwise(F.col("d")).alias("d"))
        row = gates.market_quality(near, members, "sym", "d", 0.9, start="s", end="e").select(X.day(cut).alias("cut"), "universe_symbols", "seen_symbols", "active_symbols", "active_seen", "passed")
        out = row if out is None else out.unionByName(row)
    return out


@query("tk_6_modulo_shards", "", "SELECT (rn - 1) % 8 AS shard, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM (SELECT DISTINCT o_orderkey FROM orders)) GROUP BY 1")
def modulo_shards(spark, sf):
    scope = X.table(spark, sf, "orders").select("o_orderkey").distinct()
    return windows.modulo_shards(scope, "o_orderkey", 8).groupBy("shard").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("tk_5_canonical_order", "v_annc", "SELECT doc, row_number() OVER (PARTITION BY CAST(pub AS DATE) ORDER BY cls, ent, doc) AS place FROM v_annc")
def canonical_order(spark, sf):
    order = [F.col("cls"), F.col("ent"), F.col("doc")]
    return combine.canonical_place(X.announcements(spark, sf), [F.col("pub").cast("date")], order).select("doc", "place")


@query("set_2_disjoint_append", "v_bars", "SELECT DISTINCT d FROM v_bars WHERE d BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'")
def disjoint_append(spark, sf):
    b = X.bars(spark, sf).select("d", "px")
    _, overlap = sets.append_disjoint(b.where(F.col("d") <= X.day("1998-03-31")), b.where(F.col("d") >= X.day("1998-01-01")), "d")
    return overlap
