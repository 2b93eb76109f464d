"""The shapes that the queries work on, as views over the given tables: in Spark, and as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.operators import spread
from chronolake.operators.calendar import slots


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows grow into texts: its file may be small enough for one task, their texts are not."""
    return spread.by_key(table(spark, sf_dir, name), key)


def day(date: str):
    return F.lit(date).cast("date")


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """d, slot: order dates without Saturdays and Sundays."""
    d = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return slots(d.where("weekday(d) < 5"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """d, sym, px, vol: one row for each symbol and session with a trade."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"), F.col("l_suppkey").alias("sym"), "l_extendedprice", "l_quantity")
    rows = rows.groupBy("d", "sym").agg(F.max("l_extendedprice").alias("px"), F.sum("l_quantity").alias("vol"))
    return rows.join(F.broadcast(calendar(spark, sf_dir).select("d")), "d")


def member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sym, s, e: inclusive membership; even symbols enter twice."""
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sym"), F.expr("date_add(date'1995-01-02', cast(s_suppkey * 7 % 400 as int))").alias("s"))
    one = sup.select("sym", "s", F.expr("date_add(s, 500)").alias("e"))
    two = sup.where("sym % 2 = 0").select("sym", F.expr("date_add(s, cast(700 + (sym % 3) * 100 as int))").alias("s"), F.expr("date_add(s, 1500)").alias("e"))
    return one.unionByName(two)


def adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ed, sym, side: the membership as a ledger of entries and exits."""
    m = member(spark, sf_dir)
    return m.select(F.col("s").alias("ed"), "sym", F.lit("in").alias("side")).unionByName(m.select(F.expr("date_add(e, 1)").alias("ed"), "sym", F.lit("out").alias("side")))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ent, pe, ft, ver, val, av: versioned facts; versions F and O of a fact tie in availability."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    pe = F.expr("date_sub(add_months(trunc(cast(o_orderdate as date), 'QUARTER'), 3), 1)")
    rows = o.select(F.col("c_nationkey").alias("ent"), pe.alias("pe"), F.col("o_orderpriority").alias("ft"), F.col("o_orderstatus").alias("ver"), F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    rows = rows.groupBy("ent", "pe", "ft", "ver").agg(F.sum("v").alias("val"))
    return rows.withColumn("av", F.expr("date_add(pe, if(ver = 'P', 80, 25))"))


def announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, ent, pub, cls, value."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("doc"), F.col("user_id").alias("ent"), F.col("ts").cast("timestamp_ntz").alias("pub"), F.col("event_type").alias("cls"), "value")


def event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = announcements(spark, sf_dir).select(F.col("pub").cast("date").alias("d")).distinct()
    return slots(d.where("weekday(d) < 5"))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, entity, title, published, text: a filing of each customer, in the layouts that extracted filing text comes in.

    Four ways to declare the unit of the summary (yuan, ten thousand yuan, thousand yuan over three lines, none), wrapped
    labels, amounts in brackets, a value per share, and two statements with units of their own; one in sixteen holds no table.
    """
    c = dealt(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").alias("k"), "c_acctbal")
    k = F.col("k")
    amount = lambda x: F.format_number(x, 2)
    line = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts), F.lit("\n"))
    unit = F.when(k % 4 == 0, line("单位：元 币种：人民币")).when(k % 4 == 1, line("单位：人民币万元")).when(k % 4 == 2, line("单\u200b 位 ：\n人 民 币\n千 元")).otherwise("")
    cash = F.when(k % 3 == 0, F.concat(F.lit("("), amount(k + 0.5), F.lit(")"))).otherwise(amount(k + 0.5))
    ends = F.when(k % 5 == 0, "项目 期初余额 期末余额").otherwise("项目 期末余额 期初余额")
    text = F.concat(
        line("3.1 近3年的主要会计数据和财务指标"), unit,
        line("总资产 ", amount("c_acctbal"), " 255,168.90 -0.31"),
        line("营业收入 ", amount(k * 8 + 0.5), " 106,190.76 16.87"),
        line("归属于上市公司股东的净\n利润\n", amount(k * 3 + 0.25), " 52,460.16 19.55"),
        line("经营活动产生的现金流量\n净额\n", cash, " 64,028.37 -42.68"),
        line("归属于上市公司股东的净资产 99.00 98.00 1.02"),
        line("基本每股收益（元／股） ", amount((k % 90) / 4), " 41.76"),
        line("合并资产负债表\n单位：万元"), line(ends), line("归属于母公司所有者权益 ", amount(k + 0.5), " 11.00"),
        line("合并利润表\n单位：千元"), line("一、营业利润 ", amount(k + 0.25), " 9.00"), line("二、利润总额 (", amount(k % 1000), ") 8.00"), line("减：所得税费用 ", amount(k % 7), " 7.00"),
    )
    title = F.concat(((k % 6) + 2001).cast("string"), F.lit("年年度报告"), F.when(k % 5 == 1, "摘要").otherwise(""))
    published = F.date_add(F.lit("1998-05-01").cast("date"), (k % 97).cast("int")).cast("string")
    return c.select(k.alias("doc_id"), F.floor(k / 30).alias("entity"), title.alias("title"), published.alias("published"), F.when(k % 16 == 7, "本公司无表格").otherwise(text).alias("text"))


SQL = {
    "v_cal": "v_cal AS (SELECT d, row_number() OVER (ORDER BY d) AS slot FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) WHERE isodow(d) < 6)",
    "v_bars": "v_bars AS (SELECT b.* FROM (SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey AS sym, max(l_extendedprice) AS px, sum(l_quantity) AS vol FROM lineitem GROUP BY 1, 2) b JOIN v_cal USING (d))",
    "v_member": "v_sup AS (SELECT s_suppkey AS sym, DATE '1995-01-02' + (s_suppkey * 7 % 400)::INT AS s FROM supplier), v_member AS (SELECT sym, s, s + 500 AS e FROM v_sup UNION ALL SELECT sym, s + (700 + (sym % 3) * 100)::INT, s + 1500 FROM v_sup WHERE sym % 2 = 0)",
    "v_adjust": "v_adjust AS (SELECT s AS ed, sym, 'in' AS side FROM v_member UNION ALL SELECT e + 1, sym, 'out' FROM v_member)",
    "v_facts": "v_facts AS (SELECT *, pe + CASE ver WHEN 'P' THEN 80 ELSE 25 END AS av FROM (SELECT c_nationkey AS ent, (date_trunc('quarter', CAST(o_orderdate AS DATE)) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS pe, o_orderpriority AS ft, o_orderstatus AS ver, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS val FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4))",
    "v_annc": "v_annc AS (SELECT event_id AS doc, user_id AS ent, ts AS pub, event_type AS cls, value FROM events)",
    # the values that the filings were made from, in yuan
    "v_filings": "v_filings AS (SELECT c_custkey AS k, c_custkey // 30 AS entity, c_custkey % 6 + 2001 AS period_year, c_custkey % 5 = 1 AS abstract, DATE '1998-05-01' + (c_custkey % 97)::INT AS published, c_acctbal, CASE c_custkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 10000.0 WHEN 2 THEN 1000.0 END AS scale, c_custkey % 16 <> 7 AS tables FROM customer)",
    "v_filed": "v_filed AS (SELECT doc_id, fact, value::DOUBLE AS value FROM (SELECT k AS doc_id, unnest([{'fact': 'TOTAL_ASSETS', 'value': c_acctbal * scale}, {'fact': 'OPERATING_REVENUE', 'value': (k * 8 + 0.5) * scale}, {'fact': 'NET_PROFIT_PARENT', 'value': (k * 3 + 0.25) * scale}, {'fact': 'OPERATING_CASH_FLOW_NET', 'value': CASE WHEN k % 3 = 0 THEN -1 ELSE 1 END * (k + 0.5) * scale}, {'fact': 'EQUITY_PARENT', 'value': (k + 0.5) * 10000.0}, {'fact': 'BASIC_EPS', 'value': (k % 90) / 4.0}, {'fact': 'NET_PROFIT_MARGIN', 'value': ((k * 3 + 0.25) * scale)::DOUBLE / ((k * 8 + 0.5) * scale)::DOUBLE}]) AS f FROM v_filings WHERE tables), LATERAL (SELECT f.fact AS fact, f.value AS value) WHERE value IS NOT NULL)",
    "v_ecal": "v_ecal AS (SELECT d, row_number() OVER (ORDER BY d) AS slot FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events) WHERE isodow(d) < 6)",
}
NEEDS = {"v_bars": ("v_cal",), "v_filed": ("v_filings",), "v_adjust": ("v_member",)}


def sql(names: str, body: str) -> str:
    """A query over views by name, with what they need before them."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, ()):
            add(other)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    body = body.strip()
    own = ", " + body[5:] if body.upper().startswith("WITH ") else " " + body
    return "WITH " + ", ".join(SQL[n] for n in order) + own if order else body
