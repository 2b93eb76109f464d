"""Document queries: text lines of the documents stand for filing text, list items of the pages for tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronolake.operators import documents as D
from chronolake.operators import balance_sheets, html_tables, nonrecurring

from . import fixtures as X
from .registry import query

LINES = "ln AS (SELECT doc_id, i - 1 AS line_no, trim(parts[i], ' ') AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents), LATERAL (SELECT unnest(generate_series(1, len(parts))) AS i) WHERE trim(parts[i], ' ') <> '')"
SHORT = 40  # a line of up to so many characters stands for a heading


def lines(spark, sf):
    return D.lines(X.table(spark, sf, "documents"))


def header():
    return F.length("line") <= SHORT


SCOPE = f"{LINES}, sc AS (SELECT *, length(line) <= {SHORT} AS is_header, sum((length(line) <= {SHORT})::INT) OVER w AS block, last_value(CASE WHEN length(line) <= {SHORT} THEN line END IGNORE NULLS) OVER w AS scope FROM ln WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"


@query("doc_1_scoped_lines", "", f"WITH {SCOPE} SELECT doc_id, line_no, block, scope FROM sc")
def scoped_lines(spark, sf):
    return D.scoped(lines(spark, sf), header()).select("doc_id", "line_no", "block", "scope")


@query("doc_2_nearest_unit", "v_filings", "SELECT k AS doc_id, CASE WHEN tables THEN CASE k % 4 WHEN 0 THEN '元' WHEN 1 THEN '万元' WHEN 2 THEN '千元' END END AS summary, CASE WHEN tables THEN '万元' END AS balance, CASE WHEN tables THEN '千元' END AS income FROM v_filings")
def nearest_unit(spark, sf):
    rows = D.filing_rows(X.filings(spark, sf))
    at = lambda word: F.max(F.when(F.col("line").contains(word), F.col("unit")))
    return rows.groupBy("doc_id").agg(at("总资产").alias("summary"), at("母公司所有者").alias("balance"), at("营业利润").alias("income"))


LOGICAL = f"""{LINES}, nx AS (SELECT doc_id, line_no, list(line) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS n FROM ln),
lr AS (SELECT doc_id, line_no, n[1] AS line, array_to_string(n[1:coalesce(list_position(list_transform(n, lambda x: regexp_matches(x, '[0-9]')), true), len(n))], ' ') AS row_text FROM nx)"""


@query("doc_3_logical_rows", "", f"WITH {LOGICAL} SELECT doc_id, line_no, sha256(row_text) AS row_hash FROM lr")
def logical_rows(spark, sf):
    return D.logical_rows(lines(spark, sf)).select("doc_id", "line_no", F.sha2("row_text", 256).alias("row_hash"))


@query("doc_4_standard_facts", "v_filed", "SELECT doc_id, fact, round(value, 6) AS value FROM v_filed")
def standard_facts(spark, sf):
    """The SQL has the values that the texts were made from; nothing of it reads a text."""
    return D.standard_facts(X.filings(spark, sf)).withColumn("value", F.round("value", 6))


CELLS = f"""{LINES}, ce AS (SELECT doc_id, line_no, line, regexp_extract_all(replace(line, ' ', '  '), '(?:^|\\s)(-?[0-9][0-9,.]*|[-–—])(?:\\s|$)', 1) AS cells FROM ln),
st AS (SELECT *, CASE WHEN len(cells) = 0 THEN 'EMPTY' WHEN len(cells) = 2 OR (len(cells) = 3 AND regexp_full_match(cells[1], '[0-9]{{1,2}}')) THEN 'PROVABLE' ELSE 'AMBIGUOUS' END AS state FROM ce)"""


@query("doc_5_statement_cells", "", f"WITH {CELLS} SELECT doc_id, line_no, len(cells)::INT AS n_cells, state FROM st WHERE state <> 'EMPTY'")
def statement_cells(spark, sf):
    return D.cell_rows(lines(spark, sf)).where("state <> 'EMPTY'").select("doc_id", "line_no", F.size("cells").alias("n_cells"), "state")


@query("doc_6_reconciled_zero", "", "SELECT l_orderkey, count(*) FILTER (v IS NULL) AS blanks, round(max(t) - coalesce(sum(v), 0), 4) AS residual, count(*) FILTER (v IS NULL) > 0 AND abs(max(t) - coalesce(sum(v), 0)) <= 0.005 AS zero FROM (SELECT l_orderkey, CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END AS v, sum(CASE WHEN l_linenumber % 3 <> 0 OR l_orderkey % 2 = 0 THEN l_quantity ELSE 0 END) OVER (PARTITION BY l_orderkey) AS t FROM lineitem) GROUP BY 1")
def reconciled_zero(spark, sf):
    q, third = F.col("l_quantity"), F.col("l_linenumber") % 3 != 0
    rows = X.table(spark, sf, "lineitem").select("l_orderkey", F.when(third, q).alias("v"), F.sum(F.when(third | (F.col("l_orderkey") % 2 == 0), q).otherwise(0.0)).over(Window.partitionBy("l_orderkey")).alias("t"))
    return D.reconciled_zero(rows, ["l_orderkey"], "v", "t").withColumn("residual", F.round("residual", 4))


@query("doc_7_row_evidence", "", f"WITH {CELLS} SELECT doc_id, line_no, CASE WHEN list_has_any(cells, ['-', '–', '—']) THEN 'DASH' ELSE 'NUMERIC' END AS cell_kind, sha256(line) AS row_hash FROM st WHERE state <> 'EMPTY'")
def row_evidence(spark, sf):
    rows = D.cell_rows(lines(spark, sf)).where("state <> 'EMPTY'")
    dash = F.arrays_overlap("cells", F.array(F.lit("-"), F.lit("–"), F.lit("—")))
    return rows.select("doc_id", "line_no", F.when(dash, "DASH").otherwise("NUMERIC").alias("cell_kind"), F.sha2("line", 256).alias("row_hash"))


@query("doc_8_layout_proof", "v_filings", "SELECT k AS doc_id, CASE WHEN k % 5 = 0 THEN 9 ELSE 4 END AS \"left\", CASE WHEN k % 5 = 0 THEN 4 ELSE 9 END AS \"right\", k % 5 <> 0 AS current_first FROM v_filings WHERE tables")
def layout_proof(spark, sf):
    return D.layout_proof(X.filings(spark, sf), ["期末余额", "期初余额"]).select("doc_id", "left", "right", "current_first")


@query("doc_9_biggest_block", "", f"WITH {SCOPE}, b AS (SELECT doc_id, block, count(*) AS n FROM sc WHERE block > 0 GROUP BY 1, 2) SELECT doc_id, max(n) AS n_rows, count(*) > 1 AS conflict FROM (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY n DESC) AS rk FROM b) WHERE rk = 1 GROUP BY doc_id")
def biggest_block(spark, sf):
    b = D.scoped(lines(spark, sf), header()).where("block > 0").groupBy("doc_id", "block").agg(F.count("*").alias("n"))
    top = b.withColumn("rk", F.rank().over(Window.partitionBy("doc_id").orderBy(F.col("n").desc()))).where("rk = 1")
    return top.groupBy("doc_id").agg(F.max("n").alias("n_rows"), (F.count("*") > 1).alias("conflict"))


@query("doc_10_driver_facts", "v_filings", "SELECT k AS doc_id, f.fact, round(f.value, 6) AS value FROM (SELECT k, unnest([{'fact': 'OPERATING_PROFIT_CN_GAAP', 'value': (k + 0.25) * 1000.0}, {'fact': 'TOTAL_PROFIT_CN_GAAP', 'value': -(k % 1000) * 1000.0}, {'fact': 'INCOME_TAX_EXPENSE_CN_GAAP', 'value': (k % 7) * 1000.0}]) AS f FROM v_filings WHERE tables)")
def driver_facts(spark, sf):
    return D.driver_facts(X.filings(spark, sf)).withColumn("value", F.round("value", 6))


@query("doc_11_note_section", "", f"WITH {SCOPE}, f AS (SELECT doc_id, min(block) AS b FROM sc WHERE is_header AND length(line) <= 20 GROUP BY doc_id) SELECT doc_id, min(line_no) AS start_line, sha256(string_agg(line, chr(10) ORDER BY line_no)) AS section_hash FROM sc JOIN f USING (doc_id) WHERE block = b GROUP BY doc_id")
def note_section(spark, sf):
    return D.section(lines(spark, sf), header(), F.length("line") <= 20).select("doc_id", "start_line", F.sha2("section", 256).alias("section_hash"))


@query("doc_12_html_rows", "", "SELECT page_id, unnest(regexp_extract_all(html, '<li>(.*?)</li>', 1)) AS item FROM pages")
def html_rows(spark, sf):
    return D.html_rows(X.table(spark, sf, "pages"))


@query("doc_13_links", "", "SELECT DISTINCT page_id, href FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1)) AS href FROM pages) WHERE regexp_matches(href, '^/[a-z]')")
def page_links(spark, sf):
    return D.links(X.table(spark, sf, "pages"), "html", "^/[a-z]")


@query("doc_14_sheet_changes", "", "SELECT p_partkey // 40 AS sheet, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) FILTER (p_size % 2 = 0) AS added, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) FILTER (p_size % 2 = 1) AS removed FROM part GROUP BY 1")
def sheet_changes(spark, sf):
    """A cell table with a header row below a title row; the header names the columns, in either order."""
    p = X.table(spark, sf, "part").select(F.floor(F.col("p_partkey") / 40).alias("sheet"), (F.col("p_partkey") + 10).alias("row"), F.col("p_partkey").cast("string").alias("code"), F.when(F.col("p_size") % 2 == 0, "add").otherwise("remove").alias("side"))
    turn = (F.col("sheet") % 2).cast("int")
    cell = lambda col, value: F.struct(col.alias("col"), value.alias("value"))
    both = lambda side, code: F.explode(F.array(cell(turn, side), cell(1 - turn, code))).alias("c")
    body = p.select("sheet", "row", both(F.col("side"), F.col("code")))
    heads = p.select("sheet").distinct()
    head = heads.select("sheet", F.lit(2).cast("long").alias("row"), both(F.lit("side"), F.lit("code"))).unionByName(heads.select("sheet", F.lit(1).cast("long").alias("row"), cell(F.lit(0), F.lit("side")).alias("c")))
    rows = D.sheet_changes(body.unionByName(head).select("sheet", "row", "c.*"), ["side", "code"])
    pick = lambda s: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("side") == s, F.struct("row", "code")))), lambda x: x["code"]), ",")
    return rows.groupBy("sheet").agg(F.nullif(pick("add"), F.lit("")).alias("added"), F.nullif(pick("remove"), F.lit("")).alias("removed"))


@query("doc_15_parser_replay", "v_filed", ", n AS (SELECT doc_id, fact, CASE WHEN fact = 'TOTAL_ASSETS' THEN value + 1 ELSE value END AS value FROM v_filed WHERE NOT (fact = 'BASIC_EPS' AND doc_id % 2 = 0)) SELECT coalesce(f.doc_id, n.doc_id) AS doc_id, coalesce(f.fact, n.fact) AS fact, CASE WHEN n.doc_id IS NULL THEN 'removed' ELSE 'changed' END AS change FROM v_filed f FULL OUTER JOIN n ON f.doc_id = n.doc_id AND f.fact = n.fact WHERE n.doc_id IS NULL OR f.value IS DISTINCT FROM n.value")
def parser_replay(spark, sf):
    from chronolake.operators.sets import diff

    old = D.standard_facts(X.filings(spark, sf))
    new = old.where("not (fact = 'BASIC_EPS' and doc_id % 2 = 0)").withColumn("value", F.when(F.col("fact") == "TOTAL_ASSETS", F.col("value") + 1).otherwise(F.col("value")))
    return diff(old, new, ["doc_id", "fact"])


@query("doc_16_conflict_recheck", "v_facts", ", c AS (SELECT ent, pe, ft, av FROM v_facts GROUP BY ALL HAVING count(DISTINCT val) > 1) SELECT f.ent, f.pe, f.ft, f.ver, CASE WHEN c.ent IS NULL THEN 'UNCHECKED' WHEN f.ver = 'F' THEN 'FULL_OR_CANONICAL' ELSE 'BODY' END AS presentation FROM v_facts f LEFT JOIN c ON c.ent = f.ent AND c.pe = f.pe AND c.ft = f.ft AND c.av = f.av")
def conflict_recheck(spark, sf):
    from chronolake.functions.scalars import presentation
    from chronolake.operators.sets import conflicts

    f = X.facts(spark, sf)
    keys = ["ent", "pe", "ft", "av"]
    bad = conflicts(f, keys, ["val"]).select(*keys)
    docs = f.join(bad, keys, "left_semi").select(*keys, "ver", presentation(F.when(F.col("ver") == "F", "2023年第一季度报告全文").otherwise("2023年第一季度报告正文")).alias("p"))
    return f.join(docs, [*keys, "ver"], "left").select("ent", "pe", "ft", "ver", F.coalesce("p", F.lit("UNCHECKED")).alias("presentation"))


@query("doc_17_fact_materialisation", "v_cal v_filed", """
, chosen AS (SELECT k FROM v_filings WHERE EXISTS (SELECT 1 FROM v_cal WHERE d > published) QUALIFY row_number() OVER (PARTITION BY entity, period_year ORDER BY abstract, published DESC, k DESC) = 1),
n AS (SELECT doc_id, count(*) AS n FROM v_filed GROUP BY 1)
SELECT v.k AS doc_id, CASE WHEN c.k IS NULL THEN 0 ELSE coalesce(n, 0) END AS facts, CASE WHEN c.k IS NULL THEN 'NOT_CHOSEN' WHEN n IS NULL THEN 'SOFT_NO_FACT' ELSE 'PARSED' END AS state
FROM v_filings v LEFT JOIN chosen c ON c.k = v.k LEFT JOIN n ON n.doc_id = v.k""")
def fact_materialisation(spark, sf):
    return D.materialised_facts(X.filings(spark, sf), X.calendar(spark, sf))[1]


@query("doc_17_filed_facts", "v_cal v_filed", """
, chosen AS (SELECT k, entity, period_year, published FROM v_filings WHERE EXISTS (SELECT 1 FROM v_cal WHERE d > published) QUALIFY row_number() OVER (PARTITION BY entity, period_year ORDER BY abstract, published DESC, k DESC) = 1)
SELECT doc_id, entity, make_date(period_year, 12, 31) AS period, (SELECT min(d) FROM v_cal WHERE d > published) AS available, fact, round(value, 6) AS value FROM v_filed JOIN chosen ON k = doc_id""")
def filed_facts(spark, sf):
    rows = D.materialised_facts(X.filings(spark, sf), X.calendar(spark, sf))[0]
    return rows.select("doc_id", "entity", F.col("period").cast("date").alias("period"), "available", "fact", F.round("value", 6).alias("value"))


# --- tables of non-recurring items -------------------------------------------------------------------


def nonrecurring_texts(spark, sf):
    """A filing of each customer with one or two tables of non-recurring items, in yuan or thousands.

    Rows wrap over lines and pages; some hold two amounts or none. By customer: a second table that is smaller, as
    large with another total, or the same; no total; a label with two amounts.
    """
    k = F.col("c_custkey")
    line = lambda *parts: F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts), F.lit("\n"))
    n = lambda x, cents: F.concat(x.cast("string"), F.lit(cents))

    def table(total, short):
        return F.concat(
            line("非经常性损益项目和金额"), line("√适用 □不适用"), F.when(k % 2 == 0, line("单位：元 币种：人民币")).otherwise(line("单位：人民币千元")), line("非经常性损益项目 本期金额"),
            line("非流动性资产处置损益，包括已计提资产减值准备的冲销部分 ", n(k, ".50")), line("计入当期损益的政府补助，但与公司"), line("某某股份有限公司2020年年度报告"), line("12 / 180"), line("正常经营业务密切相关 ", n(k * 2, ".25")),
            F.when(short, line("债务重组损益")).when(k % 4 == 0, line("债务重组损益 1.00 2.00")).otherwise(line("债务重组损益 ", n(k + 3, ".00"))),
            line("其他符合非经常性损益定义的损益项目"), line("减：所得税影响额 (", n(k % 50, ".10"), ")"), line("少数股东权益影响额（税后） ", n(k % 9, ".75")),
            F.when(k % 13 == 6, line("计入当期损益的政府补助 7.00")).otherwise(line("小计")), F.when(k % 11 != 5, line("合计 ", total)).otherwise(line("总计 ", total)),
            line("对公司将《公开发行证券的公司信息披露解释性公告第1号》列举"),
        )

    one = n(k * 3, ".00")
    second = F.when(k % 7 == 1, table(one, F.lit(True))).when(k % 7 == 2, table(n(k * 3 + 1, ".00"), F.lit(False))).when(k % 7 == 3, table(one, F.lit(False))).otherwise(line("第二节"))
    return X.dealt(spark, sf, "customer", "c_custkey").select(k.alias("doc_id"), F.concat(line("第一节 公司简介"), table(one, F.lit(False)), line("其他说明 5.00"), second).alias("text"))


NONRECURRING_SQL = """WITH t AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 1000 END AS scale, CASE WHEN c_custkey % 11 = 5 OR c_custkey % 13 = 6 THEN 'NO_TABLE' WHEN c_custkey % 7 = 2 THEN 'CONFLICT' ELSE 'PARSED' END AS state FROM customer)"""


@query("doc_9_nonrecurring_facts", "", NONRECURRING_SQL + """ SELECT doc_id, fact, round(v, 4) AS value FROM (SELECT k AS doc_id, unnest([{'fact': 'NR_NON_CURRENT_ASSET_DISPOSAL', 'v': (k + 0.5) * scale}, {'fact': 'NR_GOVERNMENT_GRANT', 'v': (k * 2 + 0.25) * scale}, {'fact': 'NR_DEBT_RESTRUCTURING', 'v': CASE WHEN k % 4 <> 0 THEN (k + 3.0) * scale END},
  {'fact': 'NR_INCOME_TAX_EFFECT', 'v': -(k % 50 + 0.1) * scale}, {'fact': 'NR_MINORITY_INTEREST_EFFECT_AFTER_TAX', 'v': (k % 9 + 0.75) * scale}, {'fact': 'NR_REPORTED_NET_TOTAL', 'v': k * 3.0 * scale}], recursive := true) FROM t WHERE state = 'PARSED') WHERE v IS NOT NULL""")
def nonrecurring_facts(spark, sf):
    facts, _ = nonrecurring.nonrecurring_facts(nonrecurring_texts(spark, sf))
    return facts.select("doc_id", "fact", F.round("value", 4).alias("value"))


@query("doc_9_table_states", "", NONRECURRING_SQL + " SELECT k AS doc_id, state, CASE WHEN state = 'NO_TABLE' THEN 0 WHEN k % 7 IN (2, 3) OR k % 7 = 1 AND k % 4 = 0 THEN 2 ELSE 1 END AS tables FROM t")
def nonrecurring_states(spark, sf):
    _, states = nonrecurring.nonrecurring_facts(nonrecurring_texts(spark, sf))
    return states


# --- tables in pages ----------------------------------------------------------------------------------


def membership_pages(spark, sf):
    """A page of each supplier with index rows (a longer code, an unclosed cell, a nested table, repeats) and quarterly holdings."""
    k = F.col("s_suppkey")
    day = lambda base, span: F.date_add(F.lit(base).cast("date"), (k % span).cast("int")).cast("string")
    cell = lambda *parts: F.concat(F.lit("<td>"), *(p if not isinstance(p, str) else F.lit(p) for p in parts), F.lit("</td>"))
    row = lambda *cells: F.concat(F.lit("<tr>"), *cells, F.lit("</tr>\n"))
    start, stop = day("2018-01-01", 300), day("2018-06-01", 400)
    ended = F.when(k % 3 == 0, cell("")).otherwise(cell(stop))
    plain = row(cell("Medicine &amp; Health"), cell(" 931152 "), cell(start), ended)
    table = F.concat(F.lit("<h1>Indexes</h1><table><tr><th>name</th><th>code</th><th>from</th><th>to</th></tr>"), plain, plain, row(cell("Dollar"), cell("931152USD200"), cell("2017-01-01"), cell("")), F.when(k % 5 == 0, F.lit("<tr><td>left open<td>931152</td><td>2015-02-03</td></tr>")).otherwise(""), F.when(k % 4 == 0, F.lit("<tr><td>outer<table><tr><td>Inner</td><td>931152</td><td>2016-05-05</td><td>2016-02-01</td></tr></table></td></tr>")).otherwise(""), F.lit("</table>"))

    def report(title, symbols):
        held = F.transform(symbols, lambda s: F.concat(F.lit("<tr><td>"), (s + 1).cast("string"), F.lit("</td><td><a href='#'>"), F.lpad((s + 600000).cast("string"), 6, "0"), F.lit("</a></td><td>Name"), F.when(s % 5 == 3, F.lit("</td><td>1.00%")).otherwise(""), F.lit("</td><td>"), (s % 7 + 1).cast("string"), F.lit(".50%</td></tr>")))
        return F.concat(F.lit(f"<div class='box'><h4>Fund {title}季度 report</h4><table>"), F.array_join(held, ""), F.lit("</table></div>"))

    first = (k % 20).cast("int")
    span = lambda a, b: F.sequence(first + a, first + b)
    boxes = F.concat(report("2020年第2", span(0, 11)), report("2020年3", span(0, 9)), report("2020 年 4", span(2, 13)), F.lit("<h4>Notes</h4><table><tr><td>1</td><td>600999</td></tr></table>"))
    return X.table(spark, sf, "supplier").select(k.alias("page_id"), F.concat(F.lit("<html><body>"), table, boxes, F.lit("</body></html>")).alias("html"))


@query("doc_12_membership_intervals", "", """SELECT s_suppkey AS page_id, '931152' AS code, 'Medicine & Health' AS name, DATE '2018-01-01' + (s_suppkey % 300)::INT AS s, CASE WHEN s_suppkey % 3 <> 0 THEN DATE '2018-06-01' + (s_suppkey % 400)::INT END AS e FROM supplier WHERE s_suppkey % 3 = 0 OR DATE '2018-06-01' + (s_suppkey % 400)::INT > DATE '2018-01-01' + (s_suppkey % 300)::INT
UNION ALL SELECT s_suppkey, '931152', '', DATE '2015-02-03', NULL FROM supplier WHERE s_suppkey % 5 = 0""")
def membership_rows(spark, sf):
    return html_tables.membership_intervals(html_tables.table_cells(membership_pages(spark, sf)), "931152")


HOLDINGS_SQL = """WITH h AS (SELECT s_suppkey AS page_id, s_suppkey % 20 + s AS sym, report_date, q, count(*) OVER (PARTITION BY s_suppkey, report_date) AS n FROM supplier, (VALUES (DATE '2020-06-30', 2, 0, 11), (DATE '2020-09-30', 3, 0, 9), (DATE '2020-12-31', 4, 2, 13)) r(report_date, q, a, b), LATERAL (SELECT unnest(generate_series(a, b)) AS s))"""


@query("doc_12_holdings", "", HOLDINGS_SQL + " SELECT page_id, report_date, (600000 + sym)::VARCHAR AS symbol, CASE WHEN sym % 5 <> 3 THEN round((sym % 7 + 1.5) / 100.0, 6)::DOUBLE END AS weight, q IN (2, 4) AND n >= 11 AS whole FROM h")
def fund_holdings(spark, sf):
    return html_tables.holdings(html_tables.table_cells(membership_pages(spark, sf))).withColumn("weight", F.round("weight", 6))


@query("doc_12_held_intervals", "", HOLDINGS_SQL + """, g AS (SELECT page_id, sym, list_sort(list(q)) AS qs FROM h GROUP BY ALL)
SELECT page_id, (600000 + sym)::VARCHAR AS symbol, CASE WHEN qs[1] = 2 THEN DATE '2020-06-30' ELSE DATE '2020-12-31' END AS s, CASE WHEN list_contains(qs, 4) AND list_contains(qs, 3) OR NOT list_contains(qs, 2) THEN NULL WHEN list_contains(qs, 3) THEN DATE '2020-12-30' ELSE DATE '2020-09-29' END AS e FROM g WHERE NOT (list_contains(qs, 2) AND list_contains(qs, 4) AND NOT list_contains(qs, 3))
UNION ALL SELECT page_id, (600000 + sym)::VARCHAR, unnest([DATE '2020-06-30', DATE '2020-12-31']), unnest([DATE '2020-09-29', NULL]) FROM g WHERE list_contains(qs, 2) AND list_contains(qs, 4) AND NOT list_contains(qs, 3)""")
def held_intervals(spark, sf):
    return html_tables.held_intervals(html_tables.holdings(html_tables.table_cells(membership_pages(spark, sf))))


# --- balance sheets -----------------------------------------------------------------------------------


def sheet_texts(spark, sf):
    """A consolidated balance sheet of each customer, then one of the parent company.

    Three header forms: names, names with a note column, dates; or names on two lines, which gives no places. Rows: both
    amounts, a blank current or prior column, dashes, both blank, a note number, three amounts.
    """
    k = F.col("c_custkey")
    line = lambda *parts: F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts), F.lit("\n"))
    at = lambda *cells: F.concat(*(F.rpad(c if not isinstance(c, str) else F.lit(c), w, " ") for c, w in cells))
    n = lambda x, cents: F.concat(x.cast("string"), F.lit(cents))
    row = lambda label, note, now, then: line(at((label, 24), (note, 10), (now, 30), (then, 20)))
    form = k % 4
    header = F.when(form == 0, row("项目", "", "期末余额", "期初余额")).when(form == 1, row("项目", "附注", "期末余额", "期初余额")).when(form == 2, row("项目", "", "2020年12月31日", "2019年12月31日")).otherwise(F.concat(line("项目 期末余额"), line("期初余额")))
    note = lambda x: F.when(form == 1, x).otherwise("")
    body = F.concat(
        row("货币资金", note("12"), n(k * 2, ".50"), n(k, ".25")), row("交易性金融资产", "", "", n(k, ".00")), row("应收账款", "", n(k + 7, ".00"), ""), row("存货", note("3"), "-", n(k + 1, ".00")), row("商誉", "", "", ""), row("应收票据", "", "1.00 2.00", "3.00"),
        row("其他流动资产", "", F.concat(F.lit("("), n(k, ".75"), F.lit(")")), "-"),
    )
    parent = F.concat(line("母公司资产负债表"), line("单位：元"), row("项目", "", "期末余额", "期初余额"), row("货币资金", "", "777.00", "888.00"))
    return X.dealt(spark, sf, "customer", "c_custkey").select(k.alias("doc_id"), F.concat(line("第十节 财务报告"), line("1、合并资产负债表"), F.when(k % 5 != 3, line("单位：千元")).otherwise(""), header, body, F.when(k % 2 == 0, parent).otherwise("")).alias("text"))


@query("doc_8_sheet_rows", "", """WITH t AS (SELECT c_custkey AS k, c_custkey % 4 AS form FROM customer WHERE c_custkey % 5 <> 3),
r AS (SELECT k, form, unnest([{'fact': 'MONETARY_FUNDS', 'n': 2, 'ck': 'NUMERIC', 'c': k * 2 + 0.5, 'pk': 'NUMERIC', 'p': k + 0.25, 'note': '12'}, {'fact': 'TRADING_FINANCIAL_ASSETS', 'n': 1, 'ck': 'BLANK', 'c': NULL, 'pk': 'NUMERIC', 'p': k, 'note': NULL}, {'fact': 'ACCOUNTS_RECEIVABLE', 'n': 1, 'ck': 'NUMERIC', 'c': k + 7, 'pk': 'BLANK', 'p': NULL, 'note': NULL},
  {'fact': 'INVENTORIES', 'n': 2, 'ck': 'DASH', 'c': NULL, 'pk': 'NUMERIC', 'p': k + 1, 'note': '3'}, {'fact': 'GOODWILL', 'n': 0, 'ck': 'BLANK', 'c': NULL, 'pk': 'BLANK', 'p': NULL, 'note': NULL}, {'fact': 'NOTES_RECEIVABLE', 'n': 3, 'ck': NULL, 'c': NULL, 'pk': NULL, 'p': NULL, 'note': NULL}, {'fact': 'OTHER_CURRENT_ASSETS', 'n': 2, 'ck': 'NUMERIC', 'c': -(k + 0.75), 'pk': 'DASH', 'p': NULL, 'note': NULL}], recursive := true) FROM t),
s AS (SELECT *, CASE WHEN n = 3 THEN 'OWNERSHIP_UNRESOLVED' WHEN form = 3 THEN CASE WHEN n = 2 THEN 'ORDER_PROVEN' ELSE 'OWNERSHIP_UNRESOLVED' END WHEN n = 0 THEN 'POSITION_PROVEN_BLANK_BOTH' ELSE 'POSITION_PROVEN' END AS state FROM r)
SELECT k AS doc_id, fact, state, CASE WHEN form = 1 THEN note END AS note, CASE WHEN state <> 'OWNERSHIP_UNRESOLVED' THEN ck END AS current_kind, CASE WHEN state <> 'OWNERSHIP_UNRESOLVED' THEN round(c * 1000.0, 4)::DOUBLE END AS current_value, CASE WHEN state <> 'OWNERSHIP_UNRESOLVED' THEN pk END AS prior_kind, CASE WHEN state <> 'OWNERSHIP_UNRESOLVED' THEN round(p * 1000.0, 4)::DOUBLE END AS prior_value FROM s""")
def sheet_rows(spark, sf):
    rows = balance_sheets.sheet_rows(sheet_texts(spark, sf)).drop("row_hash")
    return rows.withColumns({"current_value": F.round("current_value", 4), "prior_value": F.round("prior_value", 4)})
