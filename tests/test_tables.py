"""Tables in filing texts and in HTML."""

import datetime as dt

from chronolake.operators import html_tables, nonrecurring


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) if columns else tuple(r) for r in df.collect()), key=str)


HEAD = "非经常性损益项目和金额\n单位：万元\n"
END = "对公司将《公开发行证券的公司信息披露解释性公告第1号》\n"


def test_nonrecurring_tables(spark):
    texts = {
        1: HEAD + "债务重组损益 1.50\n非货币性资产交换损益\n 9\n合计 (2)\n",
        2: HEAD + "债务重组损益 1\n合计 2\n" + END + HEAD + "债务重组损益 1\n合计 3\n",
        3: HEAD + "债务重组损益 1\n合计 2\n" + END + HEAD + "债务重组损益 1\n合计 2\n",
        4: HEAD + "债务重组损益 1\n债务重组损益 1\n合计 2\n",
        5: HEAD + "债务重组损益\n债务重组损益 4\n合计 2\n",
        6: "非经常性损益项目和金额\n债务重组损益 1\n合计 2\n",
        7: HEAD + "债务重组损益 1\n" + "x\n" * 150 + "合计 2\n",
        8: HEAD + "其他符合非经常性损益定义的损益项目 3\n合计 2\n其他符合非经常性损益定义的损益项目的具体情况\n债务重组损益 1\n",
        9: HEAD + "非货币性资产交换损益 2\n减：所得税影响额 1\n所得税影响额 4\n合计 2\n",
        10: None, 11: "", 13: HEAD + "债务重组损益 1\n合计 2\n" + HEAD + "债务重组损益 3\n合计 4\n", 12: "x\n" * 135 + HEAD + "债务重组损益 1\n" + "y\n" * 20 + "合计 5\n",
    }
    facts, states = nonrecurring.nonrecurring_facts(spark.createDataFrame(list(texts.items()), "doc_id int, text string"))
    assert rows(states, "doc_id", "state") == sorted([(1, "PARSED"), (2, "CONFLICT"), (3, "PARSED"), (4, "NO_TABLE"), (5, "PARSED"), (6, "NO_TABLE"), (7, "NO_TABLE"), (8, "PARSED"), (9, "NO_TABLE"), (10, "NO_TABLE"), (11, "NO_TABLE"), (12, "PARSED"), (13, "PARSED")], key=str)
    got = {(r["doc_id"], r["fact"].removeprefix("NR_")): r["value"] for r in facts.collect()}
    assert got == {
        (1, "DEBT_RESTRUCTURING"): 15_000.0, (1, "NONMONETARY_ASSET_EXCHANGE"): 90_000.0, (1, "REPORTED_NET_TOTAL"): -20_000.0, (3, "DEBT_RESTRUCTURING"): 10_000.0, (3, "REPORTED_NET_TOTAL"): 20_000.0,
        (5, "DEBT_RESTRUCTURING"): 40_000.0, (5, "REPORTED_NET_TOTAL"): 20_000.0, (8, "OTHER_DEFINED_ITEM"): 30_000.0, (8, "REPORTED_NET_TOTAL"): 20_000.0, (12, "DEBT_RESTRUCTURING"): 10_000.0, (12, "REPORTED_NET_TOTAL"): 50_000.0, (13, "DEBT_RESTRUCTURING"): 30_000.0, (13, "REPORTED_NET_TOTAL"): 40_000.0,
    }


def test_longest_prefix(spark):
    labels = spark.createDataFrame([("ab", "short"), ("abc", "long"), ("abd", "a"), ("abd", "b"), ("x", "one")], "label string, fact string")
    got = nonrecurring.prefix_matches(spark.createDataFrame([("abcz",), ("abz",), ("abd",), ("x",), ("",), (None,), ("b",)], "t string"), "t", labels, "fact")
    assert rows(got, "t", "fact") == sorted([("abcz", "long"), ("abz", "short"), ("abd", "b"), ("x", "one"), ("", None), (None, None), ("b", None)], key=str)


def test_prefixes_of_rows_in_chance_order(spark):
    """A number dealt out twice to rows that come in another order gave a row the label of another one."""
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(str(k), f"f{k}") for k in range(10, 60)], "label string, fact string")
    # without its wide column the exchange has fewer parts
    wide = F.concat(*(F.sha2((F.col("id") * k).cast("string"), 256) for k in range(1, 21))).alias("wide")
    texts = spark.range(20_000).select(F.concat((F.col("id") % 60).cast("string"), F.lit("-")).alias("t"), "id", wide).repartition("id")
    got = nonrecurring.prefix_matches(texts, "t", labels, "fact").groupBy("t", "fact").agg(F.max("wide")).collect()
    assert {(r["t"], r["fact"]) for r in got} == {(f"{k}-", f"f{k}" if k >= 10 else None) for k in range(60)}


def test_cells_of_broken_tables(spark):
    pages = {
        1: "<tr><td>a</td><td>b &amp; c<br> d</td></tr>",
        2: "<tr><td>open<td>closed</td><td>never</tr><tr><td>next</td></tr>",
        3: "<tr><td>lost</td><tr><th>kept</th></tr><td>outside</td>",
        4: "<tr><td>outer <table><tr><td>in</td></tr></table> rest</td></tr>",
        5: "<h4>One</h4><tr><td>1</td></tr><h4>Two <b>x</b></h4><!-- <tr><td>no</td></tr> --><tr><td></td><td>2</td></tr>",
        6: None, 7: "", 8: "<tr></tr>",
    }
    got = html_tables.table_cells(spark.createDataFrame(list(pages.items()), "page_id int, html string"))
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r["page_id"], r["row"], r["cell"])):
        found.setdefault(r["page_id"], []).append((r["row"], r["heading"], r["text"]))
    assert found == {
        1: [(1, None, "a"), (1, None, "b & c d")], 2: [(1, None, "closed"), (2, None, "next")], 3: [(2, None, "kept")], 4: [(2, None, "in")],
        5: [(1, "One", "1"), (2, "Two x", ""), (2, "Two x", "2")],
    }


def test_intervals_weights_and_runs(spark):
    row = lambda *cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    page = row("N", "C1", "2020-01-01", "2020-02-01") + row("C1", "2021-01-01") + row("N", "C10", "2020-01-01") + row("N", "C1", "2020-13-01") + row("N", "C1", "2020-03-01", "2020-03-01") + row("N", "C1", "2020-05-01", "x", "2020-13-40") + row("M", "C1", "2020-01-01", "2020-02-01")
    d = dt.date
    got = html_tables.membership_intervals(html_tables.table_cells(spark.createDataFrame([(1, page)], "page_id int, html string")), "C1")
    assert rows(got, "name", "s", "e") == sorted([("M", d(2020, 1, 1), d(2020, 2, 1)), ("", d(2021, 1, 1), None)], key=str)
    page = "<h4>2021年第1季度</h4>" + row("600001", "5%") + row("600002", "5%", "6%") + row("600003", "101%") + row("600004", "2%") + row("600004", "2%") + row("a", "b", "c", "d", "600009", "1%") + "<h4>2021年3季度</h4>" + row("600001", "7.5 %") + row("1234567", "1%")
    sets = html_tables.holdings(html_tables.table_cells(spark.createDataFrame([(1, page)], "page_id int, html string")))
    assert rows(sets, "report_date", "symbol", "weight", "whole") == sorted([(d(2021, 3, 31), "600001", 0.05, False), (d(2021, 3, 31), "600002", None, False), (d(2021, 3, 31), "600003", None, False), (d(2021, 3, 31), "600004", None, False), (d(2021, 9, 30), "600001", 0.075, False)], key=str)
    dated = spark.createDataFrame([(1, d(2020, m, 1), s) for m, held in ((1, "ab"), (2, "a"), (3, "b"), (4, "ab")) for s in held], "page_id int, report_date date, symbol string")
    assert rows(html_tables.held_intervals(dated), "symbol", "s", "e") == sorted([("a", d(2020, 1, 1), d(2020, 2, 29)), ("a", d(2020, 4, 1), None), ("b", d(2020, 1, 1), d(2020, 1, 31)), ("b", d(2020, 3, 1), None)], key=str)


def test_registry_rows_end_in_one_state(spark):
    """Every row has a state; conflicting contents of one id are never chosen from; members count on the day itself."""
    from pyspark.sql import functions as F

    from chronolake.operators import registry_snapshot

    d = dt.date
    p, f = "PUBLICATION_DATE_EXPLICIT", "FIRST_OBSERVED_SNAPSHOT_DATE"
    data = [
        (1, "A", "x", p, "7", "n1", d(2020, 1, 5), None, None), (2, "A", "x", p, "7", "n1", d(2020, 1, 5), None, None), (3, "A", "x", p, "8", "n1", d(2020, 1, 5), None, None), (4, "A", "x", p, "8", "n2", d(2020, 1, 5), None, None),
        (5, "A", "y", p, "9", "n1", d(2020, 1, 5), None, None), (6, "Z", "x", p, "9", "n1", d(2020, 1, 5), None, None), (7, "A", "x", f, "10", "n1", None, None, d(2020, 1, 9)), (8, "A", "x", p, "11", "n1", None, None, None),
        (9, "B", "x", f, "", "n1；n2", None, None, d(2020, 1, 9)), (10, "B", "x", f, None, "n1；n2", None, None, d(2020, 1, 9)), (11, "B", "x", f, "3", "n1", None, None, d(2020, 1, 8)), (12, "A", "x", p, "12", "who", d(2020, 1, 5), None, None), (13, "A", "x", p, "13", "n1", d(2020, 1, 11), None, None),
        (14, None, None, None, None, None, None, None, None),
    ]
    rows_ = spark.createDataFrame(data, "row int, source string, category string, basis string, own_id string, applicant string, published date, approved date, captured date")
    catalog = spark.createDataFrame([("A", ["x"], p), ("B", ["x"], f)], "source string, categories array<string>, basis string")
    names = spark.createDataFrame([("n1", 1), ("n2", 2)], "name string, ent int")
    members = spark.createDataFrame([(1, d(2020, 1, 1), d(2020, 1, 10)), (2, d(2021, 1, 1), None)], "ent int, s date, e date")
    lineage, events = registry_snapshot.materialised(rows_, catalog, names, members, F.lit("2020-01-09").cast("date"))
    got = {r["row"]: (r["state"], r["reason"]) for r in lineage.collect()}
    assert got == {
        1: ("EVENT", None), 2: ("REPEAT", None), 3: ("CONFLICT", None), 4: ("CONFLICT", None), 5: ("INVALID", "CATEGORY_NOT_OF_SOURCE"), 6: ("INVALID", "SOURCE_UNKNOWN"), 7: ("INVALID", "BASIS_NOT_OF_SOURCE"), 8: ("INVALID", "DATE_MISSING"),
        9: ("EVENT", None), 10: ("REPEAT", None), 11: ("INVALID", "CAPTURED_ANOTHER_DAY"), 12: ("UNMAPPED", None), 13: ("EXCLUDED", "NOT_A_MEMBER_WHEN_AVAILABLE"), 14: ("INVALID", "SOURCE_UNKNOWN,DATE_MISSING"),
    }
    assert rows(events, "ent", "category", "available", "availability_state") == [(1, "x", d(2020, 1, 5), "HISTORICAL_RECONSTRUCTABLE"), (1, "x", d(2020, 1, 9), "PROSPECTIVE_FIRST_OBSERVED_ONLY")]
    s = registry_snapshot.summary(lineage, events).first()
    assert s["input_rows"] == sum(s[k.lower()] for k in registry_snapshot.STATES) == 14 and s["events"] == 2


def test_places_prove_columns(spark):
    from chronolake.operators import balance_sheets as B

    def text(header, *lines, title="合并资产负债表", unit="单位：万元"):
        return "\n".join(["第一节", title, unit, header, *lines, "合并利润表", "货币资金      9.00   8.00"])

    plain = "项目              期末余额            期初余额"
    noted = "项目      附注      期末余额            期初余额"
    texts = {
        1: text(plain, "货币资金          1.00                2.00", "其中：应收账款                        3.00", "非流动资产合计    -                   －", "流动资产合计      (4.00)"),
        2: text(noted, "货币资金  七      1.00                2.00", "存货      5       1.00", "商誉      12345   1.00                2.00"),
        3: text("项目 期末余额\n附注\n期初余额", "货币资金 7 1.00 2.00", "存货 1,000.00 2.00", "商誉 7 1.00", "固定资产 1 2 3 4"),
        4: text("项目        2020 年 12 月 31 日    2019 年 12 月 31 日", "货币资金    1.00", "存货                               2.00"),
        5: text("项目", "货币资金 1.00 2.00"), 6: text(plain, "货币资金          1.00                2.00", unit="币种"), 7: text(plain, "货币资金          1.00                2.00", title="母公司资产负债表"),
        8: text("项目              期初余额            期末余额", "货币资金          1.00                2.00"), 9: text(plain, "货币资金          1.00   5.00         2.00"), 10: None, 11: "",
    }
    got = {(r["doc_id"], r["fact"]): (r["state"], r["note"], r["current_kind"], r["current_value"], r["prior_kind"], r["prior_value"]) for r in B.sheet_rows(spark.createDataFrame(list(texts.items()), "doc_id int, text string")).collect()}
    assert len(B.LABELS) == 51
    assert got == {
        (1, "MONETARY_FUNDS"): (B.BY_PLACE, None, "NUMERIC", 10_000.0, "NUMERIC", 20_000.0), (1, "ACCOUNTS_RECEIVABLE"): (B.BY_PLACE, None, "BLANK", None, "NUMERIC", 30_000.0),
        (1, "TOTAL_NON_CURRENT_ASSETS"): (B.BY_PLACE, None, "DASH", None, "DASH", None), (1, "TOTAL_CURRENT_ASSETS"): (B.BY_PLACE, None, "NUMERIC", -40_000.0, "BLANK", None),
        (2, "MONETARY_FUNDS"): (B.BY_PLACE, None, "NUMERIC", 10_000.0, "NUMERIC", 20_000.0), (2, "INVENTORIES"): (B.BY_PLACE, "5", "NUMERIC", 10_000.0, "BLANK", None), (2, "GOODWILL"): (B.OPEN, None, None, None, None, None),
        (3, "MONETARY_FUNDS"): (B.WITH_NOTE, "7", "NUMERIC", 10_000.0, "NUMERIC", 20_000.0), (3, "INVENTORIES"): (B.NOTE_BLANK, None, "NUMERIC", 10_000_000.0, "NUMERIC", 20_000.0), (3, "GOODWILL"): (B.OPEN, None, None, None, None, None), (3, "FIXED_ASSETS"): (B.OPEN, None, None, None, None, None),
        (4, "MONETARY_FUNDS"): (B.BY_PLACE, None, "NUMERIC", 10_000.0, "BLANK", None), (4, "INVENTORIES"): (B.BY_PLACE, None, "BLANK", None, "NUMERIC", 20_000.0),
        (5, "MONETARY_FUNDS"): (B.NO_HEADER, None, None, None, None, None), (8, "MONETARY_FUNDS"): (B.BY_ORDER, None, "NUMERIC", 10_000.0, "NUMERIC", 20_000.0), (9, "MONETARY_FUNDS"): (B.OPEN, None, None, None, None, None),
    }


def test_tokens_of_pages_are_never_broadcast(spark):
    """A page makes hundreds of tokens, which its file's size does not show: no join may send them to every task."""
    page = "<h4>2021年第2季度</h4><tr><td>600001</td><td>5%</td></tr>"
    sets = html_tables.holdings(html_tables.table_cells(spark.createDataFrame([(1, page), (None, page)], "page_id int, html string")))
    for df in (sets, html_tables.held_intervals(sets)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(sets, "page_id", "symbol") == [(1, "600001")]
