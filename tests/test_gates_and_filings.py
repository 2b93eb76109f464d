"""Reusable gates, joins, filing facts and streams on small fixtures with nulls, ties, repeats and empty tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronolake.functions import scalars as S
from chronolake.operators import combine, documents, gates
from chronolake.sources import injected, readers
from chronolake.streaming import ingest


def rows(df, *names):
    return sorted((tuple(r[n] for n in names or df.columns) for r in df.collect()), key=str)


SUMMARY = """
3.1 近 3 年的主要会计数据和财务指标
单位：元 币种：人民币
总资产 254,364.25 255,168.90 -0.31
营业收入 800.00 106.76 16.87
归属于上市公司股东的净
利润
200.00 52.16 19.55
经营活动产生的现金流量
净额
(36.83) 64.37 -42.68
基本每股收益（元／股） 49.93 41.76 19.55
"""


def test_filing_facts_over_wrapped_labels(spark):
    texts = {
        1: SUMMARY,
        2: "主要会计数据\n单​ 位 ：\n人 民 币\n元 币\u0000种 ： 人 民 币\n营业收入 10 9\n归属于母公司股东的净利润 5 4",
        3: "单 位 ：\n人 民 币\n万 元\n营业收入 10 9",
        4: "营业收入 10 9\n基本每股收益 1.5",
        5: "单位：千元\n基本每股收益 1.5 1.4\n归属于上市公司股东的净资产 7 6 5\n合并资产负债表\n单位：亿元\n归属于母公司所有者权益 2.5 2.0\n归属于母公司所有者权益 9 9 9",
        6: None, 7: "", 8: "单位：元\n营业收入 0 1\n归属于上市公司股东的净利润 3 2",
        9: "单位：元\n" + "注\n" * 30 + "营业收入 10 9",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {}
    for r in documents.standard_facts(df).collect():
        got.setdefault(r["doc_id"], {})[r["fact"]] = r["value"]
    assert got[1] == {"TOTAL_ASSETS": 254364.25, "OPERATING_REVENUE": 800.0, "NET_PROFIT_PARENT": 200.0, "OPERATING_CASH_FLOW_NET": -36.83, "BASIC_EPS": 49.93, "NET_PROFIT_MARGIN": 0.25}
    assert got[2] == {"OPERATING_REVENUE": 10.0, "NET_PROFIT_PARENT": 5.0, "NET_PROFIT_MARGIN": 0.5}
    assert got[3] == {"OPERATING_REVENUE": 100_000.0}
    assert got[5] == {"EQUITY_PARENT": 250_000_000.0}
    assert got[8] == {"OPERATING_REVENUE": 0.0, "NET_PROFIT_PARENT": 3.0}
    assert set(got) == {1, 2, 3, 5, 8}
    assert documents.standard_facts(df.where("false")).count() == 0 and documents.driver_facts(df).count() == 0


def test_driver_facts_need_the_income_statement(spark):
    text = "单位：元\n营业利润 1 1\n合并利润表\n单位：万元\n一、营业利润 3 2\n利润总额说明 见附注\n二、利润总额 (4) 1\n减：所得税费用 0.5 1\n现金流量表\n营业利润 9 9"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert rows(documents.driver_facts(df), "fact", "value") == [("INCOME_TAX_EXPENSE_CN_GAAP", 5000.0), ("OPERATING_PROFIT_CN_GAAP", 30000.0), ("TOTAL_PROFIT_CN_GAAP", -40000.0)]


def test_titles_give_their_known_classes(spark):
    """Golden rows, written down by hand."""
    titles = [("关于2023年年度报告的更正公告", "FINANCIAL_RESTATEMENT"), ("2023年年度报告", "FINANCIAL_REPORT_ANNOUNCEMENT"), ("关于召开股东大会的通知", "MAJOR_EVENT"), (None, "MAJOR_EVENT")]
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(titles)], "k int, t string").select("k", S.title_class(F.col("t")).alias("c"), S.presentation(F.col("t")).alias("p"), S.report_period(F.col("t")).alias("d"))
    got = {r["k"]: r for r in df.collect()}
    assert [got[0]["c"], got[1]["c"]] == [titles[0][1], titles[1][1]] and got[3]["c"] == got[2]["c"]
    assert got[1]["p"] == "FULL_OR_CANONICAL" and str(got[1]["d"]) == "2023-12-31"


def test_gates(spark):
    day = lambda k: dt.date(2024, 1, k)
    members = spark.createDataFrame([(1, day(1), day(3)), (1, day(5), None), (2, None, day(9)), (None, day(2), day(1))], "sym int, s date, e date")
    assert rows(gates.universe_diagnostics(members, "sym", "s", "e")) == [(4, 2, False)]
    assert rows(gates.universe_diagnostics(members.where("sym = 1"), "sym", "s", "e")) == [(2, 1, True)]
    obs = spark.createDataFrame([("a", 1.0, "x"), ("a", None, "y"), ("b", 5.0, "x"), ("b", 5.0, "x")], "k string, v double, tag string")
    assert rows(gates.eligible_coverage(obs, "k", F.col("v") > 2)) == [("a", 2, 0, 0.0), ("b", 2, 2, 1.0)]
    assert rows(gates.merged_snapshots(obs, "k", "tag", "v"), "k", "tags", "v", "n") == [("a", "x,y", 1.0, 2), ("b", "x", 5.0, 2)]
    assert rows(gates.blockers(obs, "k", {"FEW": F.count("*") < 3, "HIGH": F.max("v") > 2, "NULL": F.max("v") > F.lit(None)})) == [("a", "FEW"), ("b", "FEW,HIGH")]
    scope = spark.createDataFrame([("a",), ("c",)], "k string")
    assert rows(gates.entity_readiness(scope, obs, "k", {"x": F.col("tag") == "x"})) == [("a", 2, "READY", 1), ("c", 0, "MISSING", 0)]
    assert rows(gates.interval_evidence(scope, obs, "k")) == [(2, 1, 1, 2)]
    assert rows(gates.orphans(obs, scope, "k", ("LEFT", "RIGHT"))) == [("LEFT", 2), ("RIGHT", 1)]
    assert rows(gates.reference_faults(obs, "tag", {"LOW": F.col("v") < 2}, "TWICE")) == [("x", 1, "LOW"), ("x", 3, "TWICE")]
    assert rows(gates.scheduled(scope, obs, "k", 1)) == [("a", 2, "DUPLICATE"), ("c", 0, "MISSING")]
    assert rows(gates.bundle_quality(obs.withColumn("d", F.lit(day(1))), scope, "k", "d")) == [(day(1), 1, 0.5)]
    none = obs.where("false")
    assert rows(gates.bundle_quality(none.withColumn("d", F.lit(day(1))), scope.where("false"), "k", "d")) == [(None, 0, None)]
    assert gates.blockers(none, "k", {"FEW": F.count("*") < 3}).count() == 0
    cover = spark.createDataFrame([("a", "p", day(1), day(9)), ("a", "q", day(3), day(9)), ("b", "p", day(1), day(9)), ("b", "q", day(1), day(2))], "ent string, src string, s date, e date")
    assert rows(gates.window_complete(cover, "ent", "src", F.lit(day(4)), F.lit(day(8)), ["p", "q"])) == [("a", True), ("b", False)]
    cal = spark.createDataFrame([(day(1), 1), (day(2), 2), (day(4), 3)], "d date, slot int")
    bars = spark.createDataFrame([("a", day(2)), ("b", day(4)), ("c", day(3))], "k string, d date")
    assert rows(gates.publication_lag(bars, "k", "d", cal, (0, 1))) == [("a", day(2), 1, True), ("b", day(4), 0, True), ("c", day(3), None, False)]


def test_combining(spark):
    day = lambda k: dt.date(2024, 1, k)
    left = spark.createDataFrame([(1, "a b"), (2, "b"), (3, None)], "k int, words string")
    assert rows(combine.attach_rail(left, spark.createDataFrame([(1, 9)], "k int, r int"), ["k"]), "k", "r") == [(1, 9), (2, None), (3, None)]
    with pytest.raises(Exception, match="rail has a key twice"):
        combine.attach_rail(left, spark.createDataFrame([(1, 9), (1, 8)], "k int, r int"), ["k"]).collect()
    assert rows(combine.holding(left, "words", spark.createDataFrame([("b",), ("b",), (None,)], "w string"), "w"), "k") == [(1,), (2,)]
    aliases = spark.createDataFrame([(1, 10, day(3)), (1, 11, day(6))], "old int, new int, cut date")
    asked = spark.createDataFrame([(1, day(2)), (1, day(3)), (1, day(7)), (2, day(7))], "k int, d date")
    assert rows(combine.aliased(asked, aliases, "k", "d", "code"), "d", "k", "code") == sorted([(day(2), 1, 1), (day(3), 1, 10), (day(7), 1, 11), (day(7), 2, 2)], key=str)
    assert rows(combine.applicable(left.select("k"), {"all": F.lit(True), "odd": F.col("k") % 2 == 1, "never": F.lit(None).cast("boolean")})) == [(1, "all"), (1, "odd"), (2, "all"), (3, "all"), (3, "odd")]
    assert rows(combine.merged_coverage(left, "k", {"one": left.where("k < 3"), "two": left.where("false")})) == [(1, 1, 0, 1), (2, 1, 0, 1), (3, 0, 0, 0)]
    assert rows(combine.archive_states(left, left.where("k < 3"), "k", left.where("k = 2")), "k", "records", "query_status") == [(1, 1, "COMPLETE"), (2, 0, "FAILED"), (3, 0, "EMPTY")]
    entries = spark.createDataFrame([(1, "ACTIVE"), (2, "RELEASED")], "k int, state string")
    assert rows(combine.without_quarantined(left, entries, ["k"]), "k") == [(2,), (3,)]
    sides = spark.createDataFrame([(1, 0, 2.0), (1, 1, 3.0), (2, 0, 2.0), (3, 0, 1.0), (3, 1, -1.0)], "d int, side int, v double")
    assert rows(combine.both_sides(sides, "d", F.col("side"), "v", ("one", "two"))) == [(1, 5.0, 2.0, 3.0)]
    variants = spark.createDataFrame([(1, "x", 2), (1, "y", 2), (1, "z", None), (2, "w", 0)], "k int, v string, p int")
    assert rows(combine.preferred_variant(variants, ["k"], F.col("p")), "k", "v") == [(1, "x"), (1, "y"), (2, "w")]
    assert rows(combine.evidence_union({"a": left.select("k"), "b": left.where("k = 1")}), "src", "k", "words") == [("a", 1, None), ("a", 2, None), ("a", 3, None), ("b", 1, "a b")]
    ledger = spark.createDataFrame([("e", 9), ("e", 1), ("o", 9), (None, 9)], "c string, v int")
    assert rows(combine.rebuilt(ledger, F.col("c") == "e", F.col("v") > 5, "c", "n")) == sorted([("n", 9), ("o", 9), (None, 9)], key=str)


def test_readers_and_injected(spark):
    shapes = {"f": {"schema": "id string, who string", "record_id": "x.id", "applicant": "x.who"}, "d": {"schema": "acc string", "record_id": "x.acc"}}
    payloads = spark.createDataFrame([("f", '{"id":"1","who":"a"}'), ("f", "{broken"), ("d", '{"acc":"2"}'), ("z", "{}")], "feed string, j string")
    details = spark.createDataFrame([("2", "b")], "record_id string, applicant string")
    assert rows(readers.registry_rows(payloads, "feed", "j", shapes, details)) == sorted([("f", "1", "a"), ("f", None, None), ("d", "2", "b")], key=str)

    def fetch(request):
        return [][1] if request["k"] == 2 else [{"k": request["k"], "page": 1}, {"k": request["k"]}]

    got = injected.fetched(spark.createDataFrame([(1,), (2,)], "k long"), fetch, "k long, page int")
    assert rows(got, "k", "page", "ok") == sorted([(1, 1, True), (1, None, True), (2, None, False)], key=str)
    store = spark.createDataFrame([(1, "t"), (2, ""), (3, "a"), (3, "b")], "k int, text string")
    asked = spark.createDataFrame([(k,) for k in (1, 1, 2, 3, 4)], "k int")
    assert rows(injected.loaded_documents(asked, store, "k", "text"), "k", "state", "n") == [(1, "LOADED", 1), (2, "EMPTY", None), (3, "CONFLICT", None), (4, "MISSING", None)]
    one = spark.range(1)
    yuan, unknown = S.to_yuan(F.lit("1.5"), F.lit("CNY_100M"))
    assert rows(one.select(yuan.cast("string"), unknown)) == [("150000000.00", False)]
    assert rows(one.select(S.enriched(F.lit('{"a":"1"}'), {"a": F.lit("2"), "b": F.lit(3)}), S.enriched(F.lit(None).cast("string"), {"b": F.lit(3)}))) == [('{"b":"3","a":"1"}', '{"b":"3"}')]
    basis = S.availability_basis(F.lit(None).cast("date"), F.lit(dt.date(2024, 1, 2)), F.lit(dt.date(2024, 1, 3)))
    assert rows(one.select(basis.alias("b")).select("b.*")) == [(dt.date(2024, 1, 2), "APPROVAL_DATE", True)]


def test_append_once_for_ever(spark, tmp_path):
    """Batches over restarts: late repeats go, changed rows and rows that disagree in one batch are conflicts."""
    path, out = f"{tmp_path}/land", f"{tmp_path}/out"
    batches = [[(1, "a"), (2, "b"), (2, "b"), (3, "x"), (3, "y")], [(1, "a"), (4, "d")], [(2, "z"), (4, "d"), (None, "n")], [(3, "x")]]
    for batch in batches:
        spark.createDataFrame(batch, "id int, v string").coalesce(1).write.mode("append").parquet(path)
        table, conflicts = ingest.append_once(ingest.landing(spark, path), out, "id")
    assert rows(table) == [(1, "a"), (2, "b"), (3, "x"), (4, "d")]
    assert rows(conflicts) == sorted([(2,), (3,), (None,)], key=str)
    again, _ = ingest.append_once(ingest.landing(spark, path), out, "id")
    assert rows(again) == rows(table)


def test_one_batch_a_file(spark, tmp_path):
    path, out = f"{tmp_path}/land", f"{tmp_path}/out"
    for k in range(5):
        spark.createDataFrame([(j, j * 2) for j in range(k + 1)], "id int, v int").coalesce(1).write.mode("append").parquet(path)
    table, conflicts = ingest.append_once(ingest.landing(spark, path, files=1), out, "id")
    assert rows(table) == [(j, j * 2) for j in range(5)] and conflicts.count() == 0


def test_breadth_of_touched_sessions(spark, tmp_path):
    """Sessions that land in batches have the breadth of one pass over all; a late bar refreshes its own session only."""
    from chronolake.operators import breadth

    day = lambda k: dt.date(2023, 1, 1) + dt.timedelta(days=k)
    all_bars = [(s, day(k), float((k * 7 + s * 3) % 50 + 1)) for s in range(4) for k in range(400)]
    path, out = f"{tmp_path}/land", f"{tmp_path}/out"
    late = (9, day(150), 5.0)
    for batch in ([b for b in all_bars if b[1] < day(300)], [b for b in all_bars if day(300) <= b[1] < day(350)], [b for b in all_bars if b[1] >= day(350)], [late]):
        spark.createDataFrame(batch, "sym int, d date, px double").write.mode("append").parquet(path)
        got = ingest.refreshed_breadth(ingest.landing(spark, path), out)
    whole = spark.createDataFrame([*all_bars, late], "sym int, d date, px double")
    want = breadth.breadth(breadth.flags(breadth.measures(whole)), ["d"])
    assert {r["d"]: r for r in got.collect()} == {r["d"]: r for r in want.select(*got.columns).collect()}
