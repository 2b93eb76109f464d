"""The traps of the point-in-time semantics, on literal rows; fast forms against slow ones."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from chronolake.functions import scalars as S
from chronolake.operators import asof, breadth, calendar, contracts, intervals, ledger, limits, membership, valuation, windows

D = datetime.date


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def values(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_calendar_lag_is_no_row_shift(spark):
    cal = calendar.slots(frame(spark, [(D(2024, 1, k),) for k in range(1, 8)], "d date"))
    rows = frame(spark, [("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 4), 4.0), ("a", D(2024, 1, 6), 6.0)], "sym string, d date, px double")
    out = calendar.calendar_lag(rows, cal, ["sym"], "px", 2, "old")
    assert values(out.where("old is not null"), "d", "old") == [(D(2024, 1, 6), 4.0)]


def test_spine_is_made_where_its_keys_are(spark):
    """Only rows are shuffled, once; a key whose rows are off the calendar, repeated rows and null keys are on the spine as a join has them."""
    day = lambda k: D(2024, 1, k)
    cal = calendar.slots(frame(spark, [(day(k),) for k in (1, 2, 4, 5)], "d date"))
    bars = frame(spark, [("a", day(2), 1), ("a", day(2), 2), ("a", day(5), 3), ("a", day(3), 9), ("b", day(3), 4), ("b", None, 5), (None, day(2), 6), ("c", day(1), None), ("e", day(1), 7), ("e", day(4), 8)], "k string, d date, v int")
    got = calendar.on_spine(bars, cal, ["k"])
    want = bars.select("k").distinct().crossJoin(cal).join(bars, ["k", "d"], "left")
    assert got.columns == want.columns == ["k", "d", "slot", "v"]
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str) and got.where("k = 'a'").count() == 5
    covered = windows.trailing_coverage(got.where("k = 'e'"), ["k"], "v", 2)
    assert [r["coverage"] for r in covered.orderBy("d").collect()] == [None, 0.5, 0.5, 0.5]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = windows.trailing_coverage(calendar.on_spine(bars, cal, ["k"]), ["k"], "v", 2)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(k") == 1 and "SortMergeJoin" not in plan
    assert calendar.on_spine(bars, cal.where("false"), ["k"]).count() == calendar.on_spine(bars.where("false"), cal, ["k"]).count() == 0


def test_publication_availability(spark):
    cal = calendar.slots(frame(spark, [(D(2024, 1, 4),), (D(2024, 1, 5),), (D(2024, 1, 8),)], "d date"))
    rows = frame(spark, [("2024-01-05",), ("2024-01-05 15:00:00",), ("2024-01-05 15:00:01",), ("2024-01-06 09:00:00",), ("2024-01-08 16:00:00",), ("2023-12-31",), (None,)], "p string")
    got = {r["p"]: (r["available"], r["basis"]) for r in calendar.available(rows, "p", cal).collect()}
    assert got["2024-01-05"] == (D(2024, 1, 8), "DATE_ONLY_NEXT_TRADE_DATE")
    assert got["2024-01-05 15:00:00"] == (D(2024, 1, 5), "PRE_OR_AT_CLOSE_TIMESTAMP_SAME_TRADE_DATE")
    assert got["2024-01-05 15:00:01"] == (D(2024, 1, 8), "AFTER_CLOSE_NEXT_TRADE_DATE")
    assert got["2024-01-06 09:00:00"] == (D(2024, 1, 8), "NON_TRADING_DAY_NEXT_TRADE_DATE")
    assert got["2024-01-08 16:00:00"] == (None, "NO_LATER_SESSION")
    assert got["2023-12-31"][0] == D(2024, 1, 4)
    assert got[None][0] is None


def test_symbols_and_boards_keep_their_taxonomies(spark):
    rows = frame(spark, [("300750.0",), (" sz.302001 ",), ("7",), ("x",), ("920001",)], "s string")
    rows = rows.withColumn("n", S.normalize_symbol(F.col("s")))
    got = {r["s"]: r for r in rows.withColumn("b", S.board_of_symbol(F.col("n"))).withColumn("e", S.entity_id(F.col("n"))).withColumn("x", S.board_of_prefixed_code(F.trim("s"))).collect()}
    assert got["300750.0"]["n"] == "300750" and got["7"]["n"] == "000007" and got["x"]["n"] is None
    assert got[" sz.302001 "]["b"] == "chinext" and got[" sz.302001 "]["x"] == "UNKNOWN"
    assert got["920001"]["b"] == "beijing" and got["920001"]["e"] == "920001.SH"


def test_min_periods_and_unknown_flags(spark):
    rows = frame(spark, [("a", D(2024, 1, 1) + datetime.timedelta(days=k), float(k + 1)) for k in range(12)], "sym string, d date, px double")
    out = {r["d"]: r for r in breadth.flags(breadth.measures(rows)).collect()}
    assert out[D(2024, 1, 9)]["ma20"] is None and out[D(2024, 1, 10)]["ma20"] == pytest.approx(5.5)
    assert out[D(2024, 1, 1)]["is_advance"] is None and out[D(2024, 1, 2)]["is_advance"] is True
    total = breadth.breadth(breadth.flags(breadth.measures(rows)), []).first()
    assert (total["securities"], total["is_advance_n"], total["above_ma20_n"], total["above_ma60_ratio"]) == (12, 11, 3, None)


def test_long_windows_are_put_together_from_short_ones(spark):
    """Extremes of 60 and 252 bars with gaps equal a slow pass, and no frame holds 252 rows."""
    rng = random.Random(5)
    px = {s: [None if rng.random() < 0.3 else float(rng.randint(1, 10**6)) for _ in range(400)] for s in range(2)}
    bars = frame(spark, [(s, D(2020, 1, 1) + datetime.timedelta(days=k), v) for s in px for k, v in enumerate(px[s])], "sym int, d date, px double")
    found = breadth.measures(bars)

    def slow(s, k, fn, n, least):
        held = [v for v in px[s][max(0, k - n + 1) : k + 1] if v is not None]
        return fn(held) if len(held) >= least else None

    want = [(s, slow(s, k, min, 60, 30), slow(s, k, max, 252, 100), slow(s, k, len, 20, 10) is None) for s in px for k in range(400)]
    assert [(r["sym"], r["low60"], r["high252"], r["ma20"] is None) for r in found.orderBy("sym", "d").collect()] == want
    assert found.columns == ["sym", "d", "px", "pct", "ma20", "ma60", "low60", "high252"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RowFrame, -59" in plan and "RowFrame, -251" not in plan


def test_reached_bars_are_swept_in_one_sort(spark):
    """Versions, gaps, zeros and numbers that are none, in batches of 7 rows: the measures of windows for the bars a batch reaches."""
    rng, nan = random.Random(9), float("nan")
    day = lambda k: D(2020, 1, 1) + datetime.timedelta(days=k)
    price = lambda: rng.choice([None, nan, 0.0, 7.3, 7.3, *(rng.randint(1, 10**6) / 100 for _ in range(15))])
    bars = [(f"s{s}", day(k), price(), part) for s in range(12) for k in range((1, 2, 40, 300, 700)[s % 5]) for part in (0, 1, 2, 2) if rng.random() < (0.9, 0.01, 0.004, 0.004)[part]]
    bars += [("late", day(k), float(k % 9), 0) for k in range(400)] + [("late", day(10), 99.0, 2)]
    rank = lambda v: (-1, 0) if v is None else (1, 0) if v != v else (0, v)
    kept, hits = {}, {}
    for s, d, v, part in sorted(bars, key=lambda b: (b[3], rank(b[2]))):
        kept[s, d], hits[s, d] = v, part == 2
    want = set()
    for s in {b[0] for b in bars}:
        own = sorted(k for k in kept if k[0] == s)
        want |= {k for n, k in enumerate(own) if any(hits[x] for x in own[max(0, n - 251) : n + 1])}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        found = breadth.reached(frame(spark, bars, "sym string, d date, px double, part int"), 2)
        got = {(r["sym"], r["d"]): r for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    every = breadth.measures(frame(spark, [(*k, v) for k, v in kept.items()], "sym string, d date, px double"))
    assert set(got) == want and found.count() == len(want) and ("late", day(261)) in want and ("late", day(262)) not in want
    assert {k: repr(r) for k, r in got.items()} == {(r["sym"], r["d"]): repr(r) for r in every.collect() if (r["sym"], r["d"]) in want}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("RepartitionByExpression"), plan.count("Sort ["), plan.count("Window")) == (1, 1, 0)


def test_percent_change_of_zero_is_null(spark):
    rows = frame(spark, [("a", D(2024, 1, 1), 0.0), ("a", D(2024, 1, 2), 5.0)], "sym string, d date, px double")
    assert values(rows.select("d", windows.percent_change("px", ["sym"]).alias("p")).where("p is not null"), "p") == []


def test_asof_bounds_and_order_free(spark):
    left = [("k", D(2024, 1, d)) for d in (1, 3, 5)]
    right = [("k", D(2024, 1, 3), 30), ("k", D(2024, 1, 4), 40)]
    a, b = frame(spark, left, "k string, t date"), frame(spark, right, "k string, r date, v int")
    assert values(asof.backward(a, b, ["k"], "t", "r", ["v"]).fillna(-1, ["v"]), "t", "v") == [(D(2024, 1, 1), -1), (D(2024, 1, 3), 30), (D(2024, 1, 5), 40)]
    assert values(asof.backward(a, b, ["k"], "t", "r", ["v"], strict=True).fillna(-1, ["v"]), "v") == [(-1,), (-1,), (40,)]
    assert values(asof.forward(a, b, ["k"], "t", "r", ["v"]).fillna(-1, ["v"]), "t", "v") == [(D(2024, 1, 1), 30), (D(2024, 1, 3), 40), (D(2024, 1, 5), -1)]
    shuffled = asof.backward(a.repartition(3), b.repartition(2), ["k"], "t", "r", ["v"])
    assert values(shuffled.fillna(-1, ["v"]), "t", "v") == values(asof.backward(a, b, ["k"], "t", "r", ["v"]).fillna(-1, ["v"]), "t", "v")


def test_equal_versions_collapse_and_unequal_conflict(spark):
    rows = frame(spark, [("a", 1, 5, "x"), ("a", 1, 5, "y"), ("b", 1, 5, "x"), ("b", 1, 6, "y"), ("b", 0, 9, "z")], "k string, av int, v int, ver string")
    got = {r["k"]: (r["v"], r["conflict"], r["ties"]) for r in asof.chosen_versions(rows, ["k"], ["av"], "v", "ver").collect()}
    assert got == {"a": (5, False, 2), "b": (None, True, 2)}


def slow_membership(anchor, events, lo, hi):
    held, out, day = set(anchor), [], hi
    while day >= lo:
        out += [(s, day) for s in held]
        for ed, s, side in events:
            if ed == day:
                held = held - {s} if side == "in" else held | {s}
        day -= datetime.timedelta(days=1)
    return sorted(out)


def test_reconstruction_against_a_walk_backwards(spark):
    rng = random.Random(3)
    lo, hi = D(2024, 1, 1), D(2024, 2, 20)
    for _ in range(3):
        events = []
        start = {s for s in "abcdef" if rng.random() < 0.5}
        now = set(start)
        for k in range(1, 50):
            if rng.random() < 0.4:
                s = rng.choice("abcdef")
                events.append((lo + datetime.timedelta(days=k), s, "out" if s in now else "in"))
                now ^= {s}
        anchor = frame(spark, [(s,) for s in sorted(now)] or [("none",)], "sym string")
        out = membership.reconstruct(anchor, frame(spark, events, "ed date, sym string, side string"), F.lit(lo), F.lit(hi))
        days = out.select("sym", F.explode(F.sequence("s", "e")).alias("d")).where("sym <> 'none'")
        assert values(days, "sym", "d") == slow_membership(now, events, lo, hi)
        assert membership.inconsistent(anchor, frame(spark, events, "ed date, sym string, side string"), F.lit(lo)).where("sym <> 'none'").count() == 0


def test_inconsistent_ledgers_are_reported(spark):
    events = frame(spark, [(D(2024, 1, 2), "a", "in"), (D(2024, 1, 3), "a", "in"), (D(2024, 1, 4), "b", "out")], "ed date, sym string, side string")
    anchor = frame(spark, [("a",), ("b",)], "sym string")
    assert values(membership.inconsistent(anchor, events, F.lit(D(2024, 1, 1))), "sym", "problem") == [("a", "SIDES_DO_NOT_ALTERNATE"), ("b", "ANCHOR_DISAGREES")]


def test_intervals_touching_and_open(spark):
    rows = frame(spark, [("a", D(2024, 1, 1), D(2024, 1, 5)), ("a", D(2024, 1, 6), None), ("b", D(2024, 1, 1), D(2024, 1, 2)), ("b", D(2024, 1, 4), D(2024, 1, 9))], "sym string, s date, e date")
    assert values(intervals.compact(rows), "sym", "s", "e") == [("a", D(2024, 1, 1), D(9999, 12, 31)), ("b", D(2024, 1, 1), D(2024, 1, 2)), ("b", D(2024, 1, 4), D(2024, 1, 9))]
    assert values(intervals.overlaps(rows, touching=False), "sym") == [] and values(intervals.overlaps(rows), "sym") == [("a",)]


def test_ledger_append_is_idempotent(spark):
    old = frame(spark, [("1", "a", None), ("2", "b", "x")], "id string, v string, w string")
    new = frame(spark, [("1", "a", None), ("2", "b", "y"), ("3", "c", None)], "id string, v string, w string")
    assert values(ledger.merge_append(old, new, "id"), "id", "outcome") == [("1", "SAME"), ("2", "CONFLICT"), ("3", "INSERT")]


def test_strict_contract_raises_when_the_column_is_kept(spark):
    rows = frame(spark, [(1,), (-1,)], "x int")
    assert contracts.violations(rows, {"NEGATIVE": F.col("x") < 0}).count() == 1
    with pytest.raises(Exception, match="NEGATIVE"):
        contracts.strict(rows, {"NEGATIVE": F.col("x") < 0}, "x").collect()
    with pytest.raises(ValueError, match="missing columns"):
        contracts.require_columns(rows, ["y"])


def test_truncated_listing_window_is_unknown(spark):
    days = [D(2021, 3, 1) + datetime.timedelta(days=k) for k in range(8)]
    daily = frame(spark, [(d, c, "STAR", True) for c in ("full", "cut") for d in days], "d date, code string, board string, trading boolean")
    life = frame(spark, [("full", days[0], None), ("cut", D(2021, 2, 27), None)], "code string, listed date, delisted date")
    got = limits.special_days(daily, life).groupBy("code", "special_day_status").count()
    assert values(got, "code", "special_day_status", "count") == [("cut", "unknown", 8), ("full", "no_limit", 5), ("full", "ordinary", 3)]


def test_trailing_value_needs_all_parts(spark):
    rows = [("e", D(2022, 12, 31), D(2023, 4, 1), 100), ("e", D(2022, 3, 31), D(2022, 4, 20), 20), ("e", D(2023, 3, 31), D(2023, 4, 20), 30), ("f", D(2023, 3, 31), D(2023, 4, 20), 30)]
    out = valuation.trailing_value(frame(spark, rows, "ent string, pe date, av date, val int"), "ent", "pe", "av", "val")
    got = {(r["ent"], r["av"]): r["ttm"] for r in out.collect()}
    assert got == {("e", D(2022, 4, 20)): None, ("e", D(2023, 4, 1)): 100, ("e", D(2023, 4, 20)): 110, ("f", D(2023, 4, 20)): None}


def test_trailing_values_of_fact_types_do_not_mix(spark):
    rows = [("e", k, p, a, v * x) for k, x in (("sales", 1), ("profit", 10)) for p, a, v in ((D(2022, 12, 31), D(2023, 4, 1), 100), (D(2022, 3, 31), D(2022, 4, 20), 20), (D(2023, 3, 31), D(2023, 4, 20), 30))]
    out = valuation.trailing_value(frame(spark, rows, "ent string, ft string, pe date, av date, val int"), ["ent", "ft"], "pe", "av", "val")
    assert values(out.where("av = date'2023-04-20'"), "ft", "ttm") == [("profit", 1100), ("sales", 110)]


def test_filing_facts_need_a_unit_and_keep_shares(spark):
    text = "合并利润表\n单 位：人民币\n万元\n营业收入\n本期 1,234.5 900\n基本每股收益 0.25\n归属于上市公司股东的净利润 (说明) 7"
    rows = frame(spark, [(1, text), (2, "营业收入 5"), (3, None), (4, "")], "doc_id long, text string")
    from chronolake.operators import documents

    assert values(documents.standard_facts(rows), "doc_id", "fact", "value") == [(1, "NET_PROFIT_MARGIN", 70000.0 / 12345000.0), (1, "NET_PROFIT_PARENT", 70000.0), (1, "OPERATING_REVENUE", 12345000.0)]
    # a value per share is proven by 元/股 at its label or by the unit 元, never by another unit
    shares = frame(spark, [(1, "单位：万元\n基本每股收益(元/股) 0.25"), (2, "单位：元\n基本每股收益 0.25"), (3, "单位：万元\n基本每股收益 0.25")], "doc_id long, text string")
    assert values(documents.standard_facts(shares), "doc_id", "fact", "value") == [(1, "BASIC_EPS", 0.25), (2, "BASIC_EPS", 0.25)]


def test_report_titles(spark):
    rows = frame(spark, [("2023年年度报告（更新后）",), ("2023年第一季度报告正文",), ("关于2023年年度报告的公告",), ("2023年半年度报告摘要",)], "t string")
    t = F.col("t")
    got = {r["t"]: r for r in rows.select("t", S.report_period(t).alias("p"), S.is_numeric_report(t).alias("n"), S.title_family(t).alias("f"), S.variant_priority(t).alias("v"), S.revision_priority(t).alias("r"), S.presentation(t).alias("c")).collect()}
    a, b, c, d = got.values()
    assert (a["p"], a["n"], a["v"], a["r"], a["c"]) == (D(2023, 12, 31), True, 1, 1, "FULL_OR_CANONICAL")
    assert (b["p"], b["n"], b["f"], b["v"], b["c"]) == (D(2023, 3, 31), True, "2023年第一季度报告", 0, "BODY")
    assert (c["n"], d["n"], d["c"]) == (False, False, "SUMMARY")


def test_empty_tables(spark):
    none = frame(spark, [], "sym string, d date, px double")
    assert breadth.breadth(breadth.flags(breadth.measures(none)), ["d"]).count() == 0
    assert intervals.compact(frame(spark, [], "sym string, s date, e date")).count() == 0
    assert calendar.dense_days(calendar.slots(none)).count() == 0
