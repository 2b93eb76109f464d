"""Fingerprints and their tree, breadth under late bars, keyed state, publishing gates, and the derived ledger."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from chronolake.functions import fingerprint
from chronolake.operators import assembly, breadth, gates, ledger
from chronolake.sources import publish, readers
from chronolake.streaming import ingest, stateful


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) if columns else tuple(r) for r in df.collect()), key=str)


# fingerprints


def test_fingerprints_see_repeated_rows(spark):
    one = lambda values: tuple(fingerprint.content(spark.createDataFrame([(v,) for v in values], "v int")).first())
    assert one([1, 1]) != one([2, 2])
    assert one([1, 1, 2]) != one([1, 2, 2])
    assert one([3, 1, 2]) == one([1, 2, 3])
    assert one([]) == (0, 0, 0)
    two = lambda *values: tuple(fingerprint.content(spark.createDataFrame(list(values), "a string, b string")).first())
    assert len({two((None, "x")), two(("x", None)), two(("", "x")), two(("x", "")), two(("\x00", "x"))}) == 5


def test_fingerprints_merge(spark):
    df = spark.createDataFrame([(k % 7, k % 3, k // 2) for k in range(500)], "a int, b int, v int").repartition(5)
    fine = fingerprint.content(df, ["a", "b"], ["a", "b", "v"])
    assert rows(fingerprint.merged(fine, ["a"])) == rows(fingerprint.content(df, ["a"], ["a", "b", "v"]))
    assert rows(fingerprint.merged(fine)) == rows(fingerprint.content(df))


def test_changed_rows_are_found_by_descending(spark):
    day = lambda k: dt.date(2024, 1, 1 + k)
    base = [(day(k % 5), f"e{k % 4}", f"id{k}", k) for k in range(200)] + [(None, None, "odd", 1)]
    later = [r for r in base if r[2] not in ("id7", "odd")] + [base[11], (day(3), "e9", "new", 0)]
    later = [(*r[:3], -1) if r[2] == "id20" else r for r in later]
    schema = "d date, ent string, id string, v int"
    a, b = spark.createDataFrame(base, schema), spark.createDataFrame(later, schema)
    want = [("CHANGED", "id11", 1, 2), ("CHANGED", "id20", 1, 1), ("ADDED", "new", None, 1), ("REMOVED", "id7", 1, None), ("REMOVED", "odd", 1, None)]
    assert rows(fingerprint.changed_rows(a, b, ["d", "ent"], "id"), "change", "id", "n1", "n2") == sorted(want, key=str)
    known = fingerprint.content(a, ["d"])
    assert rows(fingerprint.changed_rows(a, b, ["d", "ent"], "id", known), "change", "id", "n1", "n2") == sorted(want, key=str)
    assert fingerprint.changed_rows(a, a, ["d", "ent"], "id").count() == 0


def test_replay_of_a_prefix_sees_pairs(spark):
    schema = ", ".join(f"{c} string" for c in ledger.REQUIRED if not c.endswith("_date")) + ", event_date date, available_date date"
    row = lambda i: (*[f"{c}{i}" for c in ledger.REQUIRED if not c.endswith("_date")], dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    a, b = (spark.createDataFrame([row(i), row(i)], schema) for i in (1, 2))
    assert ledger.changed_days(a, b, F.lit("2024-01-05").cast("date")).count() == 1
    assert rows(ledger.changed_records(a, b, F.lit("2024-01-05").cast("date")), "evidence_id", "change") == [("evidence_id1", "REMOVED"), ("evidence_id2", "ADDED")]
    assert ledger.changed_days(a, b, F.lit("2024-01-01").cast("date")).count() == 0


def test_broken_ids_without_gathering(spark):
    schema = ", ".join(f"{c} string" for c in ledger.REQUIRED if not c.endswith("_date")) + ", event_date date, available_date date"
    names = [c for c in ledger.REQUIRED if not c.endswith("_date")]
    row = lambda i, **k: (*[k.get(c, "AVAILABLE" if c == "availability_state" else f"{c}{i}") for c in names], dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    df = spark.createDataFrame([row(1), row(2, ingestion_id=None), row(3, ingestion_id=None), row(4, ingestion_id="x"), row(5, ingestion_id="x"), row(6), row(6)], schema)
    got = dict(rows(ledger.invalid_records(df), "evidence_id", "broken"))
    assert got == {"evidence_id2": "ingestion_id_EMPTY,ingestion_id_TWICE", "evidence_id3": "ingestion_id_EMPTY,ingestion_id_TWICE", "evidence_id4": "ingestion_id_TWICE", "evidence_id5": "ingestion_id_TWICE", "evidence_id6": "evidence_id_TWICE,ingestion_id_TWICE"}


# breadth


def test_breadth_after_late_corrected_and_missing_bars(spark, tmp_path):
    """A late bar of a symbol that has later bars changes their windows too: all sessions equal one pass."""
    rng = random.Random(2)
    day = lambda k: dt.date(2022, 1, 1) + dt.timedelta(days=k)
    bars = {(s, k): float(rng.randint(1, 60)) for s in range(3) for k in range(330) if rng.random() > 0.1}
    late = [(0, 20), (1, 150)]
    for key in late:
        bars[key] = 59.0
    first = {k: v for k, v in bars.items() if k not in late and k[1] < 300}
    first[2, 40] = 7.0
    bars[2, 40] = 33.0
    batches = [first, {k: v for k, v in bars.items() if k[1] >= 300}, {k: bars[k] for k in late}, {(2, 40): 33.0}, {}]
    path, out = f"{tmp_path}/land", f"{tmp_path}/out"
    for batch in batches:
        spark.createDataFrame([(s, day(k), v) for (s, k), v in batch.items()] + [(None, day(1), 1.0)], "sym int, d date, px double").write.mode("append").parquet(path)
        got = ingest.refreshed_breadth(ingest.landing(spark, path), out)
    want = breadth.breadth(breadth.flags(breadth.measures(spark.createDataFrame([(s, day(k), v) for (s, k), v in bars.items()], "sym int, d date, px double"))), ["d"])
    assert {r["d"]: r for r in got.collect()} == {r["d"]: r for r in want.select(*got.columns).collect()}


def test_breadth_is_kept_in_few_files(spark, tmp_path):
    """A bucket of a batch is one file, however many tasks read it, and flags are stored without the measures; a bar that comes again counts once."""
    path, out = f"{tmp_path}/land", f"{tmp_path}/out"
    day = lambda k: dt.date(2023, 1, 1) + dt.timedelta(days=k)
    bars = [(s, day(k), float((k * 7 + s * 3) % 50 + 1)) for k in range(40) for s in range(30)]
    for batch in (bars, bars[:60] + [(1, day(5), 99.0)]):
        spark.createDataFrame(batch, "sym int, d date, px double").repartition(8).write.mode("append").parquet(path)
        got = ingest.refreshed_breadth(ingest.landing(spark, path), out)
    last = [b for b in bars if b[:2] != (1, day(5))] + [(1, day(5), 99.0)]
    want = breadth.breadth(breadth.flags(breadth.measures(spark.createDataFrame(last, "sym int, d date, px double"))), ["d"])
    assert {r["d"]: r for r in got.collect()} == {r["d"]: r for r in want.select(*got.columns).collect()}
    first = tmp_path / "out" / "bars" / "part=0"
    assert len(list(first.glob("*/*.parquet"))) == len(list(first.glob("bucket=*")))
    assert set(spark.read.parquet(f"{out}/flags/part=0").columns) == {"sym", "d", "month", *breadth.USED}


def test_breadth_of_many_symbols(spark, tmp_path, monkeypatch):
    """A batch of too many symbols to send to all tasks leaves those it does not reach as they were."""
    monkeypatch.setattr(ingest, "FEW", 1)
    path, out = f"{tmp_path}/land", f"{tmp_path}/out"
    day = lambda k: dt.date(2023, 1, 1) + dt.timedelta(days=k)
    bars = [(s, day(k), float((k * 7 + s * 3) % 50 + 1)) for k in range(40) for s in range(200)]
    late = [(s, day(20), 99.0) for s in (3, 4, 5)]
    for batch in ([b for b in bars if b[:2] not in {x[:2] for x in late}], late):
        spark.createDataFrame(batch, "sym int, d date, px double").write.mode("append").parquet(path)
        got = ingest.refreshed_breadth(ingest.landing(spark, path), out)
    last = [b for b in bars if b[:2] not in {x[:2] for x in late}] + late
    want = breadth.breadth(breadth.flags(breadth.measures(spark.createDataFrame(last, "sym int, d date, px double"))), ["d"])
    assert {r["d"]: r for r in got.collect()} == {r["d"]: r for r in want.select(*got.columns).collect()}
    assert {(r["sym"], r["d"]) for r in spark.read.parquet(f"{out}/flags/part=1").collect()} == {(s, day(k)) for s in (3, 4, 5) for k in range(20, 40)}


# state


def landed(spark, path, batch, schema):
    spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    return ingest.landing(spark, path, "t")


def test_first_complete_attempt_is_final(spark, tmp_path):
    at = lambda d, h: dt.datetime(2024, 3, d, h)
    batches = [
        [("a", at(1, 9), False), ("a", at(1, 11), True), ("a", at(1, 12), True), ("b", at(1, 9), False)],
        [("a", at(1, 8), True), ("b", at(1, 13), True), ("b", at(1, 14), False), ("c", at(1, 9), False), (None, at(1, 9), True)],
        [("a", at(5, 9), True)],
        [("c", at(1, 20), True), ("d", at(6, 9), None)],
        [("a", at(20, 9), True)],
        [("a", at(21, 9), False)],
    ]
    path, out, got = f"{tmp_path}/land", f"{tmp_path}/out", None
    for batch in batches:
        stream = landed(spark, path, batch, "src string, t timestamp, ok boolean")
        got = ingest.drain(stateful.first_observations(stream, "src", "t", F.col("ok")), out)
    found = {(r["source"], r["session"].day): (r["outcome"], r["at"] and r["at"].hour, r["attempts"], r["failures"]) for r in got.collect()}
    assert got.count() == len(found)
    assert found == {("a", 1): ("COMPLETE", 11, 3, 1), ("b", 1): ("COMPLETE", 13, 3, 1), ("c", 1): ("NEVER_COMPLETE", None, 1, 1), ("a", 5): ("COMPLETE", 9, 1, 0), ("d", 6): ("NEVER_COMPLETE", None, 1, 1), ("a", 20): ("COMPLETE", 9, 1, 0)}


def state_rows(spark, out):
    return spark.read.format("statestore").option("stateVarName", "seen").load(f"{out}/checkpoint").count()


def test_state_of_old_sessions_goes(spark, tmp_path):
    path, out, held = f"{tmp_path}/land", f"{tmp_path}/out", []
    for week in range(4):
        batch = [(f"s{k}", dt.datetime(2024, 3, 1 + 7 * week, 9), k % 2 == 0) for k in range(20)]
        ingest.drain(stateful.first_observations(landed(spark, path, batch, "src string, t timestamp, ok boolean"), "src", "t", F.col("ok")), out)
        held.append(state_rows(spark, out))
    assert held[-1] <= held[0] + 20 and max(held) <= 40


def test_breaker_counts_failures_in_a_row(spark, tmp_path):
    at = lambda h, d=1: dt.datetime(2024, 3, d, h)
    batches = [
        [("u", at(1), "x", 1), ("u", at(2), "x", 2), ("v", at(1), "x", 3), ("v", at(2), "y", 4), ("v", at(3), "x", 5), ("w", at(1), "x", 6), ("w", at(2), "x", 7), ("w", at(3), None, 8)],
        [("u", at(3), "x", 9), ("u", at(4), "x", 10), ("v", at(4), "x", 11), ("w", at(4), "x", 12), ("w", at(5), "x", 13)],
        [("v", at(5), "x", 14), ("w", at(1, 20), None, 15), ("w", at(6), "x", 16)],
    ]
    path, out = f"{tmp_path}/land", f"{tmp_path}/out"
    for batch in batches:
        stream = landed(spark, path, batch, "u string, t timestamp, sig string, id int")
        got = ingest.drain(stateful.trips(stream, "u", "t", F.col("sig"), "id"), out)
    assert rows(got.select("unit", "signature", F.hour("at").alias("h"), "n")) == [("u", "x", 3, 3), ("v", "x", 5, 3), ("w", "x", 6, 3)]


# publishing


def test_manifest_comes_from_what_is_written(spark, tmp_path):
    a = spark.createDataFrame([(1, dt.date(2024, 1, 2)), (1, dt.date(2024, 1, 2)), (2, None)], "k int, d date")
    b = spark.createDataFrame([], "k int")
    path = str(tmp_path)
    got = publish.publish({"a": a, "b": b}, path, {"a": ["k", "d"], "b": ["k"]}, {"a": "d"})
    assert rows(got, "dataset", "n", "columns", "latest") == [("a", 3, "d,k", "2024-01-02"), ("b", 0, "k", None)]
    assert rows(got.where("dataset = 'a'"), "n", "f1", "f2") == [tuple(fingerprint.content(a).first())]
    assert rows(publish.matches_manifest(path, got)) == [("a", True), ("b", True)]
    spark.createDataFrame([(1, dt.date(2024, 1, 2)), (2, None), (2, None)], "k int, d date").write.mode("overwrite").parquet(f"{path}/a")
    assert rows(publish.matches_manifest(path, got)) == [("a", False), ("b", True)]
    for datasets, columns in (({"a": a}, {"a": ["k"]}), ({"a": a}, {"a": ["k", "d"], "b": ["k"]}), ({"a": a.withColumnRenamed("k", "label")}, {"a": ["label", "d"]})):
        with pytest.raises(ValueError):
            publish.publish(datasets, path, columns)


def test_bundle_gates(spark, tmp_path):
    d = lambda k: dt.date(2024, 1, k)
    universe = spark.createDataFrame([(f"s{k}", d(1), d(3) if k == 0 else None, "point_in_time") for k in range(20)], "symbol string, effective_start date, effective_end date, universe_mode string")
    bars = spark.createDataFrame([(f"s{k}", d(day)) for k in range(20) for day in (2, 5) if (k, day) != (0, 5)], "symbol string, date date")
    q = gates.market_quality(bars, universe, "symbol", "date").first()
    assert (q["latest"], q["universe_symbols"], q["active_symbols"], q["active_seen"], q["passed"]) == (d(5), 20, 19, 19, True)
    assert rows(publish.publish_bundle(bars, universe, str(tmp_path))[0], "dataset", "n", "latest") == [("prices", 39, "2024-01-05"), ("universe", 20, None)]
    thin = bars.where("symbol <> 's1' or date <> date'2024-01-05'")
    assert gates.market_quality(thin, universe, "symbol", "date").first()["active_coverage"] == round(18 / 19, 6)
    for bad_bars, bad in ((thin, universe), (bars, universe.withColumn("universe_mode", F.lit("current_snapshot"))), (bars, universe.drop("effective_end")), (bars.limit(0), universe)):
        with pytest.raises(ValueError):
            publish.publish_bundle(bad_bars, bad, str(tmp_path))


def test_public_bundle_faults(spark):
    frame = lambda n, *more: spark.createDataFrame([(f"s{k}",) for k in range(n)] + [(m,) for m in more], "symbol string")
    columns = {"metadata": ["symbol"], "prices": ["symbol"], "status": ["symbol"]}
    assert gates.bundle_faults(frame(10), frame(10), frame(10), "symbol", columns, 0.9).count() == 0
    got = gates.bundle_faults(frame(10), frame(8, "x"), frame(9, "y", "z"), "symbol", columns | {"status": ["symbol", "d"]}, 0.9)
    assert rows(got) == [("PRICE_COVERAGE", 2), ("PRICE_OUTSIDE_METADATA", 1), ("STATUS_COLUMNS", 1), ("STATUS_OUTSIDE_METADATA", 2), ("SYMBOL_WITHOUT_STATUS", 1)]


def test_file_fingerprints(spark, tmp_path):
    for name, values in (("a", [1, 1]), ("b", [2, 2]), ("c", [1, 1])):
        spark.createDataFrame([(v,) for v in values], "v int").coalesce(1).write.option("header", True).csv(f"{tmp_path}/{name}")
    got = {r["source_file"].split("/")[-2]: (r["n"], r["f1"], r["f2"]) for r in readers.file_counts(readers.read_many(spark, str(tmp_path), "*.csv", "v string")).collect()}
    assert got["a"] == got["c"] != got["b"]


# the derived ledger


KINDS = {"REV": "REVENUE_TREND", "PROFIT": "PROFIT_TREND", "MARGIN": "MARGIN_TREND"}


def inputs(spark, facts, prices, notices):
    return {
        "facts": spark.createDataFrame(facts, "ent int, ft string, pe date, av date, val decimal(18,2)"),
        "prices": spark.createDataFrame(prices, "ent int, ft string, sym int, d date, px double"),
        "notices": spark.createDataFrame(notices, "doc int, ent int, title string, published string"),
    }


def made(seed, full=True):
    """Facts of three entities over three years, prices and notices; without full: earlier, with gaps and one other value."""
    from decimal import Decimal

    rng = random.Random(seed)
    ends = [dt.date(y, m, last) for y in (2019, 2020, 2021) for m, last in ((3, 31), (6, 30), (9, 30), (12, 31))]
    facts = [(e, ft, pe, pe + dt.timedelta(days=rng.choice([25, 60])), Decimal(rng.randint(-50, 400))) for e in range(3) for ft in ("REV", "PROFIT", "CASH", "MARGIN") for pe in ends]
    facts += [(e, ft, pe, av + dt.timedelta(days=90), val + 5) for e, ft, pe, av, val in facts[::5]]
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(500)]
    prices = [(s % 3, "REV", s, d, float(rng.randint(5, 90))) for s in range(4) for d in days if rng.random() > 0.1]
    titles = ["2020年度业绩预增公告", "2020年度业绩预减公告", "年度报告", "预增预减更正", "关于处罚的公告"]
    notices = [(k, k % 3, titles[k % 5], str(dt.date(2020, 1, 1) + dt.timedelta(days=k * 4 % 480)) + (" 10:00:00" if k % 2 else "")) for k in range(60)]
    if not full:
        facts = [f if k != 30 else (*f[:4], f[4] + 99) for k, f in enumerate(facts) if not (f[0] == 1 and f[3] > dt.date(2021, 2, 1)) and k != 17]
        prices = [p for p in prices if p[3] < dt.date(2021, 3, 1) or p[2] == 3]
        notices = [n for n in notices if n[0] % 7]
    return facts, prices, notices


def parts(spark):
    from chronolake.operators import calendar

    cal = calendar.slots(spark.createDataFrame([(dt.date(2020, 1, 1) + dt.timedelta(days=k),) for k in range(520)], "d date"))
    return assembly.standard_parts(cal, cal, KINDS, ("MARGIN",), ["REV", "PROFIT", "CASH", "MARGIN"])


def test_an_increment_equals_a_full_run(spark, tmp_path):
    old, new = inputs(spark, *made(1, False)), inputs(spark, *made(1))
    path = f"{tmp_path}/ledger"
    assembly.build(parts(spark), old, path)
    changed = {name: assembly.changed_since(old[name], new[name], time) for name, time in (("facts", "av"), ("prices", "d"), ("notices", "published"))}
    assert {r["ent"] for r in changed["facts"].collect()} >= {1}
    got = assembly.advance(parts(spark), new, changed, path, 1)
    want = assembly.assembled(parts(spark), new)
    assert rows(got) == rows(want)
    assert {r["part"] for r in got.select("part").distinct().collect()} == {"trend", "state", "valuation", "earnings", "policy"}
    # again, as after a lost driver, and with nothing changed
    assert rows(assembly.advance(parts(spark), new, changed, path, 1)) == rows(want)
    none = {name: assembly.changed_since(new[name], new[name], time) for name, time in (("facts", "av"),)}
    assert rows(assembly.advance(parts(spark), new, none, path, 2)) == rows(want)


def test_an_increment_writes_only_what_it_replaces(spark, tmp_path):
    """Other rows of the same months were written again, and each generation was stored three times over."""
    facts, prices, notices = made(1)
    # a later title of entity 1, and every notice of entity 2 gone
    new = inputs(spark, facts, prices, [(*n[:2], "2020年度业绩预减公告", n[3]) if n[0] == 40 else n for n in notices if n[1] != 2])
    old = inputs(spark, facts, prices, notices)
    path, scratch = f"{tmp_path}/ledger", spark.conf.get("spark.checkpoint.dir")
    there = set(os.listdir(scratch))
    assembly.build(parts(spark), old, path)
    changed = {"notices": assembly.changed_since(old["notices"], new["notices"], "published")}
    day = dt.date(2020, 1, 1) + dt.timedelta(days=160)
    assert rows(changed["notices"], "ent", "since") == [(1, day), (2, dt.date(2020, 1, 9))]
    got = assembly.advance(parts(spark), new, changed, path, 1)
    assert rows(got) == rows(assembly.assembled(parts(spark), new))
    again = spark.read.parquet(f"{path}/rows/gen=1")
    assert {r["entity_id"] for r in again.select("entity_id").distinct().collect()} == {"1"} and again.where(again.available_date < day).count() == 0
    assert {name.split("-")[0] for name in set(os.listdir(scratch)) - there} <= {"days", "since"}


def test_rows_are_dealt_before_they_are_spelt_out(spark):
    """Hashes in hex went through the shuffle that deals rows by month."""
    new = inputs(spark, *made(1))
    for part in parts(spark):
        plan = part.rows(new, assembly.by_month)._jdf.queryExecution().executedPlan().toString()
        spelt, dealt = plan.rindex("sha2("), plan.index("REBALANCE_PARTITIONS_BY_COL")
        assert spelt < dealt, part.name


def test_the_ledger_is_sound(spark):
    got = assembly.assembled(parts(spark), inputs(spark, *made(2)))
    audit = ledger.audit(got).first()
    assert audit["evidence_ids_unique"] and audit["ingestion_ids_unique"] and audit["never_available_early"] and audit["states_known"] and audit["provenance_parses"]
    assert ledger.invalid_records(got).count() == 0
    m = {r["part"]: r for r in assembly.manifest(got).collect()}
    assert m["state"]["insufficient"] > 0 and m["trend"]["insufficient"] == 0
    scope = spark.createDataFrame([(k,) for k in range(5)], "ent int")
    seen = {r["ent"]: r for r in assembly.review(got, scope).collect()}
    assert len(seen) == 5 and seen[4]["records"] == 0 and not seen[4]["clear"] and seen[0]["negatives"] > 0


def test_trends_and_missing_comparables(spark):
    from decimal import Decimal

    d = dt.date
    facts = [(1, "REV", d(2019, 12, 31), d(2020, 3, 1), Decimal(100)), (1, "REV", d(2020, 12, 31), d(2021, 3, 1), Decimal(150)), (1, "REV", d(2019, 12, 31), d(2021, 6, 1), Decimal(50)), (1, "REV", d(2020, 12, 31), d(2021, 7, 1), Decimal(150)),
             (1, "MARGIN", d(2019, 12, 31), d(2020, 3, 1), Decimal(0)), (1, "MARGIN", d(2020, 12, 31), d(2021, 3, 1), Decimal(2)), (2, "REV", d(2019, 12, 31), d(2020, 3, 1), Decimal(0)), (2, "REV", d(2020, 12, 31), d(2021, 3, 1), Decimal(5))]
    got = assembly.trends(inputs(spark, facts, [], [])["facts"], KINDS, ("MARGIN",))
    value = F.get_json_object("payload", "$.value").cast("double").alias("value")
    assert rows(got.select("entity_id", "evidence_type", "available_date", value)) == [("1", "MARGIN_TREND", d(2021, 3, 1), 2.0), ("1", "REVENUE_TREND", d(2021, 3, 1), 0.5), ("1", "REVENUE_TREND", d(2021, 7, 1), 2.0)]


def test_first_rows_by_state(spark, tmp_path):
    """Batches over restarts: late repeats go, changed rows and rows that disagree in one batch are conflicts."""
    path, out = f"{tmp_path}/land", f"{tmp_path}/out"
    batches = [[(1, "a"), (2, "b"), (2, "b"), (3, "x"), (3, "y"), (5, None)], [(1, "a"), (4, "d"), (5, None)], [(2, "z"), (4, "d"), (None, "n"), (5, "e")], [(3, "x")]]
    for batch in batches:
        spark.createDataFrame(batch, "id int, v string").coalesce(1).write.mode("append").parquet(path)
        got = ingest.drain(stateful.first_rows(ingest.landing(spark, path), "id"), out)
    assert rows(got.where("outcome = 'KEPT'"), "id", "v") == sorted([(1, "a"), (2, "b"), (4, "d"), (5, None), (3, "x")], key=str)
    assert rows(got.where("outcome = 'CONFLICT'"), "id", "v") == sorted([(3, "x"), (3, "y"), (2, "z"), (None, "n"), (5, "e")], key=str)


def test_keys_of_a_slice_share_calls_to_their_state(spark, tmp_path):
    """A batch makes two calls for a slice, however many keys it holds, and keys of any type in one slice stay apart."""

    class Listed:
        def __init__(self):
            self.held, self.calls = [], 0

        def get(self):
            self.calls += 1
            return iter(self.held)

        def appendValue(self, value):
            self.calls += 1
            self.held.append(value)

    state, once = Listed(), stateful._Once(["id"])
    once.known = state
    row = lambda k, digest=0: Row(id=k, __one=k, __two=-k, __digest=digest)
    assert len(list(once.handleInputRows((0,), iter([row(k) for k in range(1000)]), None))) == 1000 and state.calls == 2
    assert list(once.handleInputRows((0,), iter([row(k, int(k == 7)) for k in range(1000)]), None)) == [Row(id=7, outcome="CONFLICT")] and state.calls == 3

    path, out = f"{tmp_path}/land", f"{tmp_path}/out"
    batches = [[(f"k{k}", 1, k * 0.5) for k in range(60)] + [("t", 1, 1.0), ("t", 1, 1.0), ("t", 2, 1.0)], [(f"k{k}", 1, k * 0.5 + (k % 10 == 0)) for k in range(80)] + [(None, 1, None)] * 2]
    for batch in batches:
        spark.createDataFrame(batch, "id string, n int, v double").coalesce(1).write.mode("append").parquet(path)
        got = ingest.drain(stateful.first_rows(ingest.landing(spark, path), "id", slices=2), out)
    assert rows(got.where("outcome = 'KEPT'"), "id", "v") == sorted(((f"k{k}", k * 0.5 + (k >= 60 and k % 10 == 0)) for k in range(80)), key=str)
    assert rows(got.where("outcome = 'CONFLICT'"), "id", "v") == sorted([("t", 1.0)] * 3 + [(None, None)] * 2 + [(f"k{k}", k * 0.5 + 1) for k in range(0, 60, 10)], key=str)


def test_one_month_of_a_part_is_written_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from chronolake.operators import assembly

    rows = spark.range(40_000, numPartitions=8).select(*(F.sha2(F.concat(F.lit(c), F.col("id").cast("string")), 256).alias(c) if c not in ("part", "event_date", "available_date") else (F.lit("policy") if c == "part" else F.lit("2024-01-05").cast("date")).alias(c) for c in assembly.COLUMNS))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        assembly._written(rows, str(tmp_path), 0, rows.select("part", F.trunc("available_date", "MM").alias("month")))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(tmp_path.glob("rows/gen=0/part=policy/month=2024-01-01/*.parquet"))) > 1
    assert assembly.read_ledger(spark, str(tmp_path)).select("evidence_id").distinct().count() == 40_000


def test_rules_for_boards_are_compiled(spark):
    """With the code worked out for each prefix anew the generated code was too large, and rows went through the interpreter."""
    from pyspark.sql import functions as F

    from chronolake.sources import readers

    raw = spark.range(100).select(F.concat(F.lit("600"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("证券代码"), F.lit("2020-01-02").alias("上市日期"), F.lit("5").alias("发行价格")).repartition(2)
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        kept, bad = readers.listing_metadata(raw, "p")
        assert kept.where("board = 'SSE_MAIN'").count() == 100 and bad.count() == 0
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
        spark.conf.unset("spark.sql.codegen.factoryMode")
