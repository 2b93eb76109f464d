"""Qualification gates: the strict forms raise, empty inputs have a defined result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chronolake.operators import archives, combine, qualification

D = dt.date


def test_an_event_in_two_intervals_is_an_error(spark):
    events = spark.createDataFrame([(1, "a", D(2020, 1, 5)), (2, "a", D(2020, 3, 5)), (3, "b", D(2020, 1, 5)), (4, None, D(2020, 1, 5))], "id int, sym string, day date")
    members = spark.createDataFrame([("a", D(2020, 1, 1), D(2020, 1, 31), "x"), ("a", D(2020, 3, 1), None, "y")], "sym string, s date, e date, scope string")
    got = {r["id"]: r["scope"] for r in qualification.events_in_membership(events, members, "sym", "day", "id").collect()}
    assert got == {1: "x", 2: "y"}
    twice = members.unionByName(members.where("scope = 'x'"))
    with pytest.raises(Exception, match="two membership intervals"):
        qualification.events_in_membership(events, twice, "sym", "day", "id").collect()
    assert {r["id"]: r["intervals"] for r in qualification.event_interval_counts(events, twice, "sym", "day", "id").collect()} == {1: 2, 2: 1, 3: 0, 4: 0}


def test_a_rail_that_lacks_a_key_is_an_error_where_it_must_be_complete(spark):
    rows, rail = spark.createDataFrame([(1,), (2,)], "d int"), spark.createDataFrame([(1, 5.0)], "d int, v double")
    assert sorted(tuple(r) for r in combine.attach_rail(rows, rail, ["d"]).collect()) == [(1, 5.0), (2, None)]
    with pytest.raises(Exception, match="rail lacks a key"):
        combine.attach_rail(rows, rail, ["d"], True).collect()
    with pytest.raises(Exception, match="key twice"):
        combine.attach_rail(rows, rail.unionByName(rail), ["d"]).collect()


def test_gates_of_nothing(spark):
    spine = spark.createDataFrame([], "sym int, d date, v double")
    assert qualification.archive_audit(spine, "sym", "v").count() == qualification.trailing_readiness(spine, "sym", "v").count() == 0
    scope = spark.createDataFrame([(1,)], "sym int")
    none = spark.createDataFrame([], "shard long, shards int, sym int")
    assert [tuple(r) for r in qualification.shard_faults(scope, none).collect()] == [("LOST", 1)]
    rows = spark.createDataFrame([], "ent int, doc int, fact string, event_date date, available date")
    captured, accounts = archives.increment(rows, scope.withColumnRenamed("sym", "ent"), F.lit("2020-01-01").cast("date"), F.lit("2020-02-01").cast("date"))
    assert captured.count() == 0 and [r["status"] for r in accounts.collect()] == ["EMPTY"]
    cal = spark.createDataFrame([], "d date, slot int")
    summary = qualification.capital_summary(cal, cal.select("d"), cal.select("d"), F.lit("2020-01-01").cast("date"), F.lit(0)).first()
    assert summary["sessions"] == 0 and not summary["ready"]
