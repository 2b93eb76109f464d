"""Joins that bring sources together: rails, pairs of exchanges, spines, aliases, applicability, variants, ledgers.

Right sides are one row a key unless a docstring says otherwise; missing partners give nulls in left joins; empty
frames give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attach_rail(rows: DataFrame, rail: DataFrame, on: list[str], complete: bool = False) -> DataFrame:
    """rows with the columns of a rail (one row a key; a key that comes twice is an error of the rail), null where it has none.

    complete: a row whose key the rail lacks is an error too.
    """
    rest = [c for c in rail.columns if c not in on]
    counted = rail.groupBy(*on).agg(F.count("*").alias("__n"), F.min(F.struct(*rest)).alias("__r")).select(*on, "__n", "__r.*")
    checked = counted.withColumn("__n", F.when(F.col("__n") > 1, F.raise_error(F.lit("rail has a key twice"))).otherwise(F.col("__n")))
    lost = F.raise_error(F.lit("rail lacks a key")).cast("long") if complete else F.lit(1)
    return rows.join(checked, on, "left").where(F.coalesce("__n", lost) == 1).drop("__n")


def both_sides(rows: DataFrame, on: str, side: Column, value: str, names: tuple[str, str]) -> DataFrame:
    """on, total and the value of two sides, where both are there and the total is positive. side: 0 or 1."""
    one, two = names
    g = rows.groupBy(on).agg(*(F.sum(F.when(side == k, F.col(value))).alias(n) for k, n in enumerate(names)))
    return g.where(F.col(one).isNotNull() & F.col(two).isNotNull() & (F.col(one) + F.col(two) > 0)).select(on, (F.col(one) + F.col(two)).alias("total"), one, two)


def on_spine(spine: DataFrame, on: str, feeds: dict[str, DataFrame], complete: str) -> DataFrame:
    """The spine with one column from each feed (on, value) and whether all are there."""
    out = spine.select(on)
    for name, feed in feeds.items():
        value = next(c for c in feed.columns if c != on)
        out = out.join(feed.select(on, F.col(value).alias(name)), on, "left")
    return out.withColumn(complete, reduce(lambda a, b: a & b, (F.col(n).isNotNull() for n in feeds)))


def within_tolerance(one: DataFrame, two: DataFrame, on: list[str], value: str, most: float) -> DataFrame:
    """on, one, two, mismatch for keys that both sources have: whether the values differ by more than most."""
    pair = one.select(*on, F.col(value).alias("one")).join(two.select(*on, F.col(value).alias("two")), on)
    return pair.withColumn("mismatch", F.abs(F.col("one") - F.col("two")) > most)


def applicable(entities: DataFrame, rules: dict[str, Column], source: str = "source") -> DataFrame:
    """entities with each source whose rule (a condition on the entity) holds: a bounded rule table, exploded without a cross join."""
    hits = F.filter(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items())), lambda x: x.isNotNull())
    return entities.select("*", F.explode(hits).alias(source))


def aliased(rows: DataFrame, aliases: DataFrame, key: str, day: str, out: str) -> DataFrame:
    """rows with the code that a key has on a day. aliases: old, new, cut; of several cuts that have passed the last counts."""
    slim = aliases.select(F.col("old").alias("__old"), F.col("new").alias("__new"), F.col("cut").alias("__cut"))
    all_cuts = slim.groupBy("__old").agg(F.sort_array(F.collect_list(F.struct("__cut", "__new"))).alias("__cuts"))
    joined = rows.join(all_cuts, F.col(key) == F.col("__old"), "left")
    passed = F.filter("__cuts", lambda c: c["__cut"] <= F.col(day))
    return joined.withColumn(out, F.coalesce(F.try_element_at(passed, F.lit(-1))["__new"], F.col(key))).drop("__old", "__cuts")


def holding(rows: DataFrame, field: str, wanted: DataFrame, word: str, separator: str = " ") -> DataFrame:
    """rows whose multi-valued field holds one of the wanted words: an equi-join on exploded words, each row once."""
    words = wanted.select(F.col(word).alias("__word")).where("__word is not null").distinct()
    held = rows.select(F.col(field).alias("__field")).distinct().select("__field", F.explode(F.split("__field", separator)).alias("__word"))
    hit = held.join(words, "__word", "left_semi").select("__field").distinct()
    return rows.join(hit, F.col(field) == F.col("__field"), "left_semi")


def merged_coverage(scope: DataFrame, key: str, counts: dict[str, DataFrame], total: str = "total") -> DataFrame:
    """key, one count for each source (rows of key) and their total, zero where a source has none."""
    out = scope.select(key)
    for name, rows in counts.items():
        out = out.join(rows.groupBy(key).agg(F.count("*").alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out.withColumn(total, reduce(lambda a, b: a + b, (F.col(n) for n in counts)))


def snapshot_filter(rows: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """rows whose key is in a snapshot, with the snapshot's columns; of a key that the snapshot repeats the least row counts."""
    rest = [c for c in snapshot.columns if c != key]
    once = snapshot.groupBy(key).agg(F.min(F.struct(*rest)).alias("__r")).select(key, "__r.*") if rest else snapshot.distinct()
    return rows.join(once, key)


def redundant_revisions(rows: DataFrame, keys: list[str], value: str, available: str) -> DataFrame:
    """keys, redundant, available, rows_seen: revisions of one value collapse to the first time it was known."""
    return rows.groupBy(*keys).agg((F.count_distinct(value) == 1).alias("redundant"), F.min(available).alias(available), F.count("*").alias("rows_seen"))


def preferred_variant(rows: DataFrame, keys: list[str], priority: Column) -> DataFrame:
    """Rows with the greatest priority of their key; ties stay, for the caller to see."""
    top = F.max("__priority").over(Window.partitionBy(*keys))
    return rows.withColumn("__priority", priority).withColumn("__top", top).where("__priority = __top").drop("__priority", "__top")


def canonical_place(rows: DataFrame, within: list[Column], order: list[Column], out: str = "place") -> DataFrame:
    """rows with their place in a total order inside each part; the order must end in a unique column."""
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(*within).orderBy(*order)))


def evidence_union(parts: dict[str, DataFrame], source: str = "src") -> DataFrame:
    """All rows of ledgers with different columns, by name, with the name of their ledger; missing columns are null."""
    named = [rows.withColumn(source, F.lit(name)) for name, rows in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def rebuilt(ledger: DataFrame, source: Column, derive: Column, column: str, value: str) -> DataFrame:
    """A ledger without its source events, and with an event of the derived kind for each that meets a condition."""
    is_source = F.coalesce(source, F.lit(False))
    return ledger.where(~is_source).unionByName(ledger.where(is_source & F.coalesce(derive, F.lit(False))).withColumn(column, F.lit(value)))


def archive_states(scope: DataFrame, rows: DataFrame, key: str, failed: DataFrame) -> DataFrame:
    """key, records, query_status of every key in scope: FAILED where the query failed (its rows do not count), EMPTY or COMPLETE."""
    gone = failed.select(key).distinct().withColumn("__failed", F.lit(True))
    n = rows.join(gone, key, "left_anti").groupBy(key).agg(F.count("*").alias("__n"))
    out = scope.join(gone, key, "left").join(n, key, "left")
    status = F.when(F.col("__failed"), "FAILED").when(F.col("__n").isNull(), "EMPTY").otherwise("COMPLETE")
    return out.select(key, F.coalesce("__n", F.lit(0)).alias("records"), status.alias("query_status"))


def keyword_hits(rows: DataFrame, text: str, words: list[str]) -> DataFrame:
    """rows once for each keyword that their text holds, in a column keyword."""
    return rows.withColumn("keyword", F.explode(F.filter(F.array(*(F.lit(w) for w in words)), lambda w: F.col(text).contains(w))))


def clear_of_negatives(scope: DataFrame, negatives: DataFrame, key: str, market: Column, complete: Column) -> DataFrame:
    """key, negatives, complete, exclusion_clear: clear only with complete coverage and no negative; market-wide ones count for all."""
    own = negatives.groupBy(key).agg(F.count("*").alias("__own"))
    wide = negatives.where(market).agg(F.count("*").alias("__market"))
    n = F.coalesce("__own", F.lit(0)) + F.col("__market")
    rows = scope.join(own, key, "left").crossJoin(F.broadcast(wide)).withColumn("negatives", n).withColumn("complete", complete)
    return rows.select(key, "negatives", "complete", (F.col("complete") & (F.col("negatives") == 0)).alias("exclusion_clear"))


def without_quarantined(rows: DataFrame, quarantine: DataFrame, on: list[str]) -> DataFrame:
    """rows that no ACTIVE entry of the quarantine (on, state) names; null keys are never named."""
    return rows.join(quarantine.where("state = 'ACTIVE'").select(*on).distinct(), on, "left_anti")


def registry_accounting(rows: DataFrame, key: str, known: DataFrame, inside: DataFrame, identity: str) -> DataFrame:
    """raw, mapped, unmapped, inside and excluded rows: which rows have a known key, and which lie in an interval of it (by identity)."""
    k = rows.join(known.select(key).distinct().withColumn("__known", F.lit(True)), key, "left")
    k = k.join(inside.select(identity).distinct().withColumn("__inside", F.lit(True)), identity, "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    return k.agg(F.count("*").alias("raw_rows"), F.count_if(yes("__known")).alias("mapped_rows"), F.count_if(~yes("__known")).alias("unmapped_rows"), F.count_if(yes("__inside")).alias("inside_rows"), F.count_if(yes("__known") & ~yes("__inside")).alias("excluded_rows"))
