"""The derived evidence ledger: trends, states, valuations, earnings directions and policy rows from facts, prices and notices.

A part is a function of inputs that share the entity column `ent`. The ledger is stored in generations: a
generation holds rows by part and month of availability and names the entities whose earlier rows it replaces, each
from a day on; its index, written last, makes it count. `advance` brings a ledger up to date by dependency: only
entities whose inputs changed are computed again, from the date of the earliest change on, only their rows are
written, and the result equals a full run.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolake.functions import fingerprint
from chronolake.functions import scalars as S
from chronolake.sources.scratch import saved

from . import asof, calendar, spread, valuation

SCHEMA = "part string, evidence_id string, entity_id string, evidence_type string, event_date date, available_date date, source_identity string, document_id string, ingestion_id string, availability_state string, payload string, provenance string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(",")]
COMPLETE, INSUFFICIENT = "HISTORICAL_RECONSTRUCTABLE", "DATA_INSUFFICIENT"
#: Evidence that speaks against an entity.
NEGATIVE = {"MAJOR_NEGATIVE_EVENT": None, "EARNINGS_DIRECTION": "DOWN", "FUNDAMENTAL_STATE": "FUNDAMENTAL_FAIL"}


#: What is done with rows, given their availability, before they are spelt out as ledger rows; it adds `month`.
Deal = Callable[[DataFrame, Column], DataFrame]


@dataclass(frozen=True)
class Part:
    """Ledger rows from inputs by name, and a deal or None; inputs: the names it reads."""

    name: str
    rows: Callable[..., DataFrame]
    inputs: tuple[str, ...]


def by_month(rows: DataFrame, available: Column, *keys: str) -> DataFrame:
    """rows in order by keys and month of availability, a month in few tasks."""
    # a month of a part may be any share of the ledger: rebalancing splits it over tasks, and joins small months to one file
    by = [*keys, "month"]
    return rows.withColumn("month", F.trunc(available, "MM")).hint("rebalance", *by).sortWithinPartitions(*by)


def ledger_rows(rows: DataFrame, part: str, kind: Column, event: Column, available: Column, document: Column, identity: list[Column], payload: Mapping[str, Column], provenance: Mapping[str, Column], state: Column | None = None, deal: Deal | None = None) -> DataFrame:
    """rows as ledger rows of the entity in `ent`; ids are hashes of the identity, and of identity and payload.

    Hashes and texts make a row several times as wide, and do not compress in a shuffle: rows are dealt before.
    """
    rows = deal(rows, available) if deal else rows
    body = F.to_json(F.struct(*(payload[k].alias(k) for k in sorted(payload))))
    trace = F.to_json(F.struct(*(v.alias(k) for k, v in sorted({**provenance, "source_identity": F.lit(f"derived-{part}")}.items()))))
    key = S.stable_hash(F.lit(part), F.col("ent"), kind, event, available, *identity)
    return rows.select(
        F.lit(part).alias("part"), F.concat(F.lit(f"{part}:"), key).alias("evidence_id"), F.col("ent").cast("string").alias("entity_id"), kind.alias("evidence_type"), event.alias("event_date"), available.alias("available_date"),
        F.lit(f"derived-{part}").alias("source_identity"), document.cast("string").alias("document_id"), F.sha2(F.concat(key, body), 256).alias("ingestion_id"), (state if state is not None else F.lit(COMPLETE)).alias("availability_state"), body.alias("payload"), trace.alias("provenance"), *(["month"] if deal else []),
    )


def trends(facts: DataFrame, kinds: Mapping[str, str], margins: tuple[str, ...] = (), deal: Deal | None = None) -> DataFrame:
    """Change of each fact against its comparable of the year before, as known when the fact came: a ratio, for margins a difference.

    facts: ent, ft, pe, av, val, one row for each availability. kinds: evidence type by fact type; others give no
    rows, nor do a missing or (but for margins) zero comparable.
    """
    name = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))
    rows = valuation.prior_comparable(facts.where(F.col("ft").isin(*kinds)), ["ent", "ft"], "pe", "av", "val").where("prior_value is not null")
    is_margin = F.col("ft").isin(*margins) if margins else F.lit(False)
    rows = rows.where(is_margin | (F.col("prior_value") != 0))
    now, before = F.col("val").cast("double"), F.col("prior_value").cast("double")
    change = F.when(is_margin, now - before).otherwise(now / before - 1)
    document = F.concat_ws(":", "ent", "ft", "pe", "av")
    payload = {"value": change, "basis": F.when(is_margin, "yoy_delta").otherwise("yoy_change"), "metric": F.col("ft"), "current_value": F.col("val"), "prior_comparable_value": F.col("prior_value"), "prior_period_end": F.last_day(F.add_months("pe", -12))}
    return ledger_rows(rows, "trend", name[F.col("ft")], F.col("pe"), F.col("av"), document, [F.col("ft")], payload, {"as_of_selection": F.lit("LATEST_AVAILABLE_AT_OWN_AVAILABILITY")}, deal=deal)


def states(facts: DataFrame, kinds: list[str], deal: Deal | None = None) -> DataFrame:
    """Accounting state of every period at each of its knowledge dates, against the year before as known then.

    kinds: the fact types of revenue, profit, cash and margin. A state that lacks a value on either side is
    kept as insufficient, with what is missing.
    """
    known = valuation.state_facts(facts.where(F.col("ft").isin(*kinds)), "ent", "pe", "ft", "av", "val", kinds)
    values = [f"v{i}" for i in range(len(kinds))]
    asked = known.withColumn("pe0", F.last_day(F.add_months("pe", -12)))
    past = known.select("ent", F.col("pe").alias("pe0"), F.col("cut").alias("then"), *(F.col(v).alias(f"{v}_0") for v in values))
    both = asof.backward(asked, past, ["ent", "pe0"], "cut", "then", [f"{v}_0" for v in values])
    names = ("revenue", "profit", "cash", "margin")
    state = S.accounting_state({n: F.col(v) for n, v in zip(names, values)}, {n: F.col(f"{v}_0") for n, v in zip(names, values)})
    lost = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for v in values for c in (v, f"{v}_0"))))
    both = both.withColumn("lost", lost).withColumn("x", F.when(F.size("lost") == 0, state))
    payload = {"value": F.col("x.state"), "reason": F.col("x.reason"), "missing": F.array_join("lost", ",")} | {n: F.col(v) for n, v in zip(names, values)}
    return ledger_rows(both, "state", F.lit("FUNDAMENTAL_STATE"), F.col("pe"), F.col("cut"), F.concat_ws(":", "ent", "pe", "cut"), [], payload, {"cutoffs": F.lit("AVAILABILITY_DATES_OF_THE_PERIOD")}, F.when(F.col("x").isNull(), INSUFFICIENT).otherwise(COMPLETE), deal)


def valuations(prices: DataFrame, facts: DataFrame, cal: DataFrame, sessions: int = 20, deal: Deal | None = None) -> DataFrame:
    """Change of price over trailing value against exactly so many sessions before; no fill, so either day may lack it.

    prices: ent, ft (the fact type that values the security), sym, d, px, one row for each security and day. A
    trailing value that is not positive gives no ratio.
    """
    trailing = valuation.trailing_value(facts, ["ent", "ft"], "pe", "av", "val").where("ttm is not null")
    # few facts value many securities: each day of a fact is looked up once, so no task holds all its securities
    days = asof.backward(prices.select("ent", "ft", "d").distinct(), trailing, ["ent", "ft"], "d", "av", ["ttm"]).where("ttm > 0")
    # as a table their size is known: unless there are too many of them they travel to the prices
    days = saved(days.select(*(F.col(c).alias(f"__{c}") for c in ("ent", "ft", "d")), "asof_time", "ttm"), "days")
    met = F.col("ent").eqNullSafe(F.col("__ent")) & F.col("ft").eqNullSafe(F.col("__ft")) & F.col("d").eqNullSafe(F.col("__d"))
    # prices are shuffled once, before they grow: a window looks back, both sides of a join would be shuffled
    rail = spread.by_key(prices.select("ent", "ft", "sym", "d", "px"), "sym").join(days, met).drop("__ent", "__ft", "__d")
    rail = rail.withColumn("ratio", F.col("px").cast("double") / F.col("ttm").cast("double")).where("ratio is not null and sym is not null").join(F.broadcast(cal.select("d", "slot")), "d")
    ago = Window.partitionBy("sym").orderBy("slot").rangeBetween(-sessions, -sessions)
    rail = rail.withColumn("before", F.max("ratio").over(ago)).where("before <> 0")
    payload = {"value": F.col("ratio") / F.col("before") - 1, "ratio": F.col("ratio"), "reference": F.col("before"), "trailing_value": F.col("ttm"), "close": F.col("px"), "sym": F.col("sym")}
    return ledger_rows(rail, "valuation", F.lit("TRAILING_VALUATION_CHANGE"), F.col("d"), F.col("d"), F.concat_ws(":", "ent", "ft", "asof_time"), [F.col("sym")], payload, {"sessions": F.lit(sessions), "known_since": F.col("asof_time")}, deal=deal)


def _usable(notices: DataFrame, cal: DataFrame) -> DataFrame:
    """Notices with the session from which they count; later ones wait. notices: doc, ent, title, published (text)."""
    return calendar.available(notices, "published", cal).where("available is not null").withColumn("day", F.try_to_timestamp("published").cast("date"))


def directions(notices: DataFrame, cal: DataFrame, deal: Deal | None = None) -> DataFrame:
    """Earnings directions that the title of a notice states. `unclassified` has the others."""
    rows = _usable(notices, cal).withColumn("way", S.earnings_direction(F.col("title"))).where("way <> 'UNKNOWN'")
    return ledger_rows(rows, "earnings", F.lit("EARNINGS_DIRECTION"), F.col("day"), F.col("available"), F.col("doc"), [F.col("doc")], {"value": F.col("way"), "title_sha256": F.sha2("title", 256)}, {"availability_rule": F.col("basis"), "doc": F.col("doc")}, deal=deal)


def unclassified(notices: DataFrame, cal: DataFrame) -> DataFrame:
    """ent, doc, available, reason of notices without a direction: kept apart, not dropped."""
    rows = _usable(notices, cal).where(S.earnings_direction(F.col("title")) == "UNKNOWN")
    return rows.select("ent", "doc", "available", F.lit("NO_SINGLE_EXPLICIT_DIRECTION").alias("reason"))


def policies(notices: DataFrame, cal: DataFrame, deal: Deal | None = None) -> DataFrame:
    """Every usable notice as policy or event evidence by its title."""
    rows = _usable(notices, cal).withColumn("kind", S.policy_type(F.col("title"), F.lit("OFFICIAL_NOTICE")))
    return ledger_rows(rows, "policy", F.col("kind"), F.col("day"), F.col("available"), F.col("doc"), [F.col("doc")], {"value": F.col("kind"), "title_sha256": F.sha2("title", 256)}, {"availability_rule": F.col("basis"), "doc": F.col("doc")}, deal=deal)


def standard_parts(cal: DataFrame, notice_cal: DataFrame, kinds: Mapping[str, str], margins: tuple[str, ...], state_kinds: list[str]) -> list[Part]:
    """The five parts over the inputs facts, prices and notices."""
    return [
        Part("trend", lambda x, deal=None: trends(x["facts"], kinds, margins, deal), ("facts",)),
        Part("state", lambda x, deal=None: states(x["facts"], state_kinds, deal), ("facts",)),
        Part("valuation", lambda x, deal=None: valuations(x["prices"], x["facts"], cal, deal=deal), ("facts", "prices")),
        Part("earnings", lambda x, deal=None: directions(x["notices"], notice_cal, deal), ("notices",)),
        Part("policy", lambda x, deal=None: policies(x["notices"], notice_cal, deal), ("notices",)),
    ]


# --- the stored ledger -------------------------------------------------------------------------------


REPLACED = "part string, entity_id string, since date"


def _finished(path: str, generation: int, touched: DataFrame, replaced: DataFrame | None = None) -> None:
    """Write what a generation replaces in earlier ones, then the index of its partitions."""
    spark = touched.sparkSession
    replaced = replaced if replaced is not None else spark.createDataFrame([], REPLACED)
    replaced.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/replaced/gen={generation}")
    touched.select("part", "month").distinct().coalesce(1).write.mode("overwrite").parquet(f"{path}/index/gen={generation}")


def _written(rows: DataFrame, path: str, generation: int, touched: DataFrame) -> None:
    """Write a generation that comes as whole rows, then its index. Running again overwrites it."""
    by_month(rows, F.col("available_date"), "part").write.mode("overwrite").option("compression", "zstd").partitionBy("part", "month").parquet(f"{path}/rows/gen={generation}")
    _finished(path, generation, touched)


def _written_parts(spark: SparkSession, rows: Mapping[str, DataFrame], path: str, generation: int, replaced: DataFrame | None = None) -> None:
    """Write a generation that comes by part, dealt and in order by month, then its index. Running again overwrites it."""
    where = f"{path}/rows/gen={generation}"
    for part, own in rows.items():
        # the ids are hashes in hex, which zstd halves
        own.drop("part").write.mode("overwrite").option("compression", "zstd").partitionBy("month").parquet(f"{where}/part={part}")
    stored = spark.read.schema("part string, month date").option("basePath", where).parquet(*(f"{where}/part={part}" for part in rows))
    # a part without rows counts too: it may replace some
    _finished(path, generation, stored.unionByName(spark.createDataFrame([(part, None) for part in rows], "part string, month date")), replaced)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The current rows: those of generations with an index that no later one replaces."""
    index = spark.read.schema("part string, month date, gen int").parquet(f"{path}/index").distinct()
    index = F.broadcast(index.select(*(F.col(c).alias(f"__{c}") for c in index.columns)))
    rows = spark.read.schema(f"{SCHEMA}, month date, gen int").option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    # an index entry for each part and month: bounded by the calendar
    rows = rows.join(index, (F.col("part") == F.col("__part")) & F.col("month").eqNullSafe(F.col("__month")) & (F.col("gen") == F.col("__gen")), "left_semi")
    gone = spark.read.schema(f"{REPLACED}, gen int").parquet(f"{path}/replaced").join(index, F.col("gen") == F.col("__gen"), "left_semi")
    gone = gone.select(F.col("part").alias("__part"), F.col("entity_id").alias("__entity"), "since", F.col("gen").alias("__gen"))
    later = (F.col("part") == F.col("__part")) & (F.col("entity_id") == F.col("__entity")) & (F.col("gen") < F.col("__gen")) & (F.col("available_date") >= F.col("since"))
    return rows.join(gone, later, "left_anti").select(*COLUMNS)


def assembled(parts: list[Part], inputs: Mapping[str, DataFrame]) -> DataFrame:
    """All parts in one ledger, from whole inputs."""
    out = None
    for part in parts:
        rows = part.rows(inputs).select(*COLUMNS)
        out = rows if out is None else out.unionByName(rows)
    return out


def build(parts: list[Part], inputs: Mapping[str, DataFrame], path: str) -> DataFrame:
    """Write the whole ledger as generation 0 and read it."""
    spark = next(iter(inputs.values())).sparkSession
    _written_parts(spark, {part.name: part.rows(inputs, by_month) for part in parts}, path, 0)
    return read_ledger(spark, path)


def changed_since(before: DataFrame, after: DataFrame, time: str) -> DataFrame:
    """ent, since: entities with rows that differ between two states of an input, and the first day on which they do.

    Found by descending fingerprints of days, then of entities on the days that differ.
    """
    a, b = (df.withColumn("__day", F.col(time).cast("date")) for df in (before, after))
    days = saved(fingerprint.differing(fingerprint.content(a, ["__day"]), fingerprint.content(b, ["__day"]), ["__day"]), "days")
    a, b = fingerprint.within(a, days, ["__day"]), fingerprint.within(b, days, ["__day"])
    by = ["__day", "ent"]
    return fingerprint.differing(fingerprint.content(a, by), fingerprint.content(b, by), by).groupBy("ent").agg(F.min("__day").alias("since"))


def advance(parts: list[Part], inputs: Mapping[str, DataFrame], changed: Mapping[str, DataFrame], path: str, generation: int) -> DataFrame:
    """Bring the stored ledger up to the new inputs: rows of changed entities from their first change on are replaced.

    inputs: the whole inputs as they are now; changed: (ent, since) by input, where since is not after any row
    that the change can reach. A part reads all rows of the changed entities, as its rows may look back. Stored rows
    are neither read nor written again: the generation holds the new ones and names the entities it replaces.
    """
    spark = next(iter(inputs.values())).sparkSession
    reach: dict[tuple[str, ...], DataFrame] = {}
    fresh: dict[str, DataFrame] = {}
    replaced = None
    for part in parts:
        names = tuple(name for name in part.inputs if name in changed)
        if not names:
            continue
        if names not in reach:
            every = functools.reduce(DataFrame.unionByName, (changed[name] for name in names))
            reach[names] = saved(every.where("ent is not null").groupBy("ent").agg(F.min("since").alias("since")), "since")
        since = reach[names]
        own = {name: inputs[name].join(since, "ent", "left_semi") for name in part.inputs}
        fresh[part.name] = part.rows(own, _dealt_since(since))
        gone = since.select(F.lit(part.name).alias("part"), F.col("ent").cast("string").alias("entity_id"), "since")
        replaced = gone if replaced is None else replaced.unionByName(gone)
    if fresh:
        _written_parts(spark, fresh, path, generation, replaced)
    return read_ledger(spark, path)


def _dealt_since(since: DataFrame) -> Deal:
    """Rows from the day of their entity on, by month."""
    first = since.select("ent", F.col("since").alias("__since"))
    return lambda rows, available: by_month(rows.join(first, "ent").where(available >= F.col("__since")), available)


def review(ledger: DataFrame, scope: DataFrame) -> DataFrame:
    """ent, records, negatives, insufficient, last_available, clear: of every entity in scope, those without rows included.

    clear: it has evidence, none of it negative.
    """
    value = F.get_json_object("payload", "$.value")
    bad = F.lit(False)
    for kind, only in NEGATIVE.items():
        bad = bad | ((F.col("evidence_type") == kind) & (F.lit(True) if only is None else F.coalesce(value == only, F.lit(False))))
    got = ledger.groupBy("entity_id").agg(F.count("*").alias("records"), F.count_if(bad).alias("negatives"), F.count_if(F.col("availability_state") == INSUFFICIENT).alias("insufficient"), F.max("available_date").alias("last_available"))
    rows = scope.select("ent").distinct().join(got, F.col("ent").cast("string") == F.col("entity_id"), "left")
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.select("ent", n("records"), n("negatives"), n("insufficient"), "last_available", F.coalesce((F.col("records") > 0) & (F.col("negatives") == 0), F.lit(False)).alias("clear"))


def manifest(ledger: DataFrame) -> DataFrame:
    """part, n, entities, insufficient, first and last availability, fingerprint f1, f2 of each part."""
    facts = ledger.groupBy("part").agg(F.count_distinct("entity_id").alias("entities"), F.count_if(F.col("availability_state") == INSUFFICIENT).alias("insufficient"), F.min("available_date").alias("first_available"), F.max("available_date").alias("last_available"))
    return fingerprint.content(ledger, ["part"]).join(facts, "part")
