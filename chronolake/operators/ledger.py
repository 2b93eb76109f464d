"""The bitemporal evidence ledger: validation, as-of replay, append, audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.functions import fingerprint

from .contracts import require_columns, violations

REQUIRED = ["evidence_id", "entity_id", "evidence_type", "event_date", "available_date", "source_identity", "document_id", "ingestion_id", "availability_state"]
STATES = ("AVAILABLE", "DELAYED", "FIRST_OBSERVED", "HISTORICAL_RECONSTRUCTABLE", "DATA_INSUFFICIENT")


def record_rules() -> dict[str, Column]:
    empty = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    rules = {f"{c}_EMPTY": empty(c) for c in REQUIRED}
    rules["AVAILABLE_BEFORE_EVENT"] = F.col("available_date") < F.col("event_date")
    rules["STATE_UNKNOWN"] = ~F.col("availability_state").isin(*STATES)
    return rules


def invalid_records(ledger: DataFrame) -> DataFrame:
    """evidence_id, broken: rule ids of rows that break a rule, duplicates of either id included."""
    require_columns(ledger, REQUIRED)
    rows = violations(ledger, record_rules()).select("evidence_id", F.explode("broken").alias("rule"))
    for c in ("evidence_id", "ingestion_id"):
        # ids of repeated keys are joined back, so a key that all rows share is gathered nowhere
        twice = ledger.groupBy(F.col(c).alias("__key")).agg(F.count("*").alias("__n")).where("__n > 1")
        met = ledger.join(twice, F.col(c).eqNullSafe(F.col("__key")), "left_semi")
        rows = rows.unionByName(met.select("evidence_id", F.lit(f"{c}_TWICE").alias("rule")).distinct())
    return rows.groupBy("evidence_id").agg(F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("broken"))


def as_of(ledger: DataFrame, date: Column) -> DataFrame:
    """Rows available by a date. The filter reaches the scan; a ledger partitioned by availability prunes."""
    return ledger.where(F.col("available_date") <= date)


def day_fingerprints(ledger: DataFrame) -> DataFrame:
    """available_date, n, f1, f2: an order-free fingerprint of the rows of each day, repeats included."""
    return fingerprint.content(ledger, ["available_date"])


def changed_days(earlier: DataFrame, later: DataFrame, cut: Column) -> DataFrame:
    """available_date, n1, n2: days up to cut whose rows differ between two ledgers. Replay of a prefix must give the same rows."""
    return fingerprint.differing(day_fingerprints(as_of(earlier, cut)), day_fingerprints(as_of(later, cut)), ["available_date"])


def changed_records(earlier: DataFrame, later: DataFrame, cut: Column, known: DataFrame | None = None) -> DataFrame:
    """available_date, entity_id, evidence_id, n1, n2, change: the rows behind `changed_days`, found by day, then entity, then id.

    known: stored fingerprints of the days of earlier, so that its equal days are not read at all.
    """
    return fingerprint.changed_rows(as_of(earlier, cut), as_of(later, cut), ["available_date", "entity_id"], "evidence_id", known)


def merge_append(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows by outcome: INSERT for a new key, SAME for an equal row, CONFLICT for any difference."""
    values = [c for c in existing.columns if c != key]
    old = existing.select(F.col(key).alias("__key"), F.struct(*values).alias("__old"))
    rows = new.join(old, F.col(key) == F.col("__key"), "left")
    outcome = F.when(F.col("__key").isNull(), "INSERT").when(F.struct(*values).eqNullSafe(F.col("__old")), "SAME").otherwise("CONFLICT")
    return rows.withColumn("outcome", outcome).drop("__key", "__old")


def audit(ledger: DataFrame) -> DataFrame:
    """One row of ledger properties and bounds."""
    flag = lambda c: F.coalesce(F.bool_and(c), F.lit(True))
    main = ledger.agg(
        F.count("*").alias("n"),
        (F.count_distinct("evidence_id") == F.count("*")).alias("evidence_ids_unique"),
        (F.count_distinct("ingestion_id") == F.count("*")).alias("ingestion_ids_unique"),
        flag(F.col("available_date") >= F.col("event_date")).alias("never_available_early"),
        flag(F.col("availability_state").isin(*STATES)).alias("states_known"),
        flag(F.col("document_id").isNotNull() & (F.col("document_id") != "")).alias("documents_named"),
        flag(F.try_parse_json("provenance").isNotNull()).alias("provenance_parses"),
        F.min("available_date").alias("first_available"),
        F.max("available_date").alias("last_available"),
        F.count_distinct("entity_id").alias("entities"),
    )
    return main


def keep_available(rows: DataFrame, publication: str, cal: DataFrame) -> DataFrame:
    """Rows published by the close of the last session, with keep false for later, date-only or after-close ones on it."""
    last = cal.agg(F.max("d").alias("last"))
    rows = rows.crossJoin(F.broadcast(last))
    day = F.try_to_timestamp(F.col(publication)).cast("date")
    clock = F.date_format(F.try_to_timestamp(F.col(publication)), "HH:mm:ss")
    on_time = F.col(publication).rlike(r"\d{1,2}:\d{2}") & (clock <= "15:00:00")
    return rows.withColumn("keep", F.coalesce((day < F.col("last")) | ((day == F.col("last")) & on_time), F.lit(False))).drop("last")
