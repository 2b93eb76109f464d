"""A registry snapshot in one run: validation, identity, mapping to entities, events with their availability, exclusions, summary.

No row is dropped on the way. Every input row ends in one state, so that the counts add up to the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.functions import scalars as S
from chronolake.sources.scratch import saved

from . import intervals
from .contracts import require_columns
from .registry import dictionary_matches

#: Availability bases, the date that each takes, and the state of events that rest on it.
BASES = {
    "PUBLICATION_DATE_EXPLICIT": ("published", "HISTORICAL_RECONSTRUCTABLE"),
    "OFFICIAL_APPROVAL_DATE_EXPLICIT": ("approved", "HISTORICAL_RECONSTRUCTABLE"),
    "FIRST_OBSERVED_SNAPSHOT_DATE": ("captured", "PROSPECTIVE_FIRST_OBSERVED_ONLY"),
}
#: What becomes of a row, in the order in which it is decided.
STATES = ("INVALID", "CONFLICT", "REPEAT", "UNMAPPED", "EXCLUDED", "EVENT")


def _per_basis(pick: int) -> Column:
    out = None
    for basis, found in BASES.items():
        value = F.col(found[0]) if pick == 0 else F.lit(found[1])
        out = F.when(F.col("basis") == basis, value) if out is None else out.when(F.col("basis") == basis, value)
    return out


def checked(rows: DataFrame, catalog: DataFrame, taken: Column) -> DataFrame:
    """rows with broken (the rules each breaks), record_id and available. catalog: source, categories, basis (one row a source)."""
    require_columns(rows, ["row", "source", "category", "basis", "own_id", "applicant", "published", "approved", "captured"])
    known = catalog.select("source", F.col("categories").alias("__categories"), F.col("basis").alias("__basis"))
    r = rows.join(known, "source", "left").withColumn("available", _per_basis(0))
    missing = F.col("__basis").isNull()
    rules = {
        "SOURCE_UNKNOWN": missing,
        "CATEGORY_NOT_OF_SOURCE": ~missing & ~F.coalesce(F.array_contains("__categories", F.col("category")), F.lit(False)),
        "BASIS_NOT_OF_SOURCE": ~missing & ~F.col("__basis").eqNullSafe(F.col("basis")),
        "DATE_MISSING": F.col("available").isNull(),
        "CAPTURED_ANOTHER_DAY": (F.col("basis") == "FIRST_OBSERVED_SNAPSHOT_DATE") & (F.col("captured") != taken),
    }
    broken = F.array_join(F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()))), ",")
    content = S.stable_hash(F.col("source"), F.col("category"), F.col("applicant"), F.col("available"))
    identity = F.when(F.trim("own_id") != "", F.concat(F.col("source"), F.lit(":"), F.trim("own_id"))).otherwise(F.concat(F.lit("H:"), F.left(content, F.lit(24))))
    return r.withColumns({"broken": broken, "record_id": identity, "content": content}).drop("__categories", "__basis")


def materialised(rows: DataFrame, catalog: DataFrame, names: DataFrame, members: DataFrame, taken: Column) -> tuple[DataFrame, DataFrame]:
    """(lineage: row, record_id, state, reason; events: record_id, ent, category, available, availability_state).

    rows: row (unique), source, category, basis, own_id (the registry's id, may be empty), applicant, published,
    approved, captured; names: name, ent; members: ent, s, e. Rows of one identity and one content count once, the
    least row stands; with two contents all are in conflict, and none is chosen. A record is an event of every entity
    that its applicant field names and that is a member on the day it became available.
    """
    r = saved(checked(rows, catalog, taken), "checked")
    sound = r.where("broken = ''")
    ids = sound.groupBy("record_id").agg(F.count_distinct("content").alias("contents"), F.min("row").alias("first"))
    r = r.join(ids, "record_id", "left")
    single = r.where("broken = '' and contents = 1 and row = first")
    mapped = dictionary_matches(single.select("record_id", "applicant"), "record_id", "applicant", names).select("record_id", "ent").distinct()
    held = mapped.join(single.select("record_id", "category", "available", _per_basis(1).alias("availability_state")), "record_id")
    inside = intervals.interval_join(held, members, "ent", "available").select(*held.columns).distinct()
    events = saved(inside, "events")
    reached = mapped.select("record_id").distinct().withColumn("__mapped", F.lit(True))
    kept = events.select("record_id").distinct().withColumn("__event", F.lit(True))
    out = r.join(reached, "record_id", "left").join(kept, "record_id", "left")
    state = (
        F.when(F.col("broken") != "", "INVALID").when(F.col("contents") > 1, "CONFLICT").when(F.col("row") != F.col("first"), "REPEAT")
        .when(F.col("__mapped").isNull(), "UNMAPPED").when(F.col("__event").isNull(), "EXCLUDED").otherwise("EVENT")
    )
    reason = F.when(F.col("broken") != "", F.col("broken")).when(state == "EXCLUDED", "NOT_A_MEMBER_WHEN_AVAILABLE")
    return out.select("row", "record_id", state.alias("state"), reason.alias("reason")), events


def summary(lineage: DataFrame, events: DataFrame) -> DataFrame:
    """One row: input_rows, one count a state, and events, entities and categories of the snapshot."""
    states = lineage.agg(F.count("*").alias("input_rows"), *(F.count_if(F.col("state") == s).alias(s.lower()) for s in STATES))
    made = events.agg(F.count("*").alias("events"), F.count_distinct("ent").alias("entities"), F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"))
    return states.join(F.broadcast(made), F.lit(True))
