"""Versioned facts over two time axes: trailing values, trends and states at each knowledge date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import asof


def prior_comparable(facts: DataFrame, keys: list[str], period: str, available: str, value: str) -> DataFrame:
    """Each fact with the value of the same period a year before, as known when the fact became available.

    Period ends are month ends, so a year back is add_months(.., -12) on the last day of the month.
    """
    now = facts.withColumn("__period", F.last_day(F.add_months(period, -12))).withColumnRenamed(value, "__now").withColumnRenamed(period, "__p")
    past = facts.select(*keys, F.col(period).alias("__period"), F.col(available).alias("__av"), F.col(value).alias("prior_value"))
    out = asof.backward(now, past, [*keys, "__period"], available, "__av", ["prior_value"])
    return out.withColumnRenamed("__now", value).withColumnRenamed("__p", period).drop("__period", "asof_time")


def yearly_trend(facts: DataFrame, keys: list[str], period: str, available: str, value: str) -> DataFrame:
    """Relative change against the prior comparable; a zero or missing prior gives no row."""
    rows = prior_comparable(facts, keys, period, available, value).where("prior_value <> 0")
    return rows.withColumn("change", F.round((F.col(value) - F.col("prior_value")).cast("double") / F.abs("prior_value").cast("double"), 6))


def knowledge_dates(facts: DataFrame, keys: list[str], available: str) -> DataFrame:
    return facts.select(*keys, available).distinct()


def state_facts(facts: DataFrame, entity: str, period: str, kind: str, available: str, value: str, kinds: list[str]) -> DataFrame:
    """For each entity, period and knowledge date of that period, the values of all kinds known then, one column a kind, and missing.

    Cutoffs are the availability dates of the period itself; every kind is looked up as of each cutoff in one pass.
    """
    cuts = facts.select(entity, period, F.col(available).alias("cut")).distinct()
    asked = cuts.withColumn(kind, F.explode(F.array(*(F.lit(k) for k in kinds))))
    known = asof.backward(asked, facts.select(entity, period, kind, available, value), [entity, period, kind], "cut", available, [value])
    wide = known.groupBy(entity, period, "cut").agg(*(F.max(F.when(F.col(kind) == k, F.col(value))).alias(f"v{i}") for i, k in enumerate(kinds)))
    lost = F.array(*(F.when(F.col(f"v{i}").isNull(), F.lit(k)) for i, k in enumerate(kinds)))
    return wide.withColumn("missing", F.array_join(F.filter(lost, lambda x: x.isNotNull()), ","))


def trailing_value(facts: DataFrame, keys: str | list[str], period: str, available: str, value: str) -> DataFrame:
    """Trailing-twelve-month value known from each availability date of a key: keys, available, period, ttm.

    keys: an entity, or an entity and a fact type, each with values of its own. A fourth-quarter period stands for itself; an earlier one is last year's whole + its own - its comparable, each
    as known then; a missing part gives null. Values are cumulative within a year. A later date never goes back
    to an older period.
    """
    keys = [keys] if isinstance(keys, str) else keys
    w = Window.partitionBy(*keys).orderBy(available).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    times = facts.groupBy(*keys, available).agg(F.max(period).alias("__p")).withColumn("latest", F.max("__p").over(w)).drop("__p")
    year = F.year("latest")
    parts = F.array(
        F.struct(F.lit("now").alias("part"), F.col("latest").alias(period)),
        F.struct(F.lit("year").alias("part"), F.make_date(year - 1, F.lit(12), F.lit(31)).alias(period)),
        F.struct(F.lit("comparable").alias("part"), F.last_day(F.add_months("latest", -12)).alias(period)),
    )
    asked = times.select(*keys, F.col(available).alias("__cut"), "latest", F.explode(parts).alias("x")).select(*keys, "__cut", "latest", "x.*")
    known = asof.backward(asked, facts.select(*keys, period, available, value), [*keys, period], "__cut", available, [value])
    wide = known.groupBy(*keys, "__cut", "latest").agg(*(F.max(F.when(F.col("part") == p, F.col(value))).alias(p) for p in ("now", "year", "comparable")))
    ttm = F.when(F.month("latest") == 12, F.col("now")).otherwise(F.col("year") + F.col("now") - F.col("comparable"))
    return wide.select(*keys, F.col("__cut").alias(available), F.col("latest").alias(period), ttm.alias("ttm"))
