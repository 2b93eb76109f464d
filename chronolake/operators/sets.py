"""Set operations between keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """keys, side: both, left_only or right_only, of two sets of keys."""
    a = left.select(*keys).distinct().withColumn("__l", F.lit(1))
    b = right.select(*keys).distinct().withColumn("__r", F.lit(1))
    side = F.when(F.col("__l").isNull(), "right_only").when(F.col("__r").isNull(), "left_only").otherwise("both")
    return a.join(b, keys, "full_outer").select(*keys, side.alias("side"))


def diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, change: added, removed or changed rows between two versions of a table; equal rows go."""
    values = [c for c in old.columns if c not in keys]
    a = old.select(*keys, F.struct(*values).alias("__old"), F.lit(1).alias("__l"))
    b = new.select(*keys, F.struct(*values).alias("__new"), F.lit(1).alias("__r"))
    change = F.when(F.col("__l").isNull(), "added").when(F.col("__r").isNull(), "removed").when(~F.col("__old").eqNullSafe(F.col("__new")), "changed")
    return a.join(b, keys, "full_outer").select(*keys, change.alias("change")).where("change is not null")


def append_disjoint(seed: DataFrame, fresh: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(union, overlap): the overlap of keys must be empty for the union to count."""
    return seed.unionByName(fresh), fresh.join(seed.select(key).distinct(), key, "left_semi").select(key).distinct()


def replace_part(rows: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """rows without the keys that fresh holds, and fresh."""
    return rows.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh)


def remove_ids(rows: DataFrame, drop: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows without the ids, ids that were not there)."""
    return rows.join(drop.select(key).distinct(), key, "left_anti"), drop.select(key).distinct().join(rows.select(key).distinct(), key, "left_anti")


def scope(parts: list[tuple[DataFrame, str, Column]]) -> DataFrame:
    """sym, scopes: union of keys with the sorted list of the tags under which each was found."""
    out = None
    for df, key, tag in parts:
        one = df.select(F.col(key).alias("sym"), tag.alias("tag")).where("sym is not null")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("sym").agg(F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("scopes"))


def conflicts(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys with more than one distinct set of values: keys, rows, variants. Repeats of equal rows do not count."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count_distinct(F.struct(*values)).alias("variants")).where("variants > 1")
