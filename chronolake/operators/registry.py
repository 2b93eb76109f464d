"""Mapping and accounting of registry rows, shards and states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dictionary_matches(rows: DataFrame, key: str, field: str, names: DataFrame) -> DataFrame:
    """key, name, ent: the whole field if it is a name, else each of its tokens that is one.

    Tokens stand between ; ； 、 or newlines. names: name, ent.
    """
    whole = rows.select(key, F.trim(field).alias("name")).join(names, "name")
    tokens = rows.select(key, F.explode(F.array_distinct(F.transform(F.split(field, "[;；、\n]"), lambda t: F.trim(t)))).alias("name"))
    parts = tokens.join(names, "name").join(whole.select(key).distinct(), key, "left_anti")
    return whole.select(key, "name", "ent").unionByName(parts.select(key, "name", "ent"))


def worst_state(rows: DataFrame, item: str, state: str, order: list[str]) -> DataFrame:
    """The worst state of each item; order lists states from worst to best."""
    rank = F.array_position(F.array(*(F.lit(s) for s in order)), F.col(state))
    return rows.groupBy(item).agg(F.element_at(F.array(*(F.lit(s) for s in order)), F.min(rank).cast("int")).alias(state))


def shard_states(scope: DataFrame, shards: DataFrame, key: str, shard: str) -> DataFrame:
    """key, shards, state of each key of a scope: OK in exactly one shard, else LOST or IN_TWO_SHARDS."""
    g = scope.join(shards.select(key, shard).distinct(), key, "left").groupBy(key).agg(F.count(shard).alias("shards"))
    return g.select(key, "shards", F.when(F.col("shards") > 1, "IN_TWO_SHARDS").when(F.col("shards") == 0, "LOST").otherwise("OK").alias("state"))
