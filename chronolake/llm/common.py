"""Shared helpers: scratch tables, table readers and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.sources.scratch import new_path

#: Links that a task joins into trees, 16 bytes each.
TREE_LINKS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again: cuts the lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before them as make them new in df (names differ by more than case)."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its tree) of the links u - v."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(ids))
    while True:
        x, y = low[a], low[b]
        if (x == y).all():
            return ids, ids[low]
        # of two roots the larger goes under the smaller, then every node straight under its root
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low = low[low]


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a part as (node, smallest node of its tree)."""
    both = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
    if both:
        node, low = forest(*(np.concatenate(x) for x in zip(*both)))
        below = node != low
        yield pa.RecordBatch.from_arrays([pa.array(node[below]), pa.array(low[below])], ["u", "v"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list: trees within parts, then alternating large-star and small-star steps.

    The edges are dealt by their hash into parts of about TREE_LINKS, so a hub spreads over all parts; a task leaves
    one edge a node of its part. That goes on while it halves the edges; once one part holds all that are left, its
    trees are the components. The star steps, for what stays larger, are a minimum per node and an equi-join, so a
    hub is one skewed join key that AQE splits; no group is ever gathered in a list. Nodes are longs. Returns (node, component): component is the smallest node id that can be reached.
    Only nodes with an edge to another node appear.
    """
    now = saved(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )

    def mark(df: DataFrame):
        row = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        return row["n"], row["x"]

    links, deals = now.count(), 0
    while links > TREE_LINKS:
        deals += 1
        dealt = now.repartition(-(-links // TREE_LINKS), F.xxhash64("u", "v", F.lit(deals)))
        now = saved(dealt.mapInArrow(_trees, "u long, v long").distinct(), "trees")
        was, links = links, now.count()
        if links * 2 > was:
            break
    if links <= TREE_LINKS:
        # one part by number, not by key: all links meet in it
        now = saved(now.repartition(1).mapInArrow(_trees, "u long, v long"), "trees") if links else now
        before = (0, None)
    else:
        before = mark(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        now = saved(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        after = mark(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
