"""Rows dealt over the cluster before they grow: a small file is one task, whatever is made of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def by_key(rows: DataFrame, *keys: str) -> DataFrame:
    """rows in as many parts as shuffles have, by key; windows and groups by the key that follow need no other exchange.

    The number is given, as adaptive execution would join small parts to few again.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), *keys)
