"""Column and value contracts: plan-time checks, rule columns, and the strict form that raises."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """df itself if it has all the columns; fails while the plan is built."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break a rule, with the ids of all rules they break in the column broken. A rule is true where broken."""
    broken = F.filter(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules.items())), lambda x: x.isNotNull())
    return df.withColumn("broken", broken).where(F.size("broken") > 0)


def strict(df: DataFrame, rules: Mapping[str, Column], key: str) -> DataFrame:
    """df whose column key raises on the first row that breaks a rule; key must be kept by what follows."""
    out = F.col(key)
    for name, rule in rules.items():
        out = F.when(rule, F.raise_error(F.lit(f"{name} violated")).cast(df.schema[key].dataType)).otherwise(out)
    return df.withColumn(key, out)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count n."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key under a total order; never an arbitrary survivor."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
