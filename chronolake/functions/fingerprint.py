"""Fingerprints of tables as multisets, and the search for what differs between two tables by descending a tree of them.

A row has two 64-bit hashes; a set of rows has their sums modulo two primes and its size. Sums merge over any
parts, do not depend on order, and see how often a row occurs, which an exclusive or does not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolake.sources.scratch import saved

#: Two primes below 2**63.
PRIMES = ((1 << 61) - 1, 10**18 + 9)


def row_hashes(df: DataFrame, columns: list[str] | None = None) -> tuple[Column, Column]:
    """Two hashes of the values of a row, by sorted column name; null differs from every value."""
    names = sorted(columns if columns is not None else df.columns)
    values = [F.col(f"`{c}`").cast("string") for c in names]
    gaps = F.concat(F.lit("."), *(F.when(v.isNull(), "n").otherwise("v") for v in values))
    return F.xxhash64(gaps, *values), F.xxhash64(F.lit("second"), *values, gaps)


def _modulo(total: Column, prime: int) -> Column:
    return F.coalesce(F.pmod(total, F.lit(prime).cast("decimal(38,0)")), F.lit(0)).cast("long")


def content(df: DataFrame, by: list[str] | None = None, values: list[str] | None = None) -> DataFrame:
    """by, n, f1, f2: the fingerprint of each group of rows, or one row for all; values: the columns that count."""
    by = by or []
    h1, h2 = row_hashes(df, values if values is not None else [c for c in df.columns if c not in by])
    rows = df.select(*by, h1.cast("decimal(20,0)").alias("__h1"), h2.cast("decimal(20,0)").alias("__h2"))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), _modulo(F.sum("__h1"), PRIMES[0]).alias("f1"), _modulo(F.sum("__h2"), PRIMES[1]).alias("f2"))


def merged(prints: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Fingerprints of larger groups from those of their parts."""
    whole = lambda c, p: _modulo(F.sum(F.col(c).cast("decimal(20,0)")), p).alias(c)
    return prints.groupBy(*(by or [])).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), whole("f1", PRIMES[0]), whole("f2", PRIMES[1]))


def differing(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """by, n1, n2: groups whose fingerprints are not the same in both; null keys are keys."""
    one = a.select(*(F.col(c).alias(f"__{c}") for c in by), F.col("n").alias("n1"), F.struct("n", "f1", "f2").alias("__p1"))
    two = b.select(*by, F.col("n").alias("n2"), F.struct("n", "f1", "f2").alias("__p2"))
    met = F.lit(True)
    for c in by:
        met = met & F.col(f"__{c}").eqNullSafe(F.col(c))
    both = one.join(two, met, "full_outer").where(~F.coalesce(F.col("__p1") == F.col("__p2"), F.lit(False)))
    return both.select(*(F.when(F.col("__p2").isNull(), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in by), "n1", "n2")


def within(df: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Rows of the given groups; null keys are keys."""
    keys = groups.select(*(F.col(c).alias(f"__{c}") for c in by)).distinct()
    met = F.lit(True)
    for c in by:
        met = met & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return df.join(keys, met, "left_semi")


def changed_rows(earlier: DataFrame, later: DataFrame, levels: list[str], key: str, known: DataFrame | None = None) -> DataFrame:
    """levels, key, n1, n2, change (ADDED, REMOVED, CHANGED): what differs, found from the coarsest level down.

    Each level compares fingerprints of groups and only the groups that differ are read again for the next, so
    equal days cost one aggregation. known: stored fingerprints of earlier by the first level, which spare even
    that. A row that only occurs more often is CHANGED.
    """
    by: list[str] = []
    for level in levels:
        by = [*by, level]
        before = known if known is not None and len(by) == 1 else content(earlier, by)
        groups = saved(differing(before, content(later, by), by), "groups")
        earlier, later = within(earlier, groups, by), within(later, groups, by)
    by = [*by, key]
    rows = differing(content(earlier, by), content(later, by), by)
    change = F.when(F.col("n1").isNull(), "ADDED").when(F.col("n2").isNull(), "REMOVED").otherwise("CHANGED")
    return rows.withColumn("change", change)
