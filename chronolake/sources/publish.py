"""Publishing tables: schema allowlists, content manifests, chunked materialisation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from chronolake.functions import fingerprint
from chronolake.operators import gates

from .scratch import saved

RUNTIME = re.compile(r"^(runtime_|run_)|_elapsed$|^generated_at$|^hostname$")
OUTCOME = re.compile(r"(forward|future|outcome|label|target)_?", re.I)


def canonical_columns(df: DataFrame) -> DataFrame:
    """df without columns that describe a run, not the data."""
    return df.drop(*[c for c in df.columns if RUNTIME.search(c)])


def allowlist(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly the given columns; a name that sounds like an outcome is refused while the plan is built."""
    bad = [c for c in columns if OUTCOME.search(c)]
    if bad:
        raise ValueError(f"columns not allowed: {bad}")
    return df.select(*columns)


def content_hash(df: DataFrame) -> DataFrame:
    """One row: n, f1, f2, an order-free fingerprint of the content that sees repeated rows."""
    return fingerprint.content(df)


def written(df: DataFrame, path: str, name: str, day: str | None = None) -> dict:
    """Write df and return dataset, n, f1, f2, columns, latest: figures of the very rows that were written, from the pass that wrote them."""
    h1, h2 = fingerprint.row_hashes(df)
    watch = Observation(f"written-{name}")
    total = lambda h: F.sum(h.cast("decimal(20,0)"))
    last = F.max(F.col(day).cast("date") if day else F.lit(None).cast("date")).cast("string")
    df.observe(watch, F.count(F.lit(1)).alias("n"), total(h1).alias("s1"), total(h2).alias("s2"), last.alias("latest")).write.mode("overwrite").parquet(f"{path}/{name}")
    got = watch.get
    mod = lambda x, p: int(x or 0) % p
    return {"dataset": name, "n": got["n"], "f1": mod(got["s1"], fingerprint.PRIMES[0]), "f2": mod(got["s2"], fingerprint.PRIMES[1]), "columns": ",".join(sorted(df.columns)), "latest": got["latest"]}


MANIFEST = "dataset string, n long, f1 long, f2 long, columns string, latest string"


def publish(datasets: dict[str, DataFrame], path: str, columns: dict[str, list[str]] | None = None, days: dict[str, str] | None = None) -> DataFrame:
    """Write each dataset below path and return the manifest, a row a dataset: n, fingerprint, columns, latest day.

    columns: the allowlist of each dataset; a dataset without one, a missing dataset or a column off the list is refused
    before anything is written. days: the column of the day of a dataset.
    """
    if columns is not None:
        if set(columns) != set(datasets):
            raise ValueError(f"datasets must be {sorted(columns)}, got {sorted(datasets)}")
        for name, df in datasets.items():
            if sorted(df.columns) != sorted(columns[name]):
                raise ValueError(f"columns of {name} must be {columns[name]}, got {df.columns}")
            allowlist(df, columns[name])
    rows = [written(df, path, name, (days or {}).get(name)) for name, df in sorted(datasets.items())]
    spark = next(iter(datasets.values())).sparkSession
    return spark.createDataFrame([[r[f] for f in ("dataset", "n", "f1", "f2", "columns", "latest")] for r in rows], MANIFEST)


def matches_manifest(path: str, manifest: DataFrame) -> DataFrame:
    """dataset, same: whether what is stored still has the size and fingerprint of its manifest."""
    spark, out = manifest.sparkSession, None
    for row in manifest.collect():
        back = fingerprint.content(spark.read.parquet(f"{path}/{row['dataset']}"))
        one = back.select(F.lit(row["dataset"]).alias("dataset"), ((F.col("n") == row["n"]) & (F.col("f1") == row["f1"]) & (F.col("f2") == row["f2"])).alias("same"))
        out = one if out is None else out.unionByName(one)
    return out


def publish_bundle(bars: DataFrame, universe: DataFrame, path: str, key: str = "symbol", day: str = "date", floor: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """(manifest, quality) of a market bundle; refused if its universe is no point-in-time one or a coverage is below floor.

    universe: key, effective_start, effective_end (null: open), universe_mode.
    """
    if not {"effective_start", "effective_end", "universe_mode"} <= set(universe.columns):
        raise ValueError("a universe without intervals is no point-in-time universe")
    modes = [r[0] for r in universe.select("universe_mode").distinct().limit(3).collect()]
    if modes != ["point_in_time"]:
        raise ValueError(f"universe mode must be point_in_time, got {modes}")
    quality = saved(gates.market_quality(bars, universe, key, day, floor), "quality")
    figures = quality.first()
    if not figures["passed"]:
        raise ValueError(f"coverage below {floor}: {figures.asDict()}")
    return publish({"prices": bars, "universe": universe}, path, days={"prices": day}), quality


def missing_chunks(expected: DataFrame, receipts: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks without a complete receipt."""
    return expected.join(receipts.where("complete"), keys, "left_anti")


def permanent_chunks(rows: DataFrame, expected: DataFrame, chunk: str, keys: list[str], value: str) -> DataFrame:
    """chunk, expected, missing, nulls, permanent: a chunk may be reused only if every key is there with a value."""
    got = rows.select(*keys, F.lit(True).alias("there"), F.col(value).isNull().alias("empty")).distinct()
    both = expected.join(got, keys, "left")
    g = both.groupBy(chunk).agg(F.count("*").alias("expected"), F.count_if(F.col("there").isNull()).alias("missing"), F.count_if(F.coalesce("empty", F.lit(False))).alias("nulls"))
    return g.withColumn("permanent", (F.col("missing") == 0) & (F.col("nulls") == 0))


def write_chunks(df: DataFrame, path: str, chunk: str) -> None:
    """Write by chunk, replacing only the chunks that df holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(chunk).parquet(path)
