"""Functions that a caller hands in, run where the rows are: fetchers, document loaders, producers of chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fetched(requests: DataFrame, fetch: Callable[[dict], Iterable[dict]], schema: str) -> DataFrame:
    """Rows that fetch gives for each request (a dict of its columns), with columns ok and error beside those of schema.

    A request whose fetch raises gives one row with ok false and the error; one that gives nothing gives no row.
    fetch runs in the tasks, so it must hold no session, and it may run again when a task does.
    """
    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for request in frame.to_dict("records"):
                try:
                    out += [{**{n: row.get(n) for n in names}, "ok": True, "error": None} for row in fetch(request)]
                except Exception as e:  # the caller's code: its failure is a row, not the end of the job
                    out.append({**{n: request.get(n) for n in names}, "ok": False, "error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(out, columns=[*names, "ok", "error"])

    return requests.mapInPandas(run, f"{schema}, ok boolean, error string")


def loaded_documents(asked: DataFrame, store: DataFrame, key: str, text: str) -> DataFrame:
    """key, state, n, document_sha256 of every document asked for, from a store of texts by key.

    MISSING where the store has no such key, EMPTY where its text is null or empty, CONFLICT where it has several
    texts, else LOADED; only loaded documents have a length and a hash. A key that is asked for twice comes once.
    """
    known = store.groupBy(key).agg(F.count_distinct(text).alias("__n"), F.max(text).alias("__text"))
    rows = asked.select(key).distinct().join(known.withColumn("__known", F.lit(True)), key, "left")
    state = F.when(F.col("__known").isNull(), "MISSING").when(F.col("__n") > 1, "CONFLICT").when(F.coalesce("__text", F.lit("")) == "", "EMPTY").otherwise("LOADED")
    rows = rows.withColumn("state", state)
    own = F.when(F.col("state") == "LOADED", F.col("__text"))
    return rows.select(key, "state", F.length(own).cast("long").alias("n"), F.sha2(own, 256).alias("document_sha256"))


def produced_chunks(rows: DataFrame, keys: list[str], produce: Callable[[tuple, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """What produce gives for the rows of each chunk (one value of keys); a chunk must fit in a task."""
    return rows.groupBy(*keys).applyInPandas(produce, schema)
