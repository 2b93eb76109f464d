"""Archives of notices as rows with accounting: keyword searches in stages, and increments between two dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .combine import keyword_hits


def keyword_archive(rows: DataFrame, ident: str, text: str, words: list[str], scope: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(archive: rows with keyword, each ident once; stages: keyword, hits, notices, candidates, kept of each keyword).

    hits: rows that hold the keyword, repeats included; notices: distinct idents; candidates: those of an entity in scope;
    kept: those that no keyword earlier in the list has taken. Keywords without hits have zeros. Of rows of one ident
    that differ the least counts.
    """
    tagged = keyword_hits(rows, text, words)
    rest = [c for c in rows.columns if c != ident]
    once = tagged.groupBy(ident, "keyword").agg(F.count("*").alias("__hits"), F.min(F.struct(*rest)).alias("__r")).select(ident, "keyword", "__hits", "__r.*")
    inside = once.join(scope.select(key).distinct().withColumn("__in", F.lit(True)), key, "left").withColumn("__in", F.coalesce("__in", F.lit(False)))
    rank = F.array_position(F.array(*(F.lit(w) for w in words)), F.col("keyword"))
    first = F.min(F.when(F.col("__in"), rank)).over(Window.partitionBy(ident))
    marked = inside.withColumn("__kept", F.col("__in") & (rank == first))
    counts = marked.groupBy("keyword").agg(F.sum("__hits").alias("hits"), F.count("*").alias("notices"), F.count_if("__in").alias("candidates"), F.count_if("__kept").alias("kept"))
    every = rows.sparkSession.createDataFrame([(w,) for w in words], "keyword string").join(counts, "keyword", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return marked.where("__kept").select(*rows.columns, "keyword"), every.select("keyword", zero("hits"), zero("notices"), zero("candidates"), zero("kept"))


def increment(rows: DataFrame, scope: DataFrame, baseline: Column, target: Column, key: str = "ent") -> tuple[DataFrame, DataFrame]:
    """(captured: rows with state; accounting: key, documents, facts, pending, duplicates, status of every entity in scope).

    rows: key, doc, fact, event_date, available, ...; those with baseline < event_date <= target count. A row that is not
    yet available at the target stays as a row in state NOT_YET_AVAILABLE; a fact that a document states more than once is
    a DUPLICATE_FACT, all of its rows. Status: EMPTY, DUPLICATE, PENDING or COMPLETE, the first that holds.
    """
    window = rows.where((F.col("event_date") > baseline) & (F.col("event_date") <= target))
    n = F.count("*").over(Window.partitionBy(key, "doc", "fact"))
    state = F.when(n > 1, "DUPLICATE_FACT").when(F.coalesce(F.col("available") <= target, F.lit(False)), "AVAILABLE").otherwise("NOT_YET_AVAILABLE")
    captured = window.withColumn("state", state)
    of = lambda s: F.count_if(F.col("state") == s)
    g = captured.groupBy(key).agg(F.count_distinct("doc").alias("documents"), of("AVAILABLE").alias("facts"), of("NOT_YET_AVAILABLE").alias("pending"), of("DUPLICATE_FACT").alias("duplicates"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    status = F.when(F.col("documents").isNull(), "EMPTY").when(F.col("duplicates") > 0, "DUPLICATE").when(F.col("pending") > 0, "PENDING").otherwise("COMPLETE")
    return captured, scope.select(key).distinct().join(g, key, "left").select(key, zero("documents"), zero("facts"), zero("pending"), zero("duplicates"), status.alias("status"))
