"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each document draws an exponential key, -ln(u) / weight, with u from a hash of its id, so that
reruns agree. A source's target is filled with complete epochs first; the fraction that is left takes
documents in key order up to a word budget. Key order inside a source is taken in slices of the
key: slice totals give each slice its start, and only the documents of one slice are sorted
together, so a source with a third of all rows is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, saved, table

#: Slices for each doubling of 1 + key: some ten thousand for a source at most, and none holds more than about a thousandth of it.
SLICES = 1 << 10
#: Weights of the sources in order, repeated; share of all words that the mix takes; most epochs of a source.
WEIGHTS, SHARE, EPOCHS = (3, 1, 2), 1.5, 2


def n_words(text):
    """Number of words of a text; null has none."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def quality_weight(text):
    """A weight in (0, 1]: lower the more of a text is symbols."""
    length = F.length(text)
    marks = length - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.when(F.coalesce(length, F.lit(0)) == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(5.0) * marks / length))


def uniform(column: str):
    """A number in (0, 1) from the id: 48 bits of its SHA-256."""
    bits = F.conv(F.substring(F.sha2(F.coalesce(F.col(column).cast("string"), F.lit("")), 256), 1, 12), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Word targets of sources (source, source_size): share of all words by weight, capped, the excess dealt again by weight.

    The rounds of capping end in a common level: min(cap, level x weight). Sources sorted by cap / weight
    give the level in closed form from running sums. One row a source, so the windows stay small.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1)
    rows = sizes.withColumn("w", pick).withColumn("cap", F.col("source_size").cast("double") * epochs)
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    rows = rows.withColumn("want", F.lit(share) * F.sum("source_size").over(Window.partitionBy()))
    rows = rows.withColumn("full", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    rows = rows.withColumn("open", F.sum("w").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    rows = rows.withColumn("level", (F.col("want") - F.col("full")) / F.col("open"))
    # the first source that its level does not fill sets the level of all that follow
    whole = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    reached = F.first(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level")), ignorenulls=True).over(whole)
    return rows.withColumn("at", reached).select("source", "source_size", F.when(F.col("at").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("at") * F.col("w"))).alias("target"))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, row: str | None = None) -> DataFrame:
    """How many words the mix takes of each document.

    docs: doc_id, text, source; more columns are ignored. Null texts and texts without words have size 0
    and are taken 0 times; null sources form one source, the last; rows that repeat an id count each and
    tie on the key, where equal rows are interchangeable; an empty table gives an empty result.
    Returns doc_id, size, source_size, target, taken, copies, and the column named row where one is given.
    """
    more = [row] if row else []
    slim = docs.select(*more, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), quality_weight(F.col("text")).alias("quality"))
    u = uniform("doc_id")
    # u ** (1 / weight) descending is the key ascending; a logarithm keeps low weights, whose keys are long, apart too
    slim = slim.withColumn("key", -F.ln(u) / F.col("quality"))
    slim = saved(slim.withColumn("slice", F.floor(F.log2(F.lit(1.0) + F.col("key")) * SLICES).cast("int")), "sizes")
    slices = saved(slim.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.count("*").alias("n")), "slices")
    sources = targets(slices.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, epochs)
    sources = sources.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    sources = saved(sources.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    run = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
    starts = starts.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # a slice lies inside the budget, beyond it, or on its edge; only edge slices need their documents in order
    starts = starts.withColumn("place", F.when(F.col("before") + F.col("words") <= F.col("budget"), 1).when(F.col("before") >= F.col("budget"), -1).otherwise(0))
    place = starts.select(F.col("source").alias("s"), F.col("slice").alias("b"), "before", "place", "source_size", "target", "whole", "budget")
    rows = slim.join(place, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("b"))).drop("s", "b")
    edge = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size", *more)
    ordered = rows.where("place = 0").withColumn("upto", F.col("before") + F.sum("size").over(edge.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # the document that crosses the budget is taken if its greater part lies inside
    ordered = ordered.withColumn("once", (F.col("upto") - F.col("size") / 2.0 <= F.col("budget")).cast("long")).drop("upto")
    out = ordered.unionByName(rows.where("place <> 0").withColumn("once", (F.col("place") == 1).cast("long")))
    copies = F.when(F.col("size") > 0, F.least(F.col("whole") + F.col("once"), F.lit(epochs))).otherwise(0)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"), copies.cast("long").alias("copies"), *more)


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken; sizes of 0 go.

    Rows are told apart by a written key, so ids may repeat or be null.
    """
    row, times, copy = fresh(docs, "taken_row", "taken_times", "taken_copy")
    docs = saved(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    taken = mixed(docs, **how, row=row).where("taken > 0").select(row, F.col("copies").alias(times))
    rows = docs.join(taken, row)
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).drop(row, times, copy)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


ORACLE_OP7 = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         CASE WHEN coalesce(length(text), 0) = 0 THEN 1.0::DOUBLE
              ELSE greatest(0.05::DOUBLE, 1.0::DOUBLE - 5.0::DOUBLE * (length(text) - length(translate(text, '#*$%&|<>', '')))::DOUBLE / length(text)::DOUBLE) END AS quality,
         ((('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT)::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u
  FROM documents),
k AS (SELECT *, -ln(u) / quality AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3 AS place FROM k GROUP BY source),
w AS (SELECT source, source_size, CASE place WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
             row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS rn FROM w),
m AS (SELECT arg_min(level, rn) FILTER (WHERE level <= cap / w) AS lev FROM l),
t AS (SELECT source, source_size, CASE WHEN lev IS NULL THEN cap ELSE least(cap, lev * w) END AS target FROM l, m),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
o AS (SELECT doc_id, size, source_size, target, key, quality, whole, target - whole * source_size AS budget,
             sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * least(whole + CASE WHEN upto - size / 2.0 <= budget THEN 1 ELSE 0 END, 2))::BIGINT AS taken,
       CASE WHEN size > 0 THEN least(whole + CASE WHEN upto - size / 2.0 <= budget THEN 1 ELSE 0 END, 2) ELSE 0 END::BIGINT AS copies
FROM o
"""
