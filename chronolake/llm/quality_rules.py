"""Quality rules with adaptive thresholds, in DataFrame functions only.

Counts of each whole text come from array functions inside one projection. No threshold is fixed: for
each language and source a mergeable quantile sketch of every rate (counts per bucket of seven
significant bits, so quantiles are within 1.6 %) gives the quartiles, and a document fails where it lies
more than FENCE times their distance above the upper one. Rates add one to what they count, so that a
short text without a symbol does not claim to have none in a million; sources without any then still
have quartiles, from the lengths of their texts. Sketches merge by adding counts: every source takes the
sketch of its language in with the weight of PRIOR documents, so a small source leans on its language
and a large one on itself, without a switch between them. The verdicts come from joining the thresholds
to the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

SPACE = r"[\x20\x09-\x0D]+"
#: Rates, and how many times the distance of the quartiles a document may lie above the upper one.
FENCE = {"symbols": 8, "dup_lines": 4, "repeats": 24, "capitals": 8, "word_length": 8}
#: Weight of a language in the sketch of each of its sources, in documents.
PRIOR = 50
#: Least distance of the quartiles, as a share of the upper one: the width of a bucket.
WIDTH = 64
#: Repeated windows up to which membership is looked up in a list; more are found by sorting.
FEW = 64
SALT = 16


def occurrences(text: Column, char_class: str) -> Column:
    return (F.size(F.split(text, char_class, -1)) - 1).cast("long")


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.select(
        "doc_id", "lang", "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        occurrences(F.col("text"), r"[#*$%&|<>]").alias("n_symbols"),
        occurrences(F.col("text"), r"[A-Z]").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("w"),
    )
    # the hash of each window of three words; windows found twice or more are neighbours when sorted
    rows = rows.withColumn("h", F.expr("transform(slice(w, 1, greatest(size(w) - 2, 0)), (x, i) -> xxhash64(x, get(w, i + 1), get(w, i + 2)))"))
    rows = rows.withColumn("s", F.sort_array("h"))
    rows = rows.withColumn("dup", F.expr("array_distinct(filter(s, (x, i) -> x = get(s, i + 1)))"))
    by_sort = """size(array_distinct(flatten(transform(filter(transform(sequence(0, size(p) - 1), k -> named_struct('i', p[k].i, 'again', coalesce(p[k].x = get(p, k - 1).x, false) or coalesce(p[k].x = get(p, k + 1).x, false))), e -> e.again), e -> array(e.i, e.i + 1, e.i + 2)))))"""
    rows = rows.withColumn("p", F.expr(f"if(size(dup) > {FEW}, sort_array(transform(h, (x, i) -> named_struct('x', x, 'i', i))), null)"))
    hit = "coalesce(array_contains(dup, get(h, {})), false)"
    by_lookup = f"size(filter(sequence(0, size(w) - 1), j -> {hit.format('j')} or {hit.format('j - 1')} or {hit.format('j - 2')}))"
    repeated = F.expr(f"case when size(dup) = 0 then 0 when size(dup) > {FEW} then {by_sort} else {by_lookup} end")
    return rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", repeated.cast("long").alias("n_repeat_words"))


def rates() -> dict[str, Column]:
    """Whole-number rates in millionths, with one added to both counts (word length in thousandths of a character)."""
    of = lambda a, b: F.expr(f"((1000000 * ({a} + 1)) div ({b} + 1))")
    return {"symbols": of("n_symbols", "word_chars"), "dup_lines": of("n_dup_lines", "n_lines"), "repeats": of("n_repeat_words", "n_words"), "capitals": of("n_capitals", "word_chars"), "word_length": F.expr("((1000 * word_chars) div greatest(n_words, 1))")}


def bucket(v: Column) -> Column:
    """The value with its seven leading bits: the sketch's bucket."""
    step = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(v)) - 7, F.lit(0))).cast("long")
    return v - F.pmod(v, step)


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source, rate, threshold from sketches (lang, source, rate, bucket, n).

    Weights are exact: a source's own counts times the documents of its language, the language's times PRIOR.
    """
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    of_lang = sketch.groupBy("lang", "rate", "bucket").agg(F.sum("n").alias("n"))
    size = of_lang.groupBy(F.col("lang").alias("l"), F.col("rate").alias("r")).agg(F.sum("n").alias("docs"))
    met = F.col("lang").eqNullSafe(F.col("l")) & (F.col("rate") == F.col("r"))
    own = sketch.join(size, met).select("lang", "source", "rate", "bucket", (whole("n") * whole("docs")).cast("decimal(38,0)").alias("w"))
    groups = sketch.select("lang", "source", "rate").distinct()
    prior = of_lang.select(F.col("lang").alias("l"), F.col("rate").alias("r"), "bucket", (whole("n") * PRIOR).cast("decimal(38,0)").alias("w"))
    both = own.unionByName(groups.join(prior, met).select("lang", "source", "rate", "bucket", "w"))
    merged = both.groupBy("lang", "source", "rate", "bucket").agg(F.sum("w").cast("decimal(38,0)").alias("w"))
    group = Window.partitionBy("lang", "source", "rate")
    ranked = merged.withColumn("upto", F.sum("w").over(group.orderBy("bucket"))).withColumn("total", F.sum("w").over(group))
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bucket")))
    fence = F.create_map(*(x for k, v in FENCE.items() for x in (F.lit(k), F.lit(v).cast("long"))))
    out = ranked.groupBy("lang", "source", "rate").agg(at(1).alias("low"), at(3).alias("high"))
    apart = F.greatest(F.col("high") - F.col("low"), F.expr(f"high div {WIDTH}"), F.lit(1).cast("long"))
    return out.select("lang", "source", "rate", (F.col("high") + fence[F.col("rate")] * apart).alias("threshold"))


def judged(docs: DataFrame) -> DataFrame:
    """Counts and verdicts of every whole text.

    docs: doc_id, text, lang, source; more columns are ignored. Null texts have no words and fail; null
    languages and sources form groups of their own; repeated rows are judged and counted each; an empty
    table gives an empty result.
    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.
    """
    base_failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    counts = saved(text_counts(docs).withColumn("base_failed", base_failed), "counts")
    values = F.array(*(F.struct(F.lit(k).alias("rate"), bucket(v).alias("bucket")) for k, v in rates().items()))
    sketch = counts.where(~F.col("base_failed")).select("lang", "source", F.explode(values).alias("v")).select("lang", "source", "v.*")
    sketch = saved(sketch.groupBy("lang", "source", "rate", "bucket").agg(F.count("*").alias("n")), "sketch")
    wide = thresholds(sketch).groupBy(F.col("lang").alias("l"), F.col("source").alias("s")).agg(*(F.max(F.when(F.col("rate") == k, F.col("threshold"))).alias(f"t_{k}") for k in FENCE))
    # a source with a third of all rows would be one join key: both sides carry a salt
    wide = wide.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    rows = counts.withColumn("own_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).cast("int"))
    rows = rows.join(wide, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("own_salt") == F.col("salt")), "left")
    within = F.lit(True)
    for k, v in rates().items():
        within = within & F.coalesce(v <= F.col(f"t_{k}"), F.lit(False))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & within).alias("kept"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))
