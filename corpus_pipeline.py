"""Corpus pipeline: five stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.llm.common import fresh, saved, table
from chronolake.llm.jaccard import jaccard_groups
from chronolake.llm.mixing import mix_documents
from chronolake.llm.pieces import encode_documents
from chronolake.llm.quality_model import keep_good
from chronolake.llm.secrets import redacted
from chronolake.sources.scratch import new_path


#: Parts of a group of near copies in the join that leaves one row of it.
SALT = 16


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, with all their columns.

    Null, empty and blank texts score 0 and go; ids may repeat or be null, each row is scored by its text; an empty
    table stays empty; without labels of both classes every text scores 0.5 and goes.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest id, null ids last; rows without words stay.

    Rows are told apart by a written key, so ids may repeat or be null; of rows with one id and equal sets one stays;
    rows without words are in no group, repeats of them included; columns of any name are kept; an empty table stays empty.
    """
    names = docs.columns
    (row,) = fresh(docs, "kept_row")
    docs = saved(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = jaccard_groups(docs.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
    ids = docs.select(F.col(row).alias("r"), F.col("doc_id").cast("long").alias("id"))
    groups = groups.join(ids, F.col("row") == F.col("r"))
    groups = saved(groups.select("component_id", F.struct(F.col("id").isNull().alias("none"), "id", "row").alias("place")), "groups")
    # only groups of several rows lose any; a large one would be one join key, so both sides carry a salt
    first = groups.groupBy("component_id").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    groups = groups.withColumn("salt", F.pmod(F.xxhash64("place.row"), F.lit(SALT)).cast("int"))
    gone = groups.join(first, ["component_id", "salt"]).where(F.col("place.row") != F.col("first.row")).select(F.col("place.row").alias(row))
    return docs.join(gone, row, "left_anti").select(*(F.col(f"`{c}`") for c in names))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets masked; null texts stay null, every row is scanned by itself, n_chars follows the text."""
    return redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them: rows without words are not taken, null sources are one source, repeats count each."""
    return mix_documents(docs)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix: null and empty texts have none, repeated rows give repeated rows."""
    return encode_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding", sentencepiece_ids),
]

#: SQL can express neither the classifier nor the encoding; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = new_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
