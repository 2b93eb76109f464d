"""Where intermediate tables and stream checkpoints go: a folder that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset: a temporary folder in local mode, else one in the warehouse."""
    where = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("chronolake.scratch.dir", "")
    if not where:
        local = spark.conf.get("spark.master", "local").startswith("local") and "cluster" not in spark.conf.get("spark.master", "")
        where = tempfile.mkdtemp(prefix="chronolake-") if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
        spark.conf.set("chronolake.scratch.dir", where)
    return where


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again: cuts the lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
