"""Structured Streaming ingest of evidence: append, first observation, lateness, readiness, breaker, roll-up.

Each job reads files as they land, runs with trigger(availableNow) or continuously, and writes a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolake.operators import breadth


def capture_class(observed: Column, session: Column, decision: Column) -> Column:
    """struct(timing, eligible) of an exchange-local capture time for a session and the next session, its decision day.

    Nothing may be captured before the session closes at 15:00; on the decision day 05:30, 08:45 and 09:30 end the
    early, the late and the recovery class. Late captures keep their rows; only eligibility ends at 08:45.
    """
    at = lambda day, clock: F.to_timestamp_ntz(F.concat(day.cast("string"), F.lit(f" {clock}")))
    timing = (
        F.when(observed < at(session, "15:00:00"), "BEFORE_SESSION_CLOSE")
        .when(observed <= at(decision, "05:30:00"), "PREOPEN_BEFORE_FORMER_0530_SLA")
        .when(observed <= at(decision, "08:45:00"), "LATE_PREOPEN_BEFORE_SHADOW_DECISION_CUTOFF")
        .when(observed < at(decision, "09:30:00"), "POST_CUTOFF_PRE_EXECUTION_LATE_RECOVERY")
        .otherwise("POST_EXECUTION_LATE_RECOVERY")
    )
    eligible = (observed >= at(session, "15:00:00")) & (observed <= at(decision, "08:45:00"))
    return F.struct(timing.alias("timing"), eligible.alias("eligible"))


def landing(spark: SparkSession, path: str, time: str | None = None, files: int | None = None) -> DataFrame:
    """Files under path as a stream, with a zoned event time (watermarks need one); files: most files of a batch."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    # as a pattern the path may also name a single file
    rows = reader.parquet(f"{path[:-1]}[{path[-1]}]")
    return rows.withColumn(time, F.col(time).cast("timestamp")) if time else rows


def drain(stream: DataFrame, out: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that has landed into a table at out, and read the table."""
    spark = stream.sparkSession
    q = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{out}/data").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def upsert(stream: DataFrame, out: str, keys: list[str]) -> DataFrame:
    """Run an update-mode aggregation over all that has landed; every batch writes its keys, the last batch of a key counts."""
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        # a repeated batch overwrites itself, so a retry leaves no second copy
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{out}/data/part={number}")

    stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    rest = [c for c in stream.columns if c not in keys]
    rows = spark.read.parquet(f"{out}/data")
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")


def append_once(stream: DataFrame, out: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Append each key once and for ever to a table at out: (the table, the conflicts), over all that has landed.

    A repeat with the same values is dropped, however late it comes; one with other values is a conflict and is not
    appended, nor is a key that comes with several values in its first batch. Every batch is compared with the keys
    and digests of the batches before it, and a batch that runs again overwrites itself. Null keys are conflicts.
    """
    spark = stream.sparkSession
    values = [c for c in stream.columns if c != key]
    data, clashes = f"{out}/data", f"{out}/conflicts"
    schema = T.StructType([*stream.schema, T.StructField("digest", T.LongType()), T.StructField("part", T.LongType())])

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("digest", F.xxhash64(*values) if values else F.lit(0).cast("long"))
        new = rows.groupBy(key).agg(F.min_by(F.struct(*values, "digest"), "digest").alias("r"), F.min("digest").alias("lo"), F.max("digest").alias("hi"))
        before = spark.read.schema(schema).parquet(data).where(F.col("part") < number) if number else spark.createDataFrame([], schema)
        before = before.select(F.col(key).alias("__key"), F.col("digest").alias("__old"))
        met = new.join(before, F.col(key) == F.col("__key"), "left")
        clash = F.col(key).isNull() | (F.col("lo") != F.col("hi")) | F.coalesce(F.col("__old") != F.col("lo"), F.lit(False))
        met.where(~clash & F.col("__key").isNull()).select(key, "r.*").write.mode("overwrite").parquet(f"{data}/part={number}")
        met.where(clash).select(key).write.mode("overwrite").parquet(f"{clashes}/part={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(data).select(*stream.columns), spark.read.parquet(clashes).select(key).distinct()


#: Symbols are stored in so many buckets, and a batch reads those of its symbols.
BUCKETS = 64

#: Symbols of a batch that are sent to all tasks, to leave out the bars of others.
FEW = 10_000


def refreshed_breadth(stream: DataFrame, out: str, key: str = "sym", day: str = "d", price: str = "px", rows: int = 252) -> DataFrame:
    """Market breadth of every session, kept right as bars land late, again or with a new price.

    A bar reaches its own session and the sessions of the next rows - 1 bars of its symbol, as their windows look
    back on it. A batch computes the flags of these bars again, from the buckets of its own symbols, and the breadth
    of their sessions from the stored flags of all symbols, which it reads by month. The last batch of a bar and of a
    session counts; a batch that runs again overwrites itself. Rows without symbol or day are left out; prices count as
    doubles.
    """
    spark = stream.sparkSession
    bars, flagged, done = f"{out}/bars", f"{out}/flags", f"{out}/breadth"

    def values(df: DataFrame, name: str) -> list:
        # buckets and months: bounded by BUCKETS and by the calendar
        return [r[0] for r in df.select(name).distinct().collect()]

    def latest(df: DataFrame, by: list[str]) -> DataFrame:
        rest = [c for c in df.columns if c not in (*by, "part")]
        return df.groupBy(*by).agg(F.max_by(F.struct(*rest), "part").alias("r")).select(*by, "r.*")

    def write(batch: DataFrame, number: int) -> None:
        own = batch.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, day, price).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))
        # few files: a bucket, and below a month, lies in few tasks
        own.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{bars}/part={number}")
        if not own.isEmpty():
            refresh(number)

    def refresh(number: int) -> None:
        stored = spark.read.option("basePath", bars).parquet(bars).where(F.col("part") <= number)
        mine = stored.where(F.col("part") == number)
        near = stored.where(F.col("bucket").isin(values(mine, "bucket")))
        symbols = mine.select(key).distinct()
        # the other symbols of the buckets are not reached; where the batch has few, they are not sorted either
        if symbols.limit(FEW + 1).count() <= FEW:
            near = near.join(F.broadcast(symbols), key, "left_semi")
        fresh = breadth.flags(breadth.reached(near, number, key, day, price, rows), price)
        fresh = fresh.select(key, day, *breadth.USED).withColumn("month", F.trunc(day, "MM"))
        fresh.hint("rebalance", F.col("month")).write.mode("overwrite").partitionBy("month").parquet(f"{flagged}/part={number}")
        every = spark.read.option("basePath", flagged).parquet(flagged).where(F.col("part") <= number)
        # months and their batches: bounded by the calendar and by the batches
        stored_in = every.select("month", "part").distinct().collect()
        mine_too, older = ({r["month"] for r in stored_in if (r["part"] == number) is own} for own in (True, False))
        # a month that no batch wrote before has each bar once
        current = every.where((F.col("part") == number) & F.col("month").isin(list(mine_too - older))).select(day, *breadth.USED)
        if mine_too & older:
            met = every.where(F.col("month").isin(list(mine_too & older)))
            sessions = met.where(F.col("part") == number).select(day).distinct()
            met = met.join(F.broadcast(sessions), day, "left_semi").withColumn("__later", F.lead("part").over(Window.partitionBy(key, day).orderBy("part")))
            current = current.unionByName(met.where("__later is null").select(day, *breadth.USED))
        breadth.breadth(current, [day]).write.mode("overwrite").parquet(f"{done}/part={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return latest(spark.read.option("basePath", done).parquet(done), [day])


def first_observation(stream: DataFrame, keys: list[str], time: str, complete: Column) -> DataFrame:
    """First time at which each key was complete; later attempts never change it."""
    return stream.where(complete).groupBy(*keys).agg(F.min(time).alias("first_observed"))


def readiness(stream: DataFrame, session: Column, source: str, required: list[str]) -> DataFrame:
    """Per session the required sources that have arrived and those still missing."""
    g = stream.groupBy(session.alias("session")).agg(F.array_sort(F.collect_set(source)).alias("arrived"))
    need = F.array(*(F.lit(x) for x in required))
    return g.select("session", F.array_join(F.array_intersect(need, "arrived"), ",").alias("arrived"), F.array_join(F.array_except(need, "arrived"), ",").alias("missing"), (F.size(F.array_except(need, "arrived")) == 0).alias("ready"))


def breaker(stream: DataFrame, unit: str, signature: Column, limit: int = 3) -> DataFrame:
    """Failures per unit and signature, and whether the limit is reached."""
    return stream.groupBy(unit, signature.alias("signature")).agg(F.count("*").alias("failures")).withColumn("stop", F.col("failures") >= limit)


def roll_up(stream: DataFrame, time: str, by: str, value: str, delay: str = "1 day") -> DataFrame:
    """Counts and sums of a class by day of the event."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, "1 day").alias("w"), by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("day"), by, "n", "total")
