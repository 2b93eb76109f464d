"""Keyed state in streams with an end: first complete observation of a session, and a breaker for repeated failures.

Both run as `transformWithState` in event time: state is a value a key, a timer at the end of its life removes it, and
a watermark says when that is. Rows of a key that come after the watermark has passed its end are too late and count
nowhere. The state store must hold several states a key: `state_store` sets the one that does.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY = 24 * 3600 * 1000


def state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class _First(StatefulProcessor):
    """Attempts of a source and session: the first complete one is final, and failed ones are counted until then."""

    def __init__(self, life: int) -> None:
        self.life = life

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "first long, attempts long, failures long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first, attempts, failures = self.seen.get() if self.seen.exists() else (None, 0, 0)
        was = first
        for r in sorted(rows, key=lambda r: (r["at"], not r["complete"])):
            attempts += 1
            if r["complete"]:
                # a batch may bring an earlier attempt late: the earliest of the session counts until it has been told
                first = r["at"] if first is None else first
            elif first is None:
                failures += 1
        if not self.seen.exists():
            self.handle.registerTimer(key[1] + self.life)
        self.seen.update((first, attempts, failures))
        if first is not None and was is None:
            yield Row(source=key[0], session=key[1], outcome="COMPLETE", at=first, attempts=attempts, failures=failures)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        first, attempts, failures = self.seen.get()
        self.seen.clear()
        if first is None:
            yield Row(source=key[0], session=key[1], outcome="NEVER_COMPLETE", at=None, attempts=attempts, failures=failures)

    def close(self) -> None:
        pass


def first_observations(stream: DataFrame, source: str, time: str, complete: Column, delay: str = "1 day", days: int = 2) -> DataFrame:
    """source, session, outcome, at, attempts, failures: one row a source and day (UTC) of time, when it is first complete or never was.

    The earliest complete attempt of the first batch that has one is final: later attempts change nothing, and a
    source that fails does not hold up others. attempts and failures count up to that batch. A session ends so
    many days after its start; one without a complete attempt is told then, and its state goes either way.
    """
    state_store(stream.sparkSession)
    at = F.unix_millis(F.col(time))
    rows = stream.where(F.col(source).isNotNull() & F.col(time).isNotNull()).withWatermark(time, delay)
    rows = rows.select(F.col(source).cast("string").alias("source"), (at - F.pmod(at, F.lit(DAY))).alias("session"), at.alias("at"), F.coalesce(complete, F.lit(False)).alias("complete"), F.col(time).alias("__time"))
    out = rows.groupBy("source", "session").transformWithState(_First(days * DAY), "source string, session long, outcome string, at long, attempts long, failures long", "append", "eventTime")
    moment = lambda c: F.timestamp_millis(c).cast("timestamp_ntz")
    return out.select("source", moment("session").cast("date").alias("session"), "outcome", moment("at").alias("at"), "attempts", "failures")


class _Breaker(StatefulProcessor):
    """Runs of one failure of a unit: the limit-th in a row trips, and what ends a run starts anew."""

    def __init__(self, limit: int, life: int) -> None:
        self.limit, self.life = limit, life

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "signature string, n long, last long, timer long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        signature, n, last, timer = self.run.get() if self.run.exists() else (None, 0, 0, 0)
        for r in sorted(rows, key=lambda r: (r["at"], r["id"])):
            if r["signature"] is None:
                signature, n = None, 0
            else:
                n = n + 1 if r["signature"] == signature else 1
                signature = r["signature"]
                if n == self.limit:
                    yield Row(unit=key[0], signature=signature, at=r["at"], n=n)
            last = max(last, r["at"])
        if timer:
            self.handle.deleteTimer(timer)
        timer = last + self.life
        self.handle.registerTimer(timer)
        self.run.update((signature, n, last, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.run.clear()
        return iter(())

    def close(self) -> None:
        pass


def trips(stream: DataFrame, unit: str, time: str, signature: Column, ident: str, limit: int = 3, delay: str = "1 day", quiet_days: int = 30) -> DataFrame:
    """unit, signature, at, n: each time a unit fails for the limit-th time in a row with one signature (null: it did not fail).

    Attempts of a batch are taken by time, then ident. Another signature or a success starts the count anew, and so
    does silence of quiet_days, after which the state of a unit goes.
    """
    state_store(stream.sparkSession)
    rows = stream.where(F.col(unit).isNotNull() & F.col(time).isNotNull()).withWatermark(time, delay)
    rows = rows.select(F.col(unit).cast("string").alias("unit"), F.unix_millis(F.col(time)).alias("at"), signature.alias("signature"), F.col(ident).cast("string").alias("id"), F.col(time).alias("__time"))
    out = rows.groupBy("unit").transformWithState(_Breaker(limit, quiet_days * DAY), "unit string, signature string, at long, n long", "append", "eventTime")
    return out.withColumn("at", F.timestamp_millis("at").cast("timestamp_ntz"))


#: Keys share state by hash, in so many slices; the number is part of a checkpoint.
SLICES = 16384


class _Once(StatefulProcessor):
    """The digests of the first rows of a slice of keys, for ever: repeats go, other values are conflicts.

    A list of packed numbers, one element a batch that brought new keys: two hashes of the key and the digest of its row.
    """

    def __init__(self, names: list[str]) -> None:
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getListState("known", "packed binary")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known: dict[tuple[int, int], int] = {}
        for (packed,) in self.known.get():
            numbers = array("q", bytes(packed))
            known.update(zip(zip(numbers[::3], numbers[1::3]), numbers[2::3]))
        told = lambda r, outcome: Row(**{n: r[n] for n in self.names}, outcome=outcome)
        # of a key that is new: its row, and how often it came; None once its rows disagree
        new: dict[tuple[int, int], list | None] = {}
        for r in rows:
            ident, digest = (r["__one"], r["__two"]), r["__digest"]
            if r["__one"] is None:
                yield told(r, "CONFLICT")
            elif ident in known:
                if known[ident] != digest:
                    yield told(r, "CONFLICT")
            elif ident not in new:
                new[ident] = [r, 1]
            elif new[ident] is None:
                yield told(r, "CONFLICT")
            elif new[ident][0]["__digest"] == digest:
                new[ident][1] += 1
            else:
                held, n = new[ident]
                new[ident] = None
                for conflict in [held] * n + [r]:
                    yield told(conflict, "CONFLICT")
        kept = {ident: one[0] for ident, one in new.items() if one}
        if kept:
            self.known.appendValue((array("q", [x for ident, r in kept.items() for x in (*ident, r["__digest"])]).tobytes(),))
        for r in kept.values():
            yield told(r, "KEPT")

    def close(self) -> None:
        pass


def first_rows(stream: DataFrame, key: str, slices: int = SLICES) -> DataFrame:
    """The rows of a stream with outcome: KEPT for the first row of a key, CONFLICT for a row that differs from it, however late.

    Repeats give nothing. A key that comes with several values in its first batch, or that is null, gives conflicts only.
    No earlier batch is read again: state keeps three numbers a key for ever, as the question asks. Keys are told apart by
    two 64-bit hashes. They share state in slices, as a call to the state store costs far more than a row: a batch
    makes a few calls for each slice it touches, and reads the numbers of these slices.
    """
    state_store(stream.sparkSession)
    names = stream.columns
    values = [c for c in names if c != key]
    digest = F.xxhash64(F.concat_ws("", *(F.when(F.col(c).isNull(), "n").otherwise("v") for c in values)), *values) if values else F.lit(0).cast("long")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema) + ", outcome string"
    given = F.col(key).isNotNull()
    rows = stream.withColumns({"__digest": digest, "__one": F.when(given, F.xxhash64(key)), "__two": F.when(given, F.xxhash64(F.lit("two"), key))})
    # rows without a key need no state; they are dealt by their values
    rows = rows.withColumn("__slice", F.pmod(F.coalesce("__one", "__digest"), F.lit(slices)))
    return rows.groupBy("__slice").transformWithState(_Once(names), schema, "append", "none")
