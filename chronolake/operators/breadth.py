"""Market breadth of one session, with denominators that leave warm-up rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import spread, sweep
from .windows import by_time, percent_change


def measures(bars: DataFrame, key: str = "sym", price: str = "px") -> DataFrame:
    """Rolling measures of every bar; one shuffle by symbol serves all windows.

    A long extreme is that of short windows laid end to end, and a count the difference of two running counts, so that no
    bar is compared with all of a long window.
    """
    w = by_time([key])
    last = lambda rows: w.rowsBetween(-(rows - 1), 0)
    short = bars.withColumns({"__seen": F.count(price).over(w.rowsBetween(Window.unboundedPreceding, 0)), "__low": F.min(price).over(last(10)), "__high": F.max(price).over(last(21))})
    enough = lambda rows, least: F.col("__seen") - F.lag("__seen", rows, 0).over(w) >= least
    ends = lambda c, step, rows: [F.lag(c, k).over(w) for k in range(0, rows, step)]
    return short.withColumns(
        {
            "pct": percent_change(price, [key]),
            "ma20": F.when(enough(20, 10), F.avg(price).over(last(20))),
            "ma60": F.when(enough(60, 30), F.avg(price).over(last(60))),
            "low60": F.when(enough(60, 30), F.least(*ends("__low", 10, 60))),
            "high252": F.when(enough(252, 100), F.greatest(*ends("__high", 21, 252))),
        }
    ).drop("__seen", "__low", "__high")


def reached(bars: DataFrame, number: int, key: str = "sym", day: str = "d", price: str = "px", rows: int = sweep.LONGEST) -> DataFrame:
    """key, day, price and the measures of the bars that batch number reaches: its own and the next rows - 1 of their symbols.

    bars has the batch of each bar as part; the last batch of a bar counts, and in a batch the highest price. They are sorted
    once by symbol and day and swept as they come, with the last bars of one symbol in memory. Prices are doubles, and the
    measures those of measures, sums in the same order.
    """
    kept = bars.select(key, day, F.col(price).cast("double").alias(price), F.col("part").cast("long").alias("part"))
    out = T.StructType([*(kept.schema[c] for c in (key, day, price)), *(T.StructField(m, T.DoubleType()) for m in sweep.MEASURES)])
    return spread.by_key(kept, key).sortWithinPartitions(key, day, "part", price).mapInArrow(lambda batches: sweep.reached(batches, number, rows), out)


def flags(rows: DataFrame, price: str = "px") -> DataFrame:
    """Three-valued flags: null where the measure is null, so that a mean leaves the row out."""
    p = F.col(price)
    return rows.withColumns(
        {
            "is_advance": F.col("pct") > 0,
            "is_decline": F.col("pct") < 0,
            "is_flat": F.col("pct") == 0,
            "above_ma20": p > F.col("ma20"),
            "above_ma60": p > F.col("ma60"),
            "new_low_60": p <= F.col("low60") * 1.001,
            "new_high_252": p >= F.col("high252") * 0.999,
        }
    )


FLAGS = ("is_advance", "above_ma20", "above_ma60", "new_low_60", "new_high_252")

#: What breadth reads of a row.
USED = ("pct", *FLAGS, "is_decline", "is_flat")


def breadth(rows: DataFrame, by: list[str]) -> DataFrame:
    """Ratios over the known flags, their denominators, and counts, for each group."""
    ratio = [F.round(F.avg(F.col(f).cast("double")), 6).alias(f"{f}_ratio") for f in FLAGS]
    known = [F.count(f).alias(f"{f}_n") for f in FLAGS]
    counts = [F.count_if(F.col(f)).alias(f"{f}_count") for f in ("is_advance", "is_decline", "is_flat")]
    return rows.groupBy(*by).agg(F.count("*").alias("securities"), *ratio, *known, *counts, F.round(F.avg("pct"), 6).alias("equal_weight_return"))
