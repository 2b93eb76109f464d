"""Rolling measures of bars that come sorted by symbol and day, worked out in the tasks batch by batch.

The functions here are pickled by value, so executors need no copy of this package.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The measures of a bar, and the most rows that one looks at.
MEASURES = ("pct", "ma20", "ma60", "low60", "high252")
LONGEST = 252


def reached(batches: Iterator[pa.RecordBatch], number: int, rows: int) -> Iterator[pa.RecordBatch]:
    """The reached bars of batches of key, day, price and part in order; the symbol and the day of a bar may go on in the next batch."""
    back = max(rows, LONGEST) - 1
    old = np.zeros(0), np.zeros(0, bool), np.zeros(0, bool)
    held = None
    for batch in chain(batches, [None]):
        parts = [b for b in (held, batch) if b is not None and b.num_rows]
        if not parts:
            continue
        table = pa.Table.from_batches(parts).combine_chunks()
        keys, days = table.column(0), table.column(1)
        n = table.num_rows
        differs = lambda c: pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy()
        other = differs(keys) if n > 1 else np.zeros(0, bool)
        symbol = np.concatenate([[0], np.cumsum(other)])
        last = np.append(other | differs(days) if n > 1 else other, batch is None)
        # what follows the last row is not known yet
        found = np.flatnonzero(last)
        seen = table.column(2).is_valid().to_numpy()[found]
        values = table.column(2).fill_null(0.0).to_numpy()[found]
        hits = table.column(3).to_numpy()[found] == number
        p, known, hit = (np.concatenate(x) for x in zip(old, (values, seen, hits)))
        of = np.concatenate([np.zeros(len(old[0]), int), symbol[found]])
        at = np.arange(len(of))
        first = np.searchsorted(of, of)
        since = np.maximum.accumulate(np.where(hit, at, -1)) if len(of) else at
        out = np.flatnonzero((since >= first) & (at - since < rows) & (at >= len(old[0])))
        if len(out):
            columns = table.select([0, 1, 2]).take(pa.array(found[out - len(old[0])])).combine_chunks()
            made = [pa.array(x[out], mask=~there[out]) for x, there in _measured(p, known, of, at - first)]
            yield from pa.table([*columns.columns, *made], names=[*columns.column_names, *MEASURES]).to_batches()
        tail = np.flatnonzero(of == symbol[-1])[-back:]
        old, held = (p[tail], known[tail], hit[tail]), table.take(pa.array([n - 1])).to_batches()[0]


def _measured(p: np.ndarray, known: np.ndarray, of: np.ndarray, place: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """MEASURES and where they are there, of prices in order by symbol; place counts the bars of a symbol from 0."""
    total = np.concatenate([[0], np.cumsum(known)])
    at = np.arange(len(p))
    count = lambda rows: total[at + 1] - total[at + 1 - np.minimum(place + 1, rows)]
    # zeros before each symbol, so that a sum of up to 60 rows needs no test
    gap = 59
    slot = at + gap * (of - of[0] + 1)
    spaced = np.zeros(slot[-1] + 1)
    spaced[slot] = np.where(known, p, 0.0)

    def total_of(rows: int) -> np.ndarray:
        sums = np.zeros(len(spaced) - gap)
        for k in range(rows - 1, -1, -1):
            sums += spaced[gap - k : len(spaced) - k]
        return sums[slot - gap]

    def extreme(x: np.ndarray, rows: int, pick: Callable, none: float) -> np.ndarray:
        # of twice as many rows each time
        size = 1
        while size < rows:
            step = min(size, rows - size)
            before = np.full(len(x), none)
            before[step:] = x[:-step]
            before[place < step] = none
            x, size = pick(x, before), size + step
        return x

    before = np.concatenate([[0.0], p[:-1]])
    with np.errstate(all="ignore"):
        pct = (p - before) / before * 100
        ma20, ma60 = total_of(20) / count(20), total_of(60) / count(60)
    # as in SQL a number that is none is above all others
    low = extreme(np.where(known, p, np.nan), 60, np.fmin, np.nan)
    high = extreme(np.where(known, p, -np.inf), LONGEST, np.maximum, -np.inf)
    changed = (place > 0) & known & np.concatenate([[False], known[:-1]]) & (before != 0)
    return [(pct, changed), (ma20, count(20) >= 10), (ma60, count(60) >= 30), (low, count(60) >= 30), (high, count(LONGEST) >= 100)]
