"""Embedding near-dedup: PCA-ordered tiled comparison.

Unit vectors are rotated to the principal axes of the whole table (from a distributed sum of outer
products), so that leading coordinates carry most of a dot product. A pair is followed coordinate
block by block: when the sum so far plus the product of the two suffix norms stays below the
threshold, the cosine cannot reach it and the pair stops. What is left is decided by the cosine of
the original vectors in double precision.

Scale: equal vectors of a label count as one row. Two unit vectors with cosine c differ by at most
sqrt(2 - 2c) in every coordinate, so the first two coordinates make a grid in which only a cell and
its neighbours are compared; a cell of more than TILE_BYTES is dealt into tiles of that size and compared
tile by tile, so a vector travels nine times until its cell fills a tile and once more for each further
tile. Inside two tiles rows go by the third coordinate, and blocks only meet blocks in reach. A tile
returns link counts and a spanning forest of its links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, forest, saved, table

THRESHOLD = 0.98
#: Bytes of vectors in a tile, and rows of the blocks that are compared at once in it.
TILE_BYTES = 1 << 22
BLOCK, AHEAD = 512, 4096
#: Coordinates that are added before pairs are tested against the bound again.
STEP = 8
#: Room for rounding in the bounds; the last test is exact.
SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for width, x, _ in _by_width(batch):
            sums[width] = sums.get(width, 0) + unit(x).T @ unit(x)
    for width, s in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([width] * width, pa.int32()), pa.array(range(width), pa.int32()), pa.array(list(s), pa.list_(pa.float64()))], ["width", "i", "sums"])


def _by_width(batch: pa.RecordBatch):
    """(width, vectors, row numbers) for the vectors of each width in a batch."""
    vectors = batch.column("v")
    size = np.diff(np.frombuffer(vectors.buffers()[1], np.int32)[vectors.offset : vectors.offset + len(vectors) + 1])
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    at = np.cumsum(size) - size
    for width in np.unique(size):
        rows = np.flatnonzero(size == width)
        yield int(width), flat[at[rows][:, None] + np.arange(width)], rows


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes by width of vector: a matrix of width x width from all rows, whatever their number."""
    parts = vectors.select("v").mapInArrow(_moments, "width int, i int, sums array<double>")
    total = parts.select("width", "i", F.posexplode("sums").alias("j", "s")).groupBy("width", "i", "j").agg(F.sum("s").alias("s"))
    out: dict[int, np.ndarray] = {}
    for r in total.collect():
        out.setdefault(r["width"], np.zeros((r["width"], r["width"])))[r["i"], r["j"]] = r["s"]
    return {w: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1] for w, m in out.items()}


def _placer(axes: dict[int, np.ndarray], side: float):
    """Grid cell of each vector by its first two principal coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros((batch.num_rows, 3), np.int32)
            for width, x, rows in _by_width(batch):
                y = unit(x) @ axes[width][:, :2]
                cells[rows, 0] = width
                cells[rows, 1 : 1 + y.shape[1]] = np.floor(y / side)
            yield pa.RecordBatch.from_arrays([batch.column("first_id"), batch.column("label"), batch.column("copies"), batch.column("v"), *(pa.array(c) for c in cells.T)], ["first_id", "label", "copies", "v", "width", "x", "y"])

    return run


def close_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, upper: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) with cosine of a[i] and b[j] at or above threshold; upper: only i < j."""
    width = axes.shape[0]
    by, lead = min(2, width - 1), min(STEP, width)
    tail = lambda p: np.sqrt(np.maximum(np.cumsum((p * p)[:, ::-1], 1)[:, ::-1], 0))

    def ordered(x: np.ndarray):
        y = unit(x) @ axes
        order = np.argsort(y[:, by], kind="stable")
        return order, y[order], tail(y[order])

    oa, ya, ta = ordered(a)
    ob, yb, tb = (oa, ya, ta) if b is a else ordered(b)
    norm_a, norm_b = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    reach = np.sqrt(max(2 - 2 * threshold, 0.0)) + SLACK
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(ya), BLOCK):
        home = ya[lo : lo + BLOCK]
        least, most = np.searchsorted(yb[:, by], [home[0, by] - reach, home[-1, by] + reach])
        for at in range(int(least), int(most), AHEAD):
            guest = yb[at : min(at + AHEAD, int(most))]
            so_far = home[:, :lead] @ guest[:, :lead].T
            rest = np.outer(ta[lo : lo + BLOCK, lead], tb[at : at + len(guest), lead]) if lead < width else 0.0
            i, j = np.nonzero(so_far + rest >= threshold - SLACK)
            s, i, j = so_far[i, j], i + lo, j + at
            if upper:
                ok = oa[i] < ob[j]
                i, j, s = i[ok], j[ok], s[ok]
            done = lead
            while done < width and len(i):
                more = min(done + STEP, width)
                s = s + (ya[i, done:more] * yb[j, done:more]).sum(1)
                done = more
                ok = s + (ta[i, done] * tb[j, done] if done < width else 0.0) >= threshold - SLACK
                i, j, s = i[ok], j[ok], s[ok]
            x, y = oa[i], ob[j]
            ok = (a[x] * b[y]).sum(1) / (norm_a[x] * norm_b[y]) >= threshold
            out_i.append(x[ok])
            out_j.append(y[ok])
    return np.concatenate(out_i), np.concatenate(out_j)


def _tiles(axes: dict[int, np.ndarray], threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        home, guest = group[group["side"] == 0], group[group["side"] == 1]
        same = bool(group["same"].iloc[0])
        if not len(home) or not (same or len(guest)):
            return pd.DataFrame({"first_id": [], "links": [], "low": []}).astype("int64")
        a = np.stack(home["v"].to_list())
        b = a if same else np.stack(guest["v"].to_list())
        ia, ca = home["first_id"].to_numpy(), home["copies"].to_numpy()
        ib, cb = (ia, ca) if same else (guest["first_id"].to_numpy(), guest["copies"].to_numpy())
        i, j = close_pairs(a, b, axes[int(group["width"].iloc[0])], threshold, same)
        ids, low = forest(ia[i], ib[j])
        links = pd.Series(0, index=ids)
        links = links.add(pd.Series(cb[j]).groupby(ia[i]).sum(), fill_value=0).add(pd.Series(ca[i]).groupby(ib[j]).sum(), fill_value=0)
        return pd.DataFrame({"first_id": ids, "links": links.loc[ids].to_numpy(dtype=np.int64), "low": low})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links between vectors of one label with cosine at or above threshold.

    vectors: vec_id long (unique), embedding array of float or double, label; more columns are ignored.
    A vector that is null, empty, zero or holds null or non-finite components links with nothing, as does
    one without a label or of another length. An empty table gives an empty result.
    Returns vec_id, n_links, component_id, kept.
    """
    all_rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    usable = all_rows.where(F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    usable = usable.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    # a power of two brings very large and very small vectors to a scale where no square over- or underflows; cosines stay
    top = F.array_max(F.transform("v", lambda x: F.abs(x)))
    scale = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(top)) - 1, F.lit(-1022)))
    usable = usable.withColumn("v", F.when((top > 1e60) | (top < 1e-60), F.transform("v", lambda x: x / scale)).otherwise(F.col("v")))
    usable = usable.withColumn("key", F.struct(F.xxhash64(F.lit(1), "v").alias("a"), F.xxhash64(F.lit(2), "v").alias("b")))
    sized = saved(usable.groupBy("label", "key").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("v").alias("v")), "vectors")
    axes = principal_axes(sized)
    side = float(np.sqrt(max(2 - 2 * threshold, 0.0))) + 1e-6
    placed = sized.select("first_id", "label", "copies", "v").mapInArrow(_placer(axes, side), "first_id long, label string, copies long, v array<double>, width int, x int, y int")
    placed = saved(placed, "placed")
    cell = ["label", "width", "x", "y"]
    tiles = placed.groupBy(*cell).agg(F.ceil(F.count("*") * F.col("width") * 8 / TILE_BYTES).cast("int").alias("tiles"))
    dealt = placed.join(tiles, cell).withColumn("own", F.pmod(F.xxhash64("first_id"), F.col("tiles")).cast("int"))

    # inside a cell: each pair of its tiles once, and each tile with itself
    inside = dealt.select("first_id", "copies", "v", *cell, F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda k: F.struct(
        F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j"), F.when(F.col("own") <= k, 0).otherwise(1).alias("side"), (k == F.col("own")).alias("same")))).alias("t"))
    inside = inside.select("first_id", "copies", "v", *cell, F.lit(0).alias("dx"), F.lit(0).alias("dy"), "t.*")
    # between a cell and the four neighbours that come after it
    steps = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 1), (1, -1), (1, 0), (1, 1))))
    ahead = dealt.select("*", F.explode(steps).alias("s")).select("*", (F.col("x") + F.col("s.dx")).alias("x2"), (F.col("y") + F.col("s.dy")).alias("y2"), "s.dx", "s.dy")
    other = tiles.select("label", "width", F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("tiles").alias("theirs"))
    homes = ahead.join(other, ["label", "width", "x2", "y2"]).select("first_id", "copies", "v", *cell, "dx", "dy", F.col("own").alias("i"), F.explode(F.sequence(F.lit(0), F.col("theirs") - 1)).alias("j"), F.lit(0).alias("side"), F.lit(False).alias("same"))
    behind = dealt.select("*", F.explode(steps).alias("s")).select("*", (F.col("x") - F.col("s.dx")).alias("x2"), (F.col("y") - F.col("s.dy")).alias("y2"), "s.dx", "s.dy")
    guests = behind.join(other, ["label", "width", "x2", "y2"]).select("first_id", "copies", "v", "label", "width", F.col("x2").alias("x"), F.col("y2").alias("y"), "dx", "dy", F.explode(F.sequence(F.lit(0), F.col("theirs") - 1)).alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), F.lit(False).alias("same"))
    found = inside.unionByName(homes).unionByName(guests).groupBy(*cell, "dx", "dy", "i", "j").applyInPandas(_tiles(axes, threshold), "first_id long, links long, low long")
    found = saved(found, "links")

    comps = components(found.select(F.col("first_id").alias("a"), F.col("low").alias("b")))
    counts = found.groupBy("first_id").agg(F.sum("links").alias("links"))
    classes = sized.select("label", "key", "first_id", "copies").join(counts, "first_id", "left").join(comps.withColumnRenamed("node", "first_id"), "first_id", "left")
    classes = classes.select("label", "key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "first_id").alias("component_id"))
    linked = usable.select("vec_id", "label", "key").join(classes, ["label", "key"]).select("vec_id", "n_links", "component_id")
    out = all_rows.select("vec_id").join(linked, "vec_id", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op8_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
