"""N-gram Jaccard join by PartEnum signatures.

Texts whose sets of five-word shingles have Jaccard similarity 0.8 or more are linked; the result
is exact. Sets fall in size bands (each at most 1/0.8 as wide as it starts), so linked sets lie in
one band or in neighbours, and each set is signed for its own band and the next. Within a band of
largest size r linked sets differ in at most k = 2r/9 elements. The shingle domain (a 64-bit hash
range) is cut in n1 first-level partitions of n2 = 2 parts each, and the subsets of n2 - 1 parts
are enumerated as signatures: with 2 * n1 > k parts, two linked sets agree on at least one part.
Parts that are empty in a set carry no information: the number of parts has a margin, and two linked
sets agree on a part that is not empty unless both have more empty parts than the margin. Such sets
are partitioned again by another hash, up to FAMILIES times; only sets that are sparse in all of them
sign their empty parts, so no link is lost.

Scale: signatures travel as packed arrays keyed by a hash range, exact copies count as one node
from the start, small buckets give all pairs, large ones a star. A signature that is common among the
sets of one task gives its star there and sends its centre on, so no group holds a hot signature whole.
What stars leave open is compared in blocks inside the bucket: only rows outside its largest component
meet the others. Candidate pairs are cut by size and by a parity sketch (a proven bound on the
difference) before the exact test.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, saved, shuffle_partitions, table
from .words import U, WordHasher, chunks, mix

#: Similarity as a ratio of whole numbers: 80 / 100.
NUM, DEN = 80, 100
#: Buckets up to this size give all their pairs; larger ones a star and an exact second pass.
SMALL = 8
#: Rows of a block in the second pass, and rows that a group of blocks holds at most if it holds more than one.
BLOCK, GROUP = 2048, 50_000
#: Partitions by different hashes for sets with many empty parts.
FAMILIES = 4
#: Sets of a task's batch from which a signature that they share gives its star in the task.
HOT = 256
#: Words of 64 bits in the pre-filter of texts that take part in the exact test: one MB, whatever the input.
FILTER_WORDS = 1 << 17
BASE_OF_RANGE = 0x94D049BB133111EB


def bands(limit: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest set size of each band."""
    low, high, at = [], [], 1
    while at < limit:
        low.append(at)
        high.append(at * DEN // NUM)
        at = high[-1] + 1
    return np.array(low), np.array(high)


def parts_of(largest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parts, margin) for bands of these largest sizes: parts = 2 * n1, margin = parts - k - 1."""
    k = 2 * largest * (DEN - NUM) // (DEN + NUM)
    parts = k + 2 + (k + 1) // 7
    parts = np.where(k == 0, 1, parts + parts % 2)
    return parts, parts - k - 1


def _spans(doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.bincount(doc, minlength=n)
    return size, np.cumsum(size) - size


def node_ids(doc: np.ndarray, s: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(set size, id of the set) of each text; equal sets have equal ids."""
    size, first = _spans(doc, n)
    total = np.zeros(len(s) + 1, U)
    np.cumsum(mix(s ^ U(0x5851F42D4C957F2D)), out=total[1:])
    return size, mix(total[first + size] - total[first] + size.astype(U)).astype(np.int64)


def parity(doc: np.ndarray, s: np.ndarray, n: int) -> pa.Array:
    """A bit string for each set: the parity of its elements in each of 64 or more cells, two to four an element.

    Two sets differ in at least as many elements as their bit strings do in bits.
    """
    size, _ = _spans(doc, n)
    cells = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(size, 1) * 2)).astype(np.int64))
    start = np.cumsum(cells) - cells
    at = start[doc] + (mix(s ^ U(0x2545F4914F6CDD1D)) & (cells[doc] - 1).astype(U)).astype(np.int64)
    bits = np.packbits((np.bincount(at, minlength=int(cells.sum())) & 1).astype(np.uint8))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.append(start // 8, len(bits)).astype(np.int64)), pa.py_buffer(bits)]).cast(pa.binary())


def differ(a: bytes, b: bytes) -> int:
    """Least number of elements in which two sets with these parity strings differ."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column("text")):
            doc, s = hasher.shingles(data, offsets)
            size, node = node_ids(doc, s, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array(size), pa.array(node, mask=size == 0), parity(doc, s, hi - lo)],
                ["doc_id", "n_shingles", "node", "parity"],
            )


def _again(doc: np.ndarray, s: np.ndarray, first: np.ndarray, size: np.ndarray, some: np.ndarray, tag: np.ndarray, all_parts: np.ndarray, family: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, text number) of the parts of some sets by another hash, and how many parts of each set hold elements."""
    at = np.repeat(first[some] - (np.cumsum(size[some]) - size[some]), size[some]) + np.arange(int(size[some].sum()))
    own, x = np.repeat(np.arange(len(some)), size[some]), mix(s[at] + U(family * BASE_OF_RANGE % (1 << 64)))
    part = (((x >> U(32)) * all_parts[tag[some]][own].astype(U)) >> U(32)).astype(np.int64)
    order = np.lexsort((part, own))
    own, part, x = own[order], part[order], x[order]
    start = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (part[1:] != part[:-1])))
    value = np.add.reduceat(mix(x ^ U(0x9FB21C651E98DF25)), start)
    sig = mix(value + mix(part[start].astype(U) + U(1)) * U(3) + tag[some][own[start]].astype(U) * U(0xC2B2AE3D27D4EB4F) + U(family))
    return sig, some[own[start]], np.bincount(own[start], minlength=len(some))


def signatures(doc: np.ndarray, s: np.ndarray, n: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, text number) of all sets."""
    size, first = _spans(doc, n)
    total = np.zeros(len(s) + 1, U)
    np.cumsum(mix(s ^ U(0x9FB21C651E98DF25)), out=total[1:])
    all_parts, all_margin = parts_of(high)
    own = np.searchsorted(low, size, "right") - 1
    out_sig, out_doc = [], []
    for step in (0, 1):
        tag = own + step
        use = (size > 0) & ((size * DEN >= NUM * low[tag]) if step else True)
        if not use.any():
            continue
        parts = np.where(use, all_parts[tag], 0)
        # the part of each element, in the order of the hash, so that parts are runs
        part = ((s >> U(32)) * parts[doc].astype(U)) >> U(32)
        base = np.cumsum(parts) - parts
        cell = base[doc] + part.astype(np.int64)
        live = use[doc]
        held = np.bincount(cell[live], minlength=int(parts.sum()))
        owner = np.repeat(np.arange(n), parts)
        # elements of unused texts have no cell: skip their run of the totals
        upto = np.cumsum(held) - held
        gap = first - (np.cumsum(np.where(use, size, 0)) - np.where(use, size, 0))
        begin = upto + gap[owner]
        value = total[begin + held] - total[begin]
        place = (np.arange(len(owner)) - base[owner]).astype(U)
        sig = mix(value + mix(place + U(1)) * U(3) + tag[owner].astype(U) * U(0xC2B2AE3D27D4EB4F))
        empty = np.bincount(owner[held == 0], minlength=n)
        out_sig.append(sig[held > 0])
        out_doc.append(owner[held > 0])
        sparse = np.flatnonzero(use & (empty > all_margin[tag]))
        for family in range(1, FAMILIES):
            if not len(sparse):
                break
            more = _again(doc, s, first, size, sparse, tag, all_parts, family)
            out_sig.append(more[0])
            out_doc.append(more[1])
            sparse = sparse[all_parts[tag[sparse]] - more[2] > all_margin[tag[sparse]]]
        for i in sparse:
            place = np.arange(all_parts[tag[i]]).astype(U)
            out_sig.append(mix(mix(place + U(1)) * U(3) + tag[i].astype(U) * U(0xC2B2AE3D27D4EB4F)))
            out_doc.append(np.full(len(place), i))
    if not out_sig:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(out_sig), np.concatenate(out_doc)


def _bucket_of(sig: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Ids of buckets from the six low bytes of their signatures and their hash ranges."""
    return mix((sig & U((1 << 48) - 1)) + where.astype(U) * U(BASE_OF_RANGE)).astype(np.int64)


def _signer(ranges: int, most: int = 1 << 20):
    """Packed signatures: rows of a hash range with 6-byte signatures, 8-byte nodes and the signatures that were common here.

    Rows with done hold pairs (kind 0) and members of large buckets (kind 1) instead, for any task.
    """
    names = ["p", "kind", "sigs", "nodes", "hot"]

    def pack(sig: np.ndarray, node: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((node, sig))
        sig, node = sig[order], node[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        sig, node = sig[new], node[new]
        where = ((sig >> U(32)) * U(ranges)) >> U(32)
        start = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        size = np.diff(np.append(start, len(sig)))
        common = size >= HOT
        common_sig, common_where = sig[start[common]], where[start[common]]
        if common.any():
            inside = np.repeat(common, size)
            centre = np.repeat(node[start], size)
            bucket = _bucket_of(sig[inside], where[inside])
            spoke = inside & (centre != node)
            for kind, a, b in ((0, centre[spoke], node[spoke]), (1, bucket, node[inside])):
                for lo in range(0, len(a), 1 << 16):
                    to = ranges + int(b[lo] % ranges)
                    yield pa.RecordBatch.from_arrays([pa.array([to], pa.int32()), pa.array([kind], pa.int32()), pa.array([a[lo : lo + (1 << 16)].tobytes()], pa.binary()), pa.array([b[lo : lo + (1 << 16)].tobytes()], pa.binary()), pa.array([b""], pa.binary())], names)
            stay = ~inside
            stay[start] = True
            sig, node, where = sig[stay], node[stay], where[stay]
        bounds = np.arange(ranges + 1).astype(U)
        cut, hot_cut = np.searchsorted(where, bounds), np.searchsorted(common_where, bounds)
        some = np.flatnonzero(cut[1:] > cut[:-1])
        six = lambda x: np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :6])
        all_six, hot_six = six(sig), six(common_sig)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array([2] * len(some), pa.int32()), pa.array([all_six[cut[p] : cut[p + 1]].tobytes() for p in some], pa.binary()), pa.array([node[cut[p] : cut[p + 1]].tobytes() for p in some], pa.binary()), pa.array([hot_six[hot_cut[p] : hot_cut[p + 1]].tobytes() for p in some], pa.binary())],
            names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (low, high) = WordHasher(), bands()
        sigs, nodes, held = [], [], 0
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text")):
                doc, s = hasher.shingles(data, offsets)
                _, node = node_ids(doc, s, hi - lo)
                sig, owner = signatures(doc, s, hi - lo, low, high)
                sigs.append(sig)
                nodes.append(node[owner])
                held += len(sig)
                if held >= most:
                    yield from pack(np.concatenate(sigs), np.concatenate(nodes))
                    sigs, nodes, held = [], [], 0
        if held:
            yield from pack(np.concatenate(sigs), np.concatenate(nodes))

    return run


def _six(parts: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view(U).ravel()


def _bucket_pairs(group: pd.DataFrame) -> pd.DataFrame:
    """Pairs of nodes (kind 0) of the buckets of a hash range; rows of its large buckets (kind 1: bucket, node)."""
    if group["kind"].iloc[0] != 2:
        whole = [(k, np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)) for k, x, y in zip(group["kind"], group["sigs"], group["nodes"])]
        return pd.DataFrame({"kind": np.concatenate([np.full(len(x), k, np.int32) for k, x, _ in whole]), "a": np.concatenate([x for _, x, _ in whole]), "b": np.concatenate([y for _, _, y in whole])})
    sig, hot = _six(group["sigs"].to_list()), _six(group["hot"].to_list())
    node = np.frombuffer(b"".join(group["nodes"]), np.int64)
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node = sig[new], node[new]
    start = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(sig)))
    large = (size > SMALL) | np.isin(sig[start], hot)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for m in range(2, SMALL + 1):
        at = start[(size == m) & ~large]
        for i in range(m - 1):
            for j in range(i + 1, m):
                a.append(node[at + i])
                b.append(node[at + j])
    inside = np.repeat(large, size)
    centre = np.repeat(node[start], size)
    spoke = inside & (centre != node)
    a, b = np.concatenate([*a, centre[spoke]]), np.concatenate([*b, node[spoke]])
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    a, b = a[new], b[new]
    bucket = _bucket_of(sig[inside], np.full(int(inside.sum()), int(group["p"].iloc[0])))
    return pd.DataFrame({"kind": np.append(np.zeros(len(a), np.int32), np.ones(len(bucket), np.int32)), "a": np.append(a, bucket), "b": np.append(b, node[inside])})


@F.pandas_udf(T.BooleanType())
def may_link(pa_: pd.Series, pb_: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
    most = (na + nb) * (DEN - NUM) // (DEN + NUM)
    return pd.Series([differ(x, y) <= m for x, y, m in zip(pa_, pb_, most)], dtype=bool)


@F.pandas_udf(T.BooleanType())
def linked(sa: pd.Series, sb: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(sa, sb):
        x, y = np.frombuffer(x, U), np.frombuffer(y, U)
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(DEN * both >= NUM * (len(x) + len(y) - both))
    return pd.Series(out, dtype=bool)


def _hashed_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column("text")):
            doc, s = hasher.shingles(data, offsets)
            _, node = node_ids(doc, s, hi - lo)
            size, first = _spans(doc, hi - lo)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array([s[f : f + m].tobytes() for f, m in zip(first, size)], pa.binary())], ["node", "elements"])


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Exact test of pairs (a, b) on the sets of their texts."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = ends.join(nodes.select("node", F.col("first_id").alias("doc_id")), "node").select("doc_id")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_WORDS * 64))
    bit = lambda: F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    words = wanted.groupBy((place / 64).cast("long").alias("word")).agg(F.bit_or(bit()).alias("bits"))
    near = docs.select("doc_id", "text", (place / 64).cast("long").alias("word"), bit().alias("own"))
    near = near.join(F.broadcast(words), "word").where(F.col("bits").bitwiseAND(F.col("own")) != 0)
    texts = near.select("doc_id", "text").join(wanted.hint("shuffle_hash"), "doc_id", "left_semi").select("text")
    sets = saved(texts.mapInArrow(_hashed_sets, "node long, elements binary").dropDuplicates(["node"]), "sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("ea")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("eb")), "b")
    return both.where(linked("ea", "eb")).select("a", "b")


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that pass the bounds by size and by parity."""
    of = lambda name, *columns: nodes.select(F.col("node").alias(name), *(F.col(c).alias(c[0] + name) for c in columns))
    near = pairs.join(of("a", "n"), "a").join(of("b", "n"), "b").where(F.least("na", "nb") * DEN >= F.greatest("na", "nb") * NUM)
    near = near.join(of("a", "parity"), "a").join(of("b", "parity"), "b")
    return near.where(may_link("pa", "pb", "na", "nb")).select("a", "b")


def _nearest_joins(comp_i: np.ndarray, comp_j: np.ndarray, far: np.ndarray) -> list[int]:
    """Places of pairs, nearest first, that join components not yet joined: a forest over components."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for at in np.argsort(far, kind="stable"):
        u, v = find(int(comp_i[at])), find(int(comp_j[at]))
        if u != v:
            root[u] = v
            out.append(int(at))
    return out


def _blocks(whole: bool):
    """Pairs of nodes of two blocks of a bucket, of different components, that pass both bounds.

    A group holds many small (bucket, i, j) or a large one. whole: all such pairs; else the nearest ones
    that would join the components.
    """

    def compare(node: np.ndarray, comp: np.ndarray, n: np.ndarray, bits: list[bytes], home: np.ndarray, guest: np.ndarray):
        least = min(map(len, bits))

        def fold(x: bytes) -> np.ndarray:
            v = np.frombuffer(x, np.uint8)
            while len(v) > least:
                v = v[: len(v) // 2] ^ v[len(v) // 2 :]
            return v

        wide = np.stack([fold(x) for x in bits]).view(U)
        out = []
        step = max(1, (1 << 21) // max(1, len(guest) * wide.shape[1]))
        for lo in range(0, len(home), step):
            h = home[lo : lo + step]
            ok = comp[h][:, None] != comp[guest][None, :]
            ok &= np.minimum(n[h][:, None], n[guest]) * DEN >= np.maximum(n[h][:, None], n[guest]) * NUM
            x, y = np.nonzero(ok)
            if len(x):
                x, y = h[x], guest[y]
                far = np.bitwise_count(wide[x] ^ wide[y]).sum(axis=1)
                ok = far <= (n[x] + n[y]) * (DEN - NUM) // (DEN + NUM)
                out.append((x[ok], y[ok], far[ok]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        x, y, far = (np.concatenate(v) for v in zip(*out))
        if not whole and len(x):
            # the nearest pair of each two components, then a forest over them
            lo, hi = np.minimum(comp[x], comp[y]), np.maximum(comp[x], comp[y])
            order = np.lexsort((far, hi, lo))
            first = np.append(True, (lo[order][1:] != lo[order][:-1]) | (hi[order][1:] != hi[order][:-1]))
            order = order[first]
            use = order[_nearest_joins(lo[order], hi[order], far[order])]
            x, y = x[use], y[use]
        return node[x], node[y]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["bucket", "i", "j"], kind="stable")
        key = group[["bucket", "i", "j"]].to_numpy()
        node, comp, n, side = (group[c].to_numpy() for c in ("node", "comp", "n", "side"))
        bits = group["parity"].to_list()
        cut = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for lo, hi in zip(cut, np.append(cut[1:], len(key))):
            home, guest = np.flatnonzero(side[lo:hi] == 0), np.flatnonzero(side[lo:hi] == 1)
            if len(home) and len(guest):
                found.append(compare(node[lo:hi], comp[lo:hi], n[lo:hi], bits[lo:hi], home, guest))
        x, y = (np.concatenate(v) for v in zip(*found))
        pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _open_buckets(rest: DataFrame, comps: DataFrame, nodes: DataFrame, least: int, whole: bool) -> DataFrame:
    """What the stars of large buckets leave open: pairs of nodes of one bucket that are not yet connected.

    The rows outside the largest component of a bucket (side 0) meet all rows of the bucket (side 1), in blocks.
    """
    labelled = rest.join(comps.withColumnRenamed("component", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    held = labelled.groupBy("bucket", "comp").agg(F.count("*").alias("m"))
    state = held.groupBy("bucket").agg(F.sum("m").alias("m"), F.max(F.struct("m", "comp")).alias("top"))
    blocks = lambda c: F.ceil(c / BLOCK).cast("int")
    state = state.where("m > top.m").select("bucket", F.col("top.comp").alias("top"), blocks(F.col("m")).alias("all"), blocks(F.col("m") - F.col("top.m")).alias("minor"), F.col("m"))
    state = saved(state, "open")
    copies = state.agg(F.sum(F.col("m") * F.col("minor") + F.col("all") * F.col("minor") * BLOCK).alias("n")).first()["n"]
    groups = max(least, int(copies or 0) // GROUP)
    rows = labelled.join(state.drop("m"), "bucket").join(nodes.select("node", "n", "parity"), "node")
    own = lambda k: F.pmod(F.xxhash64("node", "bucket"), F.col(k)).cast("int")
    over = lambda k: F.sequence(F.lit(0), F.col(k) - 1)
    homes = F.when(F.col("comp") != F.col("top"), F.transform(over("all"), lambda j: F.struct(own("minor").alias("i"), j.alias("j"), F.lit(0).alias("side"))))
    guests = F.transform(over("minor"), lambda i: F.struct(i.alias("i"), own("all").alias("j"), F.lit(1).alias("side")))
    rows = rows.select("bucket", "node", "comp", "n", "parity", F.explode(F.concat(F.coalesce(homes, F.slice(guests, 1, 0)), guests)).alias("t")).select("bucket", "node", "comp", "n", "parity", "t.*")
    rows = rows.withColumn("group", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(groups)))
    return rows.groupBy("group").applyInPandas(_blocks(whole), "a long, b long").distinct()


def _across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs of nodes that are not yet connected."""
    label = comps.withColumnRenamed("component", "comp")
    pairs = pairs.join(label.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left")
    pairs = pairs.join(label.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left")
    return pairs.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """Groups of texts linked by shingle Jaccard similarity of 0.8 or more.

    docs: doc_id long (unique; rows that repeat an id count each), text string; more columns are ignored.
    Returns doc_id, n_shingles, component_id (smallest id of the group). Null, empty and blank texts
    have no shingles and stay alone; an empty table gives an empty result; exact copies are linked.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = saved(docs.mapInArrow(_sets, "doc_id long, n_shingles long, node long, parity binary"), "sets")
    nodes = sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("n_shingles").alias("n"), F.min("parity").alias("parity"))
    nodes = saved(nodes, "nodes")
    spark = docs.sparkSession
    total = sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("n")).first()["n"]
    ranges = max(shuffle_partitions(spark), 12, int(total // 600_000))
    packed = docs.mapInArrow(_signer(ranges), "p int, kind int, sigs binary, nodes binary, hot binary")
    # a pair shares many signatures: it is one row before anything is written
    found = saved(packed.groupBy("p").applyInPandas(_bucket_pairs, "kind int, a long, b long").distinct(), "buckets")

    pairs = saved(_possible(found.where("kind = 0").select("a", "b"), nodes), "possible")
    rest = found.where("kind = 1").select(F.col("a").alias("bucket"), F.col("b").alias("node"))
    # one partner for each node first: most groups are whole then, and little is left to compare
    tested = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    comps = saved(components(_verified(tested, nodes, docs)), "components")
    for step in ("stars", "nearest", "whole"):
        if step == "stars":
            more = _across(pairs.join(tested, ["a", "b"], "left_anti"), comps)
        else:
            more = _open_buckets(rest, comps, nodes, shuffle_partitions(spark), step == "whole").join(tested, ["a", "b"], "left_anti")
        more = saved(more, "possible")
        if not more.isEmpty():
            # the labels so far stand for the links that made them
            links = _verified(more, nodes, docs).unionByName(comps.select(F.col("node").alias("a"), F.col("component").alias("b")))
            comps = saved(components(links), "components")
            tested = tested.unionByName(more)

    lead = nodes.select("node", "first_id").join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = lead.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = lead.join(smallest, "component").select("node", "component_id")
    return sets.select("doc_id", "n_shingles", "node").join(named, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))
