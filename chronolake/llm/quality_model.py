"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages (runs of PASSAGE words; the last may be shorter) that covers its whole
text. Words and byte trigrams of a passage are hashed; their embeddings, learnt end to end from the
document labels, are pooled and joined by a few figures of the passage. A gated attention, learnt with
them, weighs the passages, and the score is a logistic function of the weighted passage representation.
Inputs are functions of the text alone.

The fit sees a bounded number of documents, the SAMPLE labelled ones that come first by hash, and every
passage of each. It runs where the texts are: PARTS tasks start a round from the same weights, go over
their documents in small batches and return new weights, whose mean starts the next round. Texts stay in
a written table; the driver only ever holds PARTS sets of weights, some 140 kB each. Gradients are summed
over blocks of passages, so a document of any length fits. Scoring uses every passage of every document
and maps over them without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table
from .words import U, WordHasher, chunks

PASSAGE = 64
#: Most labelled documents that the fit sees; tasks that fit side by side; rounds, and passes over the documents in each.
SAMPLE, PARTS, ROUNDS, EPOCHS = 3000, 4, 10, 2
#: Score from which a document is predicted good.
CUT = 0.7
HIDDEN, BATCH, SEED = 16, 64, 7
#: Hashed words, hashed byte trigrams, and figures of a passage.
WORDS, TRIGRAMS, FIGURES = 1024, 1024, 6
HASHED = WORDS + TRIGRAMS
FEATURES = HASHED + FIGURES
#: Passages that are encoded at once.
BLOCK = 4096


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


class Passages:
    """The passages of many texts: owner (number of the text of each) and their features, block by block."""

    def __init__(self, hasher: WordHasher, data: np.ndarray, offsets: np.ndarray) -> None:
        self.lower = hasher.lower[data]
        n = len(offsets) - 1
        doc, self.hash = hasher.words(data, offsets)
        words = np.bincount(doc, minlength=n)
        rank = np.arange(len(doc)) - (np.cumsum(words) - words)[doc]
        opens = rank % PASSAGE == 0
        self.word = np.flatnonzero(opens)
        self.owner = doc[opens]
        if not len(doc):
            return
        self.passage = np.cumsum(opens) - 1
        self.count = np.bincount(self.passage)
        # bytes of a passage reach from its first word to the next passage or the end of the text
        solid = hasher.solid[data]
        start = solid.copy()
        start[1:] &= ~solid[:-1]
        edge = offsets[:-1][offsets[:-1] < len(data)]
        start[edge] = solid[edge]
        self.first = np.flatnonzero(start)[opens]
        self.upto = np.minimum(np.append(self.first[1:], offsets[-1]), offsets[self.owner + 1])
        total = len(self.owner)
        # distinct words of a passage, and how far the text repeats its word triples
        order = np.lexsort((self.hash, self.passage))
        p, w = self.passage[order], self.hash[order]
        distinct = np.bincount(p[np.append(True, (p[1:] != p[:-1]) | (w[1:] != w[:-1]))], minlength=total)
        repeats = np.zeros(total)
        if len(self.hash) >= 3:
            h = self.hash
            triple = h[:-2] * U(3) + h[1:-1] * U(0x9E3779B97F4A7C15) + (h[2:] ^ (h[2:] >> U(7)))
            inside = doc[:-2] == doc[2:]
            d, t, where = doc[:-2][inside], triple[inside], self.passage[:-2][inside]
            order = np.lexsort((t, d))
            again = np.zeros(len(d), bool)
            again[order[1:]] = (d[order][1:] == d[order][:-1]) & (t[order][1:] == t[order][:-1])
            repeats = np.bincount(where[again], minlength=total)
        length = self.upto - self.first
        self.figures = np.stack([_ratio(length, self.count), _ratio(distinct, self.count), _ratio(repeats, self.count), np.log1p(self.count), np.log1p(words[self.owner]), (self.count < 8).astype(float)], 1)

    def hashed(self, lo: int, hi: int) -> np.ndarray:
        """Counts of hashed words and trigrams of the passages lo to hi - 1; of more than 255 of one kind 255 count."""
        a, b = self.word[lo], self.word[hi] if hi < len(self.word) else len(self.hash)
        words = np.bincount((self.passage[a:b] - lo) * WORDS + (self.hash[a:b] % U(WORDS)).astype(np.int64), minlength=(hi - lo) * WORDS)
        at, end = int(self.first[lo]), int(self.upto[hi - 1])
        x = self.lower[at:end].astype(np.uint32)
        tri = np.zeros(0, np.int64)
        if len(x) >= 3:
            place = np.arange(at, end - 2)
            own = np.searchsorted(self.first[lo:hi], place, "right") - 1
            code = ((x[:-2] << np.uint32(16)) + (x[1:-1] << np.uint32(8)) + x[2:]) * np.uint32(0x9E3779B1)
            tri = (own * TRIGRAMS + (code >> np.uint32(22)).astype(np.int64))[place + 2 < self.upto[lo:hi][own]]
        tri = np.bincount(tri, minlength=(hi - lo) * TRIGRAMS)
        return np.minimum(np.concatenate([words.reshape(-1, WORDS), tri.reshape(-1, TRIGRAMS)], 1), 255).astype(np.uint8)

    def features(self, lo: int, hi: int) -> np.ndarray:
        return joined(self.hashed(lo, hi), self.figures[lo:hi])


def joined(counts: np.ndarray, figures: np.ndarray) -> np.ndarray:
    """Features of passages: their counts of words and of trigrams, each with norm 1, and their figures."""
    parts = []
    for x in (counts[:, :WORDS].astype(np.float32), counts[:, WORDS:].astype(np.float32)):
        parts.append(x / np.maximum(np.sqrt((x * x).sum(1)), 1)[:, None])
    return np.concatenate([*parts, figures.astype(np.float32)], 1)


@dataclass
class Model:
    """Standardising shift and scale, embeddings, attention gates and output weights."""

    shift: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(standardised features, no more than 6 deviations from the mean; representation) of passages."""
        z = np.clip((x - self.shift) / self.scale, -6, 6).astype(np.float32)
        return z, np.tanh(z @ self.weights["E"] + self.weights["e"])

    def attend(self, h: np.ndarray, bag: np.ndarray, bags: int) -> dict[str, np.ndarray]:
        """Scores of bags 0 to bags - 1; bag: the bag of each passage, ascending, every bag with one or more."""
        w = self.weights
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["G"])))
        s = (t * g) @ w["a"]
        begin = np.searchsorted(bag, np.arange(bags))
        a = np.exp(s - np.maximum.reduceat(s, begin)[bag])
        a /= np.add.reduceat(a, begin)[bag]
        pooled = np.add.reduceat(a[:, None] * h, begin)
        out = 1 / (1 + np.exp(-np.clip(pooled @ w["c"] + w["d"], -30, 30)))
        return {"h": h, "t": t, "g": g, "a": a, "pooled": pooled, "out": out, "begin": begin}

    def gradient(self, blocks: list, bag: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss over bags; blocks: the features of their passages, in pieces that are made when they are asked for."""
        w, held, h = self.weights, [], []
        for x in blocks:
            z, own = self.hidden(x())
            h.append(own)
            # features of few passages are kept for the way back, of many they are made again
            held.append(z if len(bag) <= BLOCK else None)
        r = self.attend(np.concatenate(h), bag, len(label))
        err = (r["out"] - label) / len(label)
        grad = {"c": r["pooled"].T @ err, "d": np.array([err.sum()])}
        dp = (err[:, None] * w["c"])[bag]
        dh = r["a"][:, None] * dp
        da = (dp * r["h"]).sum(1)
        ds = r["a"] * (da - np.add.reduceat(r["a"] * da, r["begin"])[bag])
        grad["a"] = (r["t"] * r["g"]).T @ ds
        dtg = ds[:, None] * w["a"]
        dt, dg = dtg * r["g"] * (1 - r["t"] ** 2), dtg * r["t"] * r["g"] * (1 - r["g"])
        grad["V"], grad["G"] = r["h"].T @ dt, r["h"].T @ dg
        de = (dh + dt @ w["V"].T + dg @ w["G"].T) * (1 - r["h"] ** 2)
        grad["E"], grad["e"], at = np.zeros_like(w["E"]), de.sum(0), 0
        for x, z in zip(blocks, held):
            z = self.hidden(x())[0] if z is None else z
            grad["E"] += z.T @ de[at : at + len(z)].astype(np.float32)
            at += len(z)
        return grad


def first_weights(features: int = FEATURES) -> dict[str, np.ndarray]:
    rng, k = np.random.default_rng(SEED), HIDDEN
    return {"E": rng.normal(0, 0.1, (features, k)).astype(np.float32), "e": np.zeros(k), "V": rng.normal(0, k**-0.5, (k, k)), "G": rng.normal(0, k**-0.5, (k, k)), "a": rng.normal(0, k**-0.5, k), "c": rng.normal(0, k**-0.5, k), "d": np.zeros(1)}


def improve(model: Model, bags: list[list], sizes: np.ndarray, label: np.ndarray, rng: np.random.Generator, epochs: int = EPOCHS) -> None:
    """Adam on the log loss over batches of bags, in place. bags: the blocks of each bag; sizes: its passages."""
    weights = model.weights
    first, second = ({n: np.zeros_like(v, dtype=float) for n, v in weights.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(len(label)), max(1, len(label) // BATCH)):
            step += 1
            blocks = [x for i in batch for x in bags[i]]
            grad = model.gradient(blocks, np.repeat(np.arange(len(batch)), sizes[batch]), label[batch])
            for n, v in weights.items():
                g = grad[n] + 1e-4 * v
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g**2
                v -= (0.01 * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)).astype(v.dtype)


def scores(model: Model | None, hasher: WordHasher, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A score for each text; 0 without words; 0.5 for all others if no label was there to learn from."""
    out = np.zeros(len(offsets) - 1)
    own = Passages(hasher, data, offsets)
    if len(own.owner):
        some, bag = np.unique(own.owner, return_inverse=True)
        if model is None:
            out[some] = 0.5
        else:
            n = len(own.owner)
            h = np.concatenate([model.hidden(own.features(lo, min(lo + BLOCK, n)))[1] for lo in range(0, n, BLOCK)])
            out[some] = model.attend(h, bag, len(some))["out"]
    return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Passages]]:
    """(part, label, passages) of each text that has words; a text of any length is one."""
    hasher = WordHasher()
    for batch in batches:
        for part, label, text in zip(batch.column("part").to_pylist(), batch.column("label").to_pylist(), batch.column("text")):
            for _, _, data, offsets in chunks(pa.array([text.as_py()], pa.large_string())):
                own = Passages(hasher, data, offsets)
                if len(own.owner):
                    yield part, label, own


def _figure_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number, sums and sums of squares of the figures of all passages, and of the labels of their texts."""
    total, labels = np.zeros((3, FIGURES)), np.zeros(2, np.int64)
    for _, label, own in _texts(batches):
        total += [np.full(FIGURES, len(own.owner)), own.figures.sum(0), (own.figures**2).sum(0)]
        labels[label] += 1
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary())], ["sums", "labels"])


def _round(model: Model, number: int):
    """A function for mapInArrow: the weights that a part comes to in a round, and how many texts it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list] = {}
        for part, label, own in _texts(batches):
            by_part.setdefault(part, []).append((label, own))
        for part, texts in sorted(by_part.items()):
            mine = Model(model.shift, model.scale, {n: v.copy() for n, v in model.weights.items()})
            sizes = np.array([len(own.owner) for _, own in texts])
            bags = [[partial(own.features, lo, min(lo + BLOCK, n)) for lo in range(0, n, BLOCK)] for (_, own), n in zip(texts, sizes)]
            improve(mine, bags, sizes, np.array([label for label, _ in texts], float), np.random.default_rng([SEED, number, part]))
            yield pa.RecordBatch.from_arrays([pa.array([len(texts)]), pa.array([pickle.dumps(mine.weights)], pa.binary())], ["n", "weights"])

    return run


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on every passage of the SAMPLE labelled documents that come first by hash; None without two classes."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # of rows that repeat an id one is enough to learn from: the sample stays within its bound
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")).where("text is not null")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS)).cast("int")
    sample = saved(texts.select(part.alias("part"), "doc_id", "label", "text").repartition(PARTS, "part").sortWithinPartitions("part", "doc_id"), "sample")
    # each part is met whole and in one order, however the written files are split
    parts = lambda: sample.repartition(PARTS, "part").sortWithinPartitions("part", "doc_id").drop("doc_id")
    found = [(np.frombuffer(r["sums"]).reshape(3, FIGURES), np.frombuffer(r["labels"], np.int64)) for r in sample.drop("doc_id").mapInArrow(_figure_sums, "sums binary, labels binary").collect()]
    if not found or (sum(y for _, y in found) == 0).any():
        return None
    n, total, squares = sum(x for x, _ in found)
    # embeddings take counts as they are; figures are standardised
    shift, scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
    shift[HASHED:] = total / n
    spread = np.sqrt(np.maximum(squares / n - (total / n) ** 2, 0))
    scale[HASHED:] = np.where(spread > 1e-6, spread, 1.0)
    model = Model(shift, scale, first_weights())
    for number in range(ROUNDS):
        rows = parts().mapInArrow(_round(model, number), "n long, weights binary").collect()
        share = np.array([r["n"] for r in rows]) / sum(r["n"] for r in rows)
        got = [pickle.loads(r["weights"]) for r in rows]
        model = Model(shift, scale, {k: sum(s * w[k] for s, w in zip(share, got)).astype(v.dtype) for k, v in model.weights.items()})
    return model


def scorer(model: Model | None, keep_from: float | None = None):
    """A function for mapInArrow. It adds the score, or with keep_from keeps the rows that reach it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            parts = [scores(model, hasher, data, offsets) for _, _, data, offsets in chunks(batch.column("text"))]
            score = np.concatenate(parts) if parts else np.zeros(0)
            if keep_from is None:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])
            else:
                yield batch.filter(pa.array(score >= keep_from))

    return run


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % 4 == 2


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every whole text; the model learns only from labels of documents that are not held out.

    docs: doc_id long, text string; more columns are ignored. labels: doc_id, quality 0/1; other values and
    null ids are no labels, of several labels of a document the least counts. Null, empty and blank texts
    score 0; without labels of both classes all other texts score 0.5; repeated rows give repeated rows.
    Returns doc_id, held_out, score, predicted (1 from CUT).
    """
    model = train(docs, labels.where(~held_out()))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = slim.mapInArrow(scorer(model), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, that score CUT or more.

    Null, empty and blank texts score 0 and go; a text of any length is scored over all its passages; equal texts
    score equally, and rows that repeat stay or go together; without labels of both classes all go.
    """
    model = train(docs, labels.where(~held_out()))
    return docs.mapInArrow(scorer(model, CUT), docs.schema)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
