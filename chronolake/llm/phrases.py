"""Phrase collocation mining: Misra-Gries summaries per hash partition, then an exact count of what survives.

First pass: every task counts the n-grams (one to three words of a piece) of some megabytes of text, and
deals (fingerprint, count) by hash to parts. A part merges these counts into one Misra-Gries summary. Its
capacity is ROOM times its mass divided by the threshold; the masses arrive before the counts. Subtractions
then stay below the threshold in total, so every n-gram with THRESHOLD occurrences survives. Fingerprints
may collide, which only lets more survive. The survivors of a part set bits in its region of a bit map of
BITS in all, whatever the input: that is all that is broadcast, and a full map lets more n-grams through
but loses none.

Second pass: the n-grams whose bit is set are counted as strings, in the tasks first and then by phrase;
those below the threshold go. Scores join the counts of the parts of a phrase.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, shuffle_partitions, table
from .words import BASE, INVERSE, U, _powers, mix, text_buffers

#: Least occurrences of a phrase; longest phrase; share of a phrase in percent from which a longer one displaces it; rows a language.
THRESHOLD, LONGEST, INSIDE, TOP = 10, 3, 50, 2000
#: Capacity of a summary, in masses divided by the threshold: over 1, and more makes subtractions rare.
ROOM = 4
#: Bits of the map of survivors: 32 MB whatever the input.
BITS = 1 << 28
#: Bytes of text that a task counts at once; n-grams it holds before it deals them out.
TEXT, HELD = 1 << 21, 1 << 20
#: Groups in which the first rows of a language are found before the last sort.
SALTS = 64
LANG = "und"
ODD = [pow(0xD1342543DE82EF95, k + 1, 1 << 64) for k in range(LONGEST)]


def _counted(numbers: list[np.ndarray], many: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of numbers below many, one column a different phrase; how often each occurs)."""
    bits = max(many - 1, 1).bit_length()
    if bits * len(numbers) > 63:
        return np.unique(np.stack(numbers), axis=1, return_counts=True)
    code = numbers[0]
    for number in numbers[1:]:
        code = (code << bits) | number
    code, counts = np.unique(code, return_counts=True)
    shifts = np.arange(len(numbers) - 1, -1, -1)[:, None] * bits
    return (code >> shifts) & ((1 << bits) - 1), counts


class Grams:
    """N-grams of texts of one language: words by number, phrases by the numbers of their words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        kind = np.zeros(256, np.uint8)
        kind[[32, 9]] = 1
        kind[[*b".,;:!?\n\x0b\x0c\r"]] = 2
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        # a break between texts parts pieces, as marks do
        byte = np.insert(lower[data], offsets[1:-1], 10) if len(offsets) > 2 else lower[data]
        kinds = kind[byte]
        solid = kinds == 0
        edge = np.diff(np.pad(solid.view(np.int8), 1))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.n = len(start)
        piece = np.cumsum(kinds == 2, dtype=np.int32)[start]
        places = np.zeros(self.n + 1, np.int64)
        np.cumsum(end - start, out=places[1:])
        words = pa.LargeStringArray.from_buffers(self.n, pa.py_buffer(places), pa.py_buffer(byte[solid])).dictionary_encode()
        self.words = words.dictionary
        number = words.indices.to_numpy().astype(np.int64)
        self.phrases: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        for size in range(1, LONGEST + 1):
            m = max(self.n - size + 1, 0)
            inside = np.flatnonzero(piece[:m] == piece[size - 1 :]) if m else np.zeros(0, np.int64)
            phrases, counts = _counted([number[inside + j] for j in range(size)], len(self.words))
            self.phrases.append(phrases)
            self.counts.append(counts.astype(np.int32))

    def hashes(self, lang: int) -> list[np.ndarray]:
        """A hash of every phrase, by its number of words."""
        places, data = self.words.buffers()[1:]
        places = np.frombuffer(places, np.int64)[: len(self.words) + 1]
        data = np.frombuffer(data, np.uint8)[: places[-1]] if len(self.words) else np.zeros(0, np.uint8)
        up, down = _powers(BASE, len(data) + 1), _powers(INVERSE, len(data) + 1)
        total = np.zeros(len(data) + 1, U)
        np.cumsum((data.astype(U) + U(1)) * up[: len(data)], out=total[1:])
        word = mix((total[places[1:]] - total[places[:-1]]) * down[places[:-1]] + np.diff(places).astype(U) * U(0xA24BAED4963EE407))
        out = []
        for numbers in self.phrases:
            h = np.full(numbers.shape[1], U(lang))
            for j, number in enumerate(numbers):
                h = h + word[number] * U(ODD[j])
            out.append(mix(h))
        return out

    def strings(self, size: int, which: np.ndarray) -> pa.Array:
        """The chosen phrases of so many words, space-joined."""
        parts = [self.words.take(pa.array(number[which])) for number in self.phrases[size - 1]]
        return parts[0] if size == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Grams]]:
    """(language, n-grams) of blocks of about TEXT bytes; a longer text stays whole."""
    held: dict[str, list[pa.Array]] = {}
    size: dict[str, int] = {}

    def grams(lang: str) -> Grams:
        size.pop(lang)
        return Grams(*text_buffers(pa.chunked_array(held.pop(lang))))

    for batch in batches:
        langs = batch.column("lang")
        for lang in langs.unique().to_pylist():
            own = batch.column("text").filter(pc.equal(langs, lang)).cast(pa.large_string()).fill_null("")
            row, ends = 0, np.cumsum(np.diff(text_buffers(own)[1]))
            while row < len(own):
                upto = (ends[row - 1] if row else 0) + TEXT - size.get(lang, 0)
                end = max(row + 1, int(np.searchsorted(ends, upto, "right")))
                held.setdefault(lang, []).append(own.slice(row, end - row))
                size[lang] = size.get(lang, 0) + int(ends[end - 1] - (ends[row - 1] if row else 0))
                row = end
                if size[lang] >= TEXT or row < len(own):
                    yield lang, grams(lang)
        while sum(size.values()) >= 8 * TEXT:
            lang = max(size, key=size.get)
            yield lang, grams(lang)
    for lang in list(held):
        yield lang, grams(lang)


def _lang_hash(lang: str) -> int:
    return int(mix(np.array([zlib.crc32(lang.encode()) + 1], U))[0])


def _dealt(parts: int):
    """(part, first, mass, entries): fingerprints with their counts, for the part that owns their hash; the masses of all entries come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            h, c = np.concatenate(hashes), np.concatenate(counts)
            hashes.clear(), counts.clear()
            order = np.argsort(h)
            h, c = h[order], c[order]
            del order
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            first = np.flatnonzero(new)
            # a count of the threshold is as good as a greater one
            h, c = h[first], np.minimum(np.add.reduceat(c, first), THRESHOLD) if len(first) else c
            part = ((h >> U(32)) * U(parts) >> U(32)).astype(np.int64)
            cuts = np.searchsorted(part, np.arange(parts + 1))
            mass = np.add.reduceat(np.append(c, 0).astype(np.int64), np.minimum(cuts[:-1], len(c))) * (np.diff(cuts) > 0)
            some = np.flatnonzero(np.diff(cuts))
            prints = h.astype(np.uint32)
            entries = [prints[a:b].tobytes() + c[a:b].astype(np.uint8).tobytes() for a, b in zip(cuts[some], cuts[some + 1])]
            n = len(some)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([some, some]), pa.int32()), pa.array([True] * n + [False] * n), pa.array(np.concatenate([mass[some], mass[some]])), pa.array([None] * n + entries, pa.binary())],
                ["part", "head", "mass", "entries"],
            )

        for lang, grams in _blocks(batches):
            hashes += grams.hashes(_lang_hash(lang))
            counts += grams.counts
            if sum(map(len, hashes)) >= HELD:
                yield out()
        if hashes:
            yield out()

    return run


class Summary:
    """A Misra-Gries summary of fingerprints: what it has subtracted from any count stays below mass / capacity."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.lost = capacity, 0
        self.prints, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, prints: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((prints, counts.astype(np.int64)))
        self.held += len(prints)
        if self.held >= self.capacity:
            self.merge()

    def merge(self) -> None:
        p = np.concatenate([self.prints, *(x for x, _ in self.waiting)])
        c = np.concatenate([self.counts, *(x for _, x in self.waiting)])
        self.waiting, self.held = [], 0
        order = np.argsort(p, kind="stable")
        p, c = p[order], c[order]
        new = np.ones(len(p), bool)
        new[1:] = p[1:] != p[:-1]
        first = np.flatnonzero(new)
        p, c = p[first], np.add.reduceat(c, first) if len(first) else c
        if len(p) > self.capacity:
            # the mergeable form: the greatest count beyond the capacity goes from all
            less = int(np.partition(c, len(c) - self.capacity - 1)[len(c) - self.capacity - 1])
            self.lost += less
            keep = c > less
            p, c = p[keep], c[keep] - less
        self.prints, self.counts = p, c

    def frequent(self, threshold: int) -> np.ndarray:
        """Fingerprints that may have the threshold: none that has it is missing."""
        self.merge()
        return self.prints[self.counts + self.lost >= threshold]


def region(parts: int) -> int:
    """Bits of the map for each part."""
    return max(8, BITS // parts // 8 * 8)


def _merged(parts: int):
    """(part, bits): the survivors of each part, by its rows in order, as its compressed region of the map."""
    bits = region(parts)

    def closed(part: int, summary: Summary) -> pa.RecordBatch:
        here = np.zeros(bits, bool)
        here[(summary.frequent(THRESHOLD).astype(U) * U(bits)) >> U(32)] = True
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([zlib.compress(np.packbits(here).tobytes(), 1)], pa.binary())], ["part", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = -1, 0, None
        for batch in batches:
            for p, head, m, entries in zip(*(batch.column(c).to_pylist() for c in ("part", "head", "mass", "entries"))):
                if p != part:
                    if summary:
                        yield closed(part, summary)
                    part, mass, summary = p, 0, None
                if head:
                    mass += m
                    continue
                summary = summary or Summary(ROOM * mass // THRESHOLD + 1)
                n = len(entries) // 5
                summary.add(np.frombuffer(entries, np.uint32, n), np.frombuffer(entries, np.uint8, n, 4 * n))
        if summary:
            yield closed(part, summary)

    return run


def survivors(texts: DataFrame) -> np.ndarray:
    """The bit map of n-grams that may be frequent: BITS in all, packed, region after region."""
    parts = shuffle_partitions(texts.sparkSession)
    dealt = texts.mapInArrow(_dealt(parts), "part int, head boolean, mass long, entries binary")
    sorted_ = dealt.repartition(parts, "part").sortWithinPartitions("part", F.col("head").desc())
    width = region(parts) // 8
    packed = np.zeros(parts * width, np.uint8)
    for row in sorted_.mapInArrow(_merged(parts), "part int, bits binary").collect():
        packed[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return packed


def exact(texts: DataFrame) -> DataFrame:
    """lang, size, phrase, f: exact counts of the n-grams with THRESHOLD occurrences, and of all words (size 0, phrase null).

    texts: lang (not null), text.
    """
    spark, parts = texts.sparkSession, shuffle_partitions(texts.sparkSession)
    bits, packed = region(parts), spark.sparkContext.broadcast(survivors(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = packed.value
        for lang, grams in _blocks(batches):
            for size, h in enumerate(grams.hashes(_lang_hash(lang)), 1):
                part = (h >> U(32)) * U(parts) >> U(32)
                place = part * U(bits) + ((h & U(0xFFFFFFFF)) * U(bits) >> U(32))
                which = np.flatnonzero(seen[place >> U(3)] >> (U(7) - (place & U(7))).astype(np.uint8) & 1)
                for cut in range(0, len(which), 1 << 18):
                    some = which[cut : cut + (1 << 18)]
                    k = len(some)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * k, pa.string()), pa.array(np.full(k, size), pa.int32()), grams.strings(size, some).cast(pa.string()), pa.array(grams.counts[size - 1][some].astype(np.int64))], ["lang", "size", "phrase", "f"])
            yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([0], pa.int32()), pa.array([None], pa.string()), pa.array([grams.n], pa.int64())], ["lang", "size", "phrase", "f"])

    counted = texts.mapInArrow(run, "lang string, size int, phrase string, f long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= THRESHOLD) | (F.col("size") == 0))


def _cuts(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, k, left, right: every way to cut a phrase in two."""
    words = F.split("phrase", " ")
    piece = lambda first, n: F.array_join(F.slice(words, first, n), " ")
    ways = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda k: F.struct(k.alias("k"), piece(F.lit(1), k).alias("left"), piece(k + 1, F.size(words) - k).alias("right")))
    return phrases.select("lang", "phrase", F.col("f").alias("a"), F.explode(ways).alias("x")).select("lang", "phrase", "a", "x.*")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """The best phrases of every language.

    docs: text, lang; more columns are ignored. Null texts are empty, null languages count as `und`; repeated
    rows count each; a long text stays whole; an empty table gives an empty result. Ties of score and a are
    broken by the phrase.
    Returns lang, rank, phrase, a, l, r, n, score.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(LANG)).alias("lang"), F.col("text").cast("string").alias("text"))
    counts = saved(exact(texts), "phrases")
    parts = counts.where(F.col("size").between(1, LONGEST - 1))
    cuts = _cuts(counts.where(F.col("size") > 1))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    # whole numbers of up to 38 digits: counts of up to 16 digits cannot overflow
    wide = lambda c: f"cast({c} as decimal(16,0))"
    score = F.expr(f"({wide('a')} * {wide('a')} * 1000000BD) div ({wide('l')} * {wide('r')})")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x")).select("lang", "phrase", "a", "x.score", "x.l", "x.r")
    words = F.split("phrase", " ")
    longest = counts.where(F.col("size") == LONGEST)
    inner = F.explode(F.array(F.array_join(F.slice(words, 1, LONGEST - 1), " "), F.array_join(F.slice(words, 2, LONGEST - 1), " ")))
    over = longest.select("lang", inner.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = best.join(over, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < INSIDE * F.col("a"), F.lit(True)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    first = left.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    total = counts.where(F.col("size") == 0).select("lang", F.col("f").alias("n"))
    return first.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_OP11 = rf"""
WITH d AS (SELECT coalesce(lang, '{LANG}') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?
-
]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM w, (SELECT unnest([1, 2, 3]) AS k), LATERAL (SELECT unnest(generate_series(1, len(w) - k + 1)) AS i)),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS a FROM g GROUP BY ALL HAVING count(*) >= {THRESHOLD}),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
s AS (SELECT *, string_split(phrase, ' ') AS v FROM f WHERE k > 1),
c AS (SELECT s.*, j, x.a AS l, y.a AS r, ((1000000::HUGEINT * s.a * s.a) // (x.a::HUGEINT * y.a))::BIGINT AS score FROM s, LATERAL (SELECT unnest(generate_series(1, k - 1)) AS j) JOIN f x ON x.lang = s.lang AND x.phrase = array_to_string(v[1:j], ' ') JOIN f y ON y.lang = s.lang AND y.phrase = array_to_string(v[j + 1:], ' ')),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (SELECT lang, phrase, max(a) AS a FROM (SELECT lang, array_to_string(v[1:2], ' ') AS phrase, a FROM s WHERE k = 3 UNION ALL SELECT lang, array_to_string(v[2:3], ' '), a FROM s WHERE k = 3) GROUP BY ALL),
z AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank FROM b LEFT JOIN o USING (lang, phrase) WHERE NOT coalesce(100 * o.a >= {INSIDE} * b.a, false))
SELECT lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= {TOP}
"""
