"""Spelling variants by a frequency-vector trie.

A word's vector counts its letters in LEVELS groups. The trie's levels are these counts, one group after the
other; words that are one edit apart differ by one letter too many in one group, one too few in another, or
both. A search walks down the trie and may spend one surplus and one deficit; the words at the leaves it
reaches are verified. To meet each pair once, the shorter word searches for the longer one with a surplus
alone, and of two words of equal length the one that lacks the earlier group searches.

Subtrees are the unit of work: a word lives in the subtree of its length and first `depth` counts and sends
its search to every subtree its budget can reach (about a dozen at depth 4). Depth grows until no subtree
holds more than MEMBERS words, so no task ever gathers the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, shuffle_partitions, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_COUNT, RATIO, DROPPED = 6, 5, 5, 199
#: Letters with a group of their own, in the order of the trie's levels; all others share SHARED groups by code point.
LETTERS = "eanirtoslducmhpgbvfwkyzxjq"
SHARED = 6
LEVELS = len(LETTERS) + SHARED
#: Words of a subtree, and searches that walk down together.
MEMBERS, TOGETHER = 50_000, 20_000
#: Letters, padding included, that a task holds or compares at once.
CELLS = 1 << 23
#: Letters up to which words are counted together; a longer word is counted by itself.
WIDE = 64
#: What a search has spent: between words of one length nothing, a surplus, both; towards longer words nothing, a surplus.
NONE, OVER, BOTH, SHORT, GROWN = range(5)

RESULT = "word string, near string, near_n long"


def level_of() -> np.ndarray:
    """The level of each code point below 256."""
    out = len(LETTERS) + np.arange(256) % SHARED
    out[np.frombuffer(LETTERS.encode(), np.uint8)] = np.arange(len(LETTERS))
    return out


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of whole texts with the planted deletions, counted over all documents."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.regexp_extract_all(text, F.lit(rf"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat_ws(":", "doc", "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    word = F.when(h % DROPPED == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, padded with zeros; lengths) of words whose letters are below U+0100."""
    latin = [w.encode("latin-1") for w in words.to_pylist()]
    size = np.fromiter(map(len, latin), np.int64, len(latin))
    width = int(size.max(initial=1))
    return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in latin), np.uint8).reshape(len(latin), width), size


def _vectors(letters: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Letters by level."""
    n, width = letters.shape
    real = np.arange(width) < size[:, None]
    place = (np.arange(n)[:, None] * LEVELS + level_of()[letters])[real]
    return np.bincount(place, minlength=n * LEVELS).reshape(n, LEVELS)


def _by_width(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows again, longer words in batches of their own: no short word is padded to a long one."""
    for batch in batches:
        long = pc.greater(pc.utf8_length(batch.column("word")), WIDE)
        rest = batch.filter(pc.invert(long))
        if rest.num_rows:
            yield rest
        for at in np.flatnonzero(long.to_numpy(zero_copy_only=False)):
            yield batch.slice(int(at), 1)


def _sent(batch: pa.RecordBatch, depth: int) -> pa.RecordBatch:
    """Each word at home (state -1) and its searches: the key of a subtree and what was spent on the way to it."""
    letters, size = _letters(batch.column("word"))
    vector = _vectors(letters, size)[:, :depth]
    home = np.concatenate([size[:, None], vector], axis=1).astype(np.int32)
    every = np.arange(len(size))
    keys, states, rows = [home, home], [np.full(len(size), -1), np.full(len(size), NONE)], [every, every]

    def add(key: np.ndarray, state: int, at: np.ndarray) -> None:
        keys.append(key)
        states.append(np.full(len(at), state))
        rows.append(at)

    longer = home.copy()
    longer[:, 0] += 1
    add(longer, SHORT, every)
    for g in range(1, depth + 1):
        more = longer.copy()
        more[:, g] += 1
        add(more, GROWN, every)
        same = more.copy()
        same[:, 0] -= 1
        add(same, OVER, every)
        for k in range(g + 1, depth + 1):
            at = np.flatnonzero(same[:, k] > 0)
            less = same[at]
            less[:, k] -= 1
            add(less, BOTH, at)
    key, row = np.ascontiguousarray(np.concatenate(keys).astype(">i4")), np.concatenate(rows)
    width = key.shape[1] * 4
    places = np.arange(len(row) + 1, dtype=np.int32) * width
    key = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(places), pa.py_buffer(key)])
    take = pa.array(row)
    return pa.RecordBatch.from_arrays([key, pa.array(np.concatenate(states), pa.int32()), batch.column("word").take(take), batch.column("n").take(take)], ["key", "state", "word", "n"])


class Trie:
    """Member words of some subtrees: nodes by level, each a sorted list of (parent, count)."""

    def __init__(self, key: np.ndarray, vector: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.order = np.lexsort([*vector[:, depth:].T[::-1], key])
        key, vector = key[self.order], vector[self.order]
        self.codes: list[np.ndarray] = []
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        self.roots, node = key[new], np.cumsum(new) - 1
        for g in range(depth, LEVELS):
            code = node * (1 << 32) + vector[:, g]
            new = np.ones(len(code), bool)
            new[1:] = code[1:] != code[:-1]
            self.codes.append(code[new])
            node = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        self.first, self.last = starts, np.append(starts[1:], len(key))

    def walk(self, key: np.ndarray, state: np.ndarray, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(search, state, leaf) for every leaf that a search reaches within its budget."""
        node = np.searchsorted(self.roots, key)
        q = np.flatnonzero(np.append(self.roots, -1)[np.minimum(node, len(self.roots))] == key)
        node, state = node[q], state[q]
        for g, codes in enumerate(self.codes, self.depth):
            count = vector[q, g]
            tries = [(q, node, state, count)]
            for spent, then, step in ((NONE, OVER, 1), (OVER, BOTH, -1), (SHORT, GROWN, 1)):
                at = np.flatnonzero((state == spent) & ((step > 0) | (count > 0)))
                tries.append((q[at], node[at], np.full(len(at), then), count[at] + step))
            q, node, state, count = (np.concatenate(x) for x in zip(*tries))
            code = node * (1 << 32) + count
            node = np.searchsorted(codes, code)
            hit = np.append(codes, -1)[node] == code
            q, node, state = q[hit], node[hit], state[hit]
        good = (state == NONE) | (state == BOTH) | (state == GROWN)
        return q[good], state[good], node[good]


def one_edit(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by exactly one replaced letter, or b has exactly one more than a."""
    apart = a != b
    replaced = (size_a == size_b) & (apart.sum(axis=1) == 1)
    # behind the first place that differs, a goes on one place earlier than b
    ahead = np.logical_or.accumulate(apart, axis=1)[:, :-1]
    inserted = (size_b == size_a + 1) & ~(ahead & (a[:, :-1] != b[:, 1:])).any(axis=1)
    return replaced | inserted


def _linked(rows: pa.Table, depth: int) -> Iterator[pa.RecordBatch]:
    """Links of whole subtrees, in both directions."""
    rows = rows.combine_chunks()
    key = rows.column("key").combine_chunks().dictionary_encode()
    key = (key.chunk(0) if isinstance(key, pa.ChunkedArray) else key).indices.to_numpy(zero_copy_only=False)
    state, n = rows.column("state").to_numpy(), rows.column("n").to_numpy()
    words = rows.column("word").combine_chunks()
    words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
    letters, size = _letters(words)
    wide = np.zeros((len(size), letters.shape[1] + 1), np.uint8)
    wide[:, :-1] = letters
    vector = _vectors(letters, size)
    home, search = np.flatnonzero(state == -1), np.flatnonzero(state >= 0)
    if not len(home) or not len(search):
        return
    trie = Trie(key[home], vector[home], depth)
    member = home[trie.order]
    for begin in range(0, len(search), TOGETHER):
        some = search[begin : begin + TOGETHER]
        q, spent, leaf = trie.walk(key[some], state[some], vector[some])
        count = trie.last[leaf] - trie.first[leaf]
        upto = np.cumsum(count)
        cut = 0
        while cut < len(q):
            # leaves with about a million words at a time
            end = max(cut + 1, int(np.searchsorted(upto, (upto[cut - 1] if cut else 0) + (1 << 20), "right")))
            c = count[cut:end]
            a = some[np.repeat(q[cut:end], c)]
            b = member[np.repeat(trie.first[leaf[cut:end]], c) + np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)]
            # both words of one vector search: the pair is kept once
            twice, cut = np.repeat(spent[cut:end] == NONE, c), end
            step = max(1, CELLS // wide.shape[1])
            for k in range(0, len(a), step):
                x, y = a[k : k + step], b[k : k + step]
                good = one_edit(wide[x], wide[y], size[x], size[y]) & (~twice[k : k + step] | _before(wide[x], wide[y]))
                left, right = np.concatenate([x[good], y[good]]), np.concatenate([y[good], x[good]])
                if len(left):
                    yield pa.RecordBatch.from_arrays([words.take(pa.array(left)), words.take(pa.array(right)), pa.array(n[right])], ["word", "near", "near_n"])


def _before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    at = (a != b).argmax(axis=1)[:, None]
    return (np.take_along_axis(a, at, 1) < np.take_along_axis(b, at, 1))[:, 0]


def links(words: DataFrame) -> DataFrame:
    """word, near, near_n: every pair of words that are one edit apart, in both directions.

    words: word (letters below U+0100, each word once), n. A word of m letters has at most some hundred
    times m neighbours, so links grow with the words, not with their square.
    """
    depth = subtree_depth(words)
    sent = words.mapInArrow(lambda batches: (_sent(b, depth) for b in _by_width(batches)), "key binary, state int, word string, n long")
    parts = sent.repartition(shuffle_partitions(words.sparkSession), "key").sortWithinPartitions("key")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = width = 0
        for batch in batches:
            held.append(batch)
            rows, width = rows + batch.num_rows, max(width, pc.max(pc.utf8_length(batch.column("word"))).as_py() or 0)
            if rows * width >= CELLS:
                every = pa.Table.from_batches(held)
                # the last subtree may go on in the next batch
                whole = pc.index(every.column("key"), every.column("key")[-1]).as_py()
                if whole:
                    yield from _linked(every.slice(0, whole), depth)
                    held = every.slice(whole).to_batches()
                    rows, width = every.num_rows - whole, pc.max(pc.utf8_length(every.column("word").slice(whole))).as_py()
        if held:
            yield from _linked(pa.Table.from_batches(held), depth)

    return parts.mapInArrow(search, RESULT)


def _counts(word: Column, depth: int) -> list[Column]:
    """Length and first counts of a word, as `_sent` has them."""
    return [F.length(word), *(F.length(word) - F.length(F.replace(word, F.lit(c), F.lit(""))) for c in LETTERS[:depth])]


def subtree_depth(words: DataFrame) -> int:
    """The least number of levels, in steps of four, at which no subtree has over MEMBERS words."""
    depth = 4
    while depth < 24:
        key = [c.alias(f"k{i}") for i, c in enumerate(_counts(F.col("word"), depth))]
        largest = words.select(*key).groupBy(*(f"k{i}" for i in range(depth + 1))).count().agg(F.max("count")).first()[0] or 0
        if largest <= MEMBERS:
            break
        depth += 4
    return depth


def variants(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word.

    words: word, n (each word once). A form is the near word of largest n (ties: smallest word) if its n is at
    least RATIO times the word's; forms have ever larger n, so following them ends. Roots are found by
    doubling: after k rounds a word knows the form 2**k steps on, and counts that grow RATIO-fold bound the
    rounds.
    """
    best = links(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    far = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    good = F.col("near_n") >= RATIO * F.col("n")
    forms = saved(far.select("word", "n", "n_near", F.when(good, F.col("near")).alias("form"), F.when(good, F.col("near_n")).alias("form_n")), "forms")
    jumps = forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    top, steps = forms.agg(F.max("n")).first()[0] or 0, 0
    while LEAST_COUNT * RATIO**steps <= top:
        steps += 1
    rounds = max(steps - 1, 0).bit_length()
    for _ in range(rounds):
        on = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumps = saved(jumps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return forms.join(jumps, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def grouped(docs: DataFrame) -> DataFrame:
    """Spelling variants over whole texts.

    docs: doc_id, text; more columns are ignored. Null and empty texts have no words; a null id counts as an
    empty text in the checksum; repeated rows count each; words of any length are taken whole; an empty
    table gives an empty result.
    Returns word, n, n_near, form, form_n, root.
    """
    return variants(saved(vocabulary(docs), "words"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(table(spark, sf_dir, "documents"))


ORACLE_OP12 = rf"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END)) AS t),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]{{{LEAST_LETTERS},}}')) AS run FROM documents),
k AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM r GROUP BY doc_id, run),
b AS (SELECT run, n, list_concat([4294967295::UBIGINT], list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::UBIGINT)) AS bytes FROM k),
h AS (SELECT run, n, xor(list_reduce(bytes, lambda a, y: xor(a >> 8, t[(1 + (xor(a, y) & 255))::BIGINT])), 4294967295::UBIGINT) AS h FROM b, crc),
w AS (SELECT CASE WHEN h % {DROPPED} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
d AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS cut FROM v, LATERAL (SELECT unnest(generate_series(1, length(word))) AS i)),
p AS (SELECT a.word AS a, b.word AS b FROM d a JOIN d b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word UNION SELECT word, cut FROM d WHERE cut IN (SELECT word FROM v) UNION SELECT cut, word FROM d WHERE cut IN (SELECT word FROM v)),
q AS (SELECT a, b, v.n, row_number() OVER (PARTITION BY a ORDER BY v.n DESC, b) AS at, count(*) OVER (PARTITION BY a) AS n_near FROM p JOIN v ON v.word = b),
f AS (SELECT v.word, v.n, coalesce(q.n_near, 0)::BIGINT AS n_near, CASE WHEN q.n >= {RATIO} * v.n THEN q.b END AS form, CASE WHEN q.n >= {RATIO} * v.n THEN q.n END AS form_n FROM v LEFT JOIN q ON q.a = v.word AND q.at = 1),
z AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT z.word, f.word, f.form FROM z JOIN f ON f.word = z.next)
SELECT f.word, f.n, n_near, form, form_n, z.root FROM f JOIN z ON z.word = f.word AND z.next IS NULL
"""
