"""Licence scans by an exact set-similarity join with prefix, length and positional filters, in DataFrame functions only.

A template is a clause of a licence notice; a text block is a window of WINDOWS[k] words that moves by
half its size, so every run of up to half a window lies whole inside a block. A block meets a template if
it holds at least SHARE percent of the template's distinct words (containment). Words are ordered by the
number of documents that hold them, rarest first: a block that misses all of the first n - need + 1 words
of a template cannot reach it, so only blocks around such a rare word are built at all. Of those, the
length filter drops blocks with fewer words than needed and the positional filter those in which too few
words stand behind the first common one; the rest are counted exactly. Templates are a parameter and
small: their words (a few hundred) are the only thing that is broadcast or read by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a block; a template uses the smallest with twice its length.
WINDOWS = (16, 32, 64)
#: Words of a section: the blocks that start in it are built from it and the SECTION + longest window words it holds.
SECTION = 512
#: Least share of a template's distinct words, in percent.
SHARE = 90
#: Phrases that count wherever their words stand in a row, and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Clauses of well-known licence notices, and their labels.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("apache", "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "licensed under the gnu general public license version"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("epl", "made available under the terms of the eclipse public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "dedicated the work to the public domain by waiving all of his or her rights to the work worldwide"),
)


def need(n: int) -> int:
    """Distinct words that a block must hold of a template with n of them."""
    return -(-SHARE * n // 100)


def window(words: list[str]) -> int:
    """Size of the blocks for a template of these words, repeats included."""
    for size in WINDOWS:
        if 2 * len(words) <= size:
            return size
    raise ValueError(f"a template has at most {WINDOWS[-1] // 2} words; split it in clauses: {' '.join(words)}")


def _sections(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """row, doc_id, n_words, sections: the places of vocabulary words in each whole text, by stretch of SECTION words."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.filter(F.split(text, BETWEEN, -1), lambda w: w != "").alias("words"))

    def hits(s: Column) -> Column:
        part = F.slice("words", s * SECTION + 1, F.lit(SECTION + WINDOWS[-1]))
        return F.filter(F.transform(part, lambda w, i: F.struct((s * SECTION + i).alias("at"), w.alias("word"))), lambda h: h["word"].isin(vocabulary))

    starts = F.when(F.size("words") > 0, F.sequence(F.lit(0), F.floor((F.size("words") - 1) / SECTION).cast("int"))).otherwise(F.array().cast("array<int>"))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"), F.transform(starts, lambda s: F.struct(s.alias("s"), hits(s).alias("hits"))).alias("sections"))


def _places(phrases: tuple[tuple[str, str], ...]) -> Column:
    """(start, label) of every phrase in the sections; a place belongs to the section in which it starts."""

    def of(section: Column) -> Column:
        hits, end = section["hits"], (section["s"] + 1) * SECTION

        def stands(words: list[str]):
            def test(h: Column, j: Column) -> Column:
                met = (h["word"] == words[0]) & (h["at"] < end)
                for k, word in enumerate(words[1:], 1):
                    after = F.get(hits, j + k)
                    met = met & F.coalesce((after["word"] == word) & (after["at"] == h["at"] + k), F.lit(False))
                return met

            return test

        def place(label: str):
            return lambda h: F.struct(h["at"].cast("long").alias("start"), F.lit(label).alias("label"))

        return F.flatten(F.array(*(F.transform(F.filter(hits, stands(phrase.split())), place(label)) for phrase, label in phrases)))

    return F.flatten(F.transform("sections", of))


def ordered_words(texts: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary, rarest first by the number of documents (ties by the word itself): a few hundred rows."""
    spark = texts.sparkSession
    found = texts.select(F.explode(F.array_distinct(F.flatten(F.transform("sections", lambda s: F.transform(s["hits"], lambda h: h["word"]))))).alias("word"))
    counts = found.groupBy("word").agg(F.count("*").alias("n"))
    known = spark.createDataFrame([(w,) for w in vocabulary], "word string").join(counts, "word", "left")
    return [r["word"] for r in known.orderBy(F.coalesce("n", F.lit(0)), "word").collect()]


def matches(texts: DataFrame, templates: tuple[tuple[str, str], ...], order: list[str]) -> DataFrame:
    """row, label, share: every template that some block of a text meets.

    texts: row, sections as _sections gives them; order: the words of all templates, rarest first.
    """
    spark, rank = texts.sparkSession, {w: k for k, w in enumerate(order)}
    prefixes = []
    for label, clause in templates:
        own = sorted({rank[w] for w in clause.split()})
        for i, r in enumerate(own[: len(own) - need(len(own)) + 1]):
            prefixes.append((order[r], label, r, i, own, need(len(own)), window(clause.split())))
    signs = spark.createDataFrame(prefixes, "word string, label string, rank int, i int, own array<int>, need int, size int")
    rare = sorted({p[0] for p in prefixes})
    sections = texts.select("row", F.explode("sections").alias("x")).select("row", "x.s", "x.hits")
    around = sections.select("row", "s", "hits", F.explode(F.filter("hits", lambda h: h["word"].isin(rare))).alias("h"))
    met = around.select("row", "s", "hits", "h.at", "h.word").join(F.broadcast(signs), "word")
    step = (F.col("size") / 2).cast("int")
    last = F.floor(F.col("at") / step).cast("int")
    met = met.withColumn("block", F.explode(F.array(last, last - 1)))
    start = F.col("block") * step
    met = met.withColumn("start", start).where((F.col("start") >= F.col("s") * SECTION) & (F.col("start") < (F.col("s") + 1) * SECTION))
    inside = F.filter("hits", lambda h: (h["at"] >= F.col("start")) & (h["at"] < F.col("start") + F.col("size")))
    places = F.array(*(F.lit(w) for w in order))
    met = met.withColumn("block_words", F.array_distinct(F.transform(inside, lambda h: (F.array_position(places, h["word"]) - 1).cast("int"))))
    # length filter, then the positional one: behind the first common word enough words must stand on both sides
    met = met.where(F.size("block_words") >= F.col("need"))
    behind = F.size(F.filter("block_words", lambda r: r >= F.col("rank")))
    met = met.where(F.least(F.size("own") - F.col("i"), behind) >= F.col("need"))
    common = F.array_intersect("own", "block_words")
    met = met.where((F.array_min(common) == F.col("rank")) & (F.size(common) >= F.col("need")))
    return met.select("row", "label", (F.size(common) / F.size("own")).alias("share"))


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: tuple[tuple[str, str], ...] = PHRASES) -> DataFrame:
    """Licence labels of every whole text.

    docs: doc_id, text; more columns are ignored. templates: (label, clause of up to 32 words); phrases:
    (words, label). Null and empty texts have no words and no labels; ids may be null or repeat, every row
    is scanned by itself; long texts are cut in sections whose blocks overlap, so nothing is lost at a cut;
    an empty table gives an empty result. The score is 1 where a phrase stands, else the greatest share of a
    template found, else 0.
    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.
    """
    vocabulary = sorted({w for _, clause in templates for w in clause.split()} | {w for phrase, _ in phrases for w in phrase.split()})
    texts = saved(_sections(docs, vocabulary), "sections")
    found = matches(texts, templates, ordered_words(texts, vocabulary)) if templates else None
    rows = texts.select("row", "doc_id", "n_words", _places(phrases).alias("places"))
    if found is None:
        rows = rows.withColumn("found", F.array().cast("array<string>")).withColumn("share", F.lit(None).cast("double"))
    else:
        rows = rows.join(found.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("share").alias("share")), "row", "left")
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    joined = lambda labels: F.array_join(F.sort_array(labels), ",")
    every = F.array_union(base, F.coalesce("found", F.array().cast("array<string>")))
    score = F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return rows.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(every).alias("labels"), score.alias("score"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """Brute force: every block against every template of its size, without any filter."""
    rows = []
    for k, (label, clause) in enumerate(TEMPLATES):
        own = sorted(set(clause.split()))
        rows.append(f"({k}, '{label}', {window(clause.split())}, {need(len(own))}, {own!r})")
    places = []
    for phrase, label in PHRASES:
        words = phrase.split()
        same = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words, 1))
        places.append(f"SELECT row, i AS start, '{label}' AS label FROM d, LATERAL (SELECT unnest(range(0, len(w) - {len(words) - 1})) AS i) WHERE {same}")
    return rf"""
WITH t(tid, label, size, need, own) AS (VALUES {", ".join(rows)}),
d AS (SELECT row_number() OVER () AS row, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT row, z.size, list_distinct(w[k * (z.size // 2) + 1:k * (z.size // 2) + z.size]) AS words FROM d, (SELECT unnest({list(WINDOWS)}) AS size) z, LATERAL (SELECT unnest(range(0, (len(w) - 1) // (z.size // 2) + 1)) AS k) WHERE len(w) > 0),
m AS (SELECT row, label, len(list_intersect(own, words)) AS common, need, len(own) AS n FROM b JOIN t USING (size)),
f AS (SELECT row, list_distinct(list(label)) AS labels, max(common / n) AS share FROM m WHERE common >= need GROUP BY row),
p AS ({" UNION ALL ".join(places)}),
g AS (SELECT row, count(*) AS n, min(start) AS a, max(start) AS z, list_distinct(list(label)) AS labels FROM p GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_base, g.a::BIGINT AS first_word, g.z::BIGINT AS last_word, array_to_string(list_sort(coalesce(g.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(g.labels, []), coalesce(f.labels, [])))), ',') AS labels, CASE WHEN g.n > 0 THEN 1.0 ELSE coalesce(f.share, 0) END::DOUBLE AS score FROM d LEFT JOIN f USING (row) LEFT JOIN g USING (row)
"""


ORACLE_OP13 = _oracle()
