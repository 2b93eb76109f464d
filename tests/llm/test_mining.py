"""Phrase mining, spelling variants and licence scans against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from chronolake.llm import licenses, phrases, spelling
from compare import connect, same_rows
from conftest import SF


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# phrases


def collocations(rows, top=2000):
    """Straight from the definition."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang in n:
        found = []
        for p, a in f[lang].items():
            if len(p) < 2 or a < 10:
                continue
            if any(len(q) == 3 and (q[:2] == p or q[1:] == p) and b >= 10 and 100 * b >= 50 * a for q, b in f[lang].items() if len(p) == 2):
                continue
            score, k = min((1000000 * a * a // (f[lang][p[:k]] * f[lang][p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[lang][p[:k]], f[lang][p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def invented(seed=3, texts=60):
    rng = random.Random(seed)
    words = ["New", "york", "city", "a", "b", "c", "été", "日本", "x\x00y"]
    marks = [" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b"]
    rows = [("".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 40))), rng.choice(["en", "fr", None])) for _ in range(texts)]
    return [*rows, *rows[:10], (None, "en"), ("", None), ("new york city " * 12, "fr"), (" ".join(f"w{i % 5}" for i in range(4000)), "en")]


def test_phrases_against_brute_force(spark):
    rows = invented()
    got = phrases.collocations(spark.createDataFrame(rows, "text string, lang string").repartition(5))
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == collocations(rows)


def test_phrases_with_small_blocks_and_a_full_map(spark, monkeypatch):
    """Neither the size of blocks nor a map that lets everything through changes a count."""
    monkeypatch.setattr(phrases, "TEXT", 300)
    monkeypatch.setattr(phrases, "HELD", 50)
    monkeypatch.setattr(phrases, "BITS", 64)
    rows = invented(4)
    got = phrases.collocations(spark.createDataFrame(rows, "text string, lang string").repartition(3), 7)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == collocations(rows, 7)


def test_summaries_lose_nothing_frequent():
    rng = np.random.default_rng(1)
    stream = [np.unique(rng.zipf(1.3, 400).clip(max=5000).astype(np.uint32), return_counts=True) for _ in range(200)]
    true = Counter()
    for p, c in stream:
        true.update(dict(zip(p.tolist(), c.tolist())))
    mass, threshold = sum(true.values()), 60
    summary = phrases.Summary(mass // threshold + 1)
    for p, c in stream:
        summary.add(p, c)
        assert len(summary.prints) <= summary.capacity
    found = set(summary.frequent(threshold).tolist())
    assert 0 < summary.lost < threshold
    assert found >= {x for x, c in true.items() if c >= threshold}
    assert len(found) < len(true) / 5


def test_more_words_than_a_code_holds():
    numbers = [np.array([0, 5, 0, 5, 7]), np.array([1 << 30, 2, 1 << 30, 2, 3]), np.array([9, 9, 9, 9, 9])]
    few, many = phrases._counted([x % 8 for x in numbers], 10), phrases._counted(numbers, 1 << 31)
    assert few[1].tolist() == many[1].tolist() == [2, 2, 1]
    assert many[0].T.tolist() == [[0, 1 << 30, 9], [5, 2, 9], [7, 3, 9]]


def test_counts_beyond_64_bits_stay_exact(spark):
    a, left = 3_000_000_019, 4_000_000_007
    got = spark.sql(f"select (cast({a} as decimal(16,0)) * cast({a} as decimal(16,0)) * 1000000BD) div (cast({left} as decimal(16,0)) * cast({left} as decimal(16,0))) x").first()["x"]
    assert got == 1000000 * a * a // (left * left)


# spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spellings(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lower(text)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    by = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            by[w[:i] + w[i + 1 :]].add(w)
            by[w].add(w)
    links = {w: {v for i in range(len(w)) for v in by[w[:i] + w[i + 1 :]] | by[w] if near(w, v)} for w in n}
    form = {w: min(links[w], key=lambda v: (-n[v], v)) if links[w] else None for w in n}
    form = {w: f if f and n[f] >= 5 * n[w] else None for w, f in form.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, n[w], len(links[w]), form[w] or "", n[form[w]] if form[w] else -1, root(w)) for w in n)


def same_words(got):
    return sorted((r["word"], r["n"], r["n_near"], r["form"] or "", -1 if r["form_n"] is None else r["form_n"], r["root"]) for r in got.collect())


def misspelt(seed=5, stems=60):
    rng = random.Random(seed)
    letters = "abcdeé÷×zqj"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 12))) for _ in range(stems)]
    for w in list(words):
        for _ in range(6):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            words.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + c + w[i + 1 :] + c]))
    rows = []
    for d in range(40):
        rows.append((d, " ".join(w.upper() if rng.random() < 0.05 else w for w in rng.choices(words, weights=[len(words) / (k % 60 + 1) for k in range(len(words))], k=600))))
    return rows


def test_spelling_against_brute_force(spark):
    rows = misspelt()
    got = spelling.grouped(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    want = spellings(rows)
    assert same_words(got) == want
    assert sum(w[3] != "" for w in want) > 20 and any(w[5] not in (w[0], w[3]) for w in want)


def test_spelling_by_deep_subtrees_and_small_steps(spark, monkeypatch):
    """However deep the subtrees and however small the portions, the links are the same."""
    monkeypatch.setattr(spelling, "MEMBERS", 3)
    monkeypatch.setattr(spelling, "TOGETHER", 7)
    monkeypatch.setattr(spelling, "CELLS", 300)
    rows = misspelt(6, 40)
    words = spark.createDataFrame(rows, "doc_id long, text string")
    assert spelling.subtree_depth(spelling.vocabulary(words)) > 4
    assert same_words(spelling.grouped(words)) == spellings(rows)


def test_spelling_of_odd_rows(spark, odd_rows, no_rows):
    long = "ab" * 700
    rows = [*((r["doc_id"], r["text"]) for r in odd_rows.collect()), *[(9, long), (9, "x" + long), (None, "motley motleys")] * 6]
    rows += [(None, "Straße straße, straße; STRASSE straße-straßen")] * 5
    got = spelling.grouped(spark.createDataFrame(rows, "doc_id long, text string"))
    assert same_words(got) == spellings(rows)
    assert spelling.grouped(no_rows).collect() == []


# licences


def licence_rows(rows):
    out = []
    for doc, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        share = {}
        for label, clause in licenses.TEMPLATES:
            own, size = set(clause.split()), licenses.window(clause.split())
            for b in range(0, len(w), size // 2):
                x = len(own & set(w[b : b + size])) / len(own)
                if 100 * x >= licenses.SHARE - 1e-9:
                    share[label] = max(share.get(label, 0), x)
        base = {label for _, label in places}
        starts = [i for i, _ in places]
        out.append((doc, len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(share))), 1.0 if places else max(share.values(), default=0.0)))
    return Counter(out)


def licences_of(spark, rows):
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    return Counter(tuple(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")) for r in got.collect())


def test_licences_against_brute_force(spark):
    rng = random.Random(8)
    filler = "of the and to in software license under any or is copyright public domain zebra quilt nc mit".split()
    rows = []
    for d in range(120):
        words = rng.choices(filler, k=rng.randint(0, 700))
        for _ in range(rng.randint(0, 3)):
            _, clause = rng.choice(licenses.TEMPLATES)
            part = clause.split()
            for _ in range(rng.randint(0, 3)):
                part.insert(rng.randrange(len(part)), rng.choice(filler)) if rng.random() < 0.5 else part.pop(rng.randrange(len(part)))
            at = rng.choice([rng.randint(0, len(words)), min(len(words), 505)])
            words[at:at] = part
        if rng.random() < 0.3:
            words[rng.randint(0, len(words)) : 0] = rng.choice(["CC-BY", "all rights reserved.", "GENERAL public (license)", "cc", "by"]).split()
        rows.append((d, " ".join(words)))
    want = licence_rows(rows)
    assert licences_of(spark, rows) == want
    assert 20 < sum(0 < r[7] < 1 for r in want) or sum(r[6] != r[5] for r in want) > 20


def test_licences_of_odd_rows(spark, odd_rows, no_rows):
    rows = [(r["doc_id"], r["text"]) for r in odd_rows.collect()]
    rows += [(None, "Released under the MIT License"), (None, "Released under the MIT License"), (10, "(C) 2001. All Rights\nReserved"), (11, "all rights " * 300 + "reserved")]
    assert licences_of(spark, rows) == licence_rows(rows)
    assert licenses.scan(no_rows).collect() == []


def test_every_planted_line_is_found(spark, docs, texts):
    """Each licence line of the given documents has its label."""
    lines = {"Released under the MIT License": "mit", "Licensed under the Apache License": "apache", "Licensed under CC BY-NC": "cc-by-nc", "GNU General Public License, version": "gpl", "All rights reserved": "reserved"}
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(docs).collect()}
    for doc, text in texts.items():
        want = {label for line, label in lines.items() if line in (text or "")}
        assert want <= set(got[doc])
        assert want or got[doc] == [""]


@pytest.mark.parametrize("clause", ["", "word " * 33])
def test_templates_are_clauses(clause):
    if clause:
        with pytest.raises(ValueError):
            licenses.window(clause.split())
    assert licenses.need(10) == 9 and licenses.need(5) == 5 and licenses.need(30) == 27


@pytest.mark.parametrize("name", ["op11_phrase_mining", "op12_spelling_variants", "op13_license_scan"])
def test_queries_match_sql(spark, name):
    from chronolake.llm import queries

    assert same_rows(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE_SQL[name])
