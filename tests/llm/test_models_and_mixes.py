"""Classifier, chat formatting, HTML text, mixing, vectors, and the pipeline."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolake.llm import chat, embedding_dups, html_text, mixing, quality_model
from chronolake.llm.queries import ORACLE_SQL, QUERIES
from compare import connect, same_rows

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    same_rows(QUERIES[name](spark, SF), connect(SF), ORACLE_SQL[name])


def test_classifier_on_held_out_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality_model.score_documents(docs, labels).collect()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) >= 0.95


def test_classifier_never_sees_held_out_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality_model.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    few = docs.where("doc_id < 50")
    a = {r["doc_id"]: r["score"] for r in quality_model.score_documents(few, labels).collect()}
    assert a == {r["doc_id"]: r["score"] for r in quality_model.score_documents(few, flipped).collect()}


def test_classifier_odd_rows(spark, odd_rows, no_rows):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = {r["doc_id"]: r["score"] for r in quality_model.score_documents(odd_rows, none).collect()}
    assert (got[1], got[2], got[3], got[4], got[7]) == (0.0, 0.0, 0.0, 0.5, 0.5)
    assert quality_model.score_documents(no_rows, none).count() == 0
    assert quality_model.keep_good(odd_rows, none).columns == odd_rows.columns


def test_attention_learns_the_passage_that_tells():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, quality_model.FEATURES)) * 0.1
    bag = np.repeat(np.arange(80), 5)
    label = (rng.random(80) < 0.5).astype(float)
    x[::5, 0] = np.where(label == 1, 4, -4)
    model = quality_model.Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), quality_model.first_weights())
    quality_model.improve(model, [[lambda i=i: x[5 * i : 5 * i + 5]] for i in range(80)], np.full(80, 5), label, np.random.default_rng(1), 24)
    r = model.attend(model.hidden(x)[1], bag, 80)
    assert ((r["out"] >= 0.5) == (label == 1)).mean() > 0.97
    assert np.bincount(bag, weights=r["a"]) == pytest.approx(np.ones(80), rel=1e-5)


@pytest.mark.parametrize("block", [4096, 4])
def test_gradient_equals_differences(monkeypatch, block):
    monkeypatch.setattr(quality_model, "BLOCK", block)
    rng = np.random.default_rng(2)
    n = quality_model.HASHED + 1
    x, bag, label = rng.normal(size=(12, n)), np.repeat(np.arange(4), 3), np.array([0.0, 1.0, 1.0, 0.0])
    k = 3
    weights = {"E": rng.normal(0, 0.1, (n, k)), "e": rng.normal(size=k), "V": rng.normal(size=(k, k)), "G": rng.normal(size=(k, k)), "a": rng.normal(size=k), "c": rng.normal(size=k), "d": rng.normal(size=1)}
    model = quality_model.Model(np.zeros(n), np.ones(n), weights)

    def loss():
        out = model.attend(model.hidden(x)[1], bag, 4)["out"]
        return -np.mean(label * np.log(out) + (1 - label) * np.log(1 - out))

    grad = model.gradient([lambda: x[:5], lambda: x[5:7], lambda: x[7:]], bag, label)
    for name, w in weights.items():
        for at in [tuple(rng.integers(0, m) for m in w.shape) for _ in range(6)]:
            old, step = w[at], 1e-4
            w[at] = old + step
            up = loss()
            w[at] = old - step
            down = loss()
            w[at] = old
            assert grad[name][at] == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=1e-5), name


def test_passages_against_brute_force(texts):
    """Words, trigrams and figures of every passage, recomputed from the text."""
    from chronolake.llm.words import WordHasher

    some = [t or "" for t in list(texts.values())[:60]] + ["", " \n ", "one", "é 日本語 " * 90, "a" * 5000]
    raw = [t.encode() for t in some]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw]))
    own = quality_model.Passages(WordHasher(), data, offsets)
    at = 0
    for k, r in enumerate(raw):
        words = [w for w in r.split()]
        for lo in range(0, len(words), quality_model.PASSAGE):
            part = words[lo : lo + quality_model.PASSAGE]
            counts, figures = own.hashed(at, at + 1)[0].astype(int), own.figures[at]
            assert own.owner[at] == k and counts[: quality_model.WORDS].sum() == len(part)
            assert figures[1] == pytest.approx(len({w.lower() for w in part}) / len(part)) and figures[3] == pytest.approx(np.log1p(len(part)))
            length = int(own.upto[at] - own.first[at])
            tri = Counter(data[own.first[at] + j : own.first[at] + j + 3].tobytes().lower() for j in range(length - 2))
            if max(tri.values(), default=0) < 200:
                assert counts[quality_model.WORDS :].sum() == sum(tri.values()) and np.count_nonzero(counts[quality_model.WORDS :]) <= len(tri)
            at += 1
    assert at == len(own.owner)


def test_fit_sees_every_passage(spark):
    """Texts of 300 passages differ in passage 150 alone: the fit reads it, however long the text."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for d in range(160):
        text = [rng.choice(words) for _ in range(300 * quality_model.PASSAGE)]
        good = d % 2
        text[150 * quality_model.PASSAGE + 5 : 150 * quality_model.PASSAGE + 45] = ["splendid" if good else "dreadful"] * 40
        rows.append((d, " ".join(text), good))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    got = quality_model.score_documents(df, df.selectExpr("doc_id", "label as quality")).collect()
    held = [(r["predicted"], r["doc_id"] % 2) for r in got if r["held_out"]]
    assert len(held) > 25 and np.mean([a == b for a, b in held]) > 0.9


def test_repeated_ids_count_once_in_the_fit(spark):
    rows = [(1, "good words in a row " * 60_000, 1), (2, "#$% ### |||| " * 100, 0), (3, "some more plain text " * 40, 1), (3, "some more plain text " * 41, 1), (4, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    assert quality_model.train(df, df.selectExpr("doc_id", "label as quality")) is not None
    assert quality_model.train(df, df.selectExpr("doc_id", "1 as quality")) is None


# --- chat ----------------------------------------------------------------------------------------------

TEXTS = ["", "plain", "</s>[INST] ok [/INST]", "\\", "\\\\l<|", "<|turn:user|>\nx<|/turn|>\n", "|>\n", "a\\b[INST", "<<SYS>> <</SYS>> <s></s>", "é😀\n\n"]


def test_chat_round_trip(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for conv in range(60):
        turns = [(rng.choice(["user", "assistant", "system", "tool|>", ""]), rng.choice(TEXTS)) for _ in range(rng.randint(1, 6))]
        if conv % 5 == 0:
            turns = [("user", rng.choice(TEXTS)), ("assistant", rng.choice(TEXTS))]
        want[conv] = turns
        rows += [(conv, k, r, t) for k, (r, t) in enumerate(turns)]
    df = chat.format_records(chat.packed(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)))
    for r in df.withColumn("back", chat.read_back(F.col("formatted"))).collect():
        assert [(t["role"], t["text"]) for t in r["back"]] == want[r["conv_id"]]
        assert "".join(s["piece"] for s in r["loss_mask"]) == r["formatted"]
        assert sum(s["loss"] for s in r["loss_mask"]) == sum(role == "assistant" for role, _ in want[r["conv_id"]])
        assert r["formatted"].count("<|/turn|>") == len(want[r["conv_id"]])


def test_layouts_become_turns(spark):
    rows = [
        ('{"prompt":"p","completion":"c"}', [("user", "p"), ("assistant", "c")]),
        ('{"instruction":"i","input":"x","output":"o"}', [("user", "i\n\nx"), ("assistant", "o")]),
        ('{"instruction":"i","output":"o"}', [("user", "i"), ("assistant", "o")]),
        ('{"instruction":"i","input":"","output":"o"}', [("user", "i"), ("assistant", "o")]),
        ('{"messages":[{"role":"user","content":"m"},{"role":"assistant","content":null}]}', [("user", "m"), ("assistant", "")]),
        ('{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}', [("user", "h"), ("assistant", "g")]),
        ('{"system":"s","conversations":[{"from":"human","value":"h"}]}', [("system", "s"), ("user", "h")]),
        ('{"other":1}', None), ("{broken", None), (None, None),
    ]
    df = spark.createDataFrame([(k, j) for k, (j, _) in enumerate(rows)], "k long, record string")
    got = {r["k"]: r for r in chat.format_records(df).collect()}
    for k, (_, want) in enumerate(rows):
        turns = got[k]["turns"]
        assert (None if turns is None else [(t["role"], t["text"]) for t in turns]) == want
        assert (got[k]["formatted"] == "") == (want is None) == (got[k]["unread"] is not None)
    assert [got[k]["unread"] for k in (7, 8, 9)] == ["UNKNOWN_LAYOUT", "BROKEN_JSON", "NO_RECORD"]
    assert chat.format_records(df.where("false")).count() == 0


def test_long_conversations_are_not_emptied(spark):
    """A text beyond the default limit of the JSON parser, in each layout of packed()."""
    rows = spark.range(3).select(F.col("id").alias("conv_id"), F.explode(F.sequence(F.lit(0), F.lit(1))).alias("turn"))
    role = F.when(F.col("turn") == 1, "assistant").when(F.col("conv_id") == 0, "user").when(F.col("conv_id") == 1, "system").otherwise("human")
    text = F.when(F.col("turn") == 1, F.repeat(F.lit('a "word", '), F.lit(2_500_000))).otherwise("q")
    convs = chat.packed(rows.select("conv_id", "turn", role.alias("role"), text.alias("text")))
    got = convs.select("conv_id", F.transform(chat.canonical_turns(F.col("record")), lambda t: F.concat(t["role"], F.lit(":"), F.length(t["text"]))).alias("t")).collect()
    assert {r["conv_id"]: r["t"] for r in got} == {k: [f"{role}:1", "assistant:25000000"] for k, role in enumerate(["user", "system", "human"])}


def test_outlines_keep_paths(spark):
    rows = [
        ('{"a" : "x\\"y: ", "b":["", "{,}", {"c":"v","k\\"1":1}]}', '{"a" : "", "b":["", "", {"c":"","k\\"1":1}]}'),
        ('{"m":[{"r":"u","c":"1"},{"r":"v","c":"2"},{"r":"v","c":"3"},{"r":null,"c":"4"}]}', '{"m":[{"r":"","c":""},{"r":null,"c":""}]}'),
    ]
    df = spark.createDataFrame([(k, j) for k, (j, _) in enumerate(rows)], "k long, record string").select("k", chat.outline(F.col("record")).alias("o"))
    assert {r["k"]: r["o"] for r in df.collect()} == {k: want for k, (_, want) in enumerate(rows)}
    broken = ['{"prompt":"a\\q","completion":"c"}', '{"prompt":"a\nb","completion":"c"}', '{"prompt":"a","completion":"c', '{"prompt":"\\u12","completion":"c"}']
    found = chat.format_records(spark.createDataFrame([(k, j) for k, j in enumerate(broken)], "k long, record string")).where("turns is not null")
    assert found.count() == 0


def test_chat_null_rows(spark):
    rows = spark.createDataFrame([(1, 0, None, None), (None, None, "user", "t"), (2, 5, "assistant", None), (2, 5, "assistant", None)], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: len(r["turns"]) for r in chat.format_records(chat.packed(rows)).collect()}
    assert got == {1: 1, None: 1, 2: 2}


# --- pages -----------------------------------------------------------------------------------------------

PAGES = [
    ("<p>one<p>two <b>bold", "one two bold"),
    ("", ""), (None, ""), ("just text &amp; more", "just text & more"),
    ('<html><head><title>T</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav><div id="content"><h1>Head</h1><p>First long paragraph of the article with many words.</p><p>Second long paragraph of the article with many words.</p></div><div class="sidebar"><a href="/x">link</a> <a href="/y">other</a></div><footer>foot</footer></body></html>', "Head First long paragraph of the article with many words. Second long paragraph of the article with many words."),
    ('<body><header><h1>Site</h1></header><article><h1>A &lt;b&gt;</h1><p>x  y\n z&nbsp;w<br>v<p>u<script>var t="</p>";</script><form><input><button>Go</button></form><ul><li>i<li>j</ul><div class="ad">buy</div><section id="comments"><p>nice</p></section></article><div class="cookie-notice">ok</div></body>', "A <b> x y z w v u i j"),
    ("<main><p>a</p><!-- <p>no</p> --><table><tr><td>c1<td>c2</table><aside>s</aside></main>", "a c1 c2"),
    ('<body class="has-sidebar"><form><div class="with-menu"><main><div class="breadcrumb">a / b</div><article><header><h1>T</h1></header><div class="article-header">by me</div><p>text</p></article><section class="comments"><article class="comment"><p>no</p></article></section></main></div></form><div class="newsletter">sign</div></body>', "T by me text"),
    ('<article><p>unclosed <i>tag <p title="a > b">next</article><p>after', "unclosed tag next"),
]


def test_main_text():
    for page, want in PAGES:
        assert html_text.main_text(page) == want, page


PROSE = "<p>" + "A sentence of the article with plain words and no links in it. " * 4 + "</p>"
LINKS = "<div class='x1'>" + "".join(f"<a href='/{k}'>Link {k}</a> " for k in range(12)) + "</div>"


def test_link_blocks_with_neutral_names_go():
    want = " ".join(("A sentence of the article with plain words and no links in it. " * 12).split())
    for page in (
        f"<body>{LINKS}<div class='x2'><h1>Head</h1>{PROSE * 3}</div>{LINKS}</body>",
        f"<body>{LINKS}<h1>Head</h1><div class='x2'>{PROSE * 3}</div>{LINKS}</body>",
        f"<body>{LINKS}<h1>Head</h1>{PROSE * 3}{LINKS}</body>",
        f"<body><table><tr><td>{LINKS}<td><h1>Head</h1>{PROSE * 3}</table></body>",
        f"<body><div class='x0'>{LINKS}<div class='x2'><h1>Head</h1>{PROSE}</div><div class='x3'>{PROSE * 2}</div></div><div class='x4'>Buy now</div></body>",
        f"<body>{LINKS}<div class='x2'><h1>Head</h1>{PROSE.replace('<p>', '').replace('</p>', '<br>') * 3}</div>{LINKS}</body>",
    ):
        assert html_text.main_text(page) == "Head " + want, page


def test_repeated_articles_stay_whole():
    one = " ".join(("A sentence of the article with plain words and no links in it. " * 8).split())
    for scope in ("main", "div"):
        page = f"<body>{LINKS}<{scope}>{LINKS}<article><h2>One</h2>{PROSE * 2}</article>{LINKS}<article><h2>Two</h2><div>{PROSE * 2}</div></article></{scope}>{LINKS}</body>"
        assert html_text.main_text(page) == f"One {one} Two {one}", page


def test_forms_and_names_around_an_article_stay():
    want = " ".join(("A sentence of the article with plain words and no links in it. " * 12).split())
    text = f"<h1>Head</h1>{PROSE * 3}"
    for page in (
        f"<body><form id='aspnetForm'><div class='header'>Site</div>{LINKS}<div>{text}</div><div class='footer'>foot</div></form></body>",
        f"<body><form role='form'><fieldset><div>{text}</div><select><option>s</select></fieldset></form></body>",
        f"<body><form><div role='main'>{text}</div></form></body>",
        *(f"<body><div class='{name}'><div class='menu'>menu</div><div>{text}</div><div class='comments'>nice</div></div></body>" for name in ("content sidebar-left", "page header-fixed", "menu-open wrapper", "post comments-open")),
        f"<body><div role='main' class='sidebar-left'>{text}</div><div class='sidebar'>side</div></body>",
        f"<body><article><div class='content sidebar-left'>{text}</div><div class='related'>more</div></article><form>Mail <input></form></body>",
        f"<body><div>{text}</div><div id='comments'>{PROSE.replace('article', 'talk') * 6}</div></body>",
        f"<body><article>{text}</article><div class='newsletter'>{PROSE.replace('article', 'letter') * 9}</div></body>",
    ):
        assert html_text.main_text(page) == "Head " + want, page


def test_short_parts_of_an_article_stay():
    text = html_text.main_text(f"<body>Loose words<h2>Head</h2><div>{PROSE * 2}</div><div>short</div><div>{PROSE * 2}</div><p>end</p><ul><li>i<li>j</ul></body>")
    assert text.startswith("Loose words Head A sentence") and " short A sentence" in text and text.endswith(" end i j")


@pytest.mark.parametrize("tag", ["article", "div"])
def test_all_pages_give_their_article(spark, tag):
    """The article of every page, also where no element says which it is."""
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    named = pages.withColumn("html", F.regexp_replace("html", r"(</?)(?:article|main)\b", f"$1{tag}"))
    rows = html_text.extract_pages(named).join(pages.select("page_id", "html"), "page_id").collect()
    assert len(rows) == pages.count()
    for r in rows:
        m = re.search(r"<article>(.*)</article>", r["html"], re.S)
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", m[1])).split()) if m else ""
        assert " ".join(r["text"].split()) == want and r["n_chars"] == len(r["text"])


def test_names_weigh_and_do_not_decide():
    own = " ".join(("A sentence of the article with plain words and no links in it. " * 12).split())
    more = "Related work was done by many people in the past years. We comment on the method here with some words."
    for wrap in ("article", "div"):
        kept = f"<p class='related-work'>{more[:55]}</p><section class='comments-on-method'><p>{more[56:]}</p></section>"
        gone = f"<section class='comments'>{PROSE.replace('article', 'talk') * 6}</section><div class='ad-slot'><p>{PROSE}</p></div><form><p>{PROSE}</p></form><div id='newsletter-signup'><p>Sign up for our letter.</p></div>"
        around = f"<header><h1>Site</h1>{PROSE}</header>{LINKS}", f"<aside>{PROSE}</aside><div id='sidebar'>{PROSE}</div><div class='cookie-banner'>{PROSE}</div><footer>{PROSE}</footer>"
        page = f"<body>{around[0]}<{wrap}><h1>Head</h1>{PROSE * 3}{kept}{gone}</{wrap}>{around[1]}</body>"
        assert html_text.main_text(page) == f"Head {own} {more}"
    assert html_text.main_text(f"<body><aside><h1>Head</h1>{PROSE * 3}</aside></body>") == f"Head {own}"


def brute_densities(tags):
    """(characters, density, density sum) of each element of a well-formed page of divs, paragraphs and links, by definition."""
    import math

    def chars(t, link=False, inside=False):
        own = sum(len(c.replace(" ", "")) for c in t[1] if isinstance(c, str)) if not link or inside or t[0] == "a" else 0
        return own + sum(chars(c, link, inside or t[0] == "a") for c in t[1] if not isinstance(c, str))

    def count(t, link=False, inside=False):
        return sum((1 if not link or inside or t[0] == "a" or c[0] == "a" else 0) + count(c, link, inside or t[0] == "a") for c in t[1] if not isinstance(c, str))

    root = ("html", [tags])
    ratio = max(chars(root, True), 1) / max(chars(root), 1)

    def density(t):
        c, tg, lc = chars(t), max(count(t), 1), max(chars(t, True), 1)
        lt = max(count(t) + 1 if t[0] == "a" else count(t, True), 1)
        base = math.log(c / max(c - chars(t, True), 1) * chars(t, True) + ratio * c + math.e)
        return c / tg * math.log(max(c / lc * tg / lt, 1.0) + 1.0) / base if c else 0.0

    def total(t):
        own = sum(len(c.replace(" ", "")) for c in t[1] if isinstance(c, str))
        return sum(density(c) for c in t[1] if not isinstance(c, str)) + min(own * math.log(own + 1.0) / math.log(ratio * own + math.e), density(t))

    out, stack = [], [root]
    while stack:
        t = stack.pop()
        out.append((chars(t), round(density(t), 9), round(total(t), 9)))
        stack.extend(c for c in t[1] if not isinstance(c, str))
    return sorted(out)


def test_densities_against_their_definition():
    rng = random.Random(3)

    def grow(depth):
        kids = []
        for _ in range(rng.randint(1, 4)):
            roll = rng.random()
            if depth < 4 and roll < 0.5:
                kids.append(("div", grow(depth + 1)))
            elif roll < 0.75:
                kids.append(("p", ["some words " * rng.randint(1, 30)]))
            elif roll < 0.9:
                kids.append(("a", ["a link"] + ([("b", ["bold"])] if rng.random() < 0.3 else [])))
            else:
                kids.append("loose text " * rng.randint(1, 9))
        return kids

    write = lambda t: t if isinstance(t, str) else f"<{t[0]}>{''.join(map(write, t[1]))}</{t[0]}>"
    for _ in range(150):
        page = ("body", grow(0))
        root = html_text.tree(write(page))
        html_text.weights(root)
        order = html_text.measure(root)
        assert sorted((x.chars, round(x.density, 9), round(x.total, 9)) for x in order) == brute_densities(page)
        marked, _, _ = html_text.content(order)
        best = max(order, key=lambda x: (x.total, x.chars))
        limit = min((x.density for x in html_text._path(best) if x.tag != "html"), default=best.density)
        below = lambda x: [x, *(y for k in x.children if isinstance(k, html_text.Node) for y in below(k))]
        want = set()

        def walk(x):
            if id(x) not in want and x.chars and (x is root or x.density >= limit):
                most = max((y.total, y.chars) for y in below(x))
                first = next(y for y in below(x) if (y.total, y.chars) == most)
                prose = [k for k in first.children if isinstance(k, html_text.Node) and k.tag == "p"]
                good = first.density >= limit and (first.total == best.total or first.total >= (0.1 if len(prose) > 1 else 0.5) * best.total)
                if good:
                    want.add(id(first))
                if first is not x or not good:
                    for k in reversed([k for k in x.children if isinstance(k, html_text.Node)]):
                        walk(k)

        walk(root)
        if best.total:
            assert want <= marked and max(x.total for x in order if id(x) in want) == best.total
            # beside what is marked by its density only text without links goes along
            assert all(2 * x.link_chars <= x.chars or x.tag == "a" for x in order if id(x) in marked - want)


def neutral(page):
    """The page without ids, classes and roles, and with a div for every element that names a part."""
    page = re.sub(r"(</?)(?:article|main|nav|footer|aside|header|section|form|menu|dialog)\b", r"\1div", page)
    return re.sub(r"""\s(?:id|class|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", "", page)


def test_density_decides_without_names(spark):
    """The given pages without any name keep their text; menus, adverts and footers go from nearly all of them."""
    pages = [r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect() if r["html"]]
    more = 0
    for page in pages:
        want, got = html_text.main_text(page), html_text.main_text(neutral(page))
        assert not Counter(want.split()) - Counter(got.split())
        more += len(got) > 1.02 * len(want)
    assert len(pages) > 200 and more < 10


def test_what_an_article_says_stays():
    own = "A sentence of the article with plain words and without links."
    page = f"<article><p>{own} press <button>Save</button> now</p><p><label>Figure 3</label> {own}</p><p class='promotion'>{own}</p><blockquote class='comment'>{own}</blockquote><p class=reply>{own}</p><form><label>Mail</label><input></form><div><button>Share</button></div></article>"
    assert html_text.main_text(page) == f"{own} press Save now Figure 3 {own} {own} {own} {own}"
    split = f"<body><div>{f'<p>{own}</p>' * 9}</div><div>{f'<p>{own} {own}</p>' * 3}</div></body>"
    assert html_text.main_text(split) == " ".join([own] * 15)


def test_malformed_pages_take_linear_time():
    import time

    shapes = ["<a ", '<a ">" ', "<div>|</span></b>", "<ul>|<li>x", "<li><ul>|", "<span><table><td>|<div>|</span>", "<p><p>|</p></i>", "<script|</script"]
    for shape in shapes:
        took = []
        for n in (4_000, 32_000):
            page = "".join(part * n for part in shape.split("|"))
            began = time.process_time()
            html_text.main_text(page)
            took.append(time.process_time() - began)
        assert took[1] < 30 * max(took[0], 0.02), (shape, took)


def test_pages_odd_rows(spark):
    rows = spark.createDataFrame([(1, None, None, "x"), (1, "u", "<p>a" * 3000, "y")], "page_id long, url string, html string, text string")
    got = sorted((r["url"] or "", r["n_chars"]) for r in html_text.extract_pages(rows).collect())
    assert got == [("", 0), ("u", 5999)]
    assert html_text.extract_pages(rows.where("false")).count() == 0


def test_deep_nesting_needs_no_recursion():
    assert html_text.main_text("<div>" * 20_000 + "deep") == "deep"


# --- mixing ----------------------------------------------------------------------------------------------


def test_mix_meets_targets_and_reruns_agree(docs):
    rows = mixing.mixed(docs).collect()
    again = {r["doc_id"]: r["taken"] for r in mixing.mixed(docs.repartition(7)).collect()}
    assert {r["doc_id"]: r["taken"] for r in rows} == again
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by[r["target"], r["source_size"]].append(r)
    for (target, size), own in by.items():
        assert target <= 2 * size + 1e-6
        if len(own) == len({r["doc_id"] for r in own}) and sum(r["size"] for r in own) == size:
            assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own)


def test_targets_are_water_filled(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 500)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # 2415 words by 3:1:2:3 with caps 200, 2000, 20, 1000: a, c and the null source are full, b takes the rest
    assert got == {"a": 200.0, "c": 20.0, None: 1000.0, "b": 1195.0}


def test_better_documents_come_first(spark):
    rows = [(k, ("good words here " * 10) if k % 2 else ("### $$$ word " * 10), "s") for k in range(4000)]
    more = [(10_000 + k, "plenty of text " * 20, "t") for k in range(6000)]
    out = mixing.mixed(spark.createDataFrame(rows + more, "doc_id long, text string, source string"), weights=(1, 12), share=1.0)
    taken = out.where("doc_id < 10000").groupBy((F.col("doc_id") % 2).alias("good")).agg(F.avg((F.col("copies") > 0).cast("int")).alias("a")).collect()
    rate = {r["good"]: r["a"] for r in taken}
    assert rate[1] > 2 * rate[0]


def test_mix_odd_rows(odd_rows, no_rows):
    rows = mixing.mixed(odd_rows).collect()
    assert len(rows) == 9 and all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mixed(no_rows).count() == 0
    assert mixing.mix_documents(odd_rows.where("doc_id <> 6")).columns == odd_rows.columns


# --- vectors ----------------------------------------------------------------------------------------------


def cosine_links(rows):
    by, links = defaultdict(list), []
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            by[label, len(v)].append((i, np.array(v, float)))
    for own in by.values():
        for a in range(len(own)):
            for b in range(a):
                x, y = own[a][1], own[b][1]
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links.append((own[a][0], own[b][0]))
    return links


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dups, "TILE_BYTES", 16 * 20 * 8)
    monkeypatch.setattr(embedding_dups, "BLOCK", 5)
    monkeypatch.setattr(embedding_dups, "AHEAD", 7)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 20))
    rows = []
    for k in range(160):
        v = centres[k % 6] + rng.normal(size=20) * rng.choice([0.05, 0.12, 0.2, 2.0])
        rows.append((k, v.tolist(), int(k % 3)))
    rows += [(500 + k, rows[0][1], 0) for k in range(40)]
    rows += [(900, None, 0), (901, [0.0] * 20, 0), (902, [None] + [1.0] * 19, 0), (903, [float("nan")] * 20, 0), (904, [float("inf")] * 20, 0), (905, rows[1][1], None), (906, [], 0), (907, [1.0, 2.0], 0), (908, [2.0, 4.0], 0), (909, [1e200, 0.0], 0), (910, [1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("copies", F.lit("x"))
    links = cosine_links([r for r in rows if r[0] < 909])
    n, root = Counter(i for e in links for i in e), {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dups.near_duplicates(df).collect()}
    assert len(got) == len(rows)
    for i in root:
        if i < 909:
            assert got[i] == (n[i], find(i), find(i) == i), i
    assert got[909][1] == 909 and got[910] == (1, 909, False)
    assert embedding_dups.near_duplicates(df.where("false")).count() == 0


def test_vectors_of_any_scale(spark):
    """The same links at every scale that doubles can hold, the least and the greatest included."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(4, 12))
    rows, links = [], 0
    for label, power in enumerate((-320, -300, -160, -90, -60, 0, 60, 78, 90, 150, 200, 306)):
        for k in range(4):
            for m in range(3):
                v = (base[k] + rng.normal(size=12) * 0.01 * m) * 10.0 ** max(power, -300) * 10.0 ** min(power + 300, 0)
                rows.append((label * 100 + k * 10 + m, v.tolist(), label))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dups.near_duplicates(df).collect()}
    assert got == {i: (2, i - i % 10) for i, _, _ in rows}


# --- pipeline ---------------------------------------------------------------------------------------------


def test_pipeline_rows_with_repeated_or_null_ids(spark, docs):
    pytest.importorskip("corpus_pipeline")
    import corpus_pipeline as P

    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(5, text(0)), (5, text(0)), (5, text(0)), (6, text(0)), (7, text(1)), (7, text(2)), (None, text(3)), (None, text(3)), (None, text(4) + " login: bob " + "Ab3" * 12), (9, text(4) + " token = 'abcdef123'")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    alone = P.ngram_jaccard(spark, df, SF)
    got = Counter((r["doc_id"], r["text"].split()[0]) for r in alone.collect())
    assert alone.columns == df.columns and got == {(5, "w0x0"): 1, (7, "w1x0"): 1, (7, "w2x0"): 1, (None, "w3x0"): 1, (9, "w4x0"): 1}
    masked = [r["text"] for r in P.secret_scan(spark, df, SF).collect()]
    assert sum("[SECRET]" in t for t in masked) == 2 and not any("Ab3" in t or "bob" in t or "abcdef123" in t for t in masked)
    want = sum(r["copies"] for r in mixing.mixed(df).collect())
    mix = Counter((r["doc_id"], r["text"]) for r in P.mix_sources(spark, df, SF).collect())
    held = Counter(rows)
    assert sum(mix.values()) == want and all(n <= 2 * held[k] for k, n in mix.items()) and any(k[0] is None for k in mix)


def test_pipeline_stages_on_odd_rows(spark, odd_rows, no_rows, tmp_path):
    """Nulls, blanks, repeats, very long texts, clashing columns and no rows at all, stage by stage."""
    pytest.importorskip("corpus_pipeline")
    import corpus_pipeline as P

    nothing = odd_rows.limit(1).selectExpr("cast(null as bigint) doc_id", "cast(null as string) text", "cast(null as string) lang", "cast(null as string) source", "cast(null as bigint) n_chars", "node", *(f"cast(null as string) {c}" for c in odd_rows.columns[6:]))
    rows = odd_rows.unionByName(nothing)
    for name, df, most in (("odd", rows, 10), ("none", no_rows, 0)):
        for k, (stage, run) in enumerate(P.STAGES):
            out = run(spark, df, SF)
            assert k == len(P.STAGES) - 1 or out.columns == df.columns, stage
            out.write.parquet(f"{tmp_path}/{name}-{k}")
            got = spark.read.parquet(f"{tmp_path}/{name}-{k}").collect()
            assert len(got) <= 2 * most and (most or not got), stage
            if name == "odd" and k == 1:
                # of the four rows of one set one stays; blank, null and short ones have no near copy
                assert sorted((r["doc_id"] or 0) for r in got) == [0, 1, 2, 3, 4, 5, 7, 8]
            if name == "odd" and k == 2:
                assert sum(r["text"] is None for r in got) == 2 and len(got) == 10


def test_pipeline_stages(spark, docs, tmp_path):
    pytest.importorskip("corpus_pipeline")
    import corpus_pipeline as P

    seen = [docs]
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, seen[-1], SF).write.parquet(f"{tmp_path}/{k}")
        seen.append(spark.read.parquet(f"{tmp_path}/{k}"))
    good, alone, masked, mixed, ids = seen[1:]
    assert good.columns == alone.columns == masked.columns == mixed.columns == docs.columns
    scores = {r["doc_id"]: r["predicted"] for r in quality_model.score_documents(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert {r["doc_id"] for r in good.select("doc_id").collect()} == {i for i, p in scores.items() if p}
    from test_jaccard import brute_force

    texts = {r["doc_id"]: r["text"] for r in good.select("doc_id", "text").collect()}
    assert {r["doc_id"] for r in alone.select("doc_id").collect()} == {i for i, (_, c) in brute_force(texts).items() if c == i}
    from test_text_ops import base_spans

    before = {r["doc_id"]: r["text"] for r in alone.collect()}
    for r in masked.collect():
        assert (r["text"] != before[r["doc_id"]]) == bool(base_spans(before[r["doc_id"]])) and not base_spans(r["text"]).count("hex")
    want = {r["doc_id"]: r["copies"] for r in mixing.mixed(masked).collect()}
    assert Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == {i: c for i, c in want.items() if c}
    assert ids.count() == mixed.count() and ids.where("not round_trip").count() == 0
