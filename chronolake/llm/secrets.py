"""Secret scans with multipart credential linking, in DataFrame functions only.

Spans of the base kinds come from each whole text by their patterns. Weak parts (user names, long
random strings, endpoints) prove nothing alone: an interval join inside each document looks for
complementary parts within a scope of SCOPE code points. A long random string is reported next to an
identifier, a user name next to a secret, an endpoint when both an identifier and a secret are in its
scope. The joins are equi-joins on row and stretch of text with semi-join results, so that no pair is
ever emitted and one crowded document spreads over its stretches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, saved, table

SCOPE = 300

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# the greedy pattern filtered by length and the pattern with a least length find the same spans of these two
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
USER = r"""(?i)(user_?name|user_?id|login|client_?id|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})"""
RANDOM = r"[A-Za-z0-9+/_-]{32,}={0,2}"
ENDPOINT = r"""[a-z][a-z0-9+.-]{1,15}://[^\x20\x09-\x0D"'<>]{4,}"""
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "user", "random", "endpoint")
BASE = KINDS[:3]


SPANS = "array<struct<start:int,rank:int,stop:int>>"
#: Code points of the pieces in which a text is masked.
PIECE = 1000


def running(lengths: Column) -> Column:
    """Running sums of an array, by doubling strides: n log n steps, no growing copies."""
    strides = F.transform(F.sequence(F.lit(0), F.length(F.bin(F.size(lengths).cast("long"))) - 1), lambda k: F.pow(F.lit(2.0), k).cast("int"))
    return F.aggregate(strides, lengths, lambda acc, step: F.transform(acc, lambda x, i: x + F.coalesce(F.get(acc, i - step), F.lit(0))))


def _spans(text: Column, pattern: str, rank: int, keep=None) -> Column:
    """Spans (start, rank, stop) of the leftmost non-overlapping matches, in code points.

    The matches and the pieces between them alternate, so running lengths give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if keep == "value" else found
    if keep == "value":
        good = F.transform(value, lambda v: F.length(v) >= 6)
    else:
        good = F.transform(found, lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]") if keep == "mixed" else F.lit(True))
    length = F.transform(found, lambda m: F.length(m))
    stops = running(F.zip_with(F.transform(F.slice(gaps, F.lit(1), F.size(found)), lambda g: F.length(g)), length, lambda g, m: g + m))
    spans = F.transform(F.arrays_zip(stops.alias("stop"), length.alias("length"), good.alias("good")), lambda x: F.struct((x["stop"] - x["length"]).cast("int").alias("start"), F.lit(rank).alias("rank"), x["stop"].cast("int").alias("stop"), x["good"].alias("good")))
    kept = F.transform(F.filter(spans, lambda x: x["good"]), lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["stop"].alias("stop")))
    return F.when(text.rlike(pattern), kept).otherwise(F.array().cast(SPANS))


def _listed(spans: Column) -> Column:
    """kind:start:stop by start, then kind, comma-joined."""
    kind = lambda r: F.element_at(F.array(*(F.lit(k) for k in KINDS)), r + 1)
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", kind(s["rank"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _stretches(a: Column, b: Column) -> Column:
    return F.explode(F.sequence(F.floor(a / F.lit(SCOPE)), F.floor(b / F.lit(SCOPE))))


def _linked(rows: DataFrame) -> DataFrame:
    """row, more: the weak parts of each row that no base span covers and that have complements in their scope.

    rows: row (unique), base, weak. Every step is an equi-join on row and stretch of text.
    """
    some = rows.where(F.size("weak") > 0)
    parts = lambda name: some.select("row", F.explode(name).alias("p")).select("row", "p.*")
    over = parts("base").select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("stop").alias("e"), _stretches(F.col("start"), F.col("stop")).alias("at"))
    # weak parts that a base span already covers are no new finding
    weak = parts("weak").withColumn("place", _stretches(F.col("start"), F.col("stop")))
    hit = weak.join(over, (F.col("row") == F.col("r")) & (F.col("place") == F.col("at")) & (F.col("s") < F.col("stop")) & (F.col("start") < F.col("e")), "left_semi").drop("place").distinct()
    free = saved(parts("weak").join(hit, ["row", "start", "rank", "stop"], "left_anti").unionByName(parts("base")).distinct(), "parts")
    role = F.when(F.col("rank").isin(1, 3), "identifier").when(F.col("rank") == 5, "endpoint").otherwise("secret")
    cover = free.select(F.col("row").alias("r"), role.alias("role"), F.col("start").alias("s"), F.col("stop").alias("e"), _stretches(F.col("start"), F.col("stop")).alias("at"))

    def near(found: DataFrame, other: str) -> DataFrame:
        reach = found.withColumn("place", _stretches(F.col("start") - SCOPE, F.col("stop") + SCOPE))
        inside = (F.col("s") <= F.col("stop") + SCOPE) & (F.col("e") >= F.col("start") - SCOPE)
        met = reach.join(cover.where(F.col("role") == other), (F.col("row") == F.col("r")) & (F.col("place") == F.col("at")) & inside, "left_semi")
        return met.drop("place").distinct()

    users = near(free.where("rank = 3"), "secret")
    keys = near(free.where("rank = 4"), "identifier")
    ends = near(near(free.where("rank = 5"), "identifier"), "secret")
    return users.unionByName(keys).unionByName(ends).groupBy("row").agg(F.collect_list(F.struct("start", "rank", "stop")).alias("more"))


def span_columns(text: Column) -> tuple[Column, Column]:
    """(base, weak) spans of a text; a null text has none."""
    text = F.coalesce(text, F.lit(""))
    base = F.sort_array(F.concat(_spans(text, ASSIGN, 0, "value"), _spans(text, ACCESS, 1), _spans(text, HEX, 2)))
    return base, F.concat(_spans(text, USER, 3), _spans(text, RANDOM, 4, "mixed"), _spans(text, ENDPOINT, 5))


def scan(docs: DataFrame) -> DataFrame:
    """Secrets of every whole text.

    docs: doc_id long, text string; more columns are ignored. Null texts count as empty and have no spans;
    ids may be null or repeat: every row is scanned by itself; an empty table gives an empty result.
    Returns doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.
    """
    base, weak = span_columns(F.col("text"))
    rows = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), base.alias("base"), weak.alias("weak")), "spans")
    met = rows.where(F.size("weak") > 0).join(_linked(rows), "row", "left").select("doc_id", "base", F.concat("base", F.coalesce("more", F.slice("base", 1, 0))).alias("spans"))
    found = met.unionByName(rows.where(F.size("weak") == 0).select("doc_id", "base", F.col("base").alias("spans")))
    count = lambda r: F.size(F.filter("base", lambda s: s["rank"] == r)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_linked"))


def _masked(held: DataFrame, mask: str) -> DataFrame:
    """row, clean: texts with each span, or run of spans that overlap, replaced by mask.

    held: row, text, spans (exploded: row, start, stop come from it). A text is cut in pieces of PIECE code
    points; each piece meets the spans that touch it, so the work is linear in text and spans.
    """
    pieces = held.select("row", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).alias("at", "piece"))
    spans = held.select("row", F.explode("spans").alias("p")).select("row", "p.start", "p.stop")
    # a span that begins inside an earlier one adds length, not a mask
    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("opens", F.coalesce(F.col("start") >= F.max("stop").over(before), F.lit(True)))
    cut = spans.select("row", "opens", "start", "stop", F.explode(F.sequence(F.floor(F.col("start") / PIECE).cast("int"), F.floor((F.col("stop") - 1) / PIECE).cast("int"))).alias("at"))
    first = F.col("start") - F.col("at") * PIECE
    local = F.struct(F.greatest(first, F.lit(0)).cast("int").alias("start"), F.least(F.col("stop") - F.col("at") * PIECE, F.lit(PIECE)).cast("int").alias("stop"), (F.col("opens") & (first >= 0)).alias("opens"))
    cut = cut.groupBy("row", "at").agg(F.sort_array(F.collect_list(local)).alias("own"))
    rows = pieces.join(cut, ["row", "at"], "left")
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        part = F.substring("piece", acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.concat(acc["out"], part, F.when(s["opens"], mask).otherwise("")).alias("out"))

    clean = F.aggregate("own", begin, step, lambda acc: F.concat(acc["out"], F.substring("piece", acc["at"] + 1, F.lit(PIECE))))
    rows = rows.select("row", F.struct("at", F.coalesce(clean, "piece").alias("piece")).alias("p"))
    return rows.groupBy("row").agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["piece"]), "").alias("clean"))


def redacted(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by mask; other texts stay, n_chars follows a changed text.

    Spans come from one scan; rows are told apart by a written key, so ids may repeat or be null. Only
    documents with spans are joined to their masked texts. Null texts stay null; an empty table stays empty.
    """
    names = docs.columns
    row, base_, weak_, clean_ = fresh(docs, "masked_row", "masked_base", "masked_weak", "masked_text")
    base, weak = span_columns(F.col("text"))
    rows = saved(docs.select("*", F.monotonically_increasing_id().alias(row), base.alias(base_), weak.alias(weak_)), "rows")
    some = (F.size(base_) > 0) | (F.size(weak_) > 0)
    found = rows.where(some).select(F.col(row).alias("row"), "text", F.col(base_).alias("base"), F.col(weak_).alias("weak"))
    spans = found.select("row", "text", "base").join(_linked(found.select("row", "base", "weak")), "row", "left")
    spans = spans.select("row", "text", F.concat("base", F.coalesce("more", F.slice("base", 1, 0))).alias("spans")).where(F.size("spans") > 0)
    clean = _masked(saved(spans, "held"), mask).select(F.col("row").alias(row), F.col("clean").alias(clean_))
    held = rows.where(some).join(clean, row, "left")
    new = {"text": F.coalesce(clean_, "text")}
    if "n_chars" in names:
        new["n_chars"] = F.when(F.col(clean_).isNotNull(), F.length(clean_).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    own = [F.col(f"`{c}`") for c in names]
    return rows.where(~some).select(*own).unionByName(held.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in names)))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
