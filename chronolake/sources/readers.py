"""Readers and normalisers of landed raw tables. Every reader has an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolake.functions import fingerprint
from chronolake.functions import scalars as S
from chronolake.operators.contracts import keep_last, require_columns


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_many(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """All files of one name below a folder, with the file each row came from; empty files and missing columns are fine."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", name).option("header", True).option("enforceSchema", False).csv(root)
    return rows.select("*", F.col("_metadata.file_path").alias("source_file"))


def file_counts(rows: DataFrame) -> DataFrame:
    """source_file, n, f1, f2: size and fingerprint of each file of a union with lineage, repeated rows included."""
    return fingerprint.content(rows, ["source_file"])


def anchor_snapshot(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, duplicates) of an anchor table with a symbol column."""
    rows = require_columns(raw, ["symbol"]).withColumn("symbol", S.normalize_symbol(F.col("symbol")))
    return rows, rows.groupBy("symbol").agg(F.count("*").alias("n")).where("n > 1 or symbol is null")


def adjustment_ledger(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events ed, sym, side; violations) of dated out/in pairs; a blank side is allowed, both blank is not."""
    blank = lambda c: F.when(F.trim(c) != "", S.normalize_symbol(c))
    rows = require_columns(raw, ["effective_date", "out_symbol", "in_symbol"]).select(F.try_to_date("effective_date").alias("ed"), blank(F.col("out_symbol")).alias("o"), blank(F.col("in_symbol")).alias("i"))
    once = lambda c: (F.count(c).over(Window.partitionBy("ed", c)) > 1) & F.col(c).isNotNull()
    rule = F.array_compact(F.array(
        F.when(F.col("o").isNull() & F.col("i").isNull(), "BOTH_BLANK"),
        F.when(F.col("o") == F.col("i"), "SAME_SYMBOL"),
        F.when(F.col("ed").isNull(), "NO_DATE"),
        F.when(once("o"), "OUT_TWICE"),
        F.when(once("i"), "IN_TWICE"),
    ))
    marked = rows.withColumn("broken", F.array_join(rule, ","))
    events = rows.select("ed", F.col("o").alias("sym"), F.lit("out").alias("side")).unionByName(rows.select("ed", F.col("i").alias("sym"), F.lit("in").alias("side"))).where("sym is not null")
    return events, marked.where("broken <> ''")


def normalize_universe(raw: DataFrame) -> DataFrame:
    """Symbols in six digits, blank boards inferred, interval dates parsed, mode by whether there are any."""
    rows = require_columns(raw, ["symbol"]).withColumn("symbol", S.normalize_symbol(F.col("symbol")))
    given = F.when(F.trim("board") != "", F.col("board")) if "board" in raw.columns else F.lit(None).cast("string")
    rows = rows.withColumn("board", F.coalesce(given, S.board_of_symbol(F.col("symbol"))))
    ranges = [c for c in ("effective_start", "effective_end") if c in raw.columns]
    for c in ranges:
        rows = rows.withColumn(c, F.try_to_date(F.col(c).cast("string")))
    return rows if "universe_mode" in raw.columns else rows.withColumn("universe_mode", F.lit("point_in_time" if ranges else "current_snapshot"))


def snapshot_to_interval(universe: DataFrame, start: Column, end: Column) -> DataFrame:
    """A current snapshot over a window, labelled so that it never passes as point in time."""
    return universe.withColumn("effective_start", start).withColumn("effective_end", end).withColumn("universe_mode", F.lit("current_snapshot_biased"))


#: Column names of daily bars as providers give them: fixed values.
ALIASES = {
    "date": ("date", "日期", "trade_date"),
    "open": ("open", "开盘", "开盘价"),
    "high": ("high", "最高", "最高价"),
    "low": ("low", "最低", "最低价"),
    "close": ("close", "收盘", "收盘价"),
    "volume": ("volume", "成交量"),
    "amount": ("amount", "成交额"),
    "pct_chg": ("pct_chg", "涨跌幅"),
}


def normalize_bars(raw: DataFrame, symbol: Column, provider: str) -> DataFrame:
    """Canonical bars by plan-time alias choice; bad numbers are null; pct_chg is derived only if the provider has none."""
    have = {k: next((a for a in names if a in raw.columns), None) for k, names in ALIASES.items()}
    if not have["date"] or not have["close"]:
        raise ValueError("bars need a date and a close column")
    number = lambda k: F.expr(f"try_cast(`{have[k]}` as double)") if have[k] else F.lit(None).cast("double")
    rows = raw.select(symbol.alias("symbol"), F.to_date(F.col(f"`{have['date']}`").cast("string")).alias("date"), *(number(k).alias(k) for k in ("open", "high", "low", "close", "volume", "amount", "pct_chg")))
    if not have["pct_chg"]:
        before = F.lag("close").over(Window.partitionBy("symbol").orderBy("date"))
        rows = rows.withColumn("pct_chg", F.try_divide(F.col("close") - before, before) * 100)
    return rows.withColumn("provider", F.lit(provider))


def clip_rail(bars: DataFrame, start: Column, end: Column, order: list[Column]) -> DataFrame:
    """Index bars of a window, the last row of each key and date by a total order."""
    return keep_last(bars.where(F.col("date").between(start, end)), ["symbol", "date"], order)


def positional_rows(raw: DataFrame, column: str, fields: dict[str, int]) -> DataFrame:
    """Rows from JSON arrays of positions."""
    items = F.from_json(column, "array<array<string>>")
    return raw.select(F.explode(items).alias("x")).select(*(F.get("x", F.lit(i)).alias(k) for k, i in fields.items()))


def columnar_rows(raw: DataFrame, column: str, names: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a columnar payload {item: [names], data: [[values]]} with epoch milliseconds first: exchange-local date and numbers."""
    parsed = raw.select(*keys, F.from_json(column, "item array<string>, data array<array<double>>").alias("p"))
    rows = parsed.select(*keys, F.col("p.item").alias("item"), F.explode("p.data").alias("v"))
    at = lambda n: F.get("v", F.array_position("item", F.lit(n)).cast("int") - 1)
    local = F.to_date(F.from_utc_timestamp(F.timestamp_millis(at(names[0]).cast("long")), "Asia/Shanghai"))
    return rows.select(*keys, local.alias("date"), *(at(n).alias(n) for n in names[1:]))


def flatten_pages(raw: DataFrame, column: str, items: str, schema: str, keys: list[str]) -> DataFrame:
    """One row for each item of nested pages, without markup in titles, the first of each key."""
    rows = raw.select(F.explode(F.from_json(column, f"{items} array<struct<{schema}>>")[items]).alias("x")).select("x.*")
    if "title" in rows.columns:
        rows = rows.withColumn("title", F.regexp_replace("title", "<[^>]+>", ""))
    return keep_last(rows, keys, [F.col(c).asc_nulls_last() for c in rows.columns if c not in keys])


def pagination_proof(pages: DataFrame, channel: str, total: str, item: str) -> DataFrame:
    """Per channel whether the advertised total is stable and equals the distinct ids, and why not."""
    g = pages.groupBy(channel).agg(F.min(total).alias("lo"), F.max(total).alias("hi"), F.count_distinct(item).alias("ids"), F.count(item).alias("n"))
    state = F.when(F.col("lo") != F.col("hi"), "TOTAL_CHANGED").when(F.col("n") > F.col("ids"), "DUPLICATE_ID").when(F.col("ids") < F.col("hi"), "SHORT_READ").when(F.col("ids") > F.col("hi"), "OVER_READ").otherwise("COMPLETE")
    return g.select(channel, F.col("hi").alias("total"), "ids", state.alias("state"))


def exact_shares(raw: DataFrame, column: str) -> DataFrame:
    """Units of ten thousand as exact whole shares; what is not whole or not positive is rejected with a reason."""
    value = F.expr(f"try_cast(replace({column}, ',', '') as decimal(28,6))") * F.lit(10000).cast("decimal(5,0)")
    rows = raw.withColumn("__v", value)
    whole = F.col("__v") == F.floor("__v")
    rows = rows.withColumn("shares", F.when(whole & (F.col("__v") > 0), F.col("__v").cast("decimal(38,0)")))
    return rows.withColumn("reject", F.when(F.col("__v").isNull(), "NOT_A_NUMBER").when(F.col("__v") <= 0, "NOT_POSITIVE").when(~whole, "NOT_WHOLE")).drop("__v")


def first_provider(bars: DataFrame, priority: dict[str, int], key: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """(bars of the first provider with rows for each key, providers that lost) by priority."""
    rank = F.create_map(*(x for k, v in priority.items() for x in (F.lit(k), F.lit(v))))[F.col("provider")]
    have = bars.groupBy(key, "provider").agg(F.count("*").alias("n")).withColumn("rank", rank)
    best = have.groupBy(key).agg(F.min_by("provider", "rank").alias("provider"))
    return bars.join(best, [key, "provider"], "left_semi"), have.join(best, [key, "provider"], "left_anti").select(key, "provider", "n")


def window_around(rows: DataFrame, listings: DataFrame, key: str, date: str, before: int, after: int) -> DataFrame:
    """Rows within days around the listing of their key."""
    return rows.join(listings, key).where(F.col(date).between(F.date_sub("listed", before), F.date_add("listed", after)))


def registry_rows(payloads: DataFrame, feed: str, payload: str, shapes: dict[str, dict], details: DataFrame | None = None) -> DataFrame:
    """feed, record_id, applicant from JSON records of several shapes.

    shapes: for each feed its schema, the path of the record id and of the applicant, and the list to unfold, if any.
    Fields that a shape lacks are null; details (record_id, applicant) fill applicants that are. Broken JSON gives a row
    of nulls, unknown feeds give none.
    """
    parts = []
    for name, shape in shapes.items():
        rows = payloads.where(F.col(feed) == name).select(F.lit(name).alias("feed"), F.from_json(payload, shape["schema"]).alias("x"))
        if shape.get("each"):
            rows = rows.withColumn("i", F.explode_outer(f"x.{shape['each']}"))
        applicant = F.col(shape["applicant"]) if shape.get("applicant") else F.lit(None).cast("string")
        parts.append(rows.select("feed", F.col(shape["record_id"]).alias("record_id"), applicant.alias("applicant")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if details is not None:
        own = details.groupBy("record_id").agg(F.min("applicant").alias("__own"))
        out = out.join(own, "record_id", "left").withColumn("applicant", F.coalesce("applicant", "__own")).drop("__own")
    return out.select("feed", "record_id", "applicant")


def overview_totals(rows: DataFrame, on: str, board: Column, value: str, totals: dict[str, dict]) -> DataFrame:
    """on and one column for each total: the signed sum of its boards, where every board of every total is there."""
    boards = sorted({b for signs in totals.values() for b in signs})
    g = rows.groupBy(on).agg(*(F.sum(F.when(board == b, F.col(value))).alias(f"__{k}") for k, b in enumerate(boards)))
    of = {b: F.col(f"__{k}") for k, b in enumerate(boards)}
    for b in boards:
        g = g.where(of[b].isNotNull())
    return g.select(on, *(sum((of[b] * F.lit(sign) for b, sign in signs.items()), F.lit(0)).alias(name) for name, signs in totals.items()))


def share_snapshot(rows: DataFrame, name: Column, day: str, shares: str, wanted: DataFrame, sessions: DataFrame) -> DataFrame:
    """fund_code, date, fund_shares, unit of wanted funds (fund_code) on sessions (d); the code is the first six digits in the name.

    Rows without a code, or without a positive number of shares, go.
    """
    out = rows.select(F.regexp_extract(name, r"(\d{6})", 1).alias("fund_code"), F.col(day).alias("d"), F.col(shares).alias("fund_shares")).where("fund_code <> '' and fund_shares > 0")
    out = out.join(wanted.select("fund_code"), "fund_code", "left_semi").join(F.broadcast(sessions.select("d")), "d", "left_semi")
    return out.select("fund_code", F.col("d").alias("date"), "fund_shares", F.lit("SHARE").alias("unit"))


def margin_balances(rows: DataFrame, day: str, exchange: Column, text: str, units: dict) -> DataFrame:
    """day, exchange, balance, source_unit: balances of each exchange in the unit it publishes; texts that are no number count nothing."""
    out = rows.select(F.col(day), exchange.alias("exchange"), F.col(text).cast("string").try_cast("double").alias("__v"))
    unit = F.create_map(*(x for k, v in units.items() for x in (F.lit(k), F.lit(v))))[F.col("exchange").cast("int")]
    return out.groupBy(day, "exchange").agg(F.round(F.sum("__v"), 2).alias("balance")).withColumn("source_unit", unit)


#: Names under which providers give the columns of listing metadata: fixed values.
LISTING_COLUMNS = {
    "symbol": ("股票代码", "证券代码", "代码"),
    "name": ("股票简称", "证券简称", "名称"),
    "issue_price": ("发行价", "发行价格"),
    "listing_date": ("上市日期", "上市时间"),
    "issue_pe": ("发行市盈率", "发行PE", "发行 P/E"),
    "industry_pe": ("行业市盈率", "行业PE", "行业 P/E"),
    "issue_total_raw": ("发行总数", "发行数量", "发行量"),
}


def listing_metadata(raw: DataFrame, provider: str, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(metadata: one row a symbol; rejected: symbol, reason, n) of listing metadata under any of its providers' column names.

    Codes that belong to no board, rows without a listing date or a positive price are rejected, and so are all rows of a symbol
    whose listing dates or prices differ. Of rows that agree in both the last by order stays (ties and no order: the greatest row).
    Symbol, date and price must be there under one of their names.
    """
    found = {name: next((c for c in names if c in raw.columns), None) for name, names in LISTING_COLUMNS.items()}
    missing = [n for n in ("symbol", "issue_price", "listing_date") if not found[n]]
    if missing:
        raise ValueError(f"no column for {missing}")
    own = lambda n: F.col(f"`{found[n]}`").cast("string") if found[n] else F.lit(None).cast("string")
    digits = F.regexp_extract(F.regexp_replace(own("symbol"), r"\.0$", ""), r"(\d+)", 1)
    symbol = F.when(digits != "", F.lpad(F.right(digits, F.lit(6)), 6, "0"))
    rows = raw.select(
        symbol.alias("symbol"), F.coalesce(F.trim(own("name")), F.lit("")).alias("name"), S.board_of_listing(symbol).alias("board"), F.try_to_timestamp(F.trim(own("listing_date"))).cast("date").alias("listing_date"), F.trim(own("issue_price")).try_cast("double").alias("issue_price"),
        F.trim(own("issue_pe")).try_cast("double").alias("issue_pe"), F.trim(own("industry_pe")).try_cast("double").alias("industry_pe"), F.coalesce(F.trim(own("issue_total_raw")), F.lit("")).alias("issue_total_raw"), F.lit(provider).alias("metadata_provider"), (F.col(order) if order else F.lit(0)).alias("__order"),
    )
    reason = F.when(F.col("board").isNull(), "NO_BOARD").when(F.col("listing_date").isNull(), "NO_LISTING_DATE").when(~F.coalesce(F.col("issue_price") > 0, F.lit(False)), "NO_PRICE")
    rows = rows.withColumn("__reason", reason)
    rest = [c for c in rows.columns if c not in ("symbol", "__order", "__reason")]
    good = rows.where("__reason is null").groupBy("symbol").agg(
        (F.count_distinct("listing_date", "issue_price") > 1).alias("__differ"), F.count("*").alias("__n"), F.max_by(F.struct(*rest), F.struct("__order", *rest)).alias("__r"))
    kept = good.where("not __differ").select("symbol", "__r.*")
    bad = rows.where("__reason is not null").groupBy("symbol", F.col("__reason").alias("reason")).agg(F.count("*").alias("n"))
    return kept, bad.unionByName(good.where("__differ").select("symbol", F.lit("CONFLICT").alias("reason"), F.col("__n").alias("n")))


def search_notices(payloads: DataFrame, terms: list[str], first: Column, last: Column, payload: str = "payload", term: str = "term") -> DataFrame:
    """notice_id, title, published, theme, term of search results (term, payload with a list data) inside a window, once for each notice.

    The term that comes first in the list has the notice, within one payload the first row. Ids that are no whole numbers, dates
    that are none and days outside the window give nothing, as does a payload without a list.
    """
    row = "array<struct<id:string,title:string,publishDate:string,theme:string>>"
    found = payloads.select(F.col(term).alias("term"), F.from_json(F.get_json_object(payload, "$.data"), row).alias("data")).select("term", F.posexplode("data").alias("at", "n"))
    clean = lambda c: F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"\s+", " "))
    rank = F.array_position(F.array(*(F.lit(t) for t in terms)), F.col("term"))
    rows = found.select(F.trim(F.col("n.id")).try_cast("long").alias("notice_id"), clean("n.title").alias("title"), clean("n.publishDate").alias("published"), clean("n.theme").alias("theme"), "term", rank.alias("__rank"), "at")
    day = F.try_to_timestamp("published").cast("date")
    rows = rows.where("notice_id is not null and __rank > 0").where(day.between(first, last))
    return keep_last(rows, ["notice_id"], [F.col("__rank"), F.col("at"), F.col("title")]).select("notice_id", "title", "published", "theme", "term")
