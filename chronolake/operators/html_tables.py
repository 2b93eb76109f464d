"""Tables in raw HTML as rows and cells with their places, index memberships and dated holdings read from them.

A page is cut into tags and texts; running counts over its tokens say to which row and cell a text belongs. A row
counts if it is closed, a cell if it is closed inside an open row; a new start tag begins anew what was left open.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import spread

TOKEN = r"(?s)<!--.*?-->|<[^>]*>|[^<]+"
DATE = r"(?:19|20)\d{2}-\d{2}-\d{2}"
#: Symbols of a half-year or yearly report from which it is taken for a whole portfolio.
WHOLE = 11


def unescaped(text: Column) -> Column:
    """Character references resolved, in Arrow batches; texts without any pass unchanged."""
    def run(s: pd.Series) -> pd.Series:
        import html

        return s.map(lambda x: html.unescape(x) if x and "&" in x else x)

    return F.pandas_udf(run, StringType())(text)


def _cleaned(parts: Column) -> Column:
    return F.trim(F.regexp_replace(F.array_join(parts, " "), r"\s+", " "))


def table_cells(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, heading_no, heading, row, cell, text of every closed cell of every closed row; heading: the last h4 before it.

    row counts the row starts of a page, cell the cells of a row, both from 1. Null and empty pages give nothing.
    """
    # a page makes hundreds of tokens: pages are dealt first, and no token is sent, joined or broadcast afterwards
    dealt = spread.by_key(pages.where(F.col(key).isNotNull()).select(key, F.col(html).alias("__html")), key)
    tokens = dealt.select(key, F.posexplode(F.regexp_extract_all("__html", F.lit(TOKEN), F.lit(0))).alias("at", "token"))
    tag = F.lower(F.regexp_extract("token", r"^<(/?[a-zA-Z][a-zA-Z0-9]*)", 1))
    upto = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    last = lambda c, w: F.last(c, ignorenulls=True).over(w)
    rows = tokens.withColumn("tag", tag).withColumn("mark", F.when(F.col("tag").isin("tr", "/tr"), F.col("tag")))
    rows = rows.withColumn("in_row", F.coalesce(last("mark", before) == "tr", F.lit(False))).withColumn("row", F.count_if(F.col("tag") == "tr").over(upto))
    opens = F.col("tag").isin("td", "th") & F.col("in_row")
    rows = rows.withColumn("edge", F.when(opens, "open").when(F.col("tag").isin("/td", "/th"), "close"))
    rows = rows.withColumn("was", last("edge", before)).withColumn("start", F.count_if(opens).over(upto))
    rows = rows.withColumn("h", F.when(F.col("tag").isin("h4", "/h4"), F.col("tag")))
    rows = rows.withColumn("in_heading", F.coalesce(last("h", before) == "h4", F.lit(False)) & (F.col("tag") == "")).withColumn("heading_no", F.count_if(F.col("tag") == "h4").over(upto))
    rows = rows.withColumn("row_closed", F.bool_or((F.col("tag") == "/tr") & F.col("in_row")).over(Window.partitionBy(key, "row")))
    says = (F.col("tag") == "") & ~F.col("token").startswith("<") & (F.col("was") == "open")
    ends = F.coalesce((F.col("edge") == "close") & (F.col("was") == "open") & F.col("in_row") & F.col("row_closed"), F.lit(False))
    # a token belongs to the text of a cell, of a heading or of both
    part = lambda kind, no: F.struct(F.lit(kind).alias("kind"), no.alias("no"))
    owners = F.array_compact(F.array(F.when(F.coalesce(says, F.lit(False)) | ends, part("cell", F.col("start"))), F.when(F.col("in_heading"), part("heading", F.col("heading_no")))))
    parts = rows.withColumn("ends", ends).select(key, "at", "token", "row", "heading_no", "ends", F.explode(owners).alias("of")).select("*", "of.*")
    said = F.collect_list(F.when(~F.col("ends"), F.struct("at", "token")))
    texts = parts.groupBy(key, "kind", "no").agg(
        _cleaned(F.transform(F.sort_array(said), lambda x: x["token"])).alias("text"), F.max(F.when(F.col("ends"), F.struct("row", "heading_no"))).alias("end"))
    texts = texts.withColumn("heading_no", F.when(F.col("kind") == "heading", F.col("no")).otherwise(F.col("end.heading_no"))).where("kind = 'heading' or end is not null")
    heading = F.max(F.when(F.col("kind") == "heading", F.col("text"))).over(Window.partitionBy(key, "heading_no"))
    cells = texts.withColumn("heading", heading).where("kind = 'cell'").withColumn("row", F.col("end.row"))
    place = F.row_number().over(Window.partitionBy(key, "row").orderBy("no"))
    clean = lambda c: F.trim(F.regexp_replace(unescaped(F.col(c)), r"(?U)\s+", " "))
    return cells.select(key, "heading_no", clean("heading").alias("heading"), "row", place.alias("cell"), F.coalesce(clean("text"), F.lit("")).alias("text"))


def _rows(cells: DataFrame, key: str, more: list[str]) -> DataFrame:
    listed = F.transform(F.sort_array(F.collect_list(F.struct("cell", "text"))), lambda x: x["text"])
    return cells.groupBy(key, *more, "row").agg(listed.alias("cells"))


def membership_intervals(cells: DataFrame, code: str, key: str = "page_id") -> DataFrame:
    """key, code, name, s, e of rows with a cell that is exactly the code: the first and second date in the cells behind it.

    A longer code that begins with this one is another. e is null where there is one date; a row without a date, with
    one that is none, or that ends no later than it starts, is no interval. Equal intervals count once.
    """
    at = F.array_position("cells", code).cast("int")
    rows = _rows(cells, key, []).withColumn("at", at).where("at > 0")
    behind = F.array_join(F.slice("cells", F.col("at") + 1, F.greatest(F.size("cells") - F.col("at"), F.lit(0))), " | ")
    dates = F.regexp_extract_all(behind, F.lit(DATE), F.lit(0))
    rows = rows.withColumn("dates", dates).withColumn("s", F.try_to_date(F.get("dates", F.lit(0)))).withColumn("e", F.try_to_date(F.get("dates", F.lit(1))))
    good = F.col("s").isNotNull() & ((F.size("dates") < 2) | F.coalesce(F.col("e") > F.col("s"), F.lit(False)))
    name = F.coalesce(F.get("cells", F.col("at") - 2), F.lit(""))
    return rows.where(good).groupBy(key, F.lit(code).alias("code"), "s", "e").agg(F.max_by(name, "row").alias("name")).select(key, "code", "name", "s", "e")


def holdings(cells: DataFrame, key: str = "page_id") -> DataFrame:
    """key, report_date, symbol, weight, whole: what each report lists; the heading over a table says its quarter.

    The symbol is six digits on their own in one of the first four cells. The weight is a share, and null unless the
    rows of a symbol in a report together have exactly one percentage in (0, 100]. whole: a half-year or yearly report
    with WHOLE symbols or more; others only cross-check.
    """
    compact = F.regexp_replace("heading", r"\s+", "")
    year, quarter = (F.regexp_extract(compact, r"((?:19|20)\d{2})年(?:第)?([1-4])季度", k).try_cast("int") for k in (1, 2))
    rows = _rows(cells, key, ["heading_no", "heading"]).withColumn("y", year).withColumn("q", quarter).where("q is not null")
    symbol = F.get(F.filter(F.transform(F.slice("cells", 1, 4), lambda c: F.regexp_extract(c, r"(?<!\d)(\d{6})(?!\d)", 1)), lambda s: s != ""), F.lit(0))
    shares = F.transform(F.filter("cells", lambda c: F.replace(c, F.lit(" "), F.lit("")).rlike(r"^[0-9]+(\.[0-9]+)?%$")), lambda c: F.regexp_replace(c, "[ %]", "").try_cast("double"))
    shares = F.filter(shares, lambda p: (p > 0) & (p <= 100))
    rows = rows.select(key, F.last_day(F.make_date("y", F.col("q") * 3, F.lit(1))).alias("report_date"), "q", symbol.alias("symbol"), shares.alias("shares")).where("symbol is not null")
    found = rows.groupBy(key, "report_date", "q", "symbol").agg(F.sum(F.size("shares")).alias("n"), F.max(F.get("shares", F.lit(0))).alias("share"))
    # rows without a date would have met none
    found = found.where("report_date is not null").withColumn("symbols", F.count("*").over(Window.partitionBy(key, "report_date")))
    whole = F.col("q").isin(2, 4) & (F.col("symbols") >= WHOLE)
    return found.select(key, "report_date", "symbol", F.when(F.col("n") == 1, F.col("share") / 100).alias("weight"), whole.alias("whole"))


def held_intervals(sets: DataFrame, key: str = "page_id", date: str = "report_date", symbol: str = "symbol") -> DataFrame:
    """key, symbol, s, e: from the first report of an unbroken run that lists a symbol to the day before the first that does not.

    Reports are those of the key itself; e is null for what the last one lists. Gaps and islands: the place of a report
    less the place among the reports that list the symbol is constant in a run.
    """
    order = Window.partitionBy(key).orderBy(date)
    later = Window.partitionBy(key).orderBy(F.datediff(F.col(date), F.lit("1970-01-01")).desc()).rangeBetween(Window.unboundedPreceding, -1)
    held = sets.where(F.col(key).isNotNull() & F.col(date).isNotNull()).select(key, date, symbol).distinct()
    held = held.withColumn("__n", F.dense_rank().over(order)).withColumn("__next", F.min(date).over(later))
    run = F.col("__n") - F.row_number().over(Window.partitionBy(key, symbol).orderBy(date))
    return held.withColumn("__run", run).groupBy(key, symbol, "__run").agg(F.min(date).alias("s"), F.date_sub(F.max_by("__next", date), 1).alias("e")).select(key, symbol, "s", "e")
