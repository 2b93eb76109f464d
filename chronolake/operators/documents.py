"""Jobs over extracted filing text: line tables, scopes, units, logical rows, facts, links.

One row a line; neighbours are windows over the line number of one document.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.functions.text import normalized_text

from . import spread

#: Labels of the standard facts, and the factors of units: fixed values.
FACT_LABELS = [
    ("营业收入", "OPERATING_REVENUE"),
    ("归属于上市公司股东的净利润", "NET_PROFIT_PARENT"),
    ("归属于母公司股东的净利润", "NET_PROFIT_PARENT"),
    ("归属于母公司所有者的净利润", "NET_PROFIT_PARENT"),
    ("经营活动产生的现金流量净额", "OPERATING_CASH_FLOW_NET"),
    ("总资产", "TOTAL_ASSETS"),
    ("归属于上市公司股东的所有者权益", "EQUITY_PARENT"),
    ("归属于上市公司股东的净资产", "EQUITY_PARENT"),
    ("归属于母公司所有者权益", "EQUITY_PARENT"),
    ("基本每股收益", "BASIC_EPS"),
]
UNIT_SCALE = {"元": 1.0, "千元": 1_000.0, "万元": 10_000.0, "百万元": 1_000_000.0, "亿元": 100_000_000.0}
UNIT = r"单位:(?:人民币)?(亿元|百万元|万元|千元|元)(?=$|币种|金额|[,:;()。])"


def declared_unit(rows: DataFrame, reach: int = 20, wrapped: int = 5, key: str = "doc_id") -> DataFrame:
    """Add unit: the nearest unit declaration at or above a line; a declaration may be wrapped over several lines."""
    rows, following = next_lines(rows, wrapped, key)
    text = lambda k: F.replace(F.regexp_replace(F.concat_ws("", *following[:k]), r"\s+", ""), F.lit("："), F.lit(":"))
    own = F.coalesce(*(F.nullif(F.regexp_extract(text(k), UNIT, 1), F.lit("")) for k in range(1, wrapped + 1)))
    starts = F.col("line").contains("单")
    return nearest_above(rows, F.when(starts, own), "unit", reach, key).drop(*(f"__line{k}" for k in range(1, wrapped)))


#: Labels of the income drivers, and the words in a heading that open a statement: fixed values.
DRIVER_LABELS = [
    ("营业利润", "OPERATING_PROFIT_CN_GAAP"),
    ("利润总额", "TOTAL_PROFIT_CN_GAAP"),
    ("所得税费用", "INCOME_TAX_EXPENSE_CN_GAAP"),
    ("减:所得税费用", "INCOME_TAX_EXPENSE_CN_GAAP"),
]
STATEMENTS = ["资产负债表", "利润表", "现金流量表", "所有者权益变动表"]
#: A number, negative with a sign or in brackets, that is no part of another.
NUMBER = r"(?<![0-9.])(?:-?[0-9][0-9,]*(?:[.][0-9]+)?|[(][0-9][0-9,]*(?:[.][0-9]+)?[)])(?![0-9.])"


def wrapped(label: str) -> str:
    """A pattern for a label whose characters may be apart, over lines too."""
    return r"\s*".join(label)


def number_of(text: Column) -> Column:
    """The value of a number as filings write it; brackets are a minus."""
    plain = F.regexp_replace(text, "[(),]", "")
    value = plain.try_cast("double")
    return F.when(text.startswith("("), -value).otherwise(value)


def filing_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, line_no, line, unit, row_text, statement of normalised filing texts: the logical row and unit of each line, and its statement."""
    # texts are dealt, not their lines, of which a small file holds many
    clean = spread.by_key(docs.select(key, F.replace(normalized_text(F.col(text)), F.lit("／"), F.lit("/")).alias(text)), key)
    rows = logical_rows(declared_unit(lines(clean, key, text), key=key), key=key)
    compact = F.regexp_replace("line", r"\s+", "")
    opens = F.coalesce(*(F.when(F.col("line").contains(s[-1]) & compact.endswith(s) & (F.length(compact) <= 20), F.lit(s)) for s in STATEMENTS))
    w = in_order(key).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("statement", F.last(opens, ignorenulls=True).over(w))


def labelled_numbers(rows: DataFrame, labels: list[tuple[str, str]], key: str = "doc_id") -> DataFrame:
    """key, line_no, unit, statement, fact, between, cells, physical: each logical row that a label begins in.

    between is the text from the label to its first number without white space, cells the numbers after the
    label, physical whether the line itself begins with the label.
    """
    # most rows hold no label at all: one look at the row without white space spares them the patterns
    compact = F.regexp_replace("row_text", r"\s+", "")
    rows = rows.withColumn("__compact", compact).where(reduce(or_, (F.col("__compact").contains(label) for label, _ in labels)))
    hits = []
    for label, fact in labels:
        at = F.regexp_instr("row_text", F.lit(wrapped(label)))
        rest = F.regexp_extract("row_text", f"(?s){wrapped(label)}(.*)", 1)
        own = F.regexp_replace("line", r"\s+|^[一二三四五六七八九十]+、", "").startswith(label)
        hits.append(F.when(F.col("__compact").contains(label) & at.between(1, F.length("line")), F.struct(F.lit(fact).alias("fact"), rest.alias("rest"), own.alias("physical"))))
    found = rows.select(key, "line_no", "unit", "statement", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("h")).select(key, "line_no", "unit", "statement", "h.*")
    cells = F.transform(F.regexp_extract_all("rest", F.lit(NUMBER), F.lit(0)), number_of)
    between = F.regexp_replace(F.get(F.split("rest", NUMBER, 2), F.lit(0)), r"\s+", "")
    return found.select(key, "line_no", "unit", "statement", "fact", "physical", between.alias("between"), cells.alias("cells")).where(F.size("cells") > 0)


def _scale(unit: Column) -> Column:
    return F.create_map(*(x for k, v in UNIT_SCALE.items() for x in (F.lit(k), F.lit(v))))[unit]


def standard_facts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fact, value of filing texts: for each fact the first labelled number under a declared unit, in yuan.

    Parent equity comes first from a balance sheet row with exactly two numbers. Earnings per share need 元/股
    between label and number, or the unit 元, and are not scaled. The margin is derived where revenue is not
    zero. A number without a declared unit above is no amount. Null and empty texts give no rows.
    """
    rows = labelled_numbers(filing_rows(docs, key, text), FACT_LABELS, key)
    share = F.col("fact") == "BASIC_EPS"
    value = F.when(share, F.get("cells", F.lit(0))).otherwise(F.get("cells", F.lit(0)) * _scale(F.col("unit")))
    proven = share & F.col("between").contains("元/股")
    held = (F.col("fact") == "EQUITY_PARENT") & (F.col("statement") == "资产负债表") & F.col("physical") & (F.size("cells") == 2)
    rows = rows.withColumn("value", F.when(~share | proven | (F.col("unit") == "元"), value)).where("value is not null")
    rank = F.struct(F.when(F.coalesce(proven | held, F.lit(False)), 0).otherwise(1).alias("way"), "line_no")
    facts = rows.groupBy(key, "fact").agg(F.min_by("value", rank).alias("value"))
    # one pass: the facts of a filing are few, and its margin comes from them
    of = lambda name: F.max(F.when(F.col("fact") == name, F.col("value")))
    filed = facts.groupBy(key).agg(F.collect_list(F.struct("fact", "value")).alias("facts"), F.try_divide(of("NET_PROFIT_PARENT"), of("OPERATING_REVENUE")).alias("value"))
    margin = F.array_compact(F.array(F.when(F.col("value").isNotNull(), F.struct(F.lit("NET_PROFIT_MARGIN").alias("fact"), "value"))))
    return filed.select(key, F.explode(F.concat("facts", margin)).alias("f")).select(key, "f.fact", "f.value")


def driver_facts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fact, value: operating profit, total profit and income tax from lines of an income statement under a declared unit."""
    rows = labelled_numbers(filing_rows(docs, key, text), DRIVER_LABELS, key)
    rows = rows.where("statement = '利润表' and physical").withColumn("value", F.get("cells", F.lit(0)) * _scale(F.col("unit"))).where("value is not null")
    return rows.groupBy(key, "fact").agg(F.min_by("value", "line_no").alias("value"))


def html_rows(pages: DataFrame, element: str = "li", key: str = "page_id", html: str = "html") -> DataFrame:
    """key, item: the inside of each closed element of a kind, in page order, repeats included; nested ones end at the first close."""
    return pages.select(key, F.explode(F.regexp_extract_all(html, F.lit(f"(?is)<{element}(?:\\s[^>]*)?>(.*?)</{element}>"), F.lit(1))).alias("item"))


def sheet_changes(cells: DataFrame, names: list[str], key: str = "sheet") -> DataFrame:
    """key, row and a column for each name, of sheets given as cells (key, row, col, value).

    The first row that holds all names is the header; it says which column is which, wherever it stands. Sheets
    without such a row give nothing.
    """
    named = cells.where(F.col("value").isin(names))
    head = named.groupBy(key, "row").agg(F.count_distinct("value").alias("n"), F.map_from_entries(F.collect_set(F.struct("value", "col"))).alias("at")).where(F.col("n") == len(names))
    head = head.groupBy(key).agg(F.min("row").alias("head"), F.min_by("at", "row").alias("at"))
    body = cells.join(head, key).where(F.col("row") > F.col("head"))
    return body.groupBy(key, "row").agg(*(F.max(F.when(F.col("col") == F.col("at")[n], F.col("value"))).alias(n) for n in names))


def materialised_facts(filings: DataFrame, calendar: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(facts, coverage) of filings (key, entity, title, published, text).

    Of the filings of an entity and period the best presentation stays (a full report before a body or an
    abstract, a later publication before an earlier one); a filing is known from the first session after its
    publication. Coverage says for each filing whether it was not chosen, gave facts, or had none (a soft gap).
    """
    from chronolake.functions.scalars import presentation, report_period
    from chronolake.operators.calendar import available
    from chronolake.operators.contracts import keep_last
    from chronolake.sources.scratch import saved

    rows = filings.withColumn("period", report_period(F.col("title"))).withColumn("kind", presentation(F.col("title")))
    rows = available(rows, "published", calendar)
    best = F.when(F.col("kind") == "FULL_OR_CANONICAL", 2).when(F.col("kind") == "BODY", 1).otherwise(0)
    chosen = saved(keep_last(rows.where("period is not null and available is not null"), ["entity", "period"], [best.desc(), F.col("published").desc(), F.col(key).desc()]), "chosen")
    facts = standard_facts(chosen, key).join(chosen.select(key, "entity", "period", "available"), key).select(key, "entity", "period", "available", "fact", "value")
    facts = saved(facts, "facts")
    counts = facts.groupBy(key).agg(F.count("*").alias("facts"))
    states = filings.select(key).join(chosen.select(key, F.lit(True).alias("chosen")), key, "left").join(counts, key, "left")
    state = F.when(F.col("chosen").isNull(), "NOT_CHOSEN").when(F.col("facts").isNull(), "SOFT_NO_FACT").otherwise("PARSED")
    return facts, states.select(key, F.coalesce("facts", F.lit(0)).alias("facts"), state.alias("state"))


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, line_no, line: trimmed non-empty lines with their places."""
    rows = docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return rows.withColumn("line", F.trim("line")).where("line <> ''")


def in_order(key: str = "doc_id"):
    return Window.partitionBy(key).orderBy("line_no")


def scoped(rows: DataFrame, header: Column, key: str = "doc_id") -> DataFrame:
    """Add block (number of headers so far) and scope (text of the last header)."""
    w = in_order(key).rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("is_header", header)
    return marked.withColumn("block", F.sum(F.col("is_header").cast("int")).over(w)).withColumn("scope", F.last(F.when(F.col("is_header"), F.col("line")), ignorenulls=True).over(w))


def nearest_above(rows: DataFrame, value: Column, out: str, reach: int = 20, key: str = "doc_id") -> DataFrame:
    """Add the last non-null value within reach line numbers above a line, itself included."""
    w = in_order(key).rangeBetween(-reach, 0)
    return rows.withColumn("__v", value).withColumn(out, F.last("__v", ignorenulls=True).over(w)).drop("__v")


def logical_rows(rows: DataFrame, most: int = 6, key: str = "doc_id") -> DataFrame:
    """Add row_text: a line with the lines after it, up to and with the first that holds a number, at most most."""
    rows, following = next_lines(rows, most, key)
    parts, open_ = [following[0]], F.lit(True)
    for before, line in zip(following, following[1:]):
        open_ = open_ & ~before.rlike("[0-9]")
        parts.append(F.when(open_, line))
    return rows.withColumn("row_text", F.concat_ws(" ", *parts)).drop(*(f"__line{k}" for k in range(1, most)))


def next_lines(rows: DataFrame, n: int, key: str = "doc_id") -> tuple[DataFrame, list[Column]]:
    """rows with the n - 1 lines after each as columns, null past the end, and these columns, the line's own first."""
    ahead = {f"__line{k}": F.lead("line", k).over(in_order(key)) for k in range(1, n)}
    return rows.withColumns(ahead), [F.col("line"), *map(F.col, ahead)]


def cell_rows(rows: DataFrame, text: str = "line") -> DataFrame:
    """Add cells (numbers and dashes of a line) and state: PROVABLE with two cells, or a note and two; else AMBIGUOUS or EMPTY."""
    cells = F.regexp_extract_all(F.col(text), F.lit(r"(?:^|\s)(-?[0-9][0-9,.]*|[-–—])(?=\s|$)"), F.lit(1))
    rows = rows.withColumn("cells", cells)
    n = F.size("cells")
    return rows.withColumn("state", F.when(n == 0, "EMPTY").when((n == 2) | ((n == 3) & F.col("cells")[0].rlike("^[0-9]{1,2}$")), "PROVABLE").otherwise("AMBIGUOUS"))


def section(rows: DataFrame, heading: Column, wanted: Column, key: str = "doc_id") -> DataFrame:
    """key, start_line, section: lines from the first wanted heading to the line before the next heading."""
    marked = scoped(rows, heading, key).withColumn("__w", F.col("is_header") & wanted)
    first = F.min(F.when(F.col("__w"), F.col("block"))).over(Window.partitionBy(key))
    own = marked.withColumn("__b", first).where("block = __b")
    return own.groupBy(key).agg(F.min("line_no").alias("start_line"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("section"))


def reconciled_zero(parts: DataFrame, keys: list[str], value: str, subtotal: str, tolerance: float = 0.005) -> DataFrame:
    """keys, blanks, residual, zero: blank components count as zero only if the others already give the subtotal."""
    g = parts.groupBy(*keys).agg(F.count_if(F.col(value).isNull()).alias("blanks"), (F.max(subtotal) - F.coalesce(F.sum(value), F.lit(0.0))).alias("residual"))
    return g.withColumn("zero", (F.col("blanks") > 0) & (F.abs("residual") <= tolerance))


def links(pages: DataFrame, html: str, pattern: str, key: str = "page_id") -> DataFrame:
    """key, href: distinct link targets that match a pattern."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r"""<a\s[^>]*href="([^"]*)\""""), F.lit(1))
    return pages.select(key, F.explode(F.array_distinct(hrefs)).alias("href")).where(F.col("href").rlike(pattern))


def layout_proof(docs: DataFrame, words: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, line_no, left, right: lines where both header words occur, with their columns; order decides ownership."""
    one, two = words
    rows = lines(docs, key, text).where(F.col("line").contains(one) & F.col("line").contains(two))
    return rows.select(key, "line_no", F.instr("line", one).alias("left"), F.instr("line", two).alias("right")).withColumn("current_first", F.col("left") < F.col("right"))
