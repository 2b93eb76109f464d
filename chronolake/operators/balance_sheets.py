"""Rows of consolidated balance sheets with proof of which cell is the current one and which the prior one.

Texts keep their spaces: a cell is a token with its character interval. The header line that names both amount
columns gives their places; halves between them are the columns, and a cell belongs to the column in which it
begins. A dash is a cell of its own kind and never zero; an empty column is BLANK. Where no single header line
shows both places, only a row with exactly as many cells as columns is proven, by their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.functions.text import nfkc

from . import spread
from .documents import STATEMENTS, UNIT, UNIT_SCALE, number_of
from .nonrecurring import prefix_matches

#: Labels of balance sheet rows: fixed values.
LABELS = {
    "TOTAL_LIABILITIES": ("负债合计",),
    "TOTAL_EQUITY": ("所有者权益合计", "股东权益合计"),
    "MINORITY_INTEREST": ("少数股东权益",),
    "TOTAL_CURRENT_ASSETS": ("流动资产合计",),
    "TOTAL_NON_CURRENT_ASSETS": ("非流动资产合计",),
    "TOTAL_CURRENT_LIABILITIES": ("流动负债合计",),
    "TOTAL_NON_CURRENT_LIABILITIES": ("非流动负债合计",),
    "MONETARY_FUNDS": ("货币资金",),
    "TRADING_FINANCIAL_ASSETS": ("交易性金融资产",),
    "DERIVATIVE_FINANCIAL_ASSETS": ("衍生金融资产",),
    "DEBT_INVESTMENTS": ("债权投资",),
    "OTHER_DEBT_INVESTMENTS": ("其他债权投资",),
    "OTHER_EQUITY_INSTRUMENT_INVESTMENTS": ("其他权益工具投资",),
    "OTHER_NON_CURRENT_FINANCIAL_ASSETS": ("其他非流动金融资产",),
    "SHORT_TERM_BORROWINGS": ("短期借款",),
    "CURRENT_PORTION_NON_CURRENT_LIABILITIES": ("一年内到期的非流动负债",),
    "LONG_TERM_BORROWINGS": ("长期借款",),
    "BONDS_PAYABLE": ("应付债券",),
    "LEASE_LIABILITIES": ("租赁负债",),
    "TRADING_FINANCIAL_LIABILITIES": ("交易性金融负债",),
    "DERIVATIVE_FINANCIAL_LIABILITIES": ("衍生金融负债",),
    "NOTES_RECEIVABLE": ("应收票据",),
    "ACCOUNTS_RECEIVABLE": ("应收账款",),
    "RECEIVABLES_FINANCING": ("应收款项融资",),
    "PREPAYMENTS": ("预付款项",),
    "INVENTORIES": ("存货",),
    "CONTRACT_ASSETS": ("合同资产",),
    "NOTES_PAYABLE": ("应付票据",),
    "ACCOUNTS_PAYABLE": ("应付账款",),
    "ADVANCES_FROM_CUSTOMERS": ("预收款项",),
    "CONTRACT_LIABILITIES": ("合同负债",),
    "EMPLOYEE_BENEFITS_PAYABLE": ("应付职工薪酬",),
    "TAXES_PAYABLE": ("应交税费",),
    "FIXED_ASSETS": ("固定资产",),
    "CONSTRUCTION_IN_PROGRESS": ("在建工程",),
    "RIGHT_OF_USE_ASSETS": ("使用权资产",),
    "INTANGIBLE_ASSETS": ("无形资产",),
    "GOODWILL": ("商誉",),
    "DEVELOPMENT_EXPENDITURE": ("开发支出",),
    "LONG_TERM_PREPAID_EXPENSES": ("长期待摊费用",),
    "OTHER_RECEIVABLES": ("其他应收款",),
    "OTHER_PAYABLES": ("其他应付款",),
    "LONG_TERM_RECEIVABLES": ("长期应收款",),
    "LONG_TERM_EQUITY_INVESTMENTS": ("长期股权投资",),
    "INVESTMENT_PROPERTY": ("投资性房地产",),
    "DEFERRED_TAX_ASSETS": ("递延所得税资产",),
    "DEFERRED_TAX_LIABILITIES": ("递延所得税负债",),
    "OTHER_CURRENT_ASSETS": ("其他流动资产",),
    "OTHER_CURRENT_LIABILITIES": ("其他流动负债",),
    "OTHER_NON_CURRENT_ASSETS": ("其他非流动资产",),
    "OTHER_NON_CURRENT_LIABILITIES": ("其他非流动负债",),
}
#: Header words of the two amount columns, and a date that stands for one: fixed values.
CURRENT = ("期末余额", "期末数", "期末金额", "本期末余额")
PRIOR = ("期初余额", "期初数", "年初余额", "年初数", "上年年末余额", "上期期末余额")
DATED = r"20\d{2}\s*年\s*\d{1,2}\s*月\s*\d{1,2}(?:\s*日)?"
NOTE = "附注"
#: First lines of a statement in which its header stands.
HEADER_LINES = 12
#: A number or dash that stands by itself.
CELL = r"(?<!\S)(?:-?\d[\d,]*(?:\.\d+)?|\(\d[\d,]*(?:\.\d+)?\)|[-–—])(?!\S)"
#: States of a row; the first two by place, the next three by order.
BY_PLACE, BLANK_BY_PLACE = "POSITION_PROVEN", "POSITION_PROVEN_BLANK_BOTH"
BY_ORDER, WITH_NOTE, NOTE_BLANK = "ORDER_PROVEN", "ORDER_PROVEN_WITH_NOTE", "ORDER_PROVEN_NOTE_BLANK"
NO_HEADER, OPEN = "HEADER_NOT_PROVEN", "OWNERSHIP_UNRESOLVED"


def _first_place(line: Column, words: tuple[str, ...]) -> Column:
    """Place of the first of the words that the line holds, in their order; null without one."""
    return F.coalesce(*(F.nullif(F.instr(line, w), F.lit(0)) for w in words)) - 1 if len(words) > 1 else F.nullif(F.instr(line, words[0]), F.lit(0)) - 1


def layout_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, line_no, line, compact: lines that are not blank, with their spaces; compact has none."""
    clean = F.translate(F.regexp_replace(nfkc(F.col(text)), r"\r\n?", "\n"), "，：（）／−—", ",:()/--")
    dealt = spread.by_key(docs.select(key, clean.alias(text)), key)
    rows = dealt.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).withColumn("line", F.rtrim("line")).where("line <> ''")
    return rows.withColumn("compact", F.regexp_replace("line", r"\s+", ""))


def statements(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Lines of consolidated balance sheets with start, unit, current, prior, note_at, has_note, declared of their statement.

    A statement reaches from its title to the next title of any statement; its unit is declared in it.
    """
    title = F.greatest(*(F.col("compact").endswith(s) for s in STATEMENTS)) & (F.length("compact") <= 20)
    upto = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("start", F.last(F.when(title, F.col("line_no")), ignorenulls=True).over(upto))
    name = F.last(F.when(title, F.regexp_replace("compact", r"^(?:\d+|[一二三四五六七八九十百]+)[、.]", "")), ignorenulls=True).over(upto)
    rows = rows.withColumn("name", name).where("name = '合并资产负债表'")
    own = Window.partitionBy(key, "start")
    rows = rows.withColumn("place", F.row_number().over(own.orderBy("line_no")))
    head = F.col("place") <= HEADER_LINES
    one, two = _first_place(F.col("line"), CURRENT), _first_place(F.col("line"), PRIOR)
    dates = F.regexp_extract_all("line", F.lit(DATED), F.lit(0))
    named = one.isNotNull() & (two > one)
    by_date = F.size(dates) >= 2
    # what stands around the dates gives their places
    around = F.split("line", DATED, 3)
    first_date = F.length(F.get(around, F.lit(0)))
    second_date = first_date + F.length(F.get(dates, F.lit(0))) + F.length(F.get(around, F.lit(1)))
    anchors = lambda a, b: F.struct(a.alias("current"), b.alias("prior"), _first_place(F.col("line"), (NOTE,)).alias("note_at"))
    anchor = F.when(head & named, anchors(one, two)).when(head & by_date, anchors(first_date, second_date))
    first = F.min_by(anchor, F.when(anchor.isNotNull(), F.col("line_no"))).over(own)
    holds = lambda words: F.bool_or(head & F.col("compact").rlike("|".join(words))).over(own)
    several = F.size(F.array_distinct(F.flatten(F.collect_list(F.when(head, F.regexp_extract_all("compact", F.lit(DATED), F.lit(0)))).over(own)))) >= 2
    declared = (holds(CURRENT) & holds(PRIOR)) | several
    unit = F.nullif(F.regexp_extract("compact", UNIT, 1), F.lit(""))
    rows = rows.withColumns({"anchor": first, "has_note": holds((NOTE,)), "declared": declared, "unit": F.min_by(unit, F.when(unit.isNotNull(), F.col("line_no"))).over(own)})
    return rows.where("unit is not null").select(key, "start", "line_no", "place", "line", "compact", "unit", "anchor.current", "anchor.prior", "anchor.note_at", "has_note", "declared")


def _cells(line: Column) -> Column:
    """Cells of a line: (at, token). Lengths of the pieces before a cell add up to its place."""
    found, gaps = F.regexp_extract_all(line, F.lit(CELL), F.lit(0)), F.split(line, CELL, -1)
    sums = lambda xs, k: F.aggregate(F.slice(xs, F.lit(1), k), F.lit(0), lambda a, x: a + F.length(x))
    return F.transform(found, lambda token, i: F.struct((sums(gaps, i + 1) + sums(found, i)).alias("at"), token.alias("token")))


def sheet_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fact, state, note, current_kind, current_value (yuan), prior_kind, prior_value, row_hash.

    The first line of a sheet that begins with a label stands for its fact (of several labels the longest counts). A kind
    is NUMERIC, DASH or BLANK, null where ownership is not proven. Null and empty texts give no rows.
    """
    spark = docs.sparkSession
    names = spark.createDataFrame([(label, fact) for fact, labels in LABELS.items() for label in labels], "label string, fact string")
    rows = statements(layout_lines(docs, key, text), key)
    # an ordinal or "其中:" before a label is no part of it
    rows = prefix_matches(rows.withColumn("begin", F.regexp_replace("compact", r"^(?:[一二三四五六七八九十]+、|其中:|加:|减:)", "")), "begin", names, "fact").where("fact is not null")
    rows = rows.groupBy(key, "fact").agg(F.min_by(F.struct("line", "unit", "current", "prior", "note_at", "has_note", "declared"), F.struct("start", "line_no")).alias("r")).select(key, "fact", "r.*")
    rows = rows.withColumn("cells", _cells(F.col("line"))).withColumn("n", F.size("cells"))
    small = lambda c: c["token"].rlike(r"^\d{1,4}$")
    edge, middle = (F.col("note_at") + F.col("current")) / 2, (F.col("current") + F.col("prior")) / 2
    noted = F.col("has_note") & F.col("note_at").isNotNull() & (F.col("note_at") < F.col("current"))
    notes = F.when(noted, F.filter("cells", lambda c: c["at"] < edge)).otherwise(F.slice("cells", 1, 0))
    rest = F.when(noted, F.filter("cells", lambda c: c["at"] >= edge)).otherwise(F.col("cells"))
    rows = rows.withColumns({"notes": notes, "rest": rest})
    now, then = F.filter("rest", lambda c: c["at"] < middle), F.filter("rest", lambda c: c["at"] >= middle)
    rows = rows.withColumns({"now": now, "then": then})
    placed = F.col("current").isNotNull() & (~F.col("has_note") | noted) & (F.size("now") <= 1) & (F.size("then") <= 1) & ((F.size("notes") == 0) | ((F.size("notes") == 1) & small(F.get("notes", F.lit(0)))))
    first = F.get("cells", F.lit(0))
    by_order = (
        F.when(~F.col("declared"), NO_HEADER)
        .when(~F.col("has_note") & (F.col("n") == 2), BY_ORDER)
        .when(F.col("has_note") & (F.col("n") == 3) & small(first), WITH_NOTE)
        .when(F.col("has_note") & (F.col("n") == 2) & ~small(first), NOTE_BLANK)
        .otherwise(OPEN)
    )
    state = F.when(F.col("declared") & placed, F.when(F.size("now") + F.size("then") == 0, BLANK_BY_PLACE).otherwise(BY_PLACE)).otherwise(by_order)
    rows = rows.withColumn("state", state)
    shift = F.when(F.col("state") == WITH_NOTE, 1).otherwise(0)
    by_place = F.col("state").isin(BY_PLACE, BLANK_BY_PLACE)
    proven = F.col("state").isin(BY_PLACE, BLANK_BY_PLACE, BY_ORDER, WITH_NOTE, NOTE_BLANK)
    token = lambda own, k: F.when(by_place, F.get(own, F.lit(0))["token"]).otherwise(F.get("cells", shift + k)["token"])
    note = F.when(by_place, F.get("notes", F.lit(0))["token"]).when(F.col("state") == WITH_NOTE, first["token"])
    rows = rows.withColumns({"now_token": token("now", 0), "then_token": token("then", 1), "note": note})
    kind = lambda c: F.when(proven, F.when(F.col(c).isNull(), "BLANK").when(F.col(c).rlike(r"\d"), "NUMERIC").otherwise("DASH"))
    scale = F.create_map(*(x for k, v in UNIT_SCALE.items() for x in (F.lit(k), F.lit(v))))[F.col("unit")]
    value = lambda c: F.when(kind(c) == "NUMERIC", number_of(F.col(c)) * scale)
    plain = F.trim(F.regexp_replace("line", r"\s+", " "))
    return rows.select(key, "fact", "state", "note", kind("now_token").alias("current_kind"), value("now_token").alias("current_value"), kind("then_token").alias("prior_kind"), value("then_token").alias("prior_value"), F.sha2(plain, 256).alias("row_hash"))
