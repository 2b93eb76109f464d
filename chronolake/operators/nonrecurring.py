"""The table of non-recurring items in filing texts: section blocks, rows by longest label prefix, one amount a row, a total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolake.functions.text import normalized_text

from . import spread
from .documents import NUMBER, UNIT, UNIT_SCALE, lines, number_of

#: Row labels and the facts they begin: fixed values.
LABELS = [
    ("非流动性资产处置损益", "NR_NON_CURRENT_ASSET_DISPOSAL"),
    ("非流动资产处置损益", "NR_NON_CURRENT_ASSET_DISPOSAL"),
    ("计入当期损益的政府补助", "NR_GOVERNMENT_GRANT"),
    ("除同公司正常经营业务相关的有效套期保值", "NR_FINANCIAL_ASSET_FAIR_VALUE_AND_DISPOSAL"),
    ("计入当期损益的对非金融企业收取的资金占用费", "NR_NONFINANCIAL_FUND_OCCUPATION_FEE"),
    ("委托他人投资或管理资产的损益", "NR_ENTRUSTED_INVESTMENT_OR_ASSET_MANAGEMENT"),
    ("对外委托贷款取得的损益", "NR_EXTERNAL_ENTRUSTED_LOAN"),
    ("因不可抗力因素", "NR_FORCE_MAJEURE_ASSET_LOSS"),
    ("单独进行减值测试的应收款项减值准备转回", "NR_SEPARATELY_TESTED_RECEIVABLE_IMPAIRMENT_REVERSAL"),
    ("企业取得子公司、联营企业及合营企业的投资成本", "NR_BARGAIN_PURCHASE_GAIN"),
    ("同一控制下企业合并产生的子公司", "NR_COMMON_CONTROL_COMBINATION_PRECOMBINATION_PROFIT"),
    ("非货币性资产交换损益", "NR_NONMONETARY_ASSET_EXCHANGE"),
    ("债务重组损益", "NR_DEBT_RESTRUCTURING"),
    ("企业因相关经营活动不再持续而发生的一次性费用", "NR_DISCONTINUATION_ONE_OFF_COST"),
    ("因税收、会计等法律、法规的调整", "NR_LAW_ACCOUNTING_CHANGE_ONE_OFF_EFFECT"),
    ("因取消、修改股权激励计划", "NR_CANCEL_MODIFY_EQUITY_INCENTIVE_ONE_OFF_SHARE_PAYMENT"),
    ("对于现金结算的股份支付", "NR_CASH_SETTLED_SHARE_PAYMENT_FAIR_VALUE_CHANGE"),
    ("采用公允价值模式进行后续计量的投资性房地产", "NR_INVESTMENT_PROPERTY_FAIR_VALUE_CHANGE"),
    ("交易价格显失公允的交易产生的收益", "NR_MANIFESTLY_UNFAIR_TRANSACTION_GAIN"),
    ("与公司正常经营业务无关的或有事项产生的损益", "NR_NONCORE_CONTINGENCY_GAIN_LOSS"),
    ("受托经营取得的托管费收入", "NR_ENTRUSTED_OPERATION_MANAGEMENT_FEE"),
    ("除上述各项之外的其他营业外收入和支出", "NR_OTHER_NON_OPERATING_INCOME_EXPENSE"),
    ("其他符合非经常性损益定义的损益项目", "NR_OTHER_DEFINED_ITEM"),
    ("减:所得税影响额", "NR_INCOME_TAX_EFFECT"),
    ("所得税影响额", "NR_INCOME_TAX_EFFECT"),
    ("少数股东权益影响额(税后)", "NR_MINORITY_INTEREST_EFFECT_AFTER_TAX"),
    ("合计", "NR_REPORTED_NET_TOTAL"),
]
TOTAL = "NR_REPORTED_NET_TOTAL"
#: What opens and ends a section, and lines that are no part of a row: fixed values.
OPENS = ("非经常性损益项目和金额", "非经常性损益项目及金额")
ENDS = ("其他符合非经常性损益定义的损益项目的具体情况", "将《公开发行证券的公司信息披露解释性公告")
SILENT = r"单位:|币种:|^√适用□不适用$|^□适用√不适用$"
NOISE = r"^\d+/\d+$"
#: Most lines of a section, and the first ones, which must declare the unit.
MOST, HEAD = 140, 15


def prefix_matches(rows: DataFrame, text: str, labels: DataFrame, out: str) -> DataFrame:
    """rows with the value of the longest label that their text begins with, or null: one equi-join on the characters that every label has.

    labels: label, and the column out; of equally long labels the greatest value counts. Each row meets one row of
    labels at most, so rows need no numbers, which a second run would deal out anew.
    """
    held = labels.where("label <> ''")
    least = held.agg(F.min(F.length("label"))).first()[0] or 1
    heads = held.groupBy(F.substring("label", 1, least).alias("__head")).agg(F.collect_list(F.struct(F.length("label").alias("n"), out, "label")).alias("__labels"))
    met = rows.withColumn("__head", F.substring(F.col(text), 1, least)).join(heads, "__head", "left")
    fits = F.filter("__labels", lambda x: F.col(text).startswith(x["label"]))
    return met.withColumn(out, F.array_max(fits)[out]).drop("__head", "__labels")


def _blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, start, idx, line, compact, scale: the lines of every section that declares a unit; sections may overlap."""
    clean = spread.by_key(docs.select(key, normalized_text(F.col(text)).alias(text)), key)
    order = Window.partitionBy(key).orderBy("line_no")
    rows = lines(clean, key, text).withColumn("idx", F.row_number().over(order))
    compact = F.replace(F.regexp_replace("line", r"\s+", ""), F.lit("："), F.lit(":"))
    rows = rows.select(key, "idx", "line", compact.alias("compact"))
    holds = lambda words: F.greatest(*(F.col("compact").contains(w) for w in words))
    # a section reaches into the next stretch of MOST lines at most
    starts = rows.where(holds(OPENS)).select(key, F.col("idx").alias("start"), F.explode(F.array(F.floor(F.col("idx") / MOST), F.floor(F.col("idx") / MOST) + 1)).alias("stretch"))
    held = rows.withColumn("stretch", F.floor(F.col("idx") / MOST)).join(starts, [key, "stretch"]).where((F.col("idx") >= F.col("start")) & (F.col("idx") < F.col("start") + MOST))
    own = Window.partitionBy(key, "start")
    end = F.min(F.when((F.col("idx") > F.col("start")) & holds(ENDS), F.col("idx"))).over(own)
    held = held.withColumn("end", end).where(F.col("end").isNull() | (F.col("idx") < F.col("end")))
    declared = F.when(F.col("idx") < F.col("start") + HEAD, F.nullif(F.regexp_extract("compact", UNIT, 1), F.lit("")))
    scale = F.create_map(*(x for k, v in UNIT_SCALE.items() for x in (F.lit(k), F.lit(v))))
    return held.withColumn("unit", F.min_by(declared, F.when(declared.isNotNull(), F.col("idx"))).over(own)).where("unit is not null").select(key, "start", "idx", "line", "compact", scale[F.col("unit")].alias("scale"))


def nonrecurring_facts(docs: DataFrame, key: str = "doc_id", text: str = "text", labels: list[tuple[str, str]] = LABELS) -> tuple[DataFrame, DataFrame]:
    """(facts: key, fact, value in yuan; states: key, state, tables) of filing texts.

    A row runs from the line that begins with a label to the next such line, without page numbers and running heads,
    and counts if it holds exactly one number. A table whose label comes again after it had an amount is ambiguous
    and gives nothing, as does one without its total. The table with most facts stands; others as large must agree
    in every fact, else the filing is a CONFLICT. States: PARSED, CONFLICT, NO_TABLE. Null and empty texts: NO_TABLE.
    """
    spark = docs.sparkSession
    names = spark.createDataFrame(labels, "label string, fact string")
    rows = prefix_matches(_blocks(docs, key, text), "compact", names, "fact")
    upto = Window.partitionBy(key, "start").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("segment", F.count("fact").over(upto)).where("segment > 0")
    noise = F.col("compact").rlike(NOISE) | (F.col("compact").contains("股份有限公司") & F.col("compact").contains("报告") & F.col("compact").rlike(r"20\d{2}")) | F.col("compact").rlike(SILENT)
    numbers = F.when(noise, F.array().cast("array<string>")).otherwise(F.regexp_extract_all("line", F.lit(NUMBER), F.lit(0)))
    parts = rows.withColumn("numbers", numbers).groupBy(key, "start", "segment").agg(F.max("fact").alias("fact"), F.sum(F.size("numbers")).alias("n"), F.max(F.get("numbers", F.lit(0))).alias("number"), F.max("scale").alias("scale"))
    value = F.when(F.col("n") == 1, number_of(F.col("number")) * F.col("scale"))
    earlier = Window.partitionBy(key, "start", "fact").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("value", value).withColumn("again", F.coalesce(F.count("value").over(earlier), F.lit(0)) > 0)
    told = F.sort_array(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("fact", "value"))))
    tables = parts.groupBy(key, "start").agg(told.alias("facts"), F.bool_or("again").alias("again"))
    tables = tables.where(~F.col("again") & F.exists("facts", lambda f: f["fact"] == TOTAL))
    best = tables.withColumn("rank", F.rank().over(Window.partitionBy(key).orderBy(F.size("facts").desc()))).where("rank = 1")
    best = best.groupBy(key).agg(F.count_distinct(F.to_json("facts")).alias("kinds"), F.count("*").alias("tables"), F.min_by("facts", "start").alias("facts"))
    states = docs.select(key).distinct().join(best, key, "left")
    state = F.when(F.col("kinds").isNull(), "NO_TABLE").when(F.col("kinds") > 1, "CONFLICT").otherwise("PARSED")
    facts = best.where("kinds = 1").select(key, F.explode("facts").alias("f")).select(key, "f.fact", "f.value")
    return facts, states.select(key, state.alias("state"), F.coalesce("tables", F.lit(0)).alias("tables"))
