"""Row-level normalisers and classifiers as Column builders.

Word lists, prefixes, dates and rule texts below are fixed values of the data sources they describe.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(text: Column, tokens: Iterable[str]) -> Column:
    out = F.lit(False)
    for token in tokens:
        out = out | text.contains(token)
    return out


def first_match(rules: list[tuple[Column, str]], default: str | None) -> Column:
    """The label of the first rule that holds."""
    out = F.lit(default)
    for rule, label in reversed(rules):
        out = F.when(rule, F.lit(label)).otherwise(out)
    return out


# --- codes and boards -------------------------------------------------------------------------


def normalize_symbol(value: Column) -> Column:
    """Six digits of a security code; null without digits."""
    text = F.regexp_replace(F.trim(value.cast("string")), r"^(\d+)\.0$", "$1")
    digits = F.regexp_replace(text, r"\D", "")
    return F.when(digits != "", F.lpad(F.substring(digits, F.greatest(F.length(digits) - 5, F.lit(1)), F.lit(6)), 6, "0"))


def starts_with(text: Column, prefixes: Iterable[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | text.startswith(p)
    return out


def board_of_symbol(code: Column) -> Column:
    """Board of a six-digit code: star, chinext, beijing or main."""
    return first_match([(starts_with(code, ("688", "689")), "star"), (starts_with(code, ("300", "301", "302")), "chinext"), (starts_with(code, ("4", "8", "92")), "beijing")], "main")


def board_of_prefixed_code(code: Column) -> Column:
    """Board of an exchange-prefixed code; other instruments are UNKNOWN."""
    c = F.lower(F.trim(code))
    return first_match(
        [(c.startswith("sh.688"), "STAR"), (starts_with(c, ("sz.300", "sz.301")), "CHINEXT"), (starts_with(c, ("sh.600", "sh.601", "sh.603", "sh.605")), "SSE_MAIN"), (starts_with(c, ("sz.000", "sz.001", "sz.002", "sz.003")), "SZSE_MAIN")],
        "UNKNOWN",
    )


def board_of_listing(symbol: Column) -> Column:
    """Board of a listing: STAR, CHINEXT, SSE_MAIN, SZSE_MAIN, BSE or null."""
    # the code is worked out once, not once a prefix: the rule for all prefixes is then small enough to be compiled
    board = lambda code: first_match(
        [(starts_with(code, ("688", "689")), "STAR"), (starts_with(code, ("300", "301", "302")), "CHINEXT"), (starts_with(code, ("600", "601", "603", "605")), "SSE_MAIN"), (starts_with(code, ("000", "001", "002", "003")), "SZSE_MAIN"), (starts_with(code, ("4", "8", "92")), "BSE")],
        None,
    ).cast("string")
    return F.get(F.transform(F.array(normalize_symbol(symbol)), board), F.lit(0))


def entity_id(code: Column) -> Column:
    """Six digits and market suffix; null unless the value holds exactly six digits."""
    digits = F.regexp_replace(F.coalesce(code.cast("string"), F.lit("")), r"\D", "")
    suffix = first_match([(starts_with(digits, ("5", "6", "9")), ".SH"), (starts_with(digits, ("0", "1", "2", "3")), ".SZ"), (starts_with(digits, ("4", "8")), ".BJ")], "")
    return F.when(F.length(digits) == 6, F.concat(digits, suffix))


def provider_code(code: Column, dot: bool) -> Column:
    """Exchange prefix before a six-digit code: sh.600000 with a dot, sh600000 without."""
    market = first_match([(starts_with(code, ("5", "6", "9")), "sh"), (starts_with(code, ("4", "8")), "bj")], "sz")
    return F.concat(market, F.lit("." if dot else ""), code)


def loose_bool(value: Column) -> Column:
    """1/0, true/false, yes/no in any case; null for anything else."""
    text = F.lower(F.trim(value.cast("string")))
    return F.when(text.isin("1", "true", "yes"), True).when(text.isin("0", "false", "no"), False)


# --- titles ---------------------------------------------------------------------------------------

REPORTS = ("年度报告", "半年度报告", "一季度报告", "三季度报告", "季度报告")
TITLE_CLASSES = [
    ("ISSUER_EARNINGS_FORECAST", ("业绩预告", "业绩快报", "盈利预测", "业绩修正")),
    ("LITIGATION_EVENT", ("诉讼", "仲裁")),
    ("CREDIT_EVENT", ("债务逾期", "违约", "信用风险", "债券违约")),
    ("MAJOR_ORDER", ("中标", "重大合同", "订单")),
    ("BD_EVENT", ("许可", "授权", "合作协议", "战略合作", "商务合作")),
    ("MAJOR_NEGATIVE_EVENT", ("风险提示", "退市", "立案", "处罚", "重大损失", "重大减值", "重大不利", "经营异常", "暂停生产", "终止临床", "临床失败")),
]
CORRECTED = ("更正", "修订", "补充更正")
CORRECTED_REPORTS = ("年度报告", "半年度报告", "季度报告", "财务报告")


def title_class(title: Column) -> Column:
    """One of nine document classes; the first rule that holds wins."""
    t = F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), "<[^>]+>", ""))
    rules = [(contains_any(t, CORRECTED) & contains_any(t, CORRECTED_REPORTS), "FINANCIAL_RESTATEMENT"), (contains_any(t, REPORTS), "FINANCIAL_REPORT_ANNOUNCEMENT")]
    rules += [(contains_any(t, words), name) for name, words in TITLE_CLASSES]
    return first_match(rules, "MAJOR_EVENT")


AGREEMENTS = ("许可协议", "授权协议", "独家许可", "合作及许可协议", "许可及合作协议")
COLLABORATION = ("药品授权合作", "药品合作", "药物合作", "新药", "研发合作", "临床合作", "治疗合作", "商业化合作", "里程碑付款", "里程碑支付")
AUDIT_TOKENS = (
    "终止临床", "临床试验终止", "临床失败", "撤回药品注册申请", "突破性治疗",
    "上市许可申请", "优先审评", "受理", "获受理", "获得药品注册批准", "药品注册批准",
    "获批上市", "批准上市", "临床试验批准通知书", "临床试验批准",
    "许可协议", "授权协议", "独家许可", "合作及许可协议", "许可及合作协议", "合作协议",
    "药品授权合作", "药品合作", "药物合作", "新药", "研发合作", "临床合作", "治疗合作", "商业化合作", "里程碑付款", "里程碑支付",
)


def compact_title(title: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(title, F.lit("")), "<[^>]+>", ""), r"\s+", "")


def drug_event(title: Column) -> Column:
    """One of nine drug event types by title, or null."""
    t = compact_title(title)
    filed = t.contains("上市许可申请")
    return first_match(
        [
            (contains_any(t, ("终止临床", "临床试验终止", "临床失败")), "CLINICAL_TRIAL_TERMINATION"),
            (t.contains("撤回药品注册申请"), "REGISTRATION_APPLICATION_WITHDRAWAL"),
            (t.contains("突破性治疗"), "BREAKTHROUGH_THERAPY_DESIGNATION"),
            (filed & t.contains("优先审评"), "MARKETING_APPLICATION_PRIORITY_REVIEW"),
            (filed & t.contains("受理"), "MARKETING_APPLICATION_ACCEPTED"),
            (contains_any(t, ("获得药品注册批准", "药品注册批准", "获批上市", "批准上市")), "MARKETING_APPROVAL"),
            (contains_any(t, ("临床试验批准通知书", "临床试验批准")), "CLINICAL_TRIAL_AUTHORIZATION"),
            (contains_any(t, AGREEMENTS), "BD_LICENSE_OR_COLLABORATION"),
            (t.contains("合作协议") & contains_any(t, COLLABORATION), "BD_COLLABORATION"),
        ],
        None,
    ).cast("string")


def title_tokens(title: Column) -> Column:
    """Audit tokens that a title holds, in registry order."""
    t = compact_title(title)
    return F.filter(F.array(*(F.lit(x) for x in AUDIT_TOKENS)), lambda x: t.contains(x))


def earnings_direction(text: Column) -> Column:
    """UP, DOWN or UNKNOWN; both sides present is UNKNOWN."""
    # one search for all words of a side: Spark works out the text again for each, and white space by regex costs most
    t = F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\f\r", "")
    up = t.rlike("预增|扭亏|扭亏为盈|续盈|略增")
    down = t.rlike("预减|首亏|续亏|略减|由盈转亏")
    return first_match([(up & down, "UNKNOWN"), (down, "DOWN"), (up, "UP")], "UNKNOWN")


def compact(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", "")


def report_period(title: Column) -> Column:
    """Quarter-end date that a report title names; null without a year and a report word."""
    t = compact(title)
    year = F.regexp_extract(t, r"(20\d{2})年", 1)
    y = F.when(year != "", year.cast("int"))
    end = lambda m, d: F.make_date(y, F.lit(m), F.lit(d))
    return (
        F.when(contains_any(t, ("第一季度", "一季度")), end(3, 31))
        .when(contains_any(t, ("半年度", "半年报", "中期报告")), end(6, 30))
        .when(contains_any(t, ("第三季度", "三季度")), end(9, 30))
        .when(contains_any(t, ("年度报告", "年报")), end(12, 31))
    )


NUMERIC_REPORTS = ("年度报告", "第一季度报告", "一季度报告", "半年度报告", "第三季度报告", "三季度报告")
NOT_NUMERIC = ("摘要", "英文版", "审计报告", "问询", "回复", "提示性公告", "关于")
REVISED = ("修订", "更正", "修正", "更新")


def is_numeric_report(title: Column) -> Column:
    """Whether a title announces a full numeric report."""
    t = compact(title)
    return contains_any(t, NUMERIC_REPORTS) & t.rlike(r"20\d{2}年") & ~contains_any(t, NOT_NUMERIC)


def title_family(title: Column) -> Column:
    """Title without the mark at its end that tells the body from the full text."""
    return F.regexp_replace(compact(title), "(?:（?(?:正文|全文)）?)$", "")


def variant_priority(title: Column) -> Column:
    """0 for a body, 1 for the full or only text."""
    return F.when(compact(title).rlike("(?:（?正文）?)$"), 0).otherwise(1)


def revision_priority(title: Column) -> Column:
    return contains_any(compact(title), REVISED).cast("int")


CARRIER = r"20\d{2}(?:年?年度报告|年(?:半年度报告|第一季度报告|一季度报告|第三季度报告|三季度报告))(?:（?(摘要|正文|全文)）?)?"


def presentation(text: Column) -> Column:
    """FULL_OR_CANONICAL, BODY, SUMMARY or UNKNOWN by the report titles in the leading part of a text.

    Marks in the first 1,200 characters count, conflicting ones give UNKNOWN; without a mark a report title in the first 5,000 is enough.
    """
    t = F.left(compact(text), F.lit(5000))
    marks = F.array_distinct(F.filter(F.regexp_extract_all(F.left(t, F.lit(1200)), F.lit(CARRIER), F.lit(1)), lambda m: m != ""))
    return (
        F.when(~t.rlike(CARRIER) | (F.size(marks) > 1), "UNKNOWN")
        .when(F.array_contains(marks, "摘要"), "SUMMARY")
        .when(F.array_contains(marks, "正文"), "BODY")
        .otherwise("FULL_OR_CANONICAL")
    )


#: How index notices and exchange notices name the day from which a change holds.
INDEX_NOTICE = (r"于(\d{4})年(\d{1,2})月(\d{1,2})日[^。；;]{0,40}(?:生效|实施)", r"(\d{4})年(\d{1,2})月(\d{1,2})日[^。；;]{0,40}(?:正式实施|正式生效)")
EXCHANGE_NOTICE = (r"于\s*(\d{4})年(\d{1,2})月(\d{1,2})日.*?生效", r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2}).*?生效")


def notice_date(text: Column, patterns: tuple[str, ...] = INDEX_NOTICE) -> Column:
    """Effective date in a notice: the first pattern that matches; null without one."""
    t = compact(F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", " "))

    def of(pattern: str) -> Column:
        y, m, d = (F.regexp_extract(t, pattern, k) for k in (1, 2, 3))
        return F.when(y != "", F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-M-d"))

    return F.coalesce(*(of(p) for p in patterns))


POLICY_NEGATIVE = ("行政处罚", "市场禁入", "立案", "处罚决定", "监管措施", "责令改正", "暂停业务", "撤销许可")


def policy_type(title: Column, default: Column) -> Column:
    """Negative words override the type of the channel."""
    return F.when(contains_any(title, POLICY_NEGATIVE), "MAJOR_NEGATIVE_EVENT").otherwise(default)


def policy_identity(url: Column, manuscript: Column) -> Column:
    """Manuscript id, else the folder of a content page (or the word document) and 16 hex digits of the url's hash."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://[^/]*", ""), r"[?#].*$", "")
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    leaf = F.when((F.size(parts) >= 2) & (F.element_at(parts, -1) == "content.shtml"), F.try_element_at(parts, F.lit(-2))).otherwise("document")
    return F.when(manuscript != "", F.concat(F.lit("MANUSCRIPT:"), manuscript)).otherwise(F.concat(leaf, F.lit(":"), F.left(F.sha2(url, 256), F.lit(16))))


# --- errors, limits, states ---------------------------------------------------------------------------


def failure_signature(error: Column) -> Column:
    """Error text with urls, hashes and long numbers masked, for grouping."""
    t = F.regexp_replace(F.trim(F.coalesce(error, F.lit(""))), r"https://\S+", "<url>")
    t = F.regexp_replace(t, r"\b[0-9a-fA-F]{32,}\b", "<hash>")
    return F.left(F.regexp_replace(t, r"\b\d{6,}\b", "<id>"), F.lit(240))


#: Messages of documents that hold too little, as against failures.
SOFT_MESSAGES = (
    "official filing has no extractable text layer",
    "filing text does not contain an explicit table unit declaration",
    "filing target fact has explicit supported amount unit but no parseable value",
    "filing has no target facts with locally proven",
    "filing parser produced no standardized facts",
)


def failure_severity(error: Column) -> Column:
    return F.when(contains_any(F.coalesce(error, F.lit("")), SOFT_MESSAGES), "SOFT_DATA_INSUFFICIENCY").otherwise("HARD_FAILURE")


STAR_FIRST_DAY, CHINEXT_REFORM, MAIN_RISK_10 = "2019-07-22", "2020-08-24", "2026-07-06"


def limit_rule(day: Column, board: Column, is_st: Column) -> Column:
    """Structural daily price limit: struct(limit_pct, eligible, reason)."""
    b = F.upper(F.trim(board))
    rule = lambda pct, ok, why: F.struct(F.lit(pct).cast("double").alias("limit_pct"), F.lit(ok).alias("eligible"), F.lit(why).alias("reason"))
    main = b.isin("SSE_MAIN", "SZSE_MAIN")
    return (
        F.when(~b.isin("STAR", "CHINEXT", "SSE_MAIN", "SZSE_MAIN") | b.isNull(), rule(None, False, "unsupported board"))
        .when((b == "STAR") & (day < F.lit(STAR_FIRST_DAY).cast("date")), rule(None, False, "STAR predates first trading date"))
        .when(b == "STAR", rule(20.0, True, "STAR structural rule"))
        .when((b == "CHINEXT") & (day >= F.lit(CHINEXT_REFORM).cast("date")), rule(20.0, True, "ChiNext post-reform rule"))
        .when((b == "CHINEXT") & is_st, rule(5.0, True, "ChiNext pre-reform risk-warning rule"))
        .when(b == "CHINEXT", rule(10.0, True, "ChiNext pre-reform ordinary rule"))
        .when(main & is_st & (day < F.lit(MAIN_RISK_10).cast("date")), rule(5.0, True, "main-board pre-2026 risk-warning rule"))
        .when(main & is_st, rule(10.0, True, "main-board 2026 risk-warning rule"))
        .otherwise(rule(10.0, True, "main-board ordinary rule"))
    )


def limit_status(trading: Column, special: Column, rule: Column) -> Column:
    """Precedence of a limit row: suspended, no limit, unknown, no rule, eligible: struct(eligible, reason)."""
    out = lambda ok, why: F.struct(F.lit(ok).alias("limit_eligible"), why.alias("limit_rule_reason"))
    s = F.lower(F.trim(special))
    return (
        F.when(~trading, out(False, F.lit("suspended_or_not_trading")))
        .when(s == "no_limit", out(False, F.lit("explicit_no_limit_special_day")))
        .when(s == "unknown", out(False, F.lit("special_day_status_not_evidenced")))
        .when(~rule["eligible"] | rule["limit_pct"].isNull(), out(False, rule["reason"]))
        .otherwise(out(True, F.lit("structural_rule_and_status_evidenced")))
    )


def accounting_state(now: dict[str, Column], before: dict[str, Column]) -> Column:
    """struct(state, reason) from revenue, profit, cash, margin of a period and its comparable."""
    r, p, c, m = (now[k] for k in ("revenue", "profit", "cash", "margin"))
    r0, p0, c0, m0 = (before[k] for k in ("revenue", "profit", "cash", "margin"))
    out = lambda state, why: F.struct(F.lit(state).alias("state"), F.lit(why).alias("reason"))
    return (
        F.when(p < 0, out("FUNDAMENTAL_FAIL", "CURRENT_NET_LOSS"))
        .when((r < r0) & (p < p0) & (c < c0) & (m < m0), out("FUNDAMENTAL_FAIL", "BROAD_BASED_DETERIORATION"))
        .when((p > 0) & (c < 0) & (c0 >= 0) & (c < c0), out("FUNDAMENTAL_FAIL", "PROFIT_CASH_DIVERGENCE"))
        .when((p < p0) & (m < m0) & (c < c0), out("FUNDAMENTAL_FAIL", "PROFIT_MARGIN_CASH_DETERIORATION"))
        .when((p > 0) & (c >= 0) & (r >= r0) & (p >= p0) & (c >= c0) & (m >= m0), out("FUNDAMENTAL_PASS", "ALL_CORE_DIMENSIONS_NON_DETERIORATING"))
        .otherwise(out("FUNDAMENTAL_WATCH", "QUALIFIED_MIXED_ACCOUNTING_STATE"))
    )


def stable_hash(*values: Column) -> Column:
    """SHA-256 of the values in order, null as an empty field, separated by a unit separator."""
    return F.sha2(F.array_join(F.array(*(F.coalesce(v.cast("string"), F.lit("")) for v in values)), "\x1f"), 256)


def has_clock(text: Column) -> Column:
    return F.trim(text).rlike(r"(?:^|\s)\d{1,2}:\d{2}(?::\d{2})?(?:\s|$)")


def query_parameter(url: Column, name: str) -> Column:
    return F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)


#: Units of amounts and what they are in yuan: fixed values.
YUAN = {"CNY": 1, "CNY_100M": 100_000_000}


def to_yuan(value: Column, unit: Column) -> tuple[Column, Column]:
    """(amount in yuan as decimal(28,2), whether the unit is unknown); unknown and null units give no amount."""
    scale = F.create_map(*(x for k, v in YUAN.items() for x in (F.lit(k), F.lit(v).cast("decimal(10,0)"))))[unit]
    return (value.cast("decimal(18,2)") * scale).cast("decimal(28,2)"), scale.isNull()


def availability_basis(published: Column, approved: Column, observed: Column) -> Column:
    """struct(event_date, basis, reconstructable): the publication day, else the approval day, else the day it was first seen.

    Only the first two can be rebuilt later. All null gives a null day and no basis.
    """
    day = F.coalesce(published, approved, observed)
    basis = F.when(published.isNotNull(), "PUBLICATION_DATE").when(approved.isNotNull(), "APPROVAL_DATE").when(observed.isNotNull(), "FIRST_OBSERVED")
    return F.struct(day.alias("event_date"), basis.alias("basis"), (published.isNotNull() | approved.isNotNull()).alias("reconstructable"))


def enriched(provenance: Column, added: dict[str, Column]) -> Column:
    """A flat JSON object with more fields; a field that it has already keeps its value, null or broken JSON counts as empty."""
    old = F.coalesce(F.from_json(provenance, "map<string,string>"), F.create_map().cast("map<string,string>"))
    new = F.create_map(*(x for k, v in added.items() for x in (F.lit(k), v.cast("string"))))
    return F.to_json(F.map_concat(F.map_filter(new, lambda k, _: ~F.map_contains_key(old, k)), old))
