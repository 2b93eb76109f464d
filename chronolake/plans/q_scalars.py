"""Queries of the row-level functions. Titles are composed from the tables with the words of the taxonomies."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.functions import scalars as S
from chronolake.functions.text import normalized_text

from . import fixtures as X
from .q_streams import TIMING_SQL, timed
from .registry import query

#: Title words in turn by event id: fixed values of the taxonomies.
TITLES = ("2023年年度报告全文", "2023年半年度报告（更正）", "2024年第一季度报告正文", "业绩预告 预增", "业绩预告 预减", "重大诉讼公告", "债务逾期", "中标通知", "授权协议公告", "立案调查", "药品上市许可申请获受理", "上市许可申请纳入优先审评", "终止临床试验", "获批上市公告", "与新药合作协议", "日常公告", "预增 续亏 说明", "<b>突破性治疗</b>认定", "临床试验批准通知书", "2022年三季度报告摘要")
TITLE_SQL = "t AS (SELECT event_id, ['" + "','".join(TITLES) + f"'][event_id % {len(TITLES)} + 1] AS title FROM events)"


def titles(spark, sf):
    pick = F.element_at(F.array(*(F.lit(t) for t in TITLES)), (F.col("event_id") % len(TITLES) + 1).cast("int"))
    return X.table(spark, sf, "events").select("event_id", pick.alias("title"))


def like_any(words, column="title"):
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


CODES = "c AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, lpad((l_partkey * 7919 % 1000000)::VARCHAR, 6, '0') AS code FROM lineitem)"


def codes(spark, sf):
    return X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.lpad((F.col("l_partkey") * 7919 % 1000000).cast("string"), 6, "0").alias("code"))


@query("nrm_1_normalize_symbol", "", "SELECT p_partkey, lpad(right(CASE WHEN p_partkey % 3 = 0 THEN p_partkey::VARCHAR ELSE regexp_replace(p_partkey::VARCHAR || '77', '\\D', '', 'g') END, 6), 6, '0') AS symbol FROM part")
def normalize_symbol(spark, sf):
    raw = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(".0 "))).otherwise(F.concat(F.lit("sz."), F.col("p_partkey").cast("string"), F.lit("-77")))
    return X.table(spark, sf, "part").select("p_partkey", S.normalize_symbol(raw).alias("symbol"))


@query("nrm_2_board_inference", "", f"""WITH {CODES} SELECT code, CASE WHEN code[:3] IN ('688','689') THEN 'star' WHEN code[:3] IN ('300','301','302') THEN 'chinext' WHEN code[:1] IN ('4','8') OR code[:2] = '92' THEN 'beijing' ELSE 'main' END AS board,
  CASE WHEN code[:3] = '688' THEN 'STAR' WHEN code[:3] IN ('600','601','603','605') THEN 'SSE_MAIN' ELSE 'UNKNOWN' END AS exchange_board,
  CASE WHEN code[:3] IN ('688','689') THEN 'STAR' WHEN code[:3] IN ('300','301','302') THEN 'CHINEXT' WHEN code[:3] IN ('600','601','603','605') THEN 'SSE_MAIN' WHEN code[:3] IN ('000','001','002','003') THEN 'SZSE_MAIN' WHEN code[:1] IN ('4','8') OR code[:2] = '92' THEN 'BSE' END AS listing_board, count(*) AS n FROM c GROUP BY ALL""")
def board_inference(spark, sf):
    """Codes repeat: rows are counted by code first, and each code is classified once."""
    c = F.col("code")
    rows = codes(spark, sf).groupBy("code").agg(F.count("*").alias("n"))
    return rows.select("code", S.board_of_symbol(c).alias("board"), S.board_of_prefixed_code(F.concat(F.lit("sh."), c)).alias("exchange_board"), S.board_of_listing(c).alias("listing_board"), "n")


@query("nrm_3_entity_id", "", f"WITH {CODES} SELECT DISTINCT code, code || CASE WHEN code[:1] IN ('5','6','9') THEN '.SH' WHEN code[:1] IN ('0','1','2','3') THEN '.SZ' WHEN code[:1] IN ('4','8') THEN '.BJ' ELSE '' END AS entity FROM c")
def entity_id(spark, sf):
    return codes(spark, sf).select("code", S.entity_id(F.col("code")).alias("entity")).distinct()


@query("nrm_4_provider_code", "", f"WITH {CODES}, p AS (SELECT DISTINCT code, CASE WHEN code[:1] IN ('5','6','9') THEN 'sh' WHEN code[:1] IN ('4','8') THEN 'bj' ELSE 'sz' END AS m FROM c) SELECT code, m || '.' || code AS dotted, m || code AS plain FROM p")
def provider_code(spark, sf):
    return codes(spark, sf).select("code", S.provider_code(F.col("code"), True).alias("dotted"), S.provider_code(F.col("code"), False).alias("plain")).distinct()


@query("nrm_5_normalize_universe", "", "SELECT lpad(s_suppkey::VARCHAR, 6, '0') AS symbol, CASE WHEN s_suppkey % 2 = 0 THEN 'given' WHEN lpad(s_suppkey::VARCHAR, 6, '0')[:1] IN ('4', '8') THEN 'beijing' ELSE 'main' END AS board, 'current_snapshot' AS universe_mode FROM supplier")
def normalize_universe(spark, sf):
    from chronolake.sources.readers import normalize_universe as run

    raw = X.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"), F.when(F.col("s_suppkey") % 2 == 0, "given").otherwise(" ").alias("board"))
    return run(raw).select("symbol", "board", "universe_mode")


@query("nrm_6_snapshot_to_interval", "", "SELECT s_suppkey AS symbol, DATE '2024-01-01' AS effective_start, DATE '2024-06-30' AS effective_end, 'current_snapshot_biased' AS universe_mode FROM supplier")
def snapshot_to_interval(spark, sf):
    from chronolake.sources.readers import snapshot_to_interval as run

    return run(X.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("symbol")), X.day("2024-01-01"), X.day("2024-06-30"))


@query("nrm_7_loose_bool", "", "SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (l_linenumber % 2 = 1) AS yes, count(*) FILTER (l_linenumber % 4 = 0) AS unknown FROM lineitem GROUP BY ALL")
def loose_bool(spark, sf):
    text = F.when(F.col("l_linenumber") % 4 == 0, "maybe").when(F.col("l_linenumber") % 2 == 1, " YES ").otherwise("0")
    v = S.loose_bool(text)
    return X.table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.count_if(v).alias("yes"), F.count_if(v.isNull()).alias("unknown"))


CLASS_SQL = f"CASE WHEN {like_any(S.CORRECTED)} AND {like_any(S.CORRECTED_REPORTS)} THEN 'FINANCIAL_RESTATEMENT' WHEN {like_any(S.REPORTS)} THEN 'FINANCIAL_REPORT_ANNOUNCEMENT' " + " ".join(f"WHEN {like_any(w)} THEN '{c}'" for c, w in S.TITLE_CLASSES) + " ELSE 'MAJOR_EVENT' END"


@query("nrm_8_title_class", "", f"WITH {TITLE_SQL} SELECT event_id, {CLASS_SQL} AS class FROM t")
def title_class(spark, sf):
    return titles(spark, sf).select("event_id", S.title_class(F.col("title")).alias("class"))


DRUG_SQL = f"""CASE WHEN {like_any(('终止临床', '临床试验终止', '临床失败'))} THEN 'CLINICAL_TRIAL_TERMINATION' WHEN contains(title, '撤回药品注册申请') THEN 'REGISTRATION_APPLICATION_WITHDRAWAL' WHEN contains(title, '突破性治疗') THEN 'BREAKTHROUGH_THERAPY_DESIGNATION'
 WHEN contains(title, '上市许可申请') AND contains(title, '优先审评') THEN 'MARKETING_APPLICATION_PRIORITY_REVIEW' WHEN contains(title, '上市许可申请') AND contains(title, '受理') THEN 'MARKETING_APPLICATION_ACCEPTED'
 WHEN {like_any(('获得药品注册批准', '药品注册批准', '获批上市', '批准上市'))} THEN 'MARKETING_APPROVAL' WHEN {like_any(('临床试验批准通知书', '临床试验批准'))} THEN 'CLINICAL_TRIAL_AUTHORIZATION'
 WHEN {like_any(S.AGREEMENTS)} THEN 'BD_LICENSE_OR_COLLABORATION' WHEN contains(title, '合作协议') AND {like_any(S.COLLABORATION)} THEN 'BD_COLLABORATION' END"""


@query("nrm_9_drug_event", "", f"WITH {TITLE_SQL} SELECT event_id, {DRUG_SQL} AS event_type FROM t WHERE {DRUG_SQL} IS NOT NULL")
def drug_event(spark, sf):
    return titles(spark, sf).select("event_id", S.drug_event(F.col("title")).alias("event_type")).where("event_type is not null")


@query("nrm_10_title_audit", "", f"WITH {TITLE_SQL}, x AS (SELECT event_id, regexp_replace(regexp_replace(title, '<[^>]+>', '', 'g'), '\\s+', '', 'g') AS title FROM t) SELECT event_id, sha256(title) AS title_sha256, array_to_string(list_filter(['" + "','".join(S.AUDIT_TOKENS) + "'], lambda w: contains(title, w)), ',') AS tokens FROM x")
def title_audit(spark, sf):
    t = F.col("title")
    return titles(spark, sf).select("event_id", F.sha2(S.compact_title(t), 256).alias("title_sha256"), F.array_join(S.title_tokens(t), ",").alias("tokens"))


@query("nrm_11_earnings_direction", "", f"WITH {TITLE_SQL} SELECT event_id, CASE WHEN up AND down THEN 'UNKNOWN' WHEN down THEN 'DOWN' WHEN up THEN 'UP' ELSE 'UNKNOWN' END AS direction FROM (SELECT event_id, {like_any(('预增', '扭亏', '续盈', '略增'))} AS up, {like_any(('预减', '首亏', '续亏', '略减', '由盈转亏'))} AS down FROM t)")
def earnings_direction(spark, sf):
    return titles(spark, sf).select("event_id", S.earnings_direction(F.col("title")).alias("direction"))


@query("nrm_12_policy_type", "", f"WITH {TITLE_SQL} SELECT event_id, CASE WHEN {like_any(S.POLICY_NEGATIVE)} THEN 'MAJOR_NEGATIVE_EVENT' ELSE 'CHANNEL_' || event_id % 3 END AS evidence_type FROM t")
def policy_type(spark, sf):
    default = F.concat(F.lit("CHANNEL_"), (F.col("event_id") % 3).cast("string"))
    return titles(spark, sf).select("event_id", S.policy_type(F.col("title"), default).alias("evidence_type"))


@query("nrm_13_report_period", "", f"WITH {TITLE_SQL}, y AS (SELECT event_id, title, regexp_extract(title, '(20\\d{{2}})年', 1) AS y FROM t) SELECT event_id, CASE WHEN y = '' THEN NULL WHEN {like_any(('第一季度', '一季度'))} THEN make_date(y::INT, 3, 31) WHEN {like_any(('半年度', '半年报', '中期报告'))} THEN make_date(y::INT, 6, 30) WHEN {like_any(('第三季度', '三季度'))} THEN make_date(y::INT, 9, 30) WHEN {like_any(('年度报告', '年报'))} THEN make_date(y::INT, 12, 31) END AS period FROM y")
def report_period(spark, sf):
    return titles(spark, sf).select("event_id", S.report_period(F.col("title")).alias("period"))


@query("nrm_14_numeric_report", "", f"WITH {TITLE_SQL} SELECT event_id, title FROM t WHERE {like_any(S.NUMERIC_REPORTS)} AND regexp_matches(title, '20\\d{{2}}年') AND NOT {like_any(S.NOT_NUMERIC)}")
def numeric_report(spark, sf):
    return titles(spark, sf).where(S.is_numeric_report(F.col("title")))


@query("nrm_15_title_priorities", "", f"WITH {TITLE_SQL} SELECT event_id, regexp_replace(regexp_replace(title, '\\s+', '', 'g'), '(?:（?(?:正文|全文)）?)$', '') AS family, CASE WHEN regexp_matches(title, '(?:（?正文）?)$') THEN 0 ELSE 1 END AS variant, {like_any(S.REVISED)}::INT AS revision FROM t")
def title_priorities(spark, sf):
    t = F.col("title")
    return titles(spark, sf).select("event_id", S.title_family(t).alias("family"), S.variant_priority(t).alias("variant"), S.revision_priority(t).alias("revision"))


@query("nrm_16_presentation", "", f"WITH {TITLE_SQL}, x AS (SELECT event_id, title || CASE WHEN event_id % 7 = 0 THEN ' 2023年年度报告（摘要）' ELSE '' END AS title FROM t), m AS (SELECT event_id, regexp_matches(replace(title, ' ', ''), '{S.CARRIER}') AS any_, list_distinct(list_filter(regexp_extract_all(replace(title, ' ', ''), '{S.CARRIER}', 1), lambda w: w <> '')) AS m FROM x) SELECT event_id, CASE WHEN NOT any_ OR len(m) > 1 THEN 'UNKNOWN' WHEN list_contains(m, '摘要') THEN 'SUMMARY' WHEN list_contains(m, '正文') THEN 'BODY' ELSE 'FULL_OR_CANONICAL' END AS presentation FROM m")
def presentation(spark, sf):
    text = F.concat(F.col("title"), F.when(F.col("event_id") % 7 == 0, " 2023年年度报告（摘要）").otherwise(""))
    return titles(spark, sf).select("event_id", S.presentation(text).alias("presentation"))


@query("nrm_18_document_identity", "", "SELECT page_id, url, CASE WHEN url LIKE '%page=%' THEN regexp_extract(url, '[?&]page=([^&#]*)', 1) ELSE '' END AS page FROM pages")
def document_identity(spark, sf):
    return X.table(spark, sf, "pages").select("page_id", "url", S.query_parameter(F.col("url"), "page").alias("page"))


@query("nrm_19_policy_identity", "", "WITH u AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN split_part(split_part(url, '?', 1), '#', 1) || '/content.shtml' ELSE url END AS url FROM pages) SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'MANUSCRIPT:' || page_id WHEN page_id % 2 = 0 THEN regexp_extract(url, '([^/]+)/+content.shtml$', 1) || ':' || left(sha256(url), 16) ELSE 'document:' || left(sha256(url), 16) END AS identity FROM u")
def policy_identity(spark, sf):
    url = F.when(F.col("page_id") % 2 == 0, F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("/content.shtml"))).otherwise(F.col("url"))
    manuscript = F.when(F.col("page_id") % 5 == 0, F.col("page_id").cast("string")).otherwise("")
    return X.table(spark, sf, "pages").select("page_id", S.policy_identity(url, manuscript).alias("identity"))


@query("nrm_20_stable_hash", "", "SELECT event_id, sha256(event_id::VARCHAR || chr(31) || user_id::VARCHAR || chr(31) || event_type) AS h FROM events")
def stable_hash(spark, sf):
    return X.table(spark, sf, "events").select("event_id", S.stable_hash(F.col("event_id"), F.col("user_id"), F.col("event_type")).alias("h"))


@query("nrm_21_strip_runtime_columns", "", "SELECT event_id, user_id, event_type FROM events")
def strip_runtime_columns(spark, sf):
    from chronolake.sources.publish import canonical_columns

    raw = X.table(spark, sf, "events").select("event_id", "user_id", "event_type", F.lit(1).alias("runtime_seconds"), F.lit("x").alias("run_id"))
    return canonical_columns(raw)


@query("nrm_25_unit_canonical", "", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2))::DECIMAL(28,2) * 100000000 WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS yuan, o_orderstatus = 'P' AS unknown_unit FROM orders")
def unit_canonical(spark, sf):
    unit = F.when(F.col("o_orderstatus") == "F", "CNY_100M").when(F.col("o_orderstatus") == "O", "CNY").otherwise("?")
    yuan, unknown = S.to_yuan(F.col("o_totalprice"), unit)
    return X.table(spark, sf, "orders").select("o_orderkey", yuan.alias("yuan"), unknown.alias("unknown_unit"))


@query("nrm_26_notice_date", "", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) END AS index_notice, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 2 THEN CAST(o_orderdate AS DATE) END AS exchange_notice FROM orders")
def notice_date(spark, sf):
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 4
    named = F.date_format(d, "yyyy年M月d日")
    text = F.when(k == 0, F.concat(F.lit("2001年1月1日公告。 <b>于</b> "), named, F.lit(" 收市后生效"))).when(k == 1, F.concat(named, F.lit("起正式实施"))).when(k == 2, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 起生效"))).otherwise("无日期")
    return X.table(spark, sf, "orders").select("o_orderkey", S.notice_date(text).alias("index_notice"), S.notice_date(text, S.EXCHANGE_NOTICE).alias("exchange_notice"))


@query("nrm_27_availability_basis", "", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(ts AS DATE) WHEN 1 THEN CAST(ts + INTERVAL 30 DAY AS DATE) ELSE CAST(ts + INTERVAL 8 HOUR AS DATE) END AS event_date, CASE event_id % 3 WHEN 0 THEN 'PUBLICATION_DATE' WHEN 1 THEN 'APPROVAL_DATE' ELSE 'FIRST_OBSERVED' END AS basis, event_id % 3 <> 2 AS reconstructable FROM events")
def availability_basis(spark, sf):
    k, ts = F.col("event_id") % 3, F.col("ts").cast("timestamp_ntz")
    seen = F.expr("cast(cast(ts as timestamp_ntz) + interval 8 hours as date)")
    basis = S.availability_basis(F.when(k == 0, ts.cast("date")), F.when(k != 2, F.date_add(ts.cast("date"), 30)), seen)
    return X.table(spark, sf, "events").select("event_id", basis.alias("b")).select("event_id", "b.*")


@query("nrm_28_record_identity", "", "SELECT event_id, CASE event_type WHEN 'click' THEN 'ID:' || event_id WHEN 'purchase' THEN 'ACC:' || user_id || '-' || event_id % 10 ELSE left(sha256(event_id::VARCHAR || chr(31) || event_type), 24) END AS record_id FROM events")
def record_identity(spark, sf):
    e = F.col("event_id").cast("string")
    rule = F.when(F.col("event_type") == "click", F.concat(F.lit("ID:"), e)).when(F.col("event_type") == "purchase", F.concat(F.lit("ACC:"), F.col("user_id").cast("string"), F.lit("-"), (F.col("event_id") % 10).cast("string")))
    return X.table(spark, sf, "events").select("event_id", F.coalesce(rule, F.left(S.stable_hash(F.col("event_id"), F.col("event_type")), F.lit(24))).alias("record_id"))


@query("nrm_29_failure_signature", "", "SELECT CASE event_id % 3 WHEN 0 THEN 'timeout at <url>' WHEN 1 THEN 'bad digest <hash> for <id>' ELSE 'filing parser produced no standardized facts' END AS signature, CASE event_id % 3 WHEN 2 THEN 'SOFT_DATA_INSUFFICIENCY' ELSE 'HARD_FAILURE' END AS severity, count(*) AS n FROM events GROUP BY ALL")
def failure_signature(spark, sf):
    e, k = F.col("event_id").cast("string"), F.col("event_id") % 3
    error = F.when(k == 0, F.concat(F.lit("timeout at https://h.example.com/x?"), e)).when(k == 1, F.concat(F.lit("bad digest "), F.left(F.sha2(e, 256), F.lit(40)), F.lit(" for 100"), F.lpad(e, 7, "0"))).otherwise("filing parser produced no standardized facts")
    rows = X.table(spark, sf, "events").select(S.failure_signature(error).alias("signature"), S.failure_severity(error).alias("severity"))
    return rows.groupBy("signature", "severity").agg(F.count("*").alias("n"))


@query("nrm_30_capture_timing", "", "WITH " + TIMING_SQL.replace("{ts}", "(ts + INTERVAL 8 HOUR)"))
def capture_timing(spark, sf):
    return timed(X.table(spark, sf, "events").select("event_id", F.expr("cast(ts as timestamp_ntz) + interval 8 hours").alias("at")))


@query("nrm_31_column_allowlist", "", "SELECT o_orderkey, o_orderdate FROM orders")
def column_allowlist(spark, sf):
    from chronolake.sources.publish import allowlist

    return allowlist(X.table(spark, sf, "orders"), ["o_orderkey", "o_orderdate"])


@query("nrm_32_provenance_json", "", "SELECT event_id, 'events' AS source, event_id::VARCHAR AS row_id, 'v' || user_id % 3 AS parser FROM events")
def provenance_json(spark, sf):
    j = F.to_json(F.struct(F.lit("events").alias("source"), F.col("event_id").cast("string").alias("row_id")))
    more = S.enriched(j, {"parser": F.concat(F.lit("v"), F.col("user_id") % 3), "source": F.lit("other")})
    return X.table(spark, sf, "events").select("event_id", F.from_json(more, "source string, row_id string, parser string").alias("x")).select("event_id", "x.*")


@query("nrm_33_text_normal", "", None)
def text_normal(spark, sf):
    return X.table(spark, sf, "documents").select("doc_id", normalized_text(F.col("text")).alias("text"))


@query("udf_4_rule_table", "", f"WITH {TITLE_SQL} SELECT event_id, coalesce((SELECT label FROM (VALUES (1, '诉讼', 'A'), (2, '公告', 'B'), (3, '报告', 'C')) r(rank, word, label) WHERE contains(title, word) ORDER BY rank LIMIT 1), 'NONE') AS label FROM t")
def rule_table(spark, sf):
    """A taxonomy given as rows: a bounded rule table becomes one ordered expression."""
    rules = [("诉讼", "A"), ("公告", "B"), ("报告", "C")]
    return titles(spark, sf).select("event_id", S.first_match([(F.col("title").contains(w), v) for w, v in rules], "NONE").alias("label"))
