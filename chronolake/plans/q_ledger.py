"""Bitemporal ledger queries over the announcements."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.functions import scalars as S
from chronolake.operators import archives, assembly, combine, intervals, ledger, sets
from chronolake.sources.scratch import new_path, saved

from . import fixtures as X
from .q_scalars import TITLE_SQL, like_any, titles
from .registry import query

LEDGER = """led AS (SELECT sha256(doc::VARCHAR || chr(31) || cls) AS evidence_id, ent, cls, doc, CAST(pub AS DATE) AS event_date, CAST(pub AS DATE) + CASE WHEN doc % 97 = 0 THEN -1 ELSE (doc % 4)::INT END AS available_date,
  CASE WHEN doc % 89 = 0 THEN '' ELSE 'D' || doc END AS document_id, doc % 9990 AS ing, CASE doc % 50 WHEN 0 THEN 'LOST' WHEN 1 THEN 'DELAYED' ELSE 'AVAILABLE' END AS state FROM v_annc)"""


def evidence(spark, sf):
    """The announcements as a ledger with planted faults: early availability, empty documents, repeated ingestion ids, unknown states."""
    day = F.col("pub").cast("date")
    state = F.when(F.col("doc") % 50 == 0, "LOST").when(F.col("doc") % 50 == 1, "DELAYED").otherwise("AVAILABLE")
    return X.announcements(spark, sf).select(
        S.stable_hash(F.col("doc"), F.col("cls")).alias("evidence_id"),
        F.col("ent").cast("string").alias("entity_id"),
        F.col("cls").alias("evidence_type"),
        day.alias("event_date"),
        F.date_add(day, F.when(F.col("doc") % 97 == 0, -1).otherwise(F.col("doc") % 4).cast("int")).alias("available_date"),
        F.lit("events").alias("source_identity"),
        F.when(F.col("doc") % 89 == 0, "").otherwise(F.concat(F.lit("D"), F.col("doc").cast("string"))).alias("document_id"),
        (F.col("doc") % 9990).cast("string").alias("ingestion_id"),
        state.alias("availability_state"),
        F.to_json(F.struct(F.col("doc"))).alias("provenance"),
    )


RULES = "v AS (SELECT evidence_id, unnest([CASE WHEN available_date < event_date THEN 'AVAILABLE_BEFORE_EVENT' END, CASE WHEN document_id = '' THEN 'document_id_EMPTY' END, CASE WHEN state = 'LOST' THEN 'STATE_UNKNOWN' END, CASE WHEN count(*) OVER (PARTITION BY ing) > 1 THEN 'ingestion_id_TWICE' END]) AS rule FROM led)"


@query("pit_1_ledger_validation", "v_annc", f", {LEDGER}, {RULES} SELECT evidence_id, string_agg(rule, ',' ORDER BY rule) AS broken FROM v WHERE rule IS NOT NULL GROUP BY evidence_id")
def ledger_validation(spark, sf):
    return ledger.invalid_records(evidence(spark, sf))


@query("pit_2_as_of_snapshot", "v_annc", f", {LEDGER} SELECT evidence_id, cls AS evidence_type, available_date FROM led WHERE available_date <= DATE '2024-01-20'")
def as_of_snapshot(spark, sf):
    return ledger.as_of(evidence(spark, sf), X.day("2024-01-20")).select("evidence_id", "evidence_type", "available_date")


@query("pit_3_prefix_replay", "v_annc", f", {LEDGER} SELECT available_date, count(*) AS n1, count(*) FILTER (doc % 1000 <> 7) AS n2 FROM led WHERE available_date <= DATE '2024-01-25' GROUP BY available_date HAVING n1 <> n2")
def prefix_replay(spark, sf):
    old = evidence(spark, sf)
    return ledger.changed_days(old, old.where("cast(get_json_object(provenance, '$.doc') as long) % 1000 <> 7"), X.day("2024-01-25"))


@query("pit_3_changed_records", "v_annc", f", {LEDGER} SELECT available_date, ent::VARCHAR AS entity_id, evidence_id, 1::BIGINT AS n1, CASE WHEN doc % 1000 = 7 THEN NULL WHEN doc % 1000 = 9 THEN 2 ELSE 1 END::BIGINT AS n2, CASE WHEN doc % 1000 = 7 THEN 'REMOVED' ELSE 'CHANGED' END AS change FROM led WHERE available_date <= DATE '2024-01-25' AND doc % 1000 IN (7, 8, 9)")
def changed_records(spark, sf):
    """A later ledger lost some rows, has others with a new state and some twice; stored fingerprints of the days stand for the earlier one."""
    old = saved(evidence(spark, sf), "ledger")
    doc = F.get_json_object("provenance", "$.doc").cast("long") % 1000
    new = old.where(doc != 7).withColumn("availability_state", F.when(doc == 8, "RESTATED").otherwise(F.col("availability_state")))
    new = saved(new.unionByName(old.where(doc == 9)), "ledger")
    stored = saved(ledger.day_fingerprints(ledger.as_of(old, X.day("2024-01-25"))), "fingerprints")
    return ledger.changed_records(old, new, X.day("2024-01-25"), stored)


@query("pit_4_ledger_audit", "v_annc", f", {LEDGER} SELECT count(*) AS n, count(DISTINCT evidence_id) = count(*) AS evidence_ids_unique, count(DISTINCT ing) = count(*) AS ingestion_ids_unique, bool_and(available_date >= event_date) AS never_available_early, bool_and(state <> 'LOST') AS states_known, bool_and(document_id <> '') AS documents_named, true AS provenance_parses, min(available_date) AS first_available, max(available_date) AS last_available, count(DISTINCT ent) AS entities FROM led")
def ledger_audit(spark, sf):
    return ledger.audit(evidence(spark, sf))


@query("pit_5_announcement_evidence", "v_ecal v_annc", f", {TITLE_SQL} SELECT doc, t.title, (SELECT min(d) FROM v_ecal WHERE d > CAST(pub AS DATE)) AS available, sha256(doc::VARCHAR || chr(31) || title) AS evidence_id FROM v_annc JOIN t ON t.event_id = doc WHERE EXISTS (SELECT 1 FROM v_ecal WHERE d > CAST(pub AS DATE))")
def announcement_evidence(spark, sf):
    from chronolake.operators import calendar

    rows = X.announcements(spark, sf).join(titles(spark, sf), F.col("doc") == F.col("event_id")).select("doc", "title", F.date_format("pub", "yyyy-MM-dd").alias("published"))
    out = calendar.available(rows, "published", X.event_calendar(spark, sf)).where("available is not null")
    return out.select("doc", "title", "available", S.stable_hash(F.col("doc"), F.col("title")).alias("evidence_id"))


@query("pit_6_archive_coverage", "v_annc", "SELECT s.ent, coalesce(n, 0) AS records, CASE WHEN s.ent % 40 = 3 THEN 'FAILED' WHEN n IS NULL THEN 'EMPTY' ELSE 'COMPLETE' END AS query_status FROM (SELECT c_custkey AS ent FROM customer) s LEFT JOIN (SELECT ent, count(*) AS n FROM v_annc GROUP BY ent) a ON a.ent = s.ent AND s.ent % 40 <> 3")
def archive_coverage(spark, sf):
    scope = X.table(spark, sf, "customer").select(F.col("c_custkey").alias("ent"))
    return combine.archive_states(scope, X.announcements(spark, sf), "ent", scope.where("ent % 40 = 3"))


@query("pit_9_direction_evidence", "v_annc", f", {TITLE_SQL}, x AS (SELECT ent, contains(title, '预增') AS up, contains(title, '预减') OR contains(title, '续亏') AS down FROM v_annc JOIN t ON event_id = doc) SELECT ent, count(*) FILTER (up AND NOT down) AS ups, count(*) FILTER (down AND NOT up) AS downs, count(*) FILTER (up = down) AS unclassified FROM x GROUP BY ent")
def direction_evidence(spark, sf):
    rows = X.announcements(spark, sf).join(titles(spark, sf), F.col("doc") == F.col("event_id")).withColumn("k", S.earnings_direction(F.col("title")))
    return rows.groupBy("ent").agg(F.count_if(F.col("k") == "UP").alias("ups"), F.count_if(F.col("k") == "DOWN").alias("downs"), F.count_if(F.col("k") == "UNKNOWN").alias("unclassified"))


@query("pit_10_domain_events", "v_annc", f", {TITLE_SQL} SELECT doc, CASE WHEN title LIKE '%协议%' THEN 'BD_LICENSING' ELSE 'CLINICAL_REGULATORY' END AS family FROM v_annc JOIN t ON event_id = doc WHERE title IN ('授权协议公告', '药品上市许可申请获受理', '上市许可申请纳入优先审评', '终止临床试验', '获批上市公告', '与新药合作协议', '<b>突破性治疗</b>认定', '临床试验批准通知书')")
def domain_events(spark, sf):
    rows = titles(spark, sf).select(F.col("event_id").alias("doc"), S.drug_event(F.col("title")).alias("kind")).where("kind is not null")
    return rows.select("doc", F.when(F.col("kind").startswith("BD_"), "BD_LICENSING").otherwise("CLINICAL_REGULATORY").alias("family"))


@query("pit_11_keyword_archive", "", f"WITH {TITLE_SQL} SELECT k AS keyword, count(*) AS hits, count(*) FILTER (event_id % 2 = 0) AS in_scope, count(DISTINCT title) AS titles FROM t, (VALUES ('公告'), ('报告'), ('协议')) w(k) WHERE contains(title, k) GROUP BY k")
def keyword_archive(spark, sf):
    rows = combine.keyword_hits(titles(spark, sf), "title", ["公告", "报告", "协议"])
    return rows.groupBy("keyword").agg(F.count("*").alias("hits"), F.count_if(F.col("event_id") % 2 == 0).alias("in_scope"), F.count_distinct("title").alias("titles"))


KEYWORDS = ["协议", "公告", "报告", "无此词"]
ARCHIVE_SQL = f""", {TITLE_SQL}, w AS (SELECT * FROM (VALUES {", ".join(f"('{w}', {k})" for k, w in enumerate(KEYWORDS))}) x(keyword, rank)),
r AS (SELECT doc, ent, title FROM v_annc JOIN t ON event_id = doc UNION ALL SELECT doc, ent, title FROM v_annc JOIN t ON event_id = doc WHERE doc % 6 = 0),
h AS (SELECT doc, ent, title, keyword, rank, count(*) AS hits, ent % 3 <> 1 AS inside FROM r JOIN w ON contains(title, keyword) GROUP BY ALL),
f AS (SELECT *, inside AND rank = min(rank) FILTER (inside) OVER (PARTITION BY doc) AS kept FROM h)"""


@query("pit_11_archive_rows", "v_annc", ARCHIVE_SQL + " SELECT doc, ent, title, keyword FROM f WHERE kept")
def archive_rows(spark, sf):
    return keyword_archive_run(spark, sf)[0]


@query("pit_11_archive_stages", "v_annc", ARCHIVE_SQL + " SELECT w.keyword, coalesce(sum(hits), 0)::BIGINT AS hits, count(f.doc) AS notices, count(*) FILTER (inside) AS candidates, count(*) FILTER (kept) AS kept FROM w LEFT JOIN f USING (keyword) GROUP BY w.keyword")
def archive_stages(spark, sf):
    return keyword_archive_run(spark, sf)[1]


def keyword_archive_run(spark, sf):
    """Notices, some of which a search gives twice; entities out of scope are counted and left out."""
    rows = X.announcements(spark, sf).join(titles(spark, sf), F.col("doc") == F.col("event_id")).select("doc", "ent", "title")
    scope = rows.select("ent").distinct().where("ent % 3 <> 1")
    return archives.keyword_archive(rows.unionByName(rows.where("doc % 6 = 0")), "doc", "title", KEYWORDS, scope, "ent")


def increment_run(spark, sf):
    """Facts of documents, two a document; some are stated twice and some become available after the target."""
    a = X.announcements(spark, sf).select("ent", (F.col("doc") / 4).cast("long").alias("doc"), F.concat(F.lit("F"), (F.col("doc") % 4).cast("string")).alias("fact"), F.col("pub").cast("date").alias("event_date"), F.date_add(F.col("pub").cast("date"), (F.col("doc") % 5).cast("int")).alias("available"), F.col("doc").alias("id"))
    rows = a.unionByName(a.where("id % 17 = 0"))
    scope = X.table(spark, sf, "customer").select(F.col("c_custkey").alias("ent"))
    return archives.increment(rows, scope, X.day("2024-01-10"), X.day("2024-01-20"))


INCREMENT_SQL = """, r AS (SELECT ent, doc // 4 AS doc, 'F' || doc % 4 AS fact, CAST(pub AS DATE) AS event_date, CAST(pub AS DATE) + (doc % 5)::INT AS available, doc AS id FROM v_annc), x AS (SELECT * FROM r UNION ALL SELECT * FROM r WHERE id % 17 = 0),
c AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY ent, doc, fact) > 1 THEN 'DUPLICATE_FACT' WHEN available <= DATE '2024-01-20' THEN 'AVAILABLE' ELSE 'NOT_YET_AVAILABLE' END AS state FROM x WHERE event_date > DATE '2024-01-10' AND event_date <= DATE '2024-01-20')"""


@query("pit_14_increment_rows", "v_annc", INCREMENT_SQL + " SELECT ent, doc, fact, event_date, available, state FROM c")
def increment_rows(spark, sf):
    return increment_run(spark, sf)[0].drop("id")


@query("pit_14_increment_accounting", "v_annc", INCREMENT_SQL + ", g AS (SELECT ent, count(DISTINCT doc) AS documents, count(*) FILTER (state = 'AVAILABLE') AS facts, count(*) FILTER (state = 'NOT_YET_AVAILABLE') AS pending, count(*) FILTER (state = 'DUPLICATE_FACT') AS duplicates FROM c GROUP BY ent) SELECT c_custkey AS ent, coalesce(documents, 0) AS documents, coalesce(facts, 0) AS facts, coalesce(pending, 0) AS pending, coalesce(duplicates, 0) AS duplicates, CASE WHEN documents IS NULL THEN 'EMPTY' WHEN duplicates > 0 THEN 'DUPLICATE' WHEN pending > 0 THEN 'PENDING' ELSE 'COMPLETE' END AS status FROM customer LEFT JOIN g ON ent = c_custkey")
def increment_accounting(spark, sf):
    return increment_run(spark, sf)[1]


@query("pit_12_adverse_review", "v_annc", ", n AS (SELECT ent, count(*) AS own FROM v_annc WHERE cls = 'error' GROUP BY ent), m AS (SELECT count(*) AS market FROM v_annc WHERE cls = 'error' AND ent = 0) SELECT c_custkey AS ent, coalesce(own, 0) + market AS negatives, c_custkey % 10 <> 0 AS complete, c_custkey % 10 <> 0 AND coalesce(own, 0) + market = 0 AS exclusion_clear FROM customer LEFT JOIN n ON ent = c_custkey, m")
def adverse_review(spark, sf):
    """Rows of the market-wide entity 0 count for every entity."""
    bad = X.announcements(spark, sf).where("cls = 'error'")
    scope = X.table(spark, sf, "customer").select(F.col("c_custkey").alias("ent"))
    return combine.clear_of_negatives(scope, bad, "ent", F.col("ent") == 0, F.col("ent") % 10 != 0)


@query("pit_13_registry_snapshot", "v_annc v_member", f"""
, m AS (SELECT doc, ent % 120 + 1 AS sym, CAST(pub AS DATE) - 9862 AS av FROM v_annc WHERE cls IN ('click', 'purchase')),
k AS (SELECT m.*, EXISTS (SELECT 1 FROM v_member v WHERE v.sym = m.sym) AS mapped, EXISTS (SELECT 1 FROM v_member v WHERE v.sym = m.sym AND av BETWEEN s AND e) AS inside FROM m)
SELECT count(*) AS raw_rows, count(*) FILTER (mapped) AS mapped_rows, count(*) FILTER (NOT mapped) AS unmapped_rows, count(*) FILTER (inside) AS inside_rows, count(*) FILTER (mapped AND NOT inside) AS excluded_rows FROM k""")
def registry_snapshot(spark, sf):
    rows = X.announcements(spark, sf).where("cls in ('click', 'purchase')").select("doc", (F.col("ent") % 120 + 1).alias("sym"), F.expr("date_sub(cast(pub as date), 9862)").alias("av"))
    m = X.member(spark, sf)
    return combine.registry_accounting(rows, "sym", m, intervals.interval_join(rows, m, "sym", "av"), "doc")


def registry_rows(spark, sf):
    """Registry rows of the events, in pairs: some pairs repeat a record, some give one id two applicants; faults of each kind are planted."""
    e = X.table(spark, sf, "events").select(F.col("event_id").cast("int").alias("row"))
    m = F.floor(F.col("row") / 2).cast("int")
    source, plain = F.concat(F.lit("S"), (m % 4).cast("string")), F.concat(F.lit("N"), ((m + F.when((m % 5 == 1) & (F.col("row") % 2 == 1), 1).otherwise(0)) % 30).cast("string"))
    basis = F.when((m % 4 == 0) | (m % 41 == 0), "PUBLICATION_DATE_EXPLICIT").when(m % 4 == 1, "OFFICIAL_APPROVAL_DATE_EXPLICIT").otherwise("FIRST_OBSERVED_SNAPSHOT_DATE")
    day = F.date_add(X.day("1995-01-01"), (m * 13 % 1600).cast("int"))
    return e.select(
        "row", source.alias("source"), F.when(m % 3 == 0, "filing").otherwise("approval").alias("category"), basis.alias("basis"),
        F.when(m % 5 <= 1, m.cast("string")).otherwise(F.concat(F.lit("R"), F.col("row").cast("string"))).alias("own_id"),
        F.when(m % 7 == 0, F.concat(plain, F.lit("; N"), ((m + 11) % 30).cast("string"))).otherwise(plain).alias("applicant"),
        F.when(m % 37 != 0, day).alias("published"), day.alias("approved"), F.when(m % 43 == 0, X.day("1996-06-02")).otherwise(X.day("1996-06-03")).alias("captured"),
    )


def registry_run(spark, sf):
    from chronolake.operators import registry_snapshot

    catalog = spark.createDataFrame([("S0", ["filing", "approval"], "PUBLICATION_DATE_EXPLICIT"), ("S1", ["approval"], "OFFICIAL_APPROVAL_DATE_EXPLICIT"), ("S2", ["filing", "approval"], "FIRST_OBSERVED_SNAPSHOT_DATE")], "source string, categories array<string>, basis string")
    names = X.table(spark, sf, "supplier").where("s_suppkey <= 25").select(F.concat(F.lit("N"), (F.col("s_suppkey") - 1).cast("string")).alias("name"), F.col("s_suppkey").alias("ent"))
    return registry_snapshot.materialised(registry_rows(spark, sf), catalog, names, X.member(spark, sf).withColumnRenamed("sym", "ent"), X.day("1996-06-03"))


REGISTRY_SQL = """
, x AS (SELECT event_id AS row, event_id // 2 AS m FROM events),
r AS (SELECT *, 'S' || m % 4 AS source, CASE WHEN m % 3 = 0 THEN 'filing' ELSE 'approval' END AS category, (m + CASE WHEN m % 5 = 1 AND row % 2 = 1 THEN 1 ELSE 0 END) % 30 AS a1, CASE WHEN m % 7 = 0 THEN (m + 11) % 30 END AS a2, CASE WHEN m % 4 < 2 THEN DATE '1995-01-01' + (m * 13 % 1600)::INT ELSE DATE '1996-06-03' END AS available,
  concat_ws(',', CASE WHEN m % 4 = 3 THEN 'SOURCE_UNKNOWN' END, CASE WHEN m % 4 = 1 AND m % 3 = 0 THEN 'CATEGORY_NOT_OF_SOURCE' END, CASE WHEN m % 41 = 0 AND m % 4 IN (1, 2) THEN 'BASIS_NOT_OF_SOURCE' END, CASE WHEN m % 37 = 0 AND (m % 4 = 0 OR m % 41 = 0) THEN 'DATE_MISSING' END, CASE WHEN m % 43 = 0 AND m % 4 >= 2 AND m % 41 <> 0 THEN 'CAPTURED_ANOTHER_DAY' END) AS broken,
  'S' || m % 4 || ':' || CASE WHEN m % 5 <= 1 THEN m::VARCHAR ELSE 'R' || row END AS record_id FROM x),
s AS (SELECT * FROM r WHERE broken = '' AND m % 5 <> 1 AND (m % 5 <> 0 OR row % 2 = 0)),
t AS (SELECT DISTINCT s.row, s_suppkey AS ent FROM s JOIN supplier ON s_suppkey <= 25 AND (s_suppkey - 1 = a1 OR s_suppkey - 1 = a2)),
v AS (SELECT DISTINCT t.row, t.ent FROM t JOIN s USING (row) JOIN v_member k ON k.sym = t.ent AND s.available BETWEEN k.s AND k.e),
z AS (SELECT row, record_id, CASE WHEN broken <> '' THEN 'INVALID' WHEN m % 5 = 1 THEN 'CONFLICT' WHEN m % 5 = 0 AND row % 2 = 1 THEN 'REPEAT' WHEN row NOT IN (SELECT row FROM t) THEN 'UNMAPPED' WHEN row NOT IN (SELECT row FROM v) THEN 'EXCLUDED' ELSE 'EVENT' END AS state, broken FROM r)
"""


@query("pit_13_registry_lineage", "v_member", REGISTRY_SQL + "SELECT row, record_id, state, CASE WHEN broken <> '' THEN broken WHEN state = 'EXCLUDED' THEN 'NOT_A_MEMBER_WHEN_AVAILABLE' END AS reason FROM z")
def registry_lineage(spark, sf):
    return registry_run(spark, sf)[0]


@query("pit_13_registry_events", "v_member", REGISTRY_SQL + "SELECT record_id, ent, category, available, CASE WHEN m % 4 < 2 THEN 'HISTORICAL_RECONSTRUCTABLE' ELSE 'PROSPECTIVE_FIRST_OBSERVED_ONLY' END AS availability_state FROM v JOIN s USING (row)")
def registry_events(spark, sf):
    return registry_run(spark, sf)[1]


@query("pit_13_registry_summary", "v_member", REGISTRY_SQL + "SELECT count(*) AS input_rows, count(*) FILTER (state = 'INVALID') AS invalid, count(*) FILTER (state = 'CONFLICT') AS conflict, count(*) FILTER (state = 'REPEAT') AS repeat, count(*) FILTER (state = 'UNMAPPED') AS unmapped, count(*) FILTER (state = 'EXCLUDED') AS excluded, count(*) FILTER (state = 'EVENT') AS event, (SELECT count(*) FROM v) AS events, (SELECT count(DISTINCT ent) FROM v) AS entities, (SELECT string_agg(DISTINCT category, ',' ORDER BY category) FROM v JOIN s USING (row)) AS categories FROM z")
def registry_totals(spark, sf):
    from chronolake.operators import registry_snapshot

    return registry_snapshot.summary(*registry_run(spark, sf))


@query("pit_14_date_increment", "v_annc", f", {LEDGER} SELECT event_date, count(*) AS documents, count(*) FILTER (available_date > DATE '2024-01-20') AS not_yet_available, count(DISTINCT ent) AS entities FROM led WHERE event_date > DATE '2024-01-10' AND event_date <= DATE '2024-01-20' GROUP BY event_date")
def date_increment(spark, sf):
    rows = evidence(spark, sf).where((F.col("event_date") > X.day("2024-01-10")) & (F.col("event_date") <= X.day("2024-01-20")))
    return rows.groupBy("event_date").agg(F.count("*").alias("documents"), F.count_if(F.col("available_date") > X.day("2024-01-20")).alias("not_yet_available"), F.count_distinct("entity_id").alias("entities"))


@query("pit_15_ledger_assembly", "v_annc v_facts", f"""
, {LEDGER}, c AS (SELECT ent, pe, ft, av, max(val) AS val FROM v_facts GROUP BY ent, pe, ft, av),
a AS (SELECT 'announcement' AS part, available_date AS av FROM led WHERE available_date >= event_date AND document_id <> '' AND state <> 'LOST' UNION ALL SELECT 'fact', av FROM c)
SELECT part, date_trunc('month', av)::DATE AS month, count(*) AS n FROM a GROUP BY ALL""")
def ledger_assembly(spark, sf):
    """Facts and announcements in one ledger, invalid rows left out, counted by part and availability month."""
    rows = evidence(spark, sf)
    good = rows.where("available_date >= event_date and document_id <> '' and availability_state <> 'LOST'").select(F.lit("announcement").alias("part"), "evidence_id", F.col("available_date").alias("av"))
    facts = X.facts(spark, sf).groupBy("ent", "pe", "ft", "av").agg(F.max("val").alias("val"))
    facts = facts.select(F.lit("fact").alias("part"), S.stable_hash(F.col("ent"), F.col("pe"), F.col("ft"), F.col("av"), F.col("val")).alias("evidence_id"), "av")
    return good.unionByName(facts).groupBy("part", F.trunc("av", "MM").alias("month")).agg(F.count("*").alias("n"))


#: Fact types of the fixture in their roles; amounts are moved so that every state occurs.
ROLES = {"1-URGENT": "REVENUE_TREND", "2-HIGH": "PROFIT_TREND", "3-MEDIUM": "CASH_FLOW_TREND", "4-NOT SPECIFIED": "MARGIN_TREND"}
MARGIN = "4-NOT SPECIFIED"


def ledger_inputs(spark, sf):
    """Facts with profit and cash moved down, bars that ask for one fact type each, and the announcements as notices."""
    from .q_series import asked, clean

    moved = F.when(F.col("ft") == "2-HIGH", 400000).when(F.col("ft") == "3-MEDIUM", 300000).otherwise(0)
    notices = X.announcements(spark, sf).join(titles(spark, sf), F.col("doc") == F.col("event_id"))
    return {
        "facts": clean(spark, sf).withColumn("val", (F.col("val") - moved).cast("decimal(18,2)")),
        "prices": asked(spark, sf),
        "notices": notices.select("doc", "ent", "title", F.date_format("pub", "yyyy-MM-dd HH:mm:ss").alias("published")),
    }


def ledger_parts(spark, sf):
    return assembly.standard_parts(X.calendar(spark, sf), X.event_calendar(spark, sf), ROLES, (MARGIN,), list(ROLES))


def _ledger_sql(body):
    from .q_series import TYPES

    known = ", ".join(f"(SELECT arg_max(val, b.av) FROM c b WHERE b.ent = cut.ent AND b.pe = cut.pe AND b.ft = '{k}' AND b.av <= cut.cut) AS v{i}" for i, k in enumerate(TYPES[:4]))
    up, down = like_any(("预增", "扭亏", "续盈", "略增")), like_any(("预减", "首亏", "续亏", "略减", "由盈转亏"))
    return f"""
, c AS (SELECT ent, pe, ft, av, max(val) - CASE ft WHEN '2-HIGH' THEN 400000 WHEN '3-MEDIUM' THEN 300000 ELSE 0 END AS val FROM v_facts GROUP BY ent, pe, ft, av),
p AS (SELECT a.*, (SELECT arg_max(b.val, b.av) FROM c b WHERE b.ent = a.ent AND b.ft = a.ft AND b.pe = last_day(a.pe - INTERVAL 12 MONTH) AND b.av <= a.av) AS prior FROM c a WHERE ft <> '5-LOW'),
trend AS (SELECT 'trend' AS part, ent, CASE ft {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROLES.items())} END AS kind, pe AS event_date, av, CASE WHEN ft = '{MARGIN}' THEN val::DOUBLE - prior::DOUBLE ELSE val::DOUBLE / prior::DOUBLE - 1 END AS x, NULL AS word FROM p WHERE prior IS NOT NULL AND (ft = '{MARGIN}' OR prior <> 0)),
cut AS (SELECT DISTINCT ent, pe, av AS cut FROM c WHERE ft <> '5-LOW'),
s AS (SELECT ent, pe, cut, {known} FROM cut),
j AS (SELECT a.ent, a.pe, a.cut, a.v0 AS r, a.v1 AS p, a.v2 AS q, a.v3 AS m, b.v0 AS r0, b.v1 AS p0, b.v2 AS q0, b.v3 AS m0 FROM (SELECT *, last_day(pe - INTERVAL 12 MONTH) AS pe0 FROM s) a ASOF LEFT JOIN s b ON b.ent = a.ent AND b.pe = a.pe0 AND a.cut >= b.cut),
state AS (SELECT 'state' AS part, ent, 'FUNDAMENTAL_STATE' AS kind, pe AS event_date, cut AS av, NULL::DOUBLE AS x, CASE WHEN r + p + q + m + r0 + p0 + q0 + m0 IS NULL THEN NULL WHEN p < 0 THEN 'FUNDAMENTAL_FAIL' WHEN r < r0 AND p < p0 AND q < q0 AND m < m0 THEN 'FUNDAMENTAL_FAIL' WHEN p > 0 AND q < 0 AND q0 >= 0 AND q < q0 THEN 'FUNDAMENTAL_FAIL' WHEN p < p0 AND m < m0 AND q < q0 THEN 'FUNDAMENTAL_FAIL' WHEN p > 0 AND q >= 0 AND r >= r0 AND p >= p0 AND q >= q0 AND m >= m0 THEN 'FUNDAMENTAL_PASS' ELSE 'FUNDAMENTAL_WATCH' END AS word FROM j),
n AS (SELECT *, row_number() OVER (ORDER BY ft) - 1 AS k FROM (SELECT DISTINCT ft FROM c)), b AS (SELECT v_bars.*, sym % 25 AS ent, n.ft FROM v_bars JOIN n ON n.k = sym % 5),
t AS (SELECT ent, ft, av, max(max(pe)) OVER (PARTITION BY ent, ft ORDER BY av) AS latest FROM c GROUP BY ent, ft, av),
y0 AS (SELECT ent, ft, av, latest, (SELECT arg_max(val, u.av) FROM c u WHERE u.ent = t.ent AND u.ft = t.ft AND u.pe = latest AND u.av <= t.av) AS now,
  (SELECT arg_max(val, u.av) FROM c u WHERE u.ent = t.ent AND u.ft = t.ft AND u.pe = make_date(year(latest) - 1, 12, 31) AND u.av <= t.av) AS whole,
  (SELECT arg_max(val, u.av) FROM c u WHERE u.ent = t.ent AND u.ft = t.ft AND u.pe = last_day(latest - INTERVAL 12 MONTH) AND u.av <= t.av) AS comparable FROM t),
y AS (SELECT * FROM (SELECT ent, ft, av, CASE WHEN month(latest) = 12 THEN now ELSE whole + now - comparable END AS ttm FROM y0) WHERE ttm IS NOT NULL),
rail AS (SELECT b.sym, b.ent, b.d, slot, b.px / y.ttm::DOUBLE AS ratio FROM b JOIN v_cal USING (d) ASOF JOIN y ON b.ent = y.ent AND b.ft = y.ft AND b.d >= y.av WHERE y.ttm > 0),
valuation AS (SELECT 'valuation' AS part, a.ent, 'TRAILING_VALUATION_CHANGE' AS kind, a.d AS event_date, a.d AS av, a.ratio / o.ratio - 1 AS x, NULL AS word FROM rail a JOIN rail o ON o.sym = a.sym AND o.slot = a.slot - 20 WHERE o.ratio <> 0),
h AS (SELECT a.doc, a.ent, title, CAST(pub AS DATE) AS day, CASE WHEN EXISTS (SELECT 1 FROM v_ecal WHERE d = CAST(pub AS DATE)) AND strftime(pub, '%H:%M:%S') <= '15:00:00' THEN CAST(pub AS DATE) ELSE (SELECT min(d) FROM v_ecal WHERE d > CAST(pub AS DATE)) END AS av FROM v_annc a JOIN titles ON event_id = doc),
usable AS (SELECT * FROM h WHERE av IS NOT NULL),
earnings AS (SELECT 'earnings' AS part, ent, 'EARNINGS_DIRECTION' AS kind, day AS event_date, av, NULL::DOUBLE AS x, CASE WHEN {down} THEN 'DOWN' ELSE 'UP' END AS word FROM usable WHERE ({up}) <> ({down})),
policy AS (SELECT 'policy' AS part, ent, CASE WHEN {like_any(S.POLICY_NEGATIVE)} THEN 'MAJOR_NEGATIVE_EVENT' ELSE 'OFFICIAL_NOTICE' END AS kind, day AS event_date, av, NULL::DOUBLE AS x, NULL AS word FROM usable),
every AS (SELECT * FROM trend UNION ALL SELECT * FROM state UNION ALL SELECT * FROM valuation UNION ALL SELECT * FROM earnings UNION ALL SELECT part, ent, kind, event_date, av, x, kind FROM policy)
{body}""".replace(", c AS (SELECT ent, pe", ", " + TITLE_SQL.replace("t AS (", "titles AS (", 1) + ", c AS (SELECT ent, pe", 1)


LEDGER_VIEWS = "v_ecal v_annc v_bars v_facts"
ALL_ROWS = _ledger_sql("SELECT part, ent::VARCHAR AS entity_id, kind AS evidence_type, event_date, av AS available_date, round(x, 6) AS x, word, CASE WHEN part = 'state' AND word IS NULL THEN 'DATA_INSUFFICIENT' ELSE 'HISTORICAL_RECONSTRUCTABLE' END AS availability_state FROM every")


def told(rows):
    """Ledger rows with the value of their payload: x where it is a number, word where it is not."""
    value = F.get_json_object("payload", "$.value")
    number = F.col("part").isin("trend", "valuation")
    return rows.select("part", "entity_id", "evidence_type", "event_date", "available_date", F.when(number, F.round(value.cast("double"), 6)).alias("x"), F.when(~number, value).alias("word"), "availability_state")


@query("pit_15_derived_ledger", LEDGER_VIEWS, ALL_ROWS)
def derived_ledger(spark, sf):
    """Trends, states, valuations, directions and policy rows in one stored ledger."""
    return told(assembly.build(ledger_parts(spark, sf), ledger_inputs(spark, sf), new_path(spark, "derived")))


@query("pit_15_increment", LEDGER_VIEWS, ALL_ROWS)
def ledger_increment(spark, sf):
    """The ledger is built from earlier inputs (facts missing and with other values, fewer bars and notices) and brought up to date: the same rows."""
    now = {name: saved(df, name) for name, df in ledger_inputs(spark, sf).items()}
    wrong = (F.col("ent") == 3) & (F.col("av") < "1996-01-01") & (F.col("ft") == "1-URGENT")
    before = {
        "facts": now["facts"].where("not (ent % 5 = 1 and av > date'1997-06-30')").withColumn("val", F.when(wrong, F.col("val") + 1).otherwise(F.col("val")).cast("decimal(18,2)")),
        "prices": now["prices"].where("d < date'1998-03-01' or ent % 3 = 0"),
        "notices": now["notices"].where("published < '2024-01-20'"),
    }
    parts, path = ledger_parts(spark, sf), new_path(spark, "derived")
    assembly.build(parts, before, path)
    changed = {name: assembly.changed_since(before[name], now[name], time) for name, time in (("facts", "av"), ("prices", "d"), ("notices", "published"))}
    return told(assembly.advance(parts, now, changed, path, 1))


@query("pit_15_manifest", LEDGER_VIEWS, _ledger_sql("SELECT part, count(*) AS n, count(DISTINCT ent) AS entities, count(*) FILTER (part = 'state' AND word IS NULL) AS insufficient, min(av) AS first_available, max(av) AS last_available FROM every GROUP BY part"))
def ledger_manifest(spark, sf):
    rows = assembly.build(ledger_parts(spark, sf), ledger_inputs(spark, sf), new_path(spark, "derived"))
    return assembly.manifest(rows).select("part", "n", "entities", "insufficient", "first_available", "last_available")


@query("pit_15_review", LEDGER_VIEWS, _ledger_sql(", g AS (SELECT ent, count(*) AS records, count(*) FILTER (kind = 'MAJOR_NEGATIVE_EVENT' OR word IN ('DOWN', 'FUNDAMENTAL_FAIL')) AS negatives, count(*) FILTER (part = 'state' AND word IS NULL) AS insufficient, max(av) AS last_available FROM every GROUP BY ent) SELECT c_custkey AS ent, coalesce(records, 0) AS records, coalesce(negatives, 0) AS negatives, coalesce(insufficient, 0) AS insufficient, last_available, coalesce(records > 0 AND negatives = 0, false) AS clear FROM customer LEFT JOIN g ON g.ent = c_custkey"))
def ledger_review(spark, sf):
    scope = X.table(spark, sf, "customer").select(F.col("c_custkey").alias("ent"))
    return assembly.review(assembly.assembled(ledger_parts(spark, sf), ledger_inputs(spark, sf)), scope)


@query("pit_9_unclassified_notices", "v_ecal v_annc", f", {TITLE_SQL}, u AS (SELECT doc, ent, {like_any(('预增', '扭亏', '续盈', '略增'))} AS up, {like_any(('预减', '首亏', '续亏', '略减', '由盈转亏'))} AS down, CASE WHEN EXISTS (SELECT 1 FROM v_ecal WHERE d = CAST(pub AS DATE)) AND strftime(pub, '%H:%M:%S') <= '15:00:00' THEN CAST(pub AS DATE) ELSE (SELECT min(d) FROM v_ecal WHERE d > CAST(pub AS DATE)) END AS available FROM v_annc JOIN t ON event_id = doc) SELECT ent, doc, available, 'NO_SINGLE_EXPLICIT_DIRECTION' AS reason FROM u WHERE up = down AND available IS NOT NULL")
def unclassified_notices(spark, sf):
    return assembly.unclassified(ledger_inputs(spark, sf)["notices"], X.event_calendar(spark, sf))


@query("pit_17_quarantine", "", "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))")
def quarantine(spark, sf):
    entries = X.table(spark, sf, "orders").where("o_orderpriority in ('1-URGENT', '2-HIGH')").select("o_orderstatus", "o_orderpriority", F.when(F.col("o_orderstatus") == "P", "ACTIVE").otherwise("RELEASED").alias("state")).distinct()
    return combine.without_quarantined(X.table(spark, sf, "orders"), entries, ["o_orderstatus", "o_orderpriority"]).select("o_orderkey", "o_orderstatus")


@query("set_1_union_by_name", "v_annc", "SELECT src, count(*) AS n, count(extra) AS with_extra FROM (SELECT 'a' AS src, doc, NULL AS extra FROM v_annc WHERE doc % 2 = 0 UNION ALL SELECT 'b', doc, cls FROM v_annc WHERE doc % 2 = 1) GROUP BY src")
def union_by_name(spark, sf):
    a = X.announcements(spark, sf)
    both = combine.evidence_union({"a": a.where("doc % 2 = 0").select("doc"), "b": a.where("doc % 2 = 1").select("doc", F.col("cls").alias("extra"))})
    return both.groupBy("src").agg(F.count("*").alias("n"), F.count("extra").alias("with_extra"))


@query("set_3_append_merge", "v_annc", "SELECT doc, CASE WHEN doc % 3 = 0 THEN 'INSERT' WHEN doc % 5 = 0 AND cls <> 'changed' THEN 'CONFLICT' ELSE 'SAME' END AS outcome FROM v_annc")
def append_merge(spark, sf):
    new = X.announcements(spark, sf).select("doc", "ent", "cls", "value")
    old = new.where("doc % 3 <> 0").withColumn("cls", F.when(F.col("doc") % 5 == 0, "changed").otherwise(F.col("cls")))
    return ledger.merge_append(old, new, "doc").select("doc", "outcome")


@query("set_8_remove_ids", "v_annc", "SELECT 'kept' AS part, count(*) AS n FROM v_annc WHERE doc % 7 <> 0 UNION ALL SELECT 'unmatched', 5")
def remove_ids(spark, sf):
    a = X.announcements(spark, sf).select("doc")
    drop = a.where("doc % 7 = 0").unionByName(spark.range(5).select((-F.col("id") - 1).alias("doc")))
    kept, unmatched = sets.remove_ids(a, drop, "doc")
    return kept.agg(F.lit("kept").alias("part"), F.count("*").alias("n")).unionByName(unmatched.agg(F.lit("unmatched").alias("part"), F.count("*").alias("n")))


@query("set_7_derived_rebuild", "v_annc", "SELECT cls, count(*) AS n FROM (SELECT cls FROM v_annc WHERE cls <> 'error' UNION ALL SELECT 'derived_negative' FROM v_annc WHERE cls = 'error' AND value > 50) GROUP BY cls")
def derived_rebuild(spark, sf):
    rows = combine.rebuilt(X.announcements(spark, sf), F.col("cls") == "error", F.col("value") > 50, "cls", "derived_negative")
    return rows.groupBy("cls").agg(F.count("*").alias("n"))
