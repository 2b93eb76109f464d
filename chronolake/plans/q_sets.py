"""Aggregation, gate, join and set-difference queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronolake.operators import combine, gates, registry, sets

from . import fixtures as X
from .registry import query


def T(spark, sf, name):
    return X.table(spark, sf, name)


@query("jn_15_dictionary_tokens", "", """
WITH dict AS (SELECT DISTINCT w AS name, hash_len AS ent FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part WHERE p_partkey % 3 = 0), LATERAL (SELECT length(w) AS hash_len)),
tok AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS name FROM part)
SELECT p_partkey, string_agg(DISTINCT name, ',' ORDER BY name) AS matched, count(DISTINCT ent) AS entities FROM tok JOIN dict USING (name) GROUP BY p_partkey""")
def dictionary_tokens(spark, sf):
    part = T(spark, sf, "part")
    words = part.where("p_partkey % 3 = 0").select(F.explode(F.split("p_name", " ")).alias("name")).distinct().withColumn("ent", F.length("name"))
    hits = registry.dictionary_matches(part.select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("；")).alias("field")), "p_partkey", "field", words)
    return hits.groupBy("p_partkey").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("matched"), F.count_distinct("ent").alias("entities"))


@query("jn_15_unmapped_rows", "", "WITH dict AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS name FROM part WHERE p_partkey % 40 = 0), tok AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS name FROM part) SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM tok JOIN dict USING (name))")
def unmapped_rows(spark, sf):
    part = T(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(";")).alias("field"))
    words = part.where("p_partkey % 40 = 0").select(F.explode(F.split("field", ";")).alias("name")).distinct().withColumn("ent", F.length("name"))
    return part.join(registry.dictionary_matches(part, "p_partkey", "field", words), "p_partkey", "left_anti").select("p_partkey")


@query("jn_18_set_reconcile", "", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right_only' WHEN b.k IS NULL THEN 'left_only' ELSE 'both' END AS side FROM (SELECT DISTINCT c_custkey AS k FROM customer) a FULL OUTER JOIN (SELECT DISTINCT o_custkey + 5 AS k FROM orders) b ON a.k = b.k")
def set_reconcile(spark, sf):
    return sets.reconcile(T(spark, sf, "customer").select(F.col("c_custkey").alias("k")), T(spark, sf, "orders").select((F.col("o_custkey") + 5).alias("k")), ["k"])


@query("jn_19_dataset_diff", "", "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'removed' WHEN o_orderkey % 7 = 0 THEN 'changed' END AS change FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 7 = 0")
def dataset_diff(spark, sf):
    old = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = old.where("o_orderkey % 11 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.lit(-1.0)).otherwise(F.col("o_totalprice")))
    return sets.diff(old, new, ["o_orderkey"])


@query("jn_21_source_applicability", "v_annc", """
, need AS (SELECT * FROM (VALUES ('click', 'all'), ('error', 'even'), ('purchase', 'odd')) t(source, scope)),
seg AS (SELECT ent, cls AS source, min(CAST(pub AS DATE)) AS s, max(CAST(pub AS DATE)) AS e FROM v_annc GROUP BY ALL)
SELECT c_custkey AS ent, n.source, coalesce(s <= DATE '2024-01-10' AND e >= DATE '2024-01-20', false) AS window_complete FROM customer JOIN need n ON scope = 'all' OR (scope = 'even') = (c_custkey % 2 = 0) LEFT JOIN seg ON seg.ent = c_custkey AND seg.source = n.source""")
def source_applicability(spark, sf):
    ent = F.col("ent") % 2
    need = combine.applicable(T(spark, sf, "customer").select(F.col("c_custkey").alias("ent")), {"click": F.lit(True), "error": ent == 0, "purchase": ent == 1})
    seg = gates.segments(X.announcements(spark, sf).withColumn("source", F.col("cls")), ["ent", "source"], F.col("pub").cast("date"))
    done = gates.spans(X.day("2024-01-10"), X.day("2024-01-20"))
    return need.join(seg, ["ent", "source"], "left").select("ent", "source", done.alias("window_complete"))


@query("jn_24_coverage_merge", "", "SELECT c_custkey, coalesce(o.n, 0) AS one, coalesce(e.n, 0) AS two, coalesce(o.n, 0) + coalesce(e.n, 0) AS total FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o_custkey = c_custkey LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) e ON user_id = c_custkey")
def coverage_merge(spark, sf):
    sources = {"one": T(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), "two": T(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))}
    return combine.merged_coverage(T(spark, sf, "customer"), "c_custkey", sources)


@query("ag_1_snapshot_merge", "", "SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments, min(c_name) AS first_name, count(*) AS n FROM customer GROUP BY 1")
def snapshot_merge(spark, sf):
    merged = gates.merged_snapshots(T(spark, sf, "customer"), "c_nationkey", "c_mktsegment", "c_name")
    return merged.select("c_nationkey", F.col("tags").alias("segments"), F.col("c_name").alias("first_name"), "n")


@query("ag_9_key_conflicts", "", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(DISTINCT (l_partkey, l_suppkey)) AS variants FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT (l_partkey, l_suppkey)) > 1")
def key_conflicts(spark, sf):
    return sets.conflicts(T(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query("ag_12_distribution", "", "SELECT event_type, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS band, count(*) AS n, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day FROM events GROUP BY ROLLUP (event_type, band)")
def distribution(spark, sf):
    e = T(spark, sf, "events").withColumn("band", F.when(F.col("value") > 50, "high").otherwise("low"))
    return gates.distribution(e, ["event_type", "band"], F.col("ts").cast("date"))


@query("ag_16_readiness_lattice", "", """
WITH st AS (SELECT event_type AS input, CASE WHEN count(*) % 3 = 0 THEN 'QUALIFIED' WHEN count(*) % 3 = 1 THEN 'PARTIAL' ELSE 'MISSING' END AS state FROM events GROUP BY 1),
need AS (SELECT input, 'all' AS item FROM st UNION ALL SELECT input, 'first' FROM st WHERE input < 'm')
SELECT item, ['MISSING', 'PARTIAL', 'QUALIFIED'][min(CASE state WHEN 'MISSING' THEN 1 WHEN 'PARTIAL' THEN 2 ELSE 3 END)] AS state FROM need JOIN st USING (input) GROUP BY item""")
def readiness_lattice(spark, sf):
    n = T(spark, sf, "events").groupBy(F.col("event_type").alias("input")).agg((F.count("*") % 3).alias("k"))
    st = n.select("input", F.when(F.col("k") == 0, "QUALIFIED").when(F.col("k") == 1, "PARTIAL").otherwise("MISSING").alias("state"))
    need = st.select("input", F.lit("all").alias("item")).unionByName(st.where("input < 'm'").select("input", F.lit("first").alias("item")))
    return registry.worst_state(need.join(st, "input"), "item", "state", ["MISSING", "PARTIAL", "QUALIFIED"])


@query("ag_17_stage_blockers", "", "SELECT s_nationkey, concat_ws(',', CASE WHEN count(*) < 4 THEN 'TOO_FEW' END, CASE WHEN min(s_acctbal) < -900 THEN 'BALANCE_LOW' END, CASE WHEN max(s_acctbal) < 9000 THEN 'BALANCE_CAP' END) AS blockers FROM supplier GROUP BY 1")
def stage_blockers(spark, sf):
    rules = {"TOO_FEW": F.count("*") < 4, "BALANCE_LOW": F.min("s_acctbal") < -900, "BALANCE_CAP": F.max("s_acctbal") < 9000}
    return gates.blockers(T(spark, sf, "supplier"), "s_nationkey", rules)


@query("ag_18_shard_accounting", "", "SELECT sym, count(DISTINCT shard) AS shards, CASE WHEN count(DISTINCT shard) > 1 THEN 'IN_TWO_SHARDS' WHEN min(shard) IS NULL THEN 'LOST' ELSE 'OK' END AS state FROM (SELECT c.c_custkey AS sym, s.shard FROM customer c LEFT JOIN (SELECT o_custkey AS sym, o_custkey % 8 AS shard FROM orders UNION ALL SELECT o_custkey, o_custkey % 8 + 1 FROM orders WHERE o_custkey % 50 = 0) s ON s.sym = c.c_custkey) GROUP BY sym")
def shard_accounting(spark, sf):
    o = T(spark, sf, "orders").select(F.col("o_custkey").alias("sym"), (F.col("o_custkey") % 8).alias("shard"))
    shards = o.unionByName(o.where("sym % 50 = 0").withColumn("shard", F.col("shard") + 1))
    return registry.shard_states(T(spark, sf, "customer").select(F.col("c_custkey").alias("sym")), shards, "sym", "shard")


@query("ag_19_entity_readiness", "", "SELECT c_custkey AS ent, coalesce(n, 0) AS receipts, CASE WHEN n IS NULL THEN 'MISSING' ELSE 'READY' END AS state, coalesce(urgent, 0) AS urgent FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) ON o_custkey = c_custkey")
def entity_readiness(spark, sf):
    receipts = T(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_custkey").alias("ent"), "o_orderpriority")
    return gates.entity_readiness(T(spark, sf, "customer").select(F.col("c_custkey").alias("ent")), receipts, "ent", {"urgent": F.col("o_orderpriority") == "1-URGENT"})


@query("ag_20_window_complete", "v_annc", ", seg AS (SELECT ent, cls, min(CAST(pub AS DATE)) <= DATE '2024-01-12' AND max(CAST(pub AS DATE)) >= DATE '2024-01-18' AS done FROM v_annc GROUP BY ALL) SELECT ent, count(*) FILTER (cls IN ('click', 'error') AND done) = 2 AS complete FROM seg GROUP BY ent")
def window_complete(spark, sf):
    seg = gates.segments(X.announcements(spark, sf), ["ent", "cls"], F.col("pub").cast("date"))
    return gates.window_complete(seg, "ent", "cls", X.day("2024-01-12"), X.day("2024-01-18"), ["click", "error"])


@query("ag_21_interval_evidence", "v_member", "SELECT count(*) AS candidates, count(n) AS with_intervals, count(*) FILTER (n IS NULL) AS without_intervals, coalesce(sum(n), 0)::BIGINT AS interval_rows FROM (SELECT DISTINCT l_suppkey + 20 AS sym FROM lineitem) c LEFT JOIN (SELECT sym, count(*) AS n FROM v_member GROUP BY 1) m USING (sym)")
def interval_evidence(spark, sf):
    candidates = T(spark, sf, "lineitem").select((F.col("l_suppkey") + 20).alias("sym"))
    return gates.interval_evidence(candidates, X.member(spark, sf), "sym")


@query("ag_25_source_probe", "", "SELECT event_type, count(*) AS n, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day, count(DISTINCT user_id) AS codes FROM events GROUP BY 1")
def source_probe(spark, sf):
    return gates.probe_profile(T(spark, sf, "events"), "event_type", F.col("ts").cast("date"), "user_id")


@query("ag_26_bundle_audit", "v_bars", "SELECT 'PRICE_WITHOUT_STATUS' AS rule, count(*) AS n FROM v_bars WHERE sym NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 6 <> 0) UNION ALL SELECT 'STATUS_WITHOUT_PRICE', count(*) FROM supplier WHERE s_suppkey % 6 <> 0 AND s_suppkey NOT IN (SELECT sym FROM v_bars WHERE d > DATE '2001-09-01')")
def bundle_audit(spark, sf):
    b = X.bars(spark, sf)
    status = T(spark, sf, "supplier").where("s_suppkey % 6 <> 0").select(F.col("s_suppkey").alias("sym"))
    return gates.orphans(b, status, "sym", ("PRICE_WITHOUT_STATUS", "STATUS_WITHOUT_PRICE"), b.where(F.col("d") > X.day("2001-09-01")))


@query("ag_26_bundle_faults", "v_bars", """, m AS (SELECT s_suppkey AS sym FROM supplier WHERE s_suppkey % 6 <> 0), b AS (SELECT DISTINCT sym FROM v_bars WHERE d > DATE '1998-08-01'), st AS (SELECT DISTINCT sym FROM v_bars WHERE vol > 95)
SELECT * FROM (SELECT 'STATUS_COLUMNS' AS rule, 1::BIGINT AS n UNION ALL SELECT 'PRICE_OUTSIDE_METADATA', count(*) FROM b WHERE sym NOT IN (FROM m) UNION ALL SELECT 'PRICE_COVERAGE', CASE WHEN count(b.sym) < 0.999 * count(*) THEN count(*) - count(b.sym) ELSE 0 END FROM m LEFT JOIN b USING (sym)
  UNION ALL SELECT 'SYMBOL_WITHOUT_STATUS', count(*) FROM m WHERE sym NOT IN (FROM st) UNION ALL SELECT 'STATUS_OUTSIDE_METADATA', count(*) FROM st WHERE sym NOT IN (FROM m)) WHERE n > 0""")
def bundle_faults(spark, sf):
    """Metadata without a sixth of the symbols, recent prices, and a status for busy symbols only, with a column too many."""
    b = X.bars(spark, sf)
    metadata = T(spark, sf, "supplier").where("s_suppkey % 6 <> 0").select(F.col("s_suppkey").alias("sym"))
    status = b.where("vol > 95").select("sym", "vol")
    columns = {"metadata": ["sym"], "prices": ["sym", "d", "px"], "status": ["sym"]}
    return gates.bundle_faults(metadata, b.where(F.col("d") > X.day("1998-08-01")).select("sym", "d", "px"), status, "sym", columns, 0.999)


@query("ag_27_fact_bundle", "v_facts", "SELECT ft, count(*) AS facts, count(DISTINCT ent) AS entities, count(*) FILTER (ver = 'P') AS provisional FROM (SELECT *, row_number() OVER (PARTITION BY ent, pe, ft ORDER BY av DESC, ver DESC) AS rn FROM v_facts) WHERE rn = 1 GROUP BY ft")
def fact_bundle(spark, sf):
    from chronolake.operators.contracts import keep_last

    last = keep_last(X.facts(spark, sf), ["ent", "pe", "ft"], [F.col("av").desc(), F.col("ver").desc()])
    return last.groupBy("ft").agg(F.count("*").alias("facts"), F.count_distinct("ent").alias("entities"), F.count_if(F.col("ver") == "P").alias("provisional"))


@query("ag_28_reference_validation", "", "SELECT p_name, count(*) AS n, 'NAME_TWICE' AS rule FROM part GROUP BY p_name HAVING count(*) > 1 UNION ALL SELECT p_name, 1, 'BASIS_UNKNOWN' FROM part WHERE p_size > 48")
def reference_validation(spark, sf):
    return gates.reference_faults(T(spark, sf, "part"), "p_name", {"BASIS_UNKNOWN": F.col("p_size") > 48}, "NAME_TWICE")


@query("set_4_replace_partition", "v_bars", "SELECT sym, d, CASE WHEN vol > 40 AND d >= DATE '1998-01-01' AND d < DATE '1998-02-01' THEN -1 ELSE px END AS px FROM v_bars")
def replace_partition(spark, sf):
    b = X.bars(spark, sf)
    fresh = b.where((F.col("vol") > 40) & (F.col("d") >= X.day("1998-01-01")) & (F.col("d") < X.day("1998-02-01"))).select("sym", "d", F.lit(-1.0).alias("px"))
    return sets.replace_part(b.select("sym", "d", "px"), fresh, ["sym", "d"])


@query("set_6_set_differences", "v_bars", "SELECT period, sym, side FROM (SELECT coalesce(a.period, b.period) AS period, coalesce(a.sym, b.sym) AS sym, CASE WHEN a.sym IS NULL THEN 'right_only' WHEN b.sym IS NULL THEN 'left_only' ELSE 'both' END AS side FROM (SELECT DISTINCT date_trunc('quarter', d)::DATE AS period, sym FROM v_bars WHERE vol > 60) a FULL OUTER JOIN (SELECT DISTINCT date_trunc('quarter', d)::DATE AS period, sym FROM v_bars WHERE px > 70000) b ON a.period = b.period AND a.sym = b.sym) WHERE side <> 'both'")
def set_differences(spark, sf):
    b = X.bars(spark, sf).withColumn("period", F.trunc("d", "QUARTER"))
    return sets.reconcile(b.where("vol > 60"), b.where("px > 70000"), ["period", "sym"]).where("side <> 'both'")
