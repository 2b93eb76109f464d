"""Daily price-limit semantics: special days, structural rules, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolake.functions import scalars as S

from .windows import session_rank

#: Days after listing in which a history without its listing day counts as truncated.
UNCERTAIN_DAYS = 14


def special_days(daily: DataFrame, lifecycle: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Add special_day_status and special_day_reason to daily rows (d, code, board, trading).

    lifecycle: code, listed, delisted. Later rules replace earlier ones; explicit overrides
    (d, code, status) replace all. Rows without a lifecycle are unknown.
    """
    rows = daily.join(lifecycle, "code", "left")
    rows = session_rank(rows, "code", "listed", "trading")
    star, old = F.col("board") == "STAR", F.col("listed") < F.lit(S.CHINEXT_REFORM).cast("date")
    growth = F.col("board") == "CHINEXT"
    free = (star & (F.col("listed") >= F.lit(S.STAR_FIRST_DAY).cast("date"))) | (growth & ~old)
    limit = F.date_add("listed", UNCERTAIN_DAYS)
    truncated = (star | (growth & ~old)) & (F.col("first_traded") != F.col("listed")) & (F.col("first_traded") <= limit) & F.col("d").between(F.col("first_traded"), limit)
    rules = [
        ((F.col("post_rank") == 1) & (F.col("board").isin("SSE_MAIN", "SZSE_MAIN") | (growth & old)), ("unknown", "listing_day_not_ordinary_structural_limit")),
        (free & F.col("post_rank").between(1, 5), ("no_limit", "first_five_trading_sessions_no_limit")),
        (truncated, ("unknown", "ipo_window_not_fully_observed")),
        (F.col("delisted").isNotNull() & (F.col("d") >= F.col("delisted")), ("unknown", "at_or_after_reported_out_date")),
        (F.col("d") < F.col("listed"), ("unknown", "date_before_ipo")),
        (F.col("listed").isNull(), ("unknown", "lifecycle_missing")),
        (F.col("board") == "UNKNOWN", ("unknown", "unsupported_board")),
    ]
    status, reason = F.lit("ordinary"), F.lit("outside_known_ipo_special_window")
    for rule, (state, why) in reversed(rules):
        status, reason = F.when(rule, state).otherwise(status), F.when(rule, why).otherwise(reason)
    rows = rows.withColumn("special_day_status", status).withColumn("special_day_reason", reason)
    if overrides is not None:
        rows = rows.join(overrides.select("d", "code", F.col("status").alias("__status")), ["d", "code"], "left")
        rows = rows.withColumn("special_day_reason", F.when(F.col("__status").isNotNull(), "explicit_override").otherwise(F.col("special_day_reason")))
        rows = rows.withColumn("special_day_status", F.coalesce("__status", "special_day_status")).drop("__status")
    return rows


def limit_rows(rows: DataFrame) -> DataFrame:
    """Add limit_pct, limit_eligible and limit_rule_reason to rows with d, board, is_st, trading, special_day_status."""
    rows = rows.withColumn("__rule", S.limit_rule(F.col("d"), F.col("board"), F.col("is_st")))
    rows = rows.withColumn("__state", S.limit_status(F.col("trading"), F.col("special_day_status"), F.col("__rule")))
    return rows.withColumn("limit_pct", F.col("__rule.limit_pct")).withColumn("limit_eligible", F.col("__state.limit_eligible")).withColumn("limit_rule_reason", F.col("__state.limit_rule_reason")).drop("__rule", "__state")


def daily_limit_coverage(rows: DataFrame, gate: float = 0.95) -> DataFrame:
    """Eligible and observed rows of each day, and whether the share reaches the gate."""
    out = rows.groupBy("d").agg(F.count("*").alias("n_rows"), F.count_if("limit_eligible").alias("eligible"))
    return out.withColumn("coverage", F.round(F.col("eligible") / F.col("n_rows"), 6)).withColumn("below_gate", F.col("eligible") / F.col("n_rows") < gate)
