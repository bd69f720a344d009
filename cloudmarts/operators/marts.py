"""Gold marts M1-M6 and their collection aggregates.

Every mart is a hash aggregate with a map-side partial, so a hot organisation
or service is pre-reduced on each task before the shuffle.  Collections are
bounded by construction: roles and services by their domains, comments by a
recency limit applied per task before the shuffle (WindowGroupLimit).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.conform import billing_usd_columns, nps_columns, ticket_columns
from ..functions.features import SERVICE_GENAI

DAILY_KEYS = ["org_id", "usage_date", "service"]


def _rsum(col: str, scale: int) -> Column:
    return F.round(F.sum(col), scale)


# --- M1 -------------------------------------------------------------------------
def daily_usage(silver: DataFrame) -> DataFrame:
    """M1 (A1-A4): cost, cpu and storage to 4 dp, carbon to 6 dp, requests and tokens exact."""
    return silver.groupBy(*DAILY_KEYS).agg(
        _rsum("daily_cost_usd", 4).alias("total_cost_usd"),
        F.sum("requests").alias("total_requests"),
        _rsum("cpu_hours", 4).alias("total_cpu_hours"),
        _rsum("storage_gb_hours", 4).alias("total_storage_gb_hours"),
        F.sum("genai_tokens_feat").alias("total_genai_tokens"),
        _rsum("carbon_kg_feat", 6).alias("total_carbon_kg"),
    )


# M1 as two steps, for incremental refresh: additive partial sums (unrounded) that can
# be computed per micro-batch, and the final re-sum with the mart's rounding.
_M1_PARTS = {
    "total_cost_usd": ("daily_cost_usd", 4),
    "total_requests": ("requests", None),
    "total_cpu_hours": ("cpu_hours", 4),
    "total_storage_gb_hours": ("storage_gb_hours", 4),
    "total_genai_tokens": ("genai_tokens_feat", None),
    "total_carbon_kg": ("carbon_kg_feat", 6),
}


def daily_usage_partials(silver: DataFrame) -> DataFrame:
    """Unrounded M1 sums of any subset of events (e.g. one micro-batch)."""
    return silver.groupBy(*DAILY_KEYS).agg(
        *[F.sum(src).alias(f"part_{name}") for name, (src, _s) in _M1_PARTS.items()])


def daily_usage_from_partials(partials: DataFrame) -> DataFrame:
    """M1 from partial sums of disjoint event subsets: re-sum, then round as M1 does."""
    aggs = []
    for name, (_src, scale) in _M1_PARTS.items():
        total = F.sum(f"part_{name}")
        aggs.append((F.round(total, scale) if scale is not None else total).alias(name))
    return partials.groupBy(*DAILY_KEYS).agg(*aggs)


# --- M2 -------------------------------------------------------------------------
def billing_usd(billing: DataFrame) -> DataFrame:
    """Q7 conformance."""
    return billing.withColumns(billing_usd_columns())


def revenue_by_month(billing_conformed: DataFrame) -> DataFrame:
    """M2 (A5): four 4-dp sums per (org_id, month)."""
    return billing_conformed.groupBy("org_id", "month").agg(
        _rsum("subtotal_usd", 4).alias("total_subtotal_usd"),
        _rsum("credits_usd", 4).alias("total_credits_usd"),
        _rsum("taxes_usd", 4).alias("total_taxes_usd"),
        _rsum("net_revenue_usd", 4).alias("net_revenue_usd"),
    )


# --- M3 -------------------------------------------------------------------------
def conform_tickets(tickets: DataFrame) -> DataFrame:
    """Q6 conformance."""
    return tickets.withColumns(ticket_columns())


def conform_nps(nps: DataFrame) -> DataFrame:
    """Q8 conformance."""
    return nps.withColumns(nps_columns())


def tickets_by_day(tickets_conformed: DataFrame, critical: str = "critical") -> DataFrame:
    """M3 (A6-A10): count, critical count, CSAT mean over answered tickets, breach rate."""
    answered = F.when(F.col("csat") > 0.0, F.col("csat"))
    breached = F.coalesce(F.col("sla_breached"), F.lit(False)).cast("double")
    # fixed values: the mart's column names and digits
    return tickets_conformed.groupBy("org_id", "ticket_date").agg(
        F.count("*").alias("total_tickets"),
        F.count_if(F.col("severity") == critical).alias("critical_tickets_count"),
        F.round(F.avg(answered), 2).alias("avg_csat"),
        F.round(F.avg(breached), 4).alias("sla_breach_rate"),
    )


# --- M4, M5 ---------------------------------------------------------------------
def genai_by_day(silver: DataFrame, service: str = SERVICE_GENAI) -> DataFrame:
    """M4 (A11): tokens and cost per (org_id, usage_date) for one service.

    On a table partitioned by service the filter prunes partitions.
    """
    return (silver.filter(F.col("service") == service)
                  .groupBy("org_id", "usage_date")
                  .agg(F.sum("genai_tokens_feat").alias("total_genai_tokens"),
                       _rsum("daily_cost_usd", 4).alias("total_cost_usd")))


def genai_from_daily(daily: DataFrame, service: str = SERVICE_GENAI) -> DataFrame:
    """M4 derived from M1: grouping (org, day) within one service is grouping
    (org, day, service), so the M1 rows of that service are the M4 rows -- read from
    the small mart instead of rescanning silver."""
    return (daily.filter(F.col("service") == service)
                 .select("org_id", "usage_date", "total_genai_tokens", "total_cost_usd"))


def cost_anomalies(silver: DataFrame) -> DataFrame:
    """M5 (N5): flagged valid events, five columns."""
    return (silver.filter(F.col("anomaly_flag"))
                  .select("org_id", "usage_date", "service", "daily_cost_usd", "anomaly_flag"))


# --- M6 -------------------------------------------------------------------------
def role_sets(users: DataFrame, only_active: bool = False) -> DataFrame:
    """Sorted distinct non-null roles per org (T3: ``only_active`` filters on ``active``)."""
    u = users.filter(F.col("role").isNotNull())
    if only_active:
        u = u.filter(F.col("active"))
    return u.groupBy("org_id").agg(F.array_sort(F.collect_set("role")).alias("active_user_roles"))


def recent_items(df: DataFrame, key: str, item: str, newest_first: list[Column],
                 limit: int | None, alias: str) -> DataFrame:
    """The items per key as an ordered array, newest first; all of them unless
    ``limit`` is given.

    A limit is cut per task before the shuffle.  Without one the list is as long as the
    key's rows (for surveys: one per day after deduplication).
    """
    w = Window.partitionBy(key).orderBy(*newest_first, F.col(item).asc())
    ranked = df.withColumn("_rn", F.row_number().over(w))
    if limit is not None:
        ranked = ranked.filter(F.col("_rn") <= limit)
    entries = F.array_sort(F.collect_list(F.struct(F.col("_rn"), F.col(item).alias("v"))))
    return ranked.groupBy(key).agg(F.transform(entries, lambda e: e["v"]).alias(alias))


def recent_comments(nps: DataFrame, limit: int | None = None) -> DataFrame:
    """A13 on NPS: every non-empty comment, newest survey first."""
    c = nps.filter(F.col("comment").isNotNull() & (F.col("comment") != ""))
    return recent_items(c, "org_id", "comment", [F.col("survey_date").desc()], limit,
                        "recent_nps_comments")


def service_costs(daily: DataFrame) -> DataFrame:
    """Re-sum of the (already rounded) daily costs per (org_id, service)."""
    return (daily.groupBy("org_id", "service")
                 .agg(_rsum("total_cost_usd", 4).alias("service_cost")))


def cost_maps(daily: DataFrame) -> DataFrame:
    """Map service -> cost per org.  NULL services are left out (a NULL map key
    raises); entries are sorted so the map is deterministic."""
    sc = service_costs(daily).filter(F.col("service").isNotNull())
    entries = F.array_sort(F.collect_list(F.struct("service", "service_cost")))
    return sc.groupBy("org_id").agg(F.map_from_entries(entries).alias("service_accumulated_costs"))


def org_profile(orgs: DataFrame, users: DataFrame, nps: DataFrame, daily: DataFrame,
                comment_limit: int | None = None, only_active: bool = False) -> DataFrame:
    """M6 (J4-J6): one row per org with a role set, a recent-comment list and a cost map.

    The three right sides are each aggregated by org_id, so their shuffle output is
    already partitioned for the joins; only ``orgs`` is exchanged.
    """
    base = orgs.select("org_id", "org_name", "plan_tier")
    return (base.join(role_sets(users, only_active), "org_id", "left")
                .join(recent_comments(nps, comment_limit), "org_id", "left")
                .join(cost_maps(daily), "org_id", "left"))
