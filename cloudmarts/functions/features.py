"""Column expressions for usage features (one projection, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: metric names, the GenAI service name
METRIC_REQUESTS = "requests"
METRIC_CPU_HOURS = "cpu_hours"
METRIC_STORAGE = "storage_gb_hours"
SERVICE_GENAI = "genai"


def _metric_value(metric: str, default_when_null: float = 0.0) -> Column:
    value = F.col("value")
    return (F.when(F.col("metric") == metric, F.coalesce(value, F.lit(default_when_null)))
            .otherwise(F.lit(0.0)))


def usage_feature_columns() -> dict[str, Column]:
    """E1-E6.  A request event without a value counts as one request."""
    return {
        "requests": _metric_value(METRIC_REQUESTS, 1.0),
        "cpu_hours": _metric_value(METRIC_CPU_HOURS),
        "storage_gb_hours": _metric_value(METRIC_STORAGE),
        "genai_tokens_feat": F.when(
            (F.col("service") == SERVICE_GENAI) & F.col("genai_tokens").isNotNull(),
            F.col("genai_tokens")).otherwise(F.lit(0).cast("bigint")),
        "carbon_kg_feat": F.coalesce(F.col("carbon_kg"), F.lit(0.0)),
        "daily_cost_usd": F.coalesce(F.col("cost_usd_increment"), F.lit(0.0)),
    }


def usage_date(ts_col: str = "timestamp_parsed") -> Column:
    """Calendar day of the event (session time zone for TIMESTAMP, none for NTZ)."""
    return F.to_date(F.col(ts_col))
