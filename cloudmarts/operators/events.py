"""Silver usage events: enrichment, features, fences, quality tags."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.features import usage_date, usage_feature_columns
from ..functions.rules import Rule, usage_rules
from .anomaly import fences, flag_anomalies
from .joins import enrich
from .quality import tag_quality


def usage_features(df: DataFrame) -> DataFrame:
    """E1-E7 in a single projection."""
    cols = usage_feature_columns()
    cols["usage_date"] = usage_date()
    return df.withColumns(cols)


def silver_usage(events: DataFrame, orgs: DataFrame, resources: DataFrame,
                 rules: list[Rule] | None = None) -> DataFrame:
    """All events, enriched, with features, fences, anomaly flag and quality tags.

    Quartiles are taken over every event, including those later quarantined
    (parity with the source pipeline), from service and cost alone: the dimensions are
    joined once, on the way to the result.  Route with ``quality.valid_rows`` /
    ``quality.quarantined_rows`` or write once with ``sinks.write_partitioned``.
    """
    cost = usage_feature_columns()["daily_cost_usd"].alias("daily_cost_usd")
    bounds = fences(events.select("service", cost))
    flagged = flag_anomalies(usage_features(enrich(events, orgs, resources)), bounds=bounds)
    return tag_quality(flagged, rules or usage_rules())
