"""Conformance and serving-format column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _z(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def ticket_columns() -> dict[str, Column]:
    """Q6: missing CSAT means "no answer" (0.0), missing breach flag means no breach."""
    return {
        "csat": _z("csat"),
        "sla_breached": F.coalesce(F.col("sla_breached"), F.lit(False)),
        "ticket_date": F.col("created_at"),
    }


def billing_usd_columns() -> dict[str, Column]:
    """Q7: every money column times the invoice's rate; a missing rate gives NULL."""
    rate = F.col("exchange_rate_to_usd")
    return {
        "subtotal_usd": _z("subtotal") * rate,
        "credits_usd": _z("credits") * rate,
        "taxes_usd": _z("taxes") * rate,
        "net_revenue_usd": (_z("subtotal") + _z("taxes") - _z("credits")) * rate,
    }


def nps_columns() -> dict[str, Column]:
    """Q8: missing score read as 0.0."""
    return {"nps_score": _z("nps_score")}


def date_from_text(col: str, fmt: str = "yyyy-MM-dd") -> Column:
    """string day to DATE."""
    return F.to_date(F.col(f"`{col}`"), fmt)


def number_or_zero(col: str, data_type="double") -> Column:
    """cast with a zero default for NULL (``data_type`` a name or a DataType)."""
    return F.coalesce(F.col(f"`{col}`").cast(data_type), F.lit(0).cast(data_type))


def round_map_values(col: str, scale: int = 2) -> Column:
    """round every value of a map<string,double>."""
    return F.transform_values(F.col(col), lambda _k, v: F.round(v, scale))


def as_percent(col: str, scale: int = 2) -> Column:
    """a 0..1 ratio rendered as a percentage string."""
    return F.format_string(f"%.{scale}f%%", F.col(col) * 100)
