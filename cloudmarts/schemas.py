"""Declared schemas of the landing inputs and serving tables.

Fixed values: column names and types below must equal the source system's
landing contract (CSV masters and the JSON usage-event feed), so that files
written for it are read by this library unchanged.  Ids are declared non-null
but a CSV read does not enforce that (see ``sources.landing``).
"""

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, LongType, StringType, StructField, StructType,
    TimestampType,
)


def _s(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# --- fixed values: landing schemas --------------------------------------------
ORGS = _s(
    ("org_id", StringType(), False),
    ("org_name", StringType(), True),
    ("industry", StringType(), True),
    ("hq_region", StringType(), True),
    ("plan_tier", StringType(), True),
    ("is_enterprise", BooleanType(), True),
    ("signup_date", DateType(), True),
    ("sales_rep", StringType(), True),
    ("lifecycle_stage", StringType(), True),
    ("marketing_source", StringType(), True),
    ("nps_score", DoubleType(), True),
)

USERS = _s(
    ("user_id", StringType(), False),
    ("org_id", StringType(), True),
    ("email", StringType(), True),
    ("role", StringType(), True),
    ("active", BooleanType(), True),
    ("created_at", TimestampType(), True),
    ("last_login", TimestampType(), True),
)

RESOURCES = _s(
    ("resource_id", StringType(), False),
    ("org_id", StringType(), True),
    ("service", StringType(), True),
    ("region", StringType(), True),
    ("created_at", TimestampType(), True),
    ("state", StringType(), True),
    ("tags_json", StringType(), True),
)

BILLING = _s(
    ("invoice_id", StringType(), False),
    ("org_id", StringType(), True),
    ("month", DateType(), True),
    ("subtotal", DoubleType(), True),
    ("credits", DoubleType(), True),
    ("taxes", DoubleType(), True),
    ("currency", StringType(), True),
    ("exchange_rate_to_usd", DoubleType(), True),
)

TICKETS = _s(
    ("ticket_id", StringType(), False),
    ("org_id", StringType(), True),
    ("category", StringType(), True),
    ("severity", StringType(), True),
    ("created_at", DateType(), True),
    ("resolved_at", DateType(), True),
    ("csat", DoubleType(), True),
    ("sla_breached", BooleanType(), True),
)

NPS = _s(
    ("org_id", StringType(), False),
    ("survey_date", DateType(), True),
    ("nps_score", DoubleType(), True),
    ("comment", StringType(), True),
)

MARKETING = _s(
    ("touch_id", StringType(), False),
    ("org_id", StringType(), True),
    ("campaign", StringType(), True),
    ("channel", StringType(), True),
    ("timestamp", TimestampType(), True),
    ("clicked", BooleanType(), True),
    ("converted", BooleanType(), True),
)

USAGE_EVENT = _s(
    ("event_id", StringType(), True),
    ("timestamp", StringType(), True),
    ("org_id", StringType(), True),
    ("resource_id", StringType(), True),
    ("service", StringType(), True),
    ("region", StringType(), True),
    ("metric", StringType(), True),
    ("value", DoubleType(), True),
    ("unit", StringType(), True),
    ("cost_usd_increment", DoubleType(), True),
    ("schema_version", LongType(), True),
    ("carbon_kg", DoubleType(), True),
    ("genai_tokens", LongType(), True),
)
# --- end of fixed values -------------------------------------------------------

# Landing inputs: (schema, dedup key, bronze partition column or None).
LANDING = {
    "customers_orgs": (ORGS, ["org_id"], "hq_region"),
    "users": (USERS, ["user_id"], "role"),
    "resources": (RESOURCES, ["resource_id"], "service"),
    "billing_monthly": (BILLING, ["invoice_id"], "currency"),
    "support_tickets": (TICKETS, ["ticket_id"], "category"),
    "nps_surveys": (NPS, ["org_id", "survey_date"], None),
    "marketing_touches": (MARKETING, ["touch_id"], "channel"),
}

# fixed values: the landing folder of the usage events and its files
EVENTS_FOLDER = "usage_events_stream"
EVENTS_GLOB = "*.jsonl"

# Masters with free-text cells that may hold line breaks: parsed multi-line (such a
# file is read by one task, so only where the content needs it).
MULTILINE_MASTERS = {"nps_surveys"}

# Serving tables: key columns, clustering order (column, descending?) and the DATE key
# that adds a month partition in front of the bucket (None: buckets only).  Only the
# daily usage table is refreshed incrementally (stream, recent days); tickets and
# revenue are loaded whole, so a month layout would only multiply their partitions.
SERVING = {
    "org_daily_usage_by_service": {
        "keys": ["org_id", "service", "usage_date"],
        "order": [("service", False), ("usage_date", True)],
        "period": "usage_date",
    },
    "tickets_by_org_date": {
        "keys": ["org_id", "ticket_date"],
        "order": [("ticket_date", True)],
        "period": None,
    },
    "revenue_by_org_month": {
        "keys": ["org_id", "month"],
        "order": [("month", True)],
        "period": None,
    },
    "org_profile_analytics": {
        "keys": ["org_id"],
        "order": [],
        "period": None,
    },
}
