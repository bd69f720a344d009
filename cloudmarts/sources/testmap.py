"""Domain views over the shared test tables, in Spark and as SQL text.

The test tables carry no NULLs, so missing values are derived from the keys with
the same modulo rules in both engines.  Each ``*_sql`` string is a SELECT that
DuckDB runs over views with the test-table names; the Spark function of the same
name builds the identical relation.

Mapping: org = customer; usage event = events (org = user_id, service =
event_type with 'purchase' as the GenAI service); resource = part; invoice,
ticket and user = orders; NPS comment = turns of conversations.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_if(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


# --- usage events ---------------------------------------------------------------
def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage_from_events(table(spark, sf_dir, "events"))


def usage_from_events(e: DataFrame) -> DataFrame:
    """The event mapping on any events frame, batch or streaming."""
    eid, val = F.col("event_id"), F.col("value")
    return e.select(
        _null_if(eid % 97 == 0, eid).alias("event_id"),
        F.col("ts").alias("timestamp_parsed"),
        F.col("user_id").alias("org_id"),
        (eid % 2500).alias("resource_id"),
        F.when(F.col("event_type") == "purchase", F.lit("genai"))
         .otherwise(F.col("event_type")).alias("service"),
        F.when(eid % 3 == 0, F.lit("requests")).when(eid % 3 == 1, F.lit("cpu_hours"))
         .otherwise(F.lit("storage_gb_hours")).alias("metric"),
        _null_if(eid % 11 == 0, val).alias("value"),
        _null_if(eid % 53 == 0, F.lit("u")).alias("unit"),
        F.when(eid % 61 == 0, F.lit(None)).when(eid % 41 == 0, -val).otherwise(val)
         .alias("cost_usd_increment"),
        _null_if(eid % 7 == 0, val * 0.002).alias("carbon_kg"),
        _null_if(eid % 5 == 0, F.get_json_object("props", "$.k").cast("bigint"))
         .alias("genai_tokens"),
    )


USAGE_EVENTS_SQL = """
SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id END AS event_id,
       ts AS timestamp_parsed,
       user_id AS org_id,
       event_id % 2500 AS resource_id,
       CASE WHEN event_type = 'purchase' THEN 'genai' ELSE event_type END AS service,
       CASE WHEN event_id % 3 = 0 THEN 'requests' WHEN event_id % 3 = 1 THEN 'cpu_hours'
            ELSE 'storage_gb_hours' END AS metric,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 53 = 0 THEN NULL ELSE 'u' END AS unit,
       CASE WHEN event_id % 61 = 0 THEN NULL WHEN event_id % 41 = 0 THEN -value ELSE value END
         AS cost_usd_increment,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE value * CAST(0.002 AS DOUBLE) END AS carbon_kg,
       CASE WHEN event_id % 5 = 0 THEN NULL
            ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS genai_tokens
FROM events"""


# --- organisations and resources --------------------------------------------------
def orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("org_id"),
        F.col("c_name").alias("org_name"),
        F.col("c_mktsegment").alias("plan_tier"),
        (F.col("c_acctbal") > 5000.0).alias("is_enterprise"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("nps_score"),
    )


ORGS_SQL = """
SELECT c_custkey AS org_id, c_name AS org_name, c_mktsegment AS plan_tier,
       c_acctbal > 5000.0 AS is_enterprise, c_nationkey AS nation_key, c_acctbal AS nps_score
FROM customer"""


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("resource_id"), F.col("p_type").alias("state"))


RESOURCES_SQL = "SELECT p_partkey AS resource_id, p_type AS state FROM part"


# --- orders as invoices, tickets and users ------------------------------------------
# Rates with full binary precision: money times rate never lands on an exact decimal
# half, where engines that round the decimal text and the binary value would differ.
RATES = {"USD": 1.0, "EUR": 1 / 0.93, "ARS": 1 / 713}

def billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key, cust, price = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    return o.select(
        key.alias("invoice_id"),
        cust.alias("org_id"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("month"),
        _null_if(key % 17 == 0, price).alias("subtotal"),
        _null_if(key % 4 == 0, price * 0.02).alias("credits"),
        (price * 0.21).alias("taxes"),
        F.when(cust % 3 == 0, F.lit("USD")).when(cust % 3 == 1, F.lit("EUR"))
         .otherwise(F.lit("ARS")).alias("currency"),
        F.when(cust % 3 == 0, F.lit(RATES["USD"])).when(cust % 3 == 1, F.lit(RATES["EUR"]))
         .otherwise(F.lit(RATES["ARS"])).alias("exchange_rate_to_usd"),
    )


BILLING_SQL = """
SELECT o_orderkey AS invoice_id, o_custkey AS org_id,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS subtotal,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice * CAST(0.02 AS DOUBLE) END AS credits,
       o_totalprice * CAST(0.21 AS DOUBLE) AS taxes,
       CASE WHEN o_custkey % 3 = 0 THEN 'USD' WHEN o_custkey % 3 = 1 THEN 'EUR' ELSE 'ARS' END
         AS currency,
       CASE WHEN o_custkey % 3 = 0 THEN CAST({USD!r} AS DOUBLE)
            WHEN o_custkey % 3 = 1 THEN CAST({EUR!r} AS DOUBLE)
            ELSE CAST({ARS!r} AS DOUBLE) END AS exchange_rate_to_usd
FROM orders""".format(**RATES)


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key, prio = F.col("o_orderkey"), F.col("o_orderpriority")
    return o.select(
        key.alias("ticket_id"),
        F.col("o_custkey").alias("org_id"),
        F.col("o_orderstatus").alias("category"),
        F.when(prio == "1-URGENT", F.lit("critical")).when(prio == "2-HIGH", F.lit("high"))
         .otherwise(F.lit("low")).alias("severity"),
        F.to_date("o_orderdate").alias("created_at"),
        _null_if(key % 6 == 0, (key % 6).cast("double")).alias("csat"),
        _null_if(key % 13 == 0, F.col("o_orderstatus") == "F").alias("sla_breached"),
    )


TICKETS_SQL = """
SELECT o_orderkey AS ticket_id, o_custkey AS org_id, o_orderstatus AS category,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'critical'
            WHEN o_orderpriority = '2-HIGH' THEN 'high' ELSE 'low' END AS severity,
       CAST(o_orderdate AS DATE) AS created_at,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey % 6 AS DOUBLE) END AS csat,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus = 'F' END AS sla_breached
FROM orders"""


# fixed values: role names of the source system's user table
ROLE_BY_PRIORITY = {
    "1-URGENT": "admin",
    "2-HIGH": "developer",
    "3-MEDIUM": "analyst",
    "5-LOW": "devops",
}


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    prio = F.col("o_orderpriority")
    role = F.lit(None).cast("string")
    for p, r in reversed(list(ROLE_BY_PRIORITY.items())):
        role = F.when(prio == p, F.lit(r)).otherwise(role)
    return o.select(
        F.col("o_orderkey").alias("user_id"),
        F.col("o_custkey").alias("org_id"),
        role.alias("role"),
        (F.col("o_orderstatus") != "F").alias("active"),
    )


USERS_SQL = (
    "SELECT o_orderkey AS user_id, o_custkey AS org_id, CASE "
    + " ".join(f"WHEN o_orderpriority = '{p}' THEN '{r}'" for p, r in ROLE_BY_PRIORITY.items())
    + " ELSE NULL END AS role, o_orderstatus <> 'F' AS active FROM orders"
)


def nps(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    turn = F.col("turn")
    return c.select(
        F.col("conv_id").alias("org_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), turn.cast("int")).alias("survey_date"),
        _null_if(turn % 4 == 3, ((F.col("conv_id") + turn) % 11).cast("double")).alias("nps_score"),
        F.col("text").alias("comment"),
    )


NPS_SQL = """
SELECT conv_id AS org_id,
       CAST(DATE '2024-01-01' + CAST(turn AS INTEGER) AS DATE) AS survey_date,
       CASE WHEN turn % 4 = 3 THEN NULL ELSE CAST((conv_id + turn) % 11 AS DOUBLE) END AS nps_score,
       text AS comment
FROM conversations"""


def sql_with(**ctes: str) -> str:
    """``WITH name AS (sql), ...`` prefix for oracle queries."""
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n"


def _user_created():
    """A user's sign-up time, from the key of the order it stands for."""
    return F.to_timestamp(F.lit("2022-01-01 00:00:00")) + F.make_dt_interval(mins=F.col("user_id").cast("int"))


# --- landing files (text ids, as the source system delivers them) --------------------------
def _s(col):
    return F.col(col).cast("string")


def landing_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every landing master in its declared schema, derived from the test tables."""
    from ..schemas import LANDING
    c = table(spark, sf_dir, "customer")
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    orgs_ = orgs(spark, sf_dir)
    nps_ = nps(spark, sf_dir)
    frames = {
        "customers_orgs": orgs_.join(c.select(F.col("c_custkey").alias("org_id"), "c_mktsegment"),
                                     "org_id").select(
            _s("org_id").alias("org_id"), "org_name", F.col("c_mktsegment").alias("industry"),
            F.concat(F.lit("region-"), (F.col("nation_key") % 5).cast("string")).alias("hq_region"),
            "plan_tier", "is_enterprise",
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("org_id") % 180).cast("int"))
             .alias("signup_date"),
            F.lit("rep").alias("sales_rep"), F.lit("active").alias("lifecycle_stage"),
            F.lit("organic").alias("marketing_source"), "nps_score"),
        "users": users(spark, sf_dir).select(
            _s("user_id").alias("user_id"), _s("org_id").alias("org_id"),
            F.concat(F.lit("u"), _s("user_id"), F.lit("@example.org")).alias("email"),
            "role", "active",
            _user_created().alias("created_at"),
            F.when(F.col("user_id") % 19 != 0, _user_created() + F.make_dt_interval(
                days=F.col("user_id").cast("int") % 400, secs=F.lit(5.5))).alias("last_login")),
        "resources": p.select(
            _s("p_partkey").alias("resource_id"),
            F.when(F.col("p_partkey") % 29 != 0, (F.col("p_partkey") % 150).cast("string")).alias("org_id"),
            F.col("p_brand").alias("service"), F.lit("region-0").alias("region"),
            F.when(F.col("p_partkey") % 23 != 0, F.to_timestamp(F.lit("2023-03-01 01:02:03")) + F.make_dt_interval(
                hours=F.col("p_partkey").cast("int"))).alias("created_at"), F.col("p_type").alias("state"),
            F.to_json(F.struct(F.col("p_brand").alias("brand"), F.col("p_name").alias("name")))
             .alias("tags_json")),
        "billing_monthly": billing(spark, sf_dir).select(
            _s("invoice_id").alias("invoice_id"), _s("org_id").alias("org_id"), "month", "subtotal",
            "credits", "taxes", "currency", "exchange_rate_to_usd"),
        "support_tickets": tickets(spark, sf_dir).select(
            _s("ticket_id").alias("ticket_id"), _s("org_id").alias("org_id"), "category", "severity",
            "created_at", F.when(F.col("ticket_id") % 5 != 0, F.date_add("created_at", (F.col("ticket_id") % 30).cast("int")))
            .alias("resolved_at"), "csat", "sla_breached"),
        "nps_surveys": nps_.select(_s("org_id").alias("org_id"), "survey_date", "nps_score", "comment"),
        "marketing_touches": li.select(
            F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber")).alias("touch_id"),
            _s("l_suppkey").alias("org_id"), F.concat(F.lit("c"), _s("l_partkey")).alias("campaign"),
            F.col("l_returnflag").alias("channel"), F.col("l_shipdate").cast("timestamp").alias("timestamp"),
            (F.col("l_discount") > 0.05).alias("clicked"), (F.col("l_tax") > 0.04).alias("converted")),
    }
    for name, df in frames.items():
        assert df.columns == LANDING[name][0].names, name
    return frames


#: Rows of a compressed landing file: no task can share one, so that it must stay small.
COMPRESSED_ROWS = 100_000


def _text(rows: DataFrame, compression: str | None):
    """Writer of landing text, plain or compressed (lz4: two fifths of the bytes at little cost)."""
    if compression is None:
        return rows.write
    return rows.write.option("compression", compression).option("maxRecordsPerFile", COMPRESSED_ROWS)


def write_landing(spark: SparkSession, sf_dir: str, landing_root: str, event_files: int = 4,
                  compression: str | None = None) -> None:
    """Landing CSV masters plus the usage events as JSON-lines files of ``event_files`` slices."""
    from ..schemas import EVENTS_FOLDER
    from ..session import run_concurrently

    def csv(name, df):
        (_text(df, compression).option("header", "true").option("quote", '"').option("escape", '"')
           .csv(f"{landing_root}/{name}.csv"))

    run_concurrently(spark, {
        EVENTS_FOLDER: lambda: write_landing_events(spark, sf_dir, f"{landing_root}/{EVENTS_FOLDER}", event_files,
                                                    compression),
        **{n: (lambda n=n, df=df: csv(n, df)) for n, df in landing_frames(spark, sf_dir).items()}})


def write_landing_events(spark: SparkSession, sf_dir: str, path: str, files: int = 4,
                         compression: str | None = None) -> None:
    """Usage events as JSON-lines files in the landing schema (text ids and time), one append
    per time slice, oldest first: the file source picks files in modification-time order,
    as a feed would deliver them.  ``files`` is the number of slices at any size; a slice is
    several files where several tasks write it."""
    with landing_event_slices(spark, sf_dir, files) as slices:
        for rows in slices:
            _text(rows, compression).mode("append").json(path)


@contextmanager
def landing_event_slices(spark: SparkSession, sf_dir: str, files: int = 4) -> Iterator[list[DataFrame]]:
    """The time slices of ``write_landing_events``, oldest first.

    The events are staged meanwhile, partitioned by slice where the scan left them (no shuffle: a
    slice is not one task's); each frame reads its slice only.
    """
    from ..session import scratch_path
    from ..sinks import delete_folder, write_table

    ev = usage_events(spark, sf_dir)
    landing_events = ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("timestamp_parsed", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        _s("org_id").alias("org_id"), _s("resource_id").alias("resource_id"), "service",
        F.lit("region-0").alias("region"), "metric", "value", "unit", "cost_usd_increment",
        F.lit(2).cast("bigint").alias("schema_version"), "carbon_kg", "genai_tokens")
    ts = F.col("timestamp_parsed")
    lo, hi = ev.agg(F.min(ts).cast("timestamp").cast("long"), F.max(ts).cast("timestamp").cast("long")).first()
    if lo is None:
        yield []
        return
    span = max(hi - lo + 1, 1)
    sliced = landing_events.withColumn(
        "_slice", F.floor((F.to_timestamp("timestamp").cast("long") - lo) * files / span))
    stage = scratch_path(spark, "landing-slices")
    write_table(sliced, stage, ["_slice"])
    try:
        yield [spark.read.schema(sliced.schema).parquet(stage).filter(F.col("_slice") == k).drop("_slice")
               for k in range(files)]
    finally:
        delete_folder(spark, stage)
