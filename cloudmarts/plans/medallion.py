"""End-to-end medallion plan: landing -> bronze -> silver -> gold -> serving.

Each step reads parquet written by the previous one and writes its own tables,
so a lost executor costs at most one step's recomputation and a rerun of any
step is safe: masters and marts are overwritten whole, silver is written once
partitioned by quality status, serving tables are upserted by key.  Row counts
are observed during the writes; nothing is collected to the driver.

Layout under ``root``::

    landing/<master>.csv  landing/usage_events_stream/*.jsonl      (inputs)
    bronze/<table>  bronze/usage_events (outcome=/service=/_batch=)  quarantine/bronze_<master>
    silver/usage_events (dq_status=/usage_date=/service=)  silver/support_tickets (ticket_month=)
    gold/<mart>  serving/<table>  checkpoints/<stream>
"""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from ..functions.rules import VALID, usage_rules
from ..operators import marts, serving
from ..operators.events import silver_usage
from ..operators.ingest import dedup_latest
from ..schemas import EVENTS_FOLDER, EVENTS_GLOB, LANDING, SERVING, USAGE_EVENT
from ..sinks import path_exists, read_table, staged_meanwhile, write_observed, write_partitioned, write_table
from ..session import LITTLE_DISK, run_concurrently, settings
from ..sources.landing import CORRUPT, corrupt_rows, ingest_master, parse_event_time
from ..streaming import onepass
from ..streaming.bronze import file_stream
from . import drops


@dataclass(frozen=True)
class Lake:
    root: str

    def landing(self, name: str) -> str:
        return f"{self.root}/landing/{name}"

    def zone(self, zone: str, table: str) -> str:
        return f"{self.root}/{zone}/{table}"


#: Types of the columns that zone tables are partitioned by; folder names alone would
#: turn a service "01" into the number 1.
ZONE_TYPES = {"service": StringType(), "usage_date": DateType(), "dq_status": StringType(),
              "ticket_month": DateType(),
              **{part: StringType() for _schema, _keys, part in LANDING.values() if part}}


def read_zone(spark: SparkSession, lake: Lake, zone: str, table: str) -> DataFrame:
    return read_table(spark, lake.zone(zone, table), types=ZONE_TYPES).drop(drops.DROP)


# --- bronze ------------------------------------------------------------------------------
def bronze_masters(spark: SparkSession, lake: Lake, names=None, incremental: bool = False) -> dict[str, int]:
    """Every landing master read, stamped, deduplicated
    and written (partitioned where declared); corrupt rows go to quarantine.

    ``incremental`` reads only files that have arrived since the last run (see ``drops``) and
    counts the rows they added; a lake keeps to one way for its life.
    """
    def one(name):
        if incremental:
            got = drops.ingest_drop(spark, lake.landing(f"{name}.csv"), name, lake.zone("bronze", name),
                                    lake.zone("quarantine", f"bronze_{name}"), lake.zone("bronze", f"{name}_drops"))
            return got["rows"], got["corrupt"]
        _schema, _keys, part = LANDING[name]
        seen = Observation()
        bronze, corrupt = ingest_master(spark, lake.landing(f"{name}.csv"), name,
                                        order_by=[F.col("ingest_ts").asc()], seen=seen)
        # written where the dedup's shuffle left the rows: the few values of a partition column
        # make a few files a task, which costs less than a second shuffle of every row
        n = write_table(bronze, lake.zone("bronze", name), [part] if part else None)
        return n, write_table(corrupt_rows(corrupt, seen), lake.zone("quarantine", f"bronze_{name}"))

    done = run_concurrently(spark, {name: (lambda n=name: one(n)) for name in names or LANDING})
    counts = {}
    for name, (n, bad) in done.items():
        counts[name], counts[f"{name}_corrupt"] = n, bad
    return counts


def bronze_usage(spark: SparkSession, lake: Lake, null_time: str = "divert",
                 max_files_per_trigger: int | None = None, events_glob: str = EVENTS_GLOB) -> dict[str, int]:
    """The usage-event stream, run to completion, every file read once.
    ``bronze/usage_events`` holds bronze (``outcome=event``) and, beside it, late, untimed and
    malformed rows and what the dedup left out.  Returns the input rows of each outcome."""
    raw = file_stream(spark, lake.landing(EVENTS_FOLDER), USAGE_EVENT, "json",
                      max_files_per_trigger, events_glob)
    parsed = parse_event_time(raw).withColumns({
        "ingest_ts": F.current_timestamp(), "source_file": F.col("_metadata.file_path")})
    ledger = lake.zone("bronze", "usage_events_ledger")
    onepass.ingest_usage_once(parsed, lake.zone("bronze", "usage_events"), ledger,
                              lake.zone("checkpoints", "bronze_usage_events"), null_time=null_time)
    if not path_exists(spark, ledger):  # no file has arrived yet
        return dict.fromkeys([*onepass.OUTCOMES, "landed"], 0)
    return onepass.landed_counts(spark, ledger).head().asDict()


def bronze_events(spark: SparkSession, lake: Lake) -> DataFrame:
    """The bronze usage events."""
    rows = onepass.outcome_rows(spark, lake.zone("bronze", "usage_events"), onepass.EVENT, types=ZONE_TYPES)
    return rows.drop(*onepass.LAYOUT, CORRUPT)


def usage_side(spark: SparkSession, lake: Lake) -> DataFrame:
    """Late, untimed and malformed rows, with their ``outcome``, delay and text."""
    rows = onepass.outcome_rows(spark, lake.zone("bronze", "usage_events"), onepass.LATE, onepass.UNTIMED,
                                onepass.MALFORMED, types=ZONE_TYPES)
    return rows.drop("_batch", "copies")


# --- silver ------------------------------------------------------------------------------
def silver_events(spark: SparkSession, lake: Lake, redup: bool = True) -> dict[str, int]:
    """Enriched, flagged, tagged events written once,
    partitioned by status/day/service.

    ``redup`` re-deduplicates bronze on (event_id, event time) (T16).  The stream's
    watermarked dedup and its sink log already keep bronze unique, so this is a safety
    net for re-appends that bypass them; it costs a full shuffle of all events, once (the
    result is staged for the quartiles and the write), and can be turned off when the sink
    log is trusted.
    """
    bronze = lambda t: read_zone(spark, lake, "bronze", t)
    events = bronze_events(spark, lake)
    if redup:
        unique = staged_meanwhile(dedup_latest(events, ["event_id", "timestamp_parsed"], [F.col("ingest_ts").asc()],
                                               exclude_from_tiebreak=["source_file"]), "deduplicated-events")
    else:
        unique = nullcontext(events)
    # Q5/K7: route and per-rule counts observed in the same pass that writes silver
    st = F.col("dq_status")
    metrics = {f"route_{r}": F.count_if(st == r) for r in ("valid", "quarantine", "unknown")}
    metrics.update({f"rule_{r.name}": F.count_if(F.array_contains("dq_errors", r.name))
                    for r in usage_rules()})
    metrics["anomalies_valid"] = F.count_if((st == "valid") & F.col("anomaly_flag"))
    with unique as rows:
        tagged = silver_usage(rows, bronze("customers_orgs"), bronze("resources"))
        written = write_observed(tagged, lake.zone("silver", "usage_events"), metrics,
                                 ["dq_status", "usage_date", "service"], rebalance=True)
    return {"usage_events": written.pop("rows"), **{k: int(v) for k, v in written.items()}}


def silver(spark: SparkSession, lake: Lake, redup: bool = True) -> dict[str, int]:
    """The events of ``silver_events`` and, beside them, conformed
    tickets, billing and NPS."""
    bronze = lambda t: read_zone(spark, lake, "bronze", t)

    def tickets():
        # by month, not by day: daily directories of a few rows each would be mostly file
        # overhead; ticket_date stays a column (row-group min/max skipping for day ranges)
        rows = marts.conform_tickets(bronze("support_tickets")).withColumn(
            "ticket_month", F.trunc(F.col("ticket_date"), "month"))
        return write_partitioned(rows, lake.zone("silver", "support_tickets"), ["ticket_month"], dynamic=False)

    done = run_concurrently(spark, {
        "usage_events": lambda: silver_events(spark, lake, redup),
        "support_tickets": tickets,
        "billing_monthly": lambda: write_table(marts.billing_usd(bronze("billing_monthly")),
                                               lake.zone("silver", "billing_monthly")),
        "nps_surveys": lambda: write_table(marts.conform_nps(bronze("nps_surveys")),
                                           lake.zone("silver", "nps_surveys"))})
    return {**done.pop("usage_events"), **done}


def silver_valid(spark: SparkSession, lake: Lake) -> DataFrame:
    """The valid side, read through partition pruning on ``dq_status``."""
    return read_zone(spark, lake, "silver", "usage_events").filter(F.col("dq_status") == VALID)


def silver_quarantine(spark: SparkSession, lake: Lake, on_unknown: str = "quarantine") -> DataFrame:
    """Definite failures, plus undecided rows unless ``on_unknown="drop"``."""
    routes = ["quarantine"] if on_unknown == "drop" else ["quarantine", "unknown"]
    return read_zone(spark, lake, "silver", "usage_events").filter(F.col("dq_status").isin(routes))


# --- gold --------------------------------------------------------------------------------
def gold(spark: SparkSession, lake: Lake, comment_limit: int | None = None) -> dict[str, int]:
    """M1-M6 written whole (every comment unless a limit is given)."""
    s = silver_valid(spark, lake)
    read = lambda zone, t: read_zone(spark, lake, zone, t)
    write = lambda n, df: write_table(df, lake.zone("gold", n))

    def usage():
        counts = {"org_daily_usage_by_service": write("org_daily_usage_by_service", marts.daily_usage(s))}
        # M4 from the written M1 mart: no second aggregation over silver
        genai = marts.genai_from_daily(read("gold", "org_daily_usage_by_service"))
        profile = marts.org_profile(read("bronze", "customers_orgs"), read("bronze", "users"),
                                    read("silver", "nps_surveys"),
                                    read("gold", "org_daily_usage_by_service"),
                                    comment_limit=comment_limit)
        return counts | run_concurrently(spark, {
            "genai_tokens_by_org_date": lambda: write("genai_tokens_by_org_date", genai),
            "org_profile_analytics": lambda: write("org_profile_analytics", profile)})

    out = {
        "revenue_by_org_month": marts.revenue_by_month(read("silver", "billing_monthly")),
        "tickets_by_org_date": marts.tickets_by_day(
            read("silver", "support_tickets").drop("ticket_month")),
        "cost_anomaly_mart": marts.cost_anomalies(s),
    }
    done = run_concurrently(spark, {"usage": usage, **{
        name: (lambda n=name, df=df: write(n, df)) for name, df in out.items()}})
    return {**done.pop("usage"), **done}


# --- serving -----------------------------------------------------------------------------
_VIEWS = {
    "org_daily_usage_by_service": serving.usage_serving,
    "tickets_by_org_date": serving.tickets_serving,
    "revenue_by_org_month": serving.revenue_serving,
    "org_profile_analytics": serving.profile_serving,
}


def serve(spark: SparkSession, lake: Lake, n_buckets: int = serving.DEFAULT_BUCKETS) -> dict[str, int]:
    """K4-K5: upsert every gold mart into its keyed serving table (reruns are idempotent)."""
    def one(name):
        spec = SERVING[name]
        order = [F.col(c).desc() if desc else F.col(c) for c, desc in spec["order"]]
        mart = _VIEWS[name](read_zone(spark, lake, "gold", name))
        return serving.upsert_table(spark, lake.zone("serving", name), mart, spec["keys"],
                                    n_buckets=n_buckets, order=[F.col("org_id"), *order],
                                    period_col=spec["period"])

    return run_concurrently(spark, {name: (lambda n=name: one(n)) for name in _VIEWS})


def run(spark: SparkSession, lake: Lake, null_time: str = "divert", redup: bool = True,
        max_files_per_trigger: int | None = None, events_glob: str = EVENTS_GLOB,
        n_buckets: int = serving.DEFAULT_BUCKETS, incremental_masters: bool = False) -> dict[str, dict[str, int]]:
    """The whole chain, in dependency order; steps that read nothing of each other's run side by
    side, so that the last tasks of one leave no core idle.  The disk holds the shuffles of the
    steps under way only."""
    with settings(spark, LITTLE_DISK):
        report = run_concurrently(spark, {
            "bronze": lambda: bronze_masters(spark, lake, incremental=incremental_masters),
            "bronze_usage": lambda: bronze_usage(spark, lake, null_time, max_files_per_trigger, events_glob)})
        report["silver"] = silver(spark, lake, redup)
        report["gold"] = gold(spark, lake)
        report["serving"] = serve(spark, lake, n_buckets)
    return report


# --- demo queries and idempotency check (V1-V6, S11, I1) ----------------------------------
def demo_queries(spark: SparkSession, lake: Lake, org_id=None, service=None,
                 usage_range=("2025-06-01", "2025-08-31"),
                 top_range=("2025-08-15", "2025-08-30"),
                 ticket_range=("2025-08-01", "2025-08-31")) -> dict[str, DataFrame]:
    """The six serving queries for one organisation (and, for the daily range, one of its
    services), as DataFrames.

    What is not given is taken from the sample key (S11: smallest (org_id, service), of the
    org if that is given).  That one row is fetched, so every read is a point read pruned to
    the org's bucket.
    """
    raw = {name: serving.open_serving(spark, lake.zone("serving", name)) for name in _VIEWS}
    usage = raw["org_daily_usage_by_service"]
    if org_id is None or service is None:
        key = serving.sample_key(serving.point_filter(usage, org_id=org_id, service=service)).first()
        if key is not None:
            org_id, service = key["org_id"], key["service"]
    # layout columns stay until each query's own projection, so range reads can prune months
    return {
        "daily_range": serving.newest_first(
            serving.daily_range(usage, *usage_range, org_id=org_id, service=service),
            ["org_id", "service"], "usage_date", 10),
        "top_services": serving.top_services(usage, *top_range, org_id=org_id),
        "tickets_range": serving.newest_first(
            serving.tickets_range(raw["tickets_by_org_date"], *ticket_range, org_id=org_id),
            ["org_id"], "ticket_date", 10),
        "revenue": serving.revenue_lines(raw["revenue_by_org_month"], org_id=org_id),
        "genai": serving.newest_first(serving.genai_days(usage, org_id=org_id), ["org_id"], "usage_date", 10),
        "profile": serving.drop_layout(serving.profile_view(raw["org_profile_analytics"], org_id=org_id)),
    }


def idempotency_check(spark: SparkSession, lake: Lake,
                      n_buckets: int = serving.DEFAULT_BUCKETS) -> list[dict]:
    """Serve again and compare every serving table by rows, key uniqueness and an
    order-free content hash.  Returns one small dict per table (four rows in all)."""
    def summary(name):
        df = serving.read_serving(spark, lake.zone("serving", name))
        keys = SERVING[name]["keys"]
        h = F.xxhash64(*[F.array_sort(F.map_entries(F.col(c))) if c == "service_accumulated_costs"
                         else F.col(c) for c in sorted(df.columns)]).cast("decimal(38,0)")
        row = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(*keys)).alias("k"),
                     F.sum(h).alias("h")).first()
        return row.n, row.k, row.h

    before = {name: summary(name) for name in _VIEWS}
    serve(spark, lake, n_buckets)
    report = []
    for name in _VIEWS:
        (n0, _k0, h0), (n1, k1, h1) = before[name], summary(name)
        report.append({"table": name, "rows_before": n0, "rows_after": n1,
                       "keys_unique": n1 == k1, "content_equal": h0 == h1})
    return report
