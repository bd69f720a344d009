"""End-to-end plan on landing files derived from the smallest test tables:
conservation between zones and an idempotent serving rerun."""

import os

from pyspark.sql import functions as F

from cloudmarts.operators import serving
from cloudmarts.plans import medallion as md
from cloudmarts.session import LITTLE_DISK
from cloudmarts.sources import testmap as tm

from conftest import SF_SMALL


def test_pipeline_conserves_rows_and_money(spark, tmp_dir):
    lake = md.Lake(tmp_dir + "/lake")
    tm.write_landing(spark, SF_SMALL, f"{lake.root}/landing", event_files=3)
    report = md.run(spark, lake, events_glob="*.json")
    read = spark.read.parquet

    bronze_events = read(lake.zone("bronze", "usage_events")).count()
    assert report["bronze_usage"]["landed"] == report["bronze_usage"]["event"] == bronze_events
    valid = md.silver_valid(spark, lake).count()
    quarantined = md.silver_quarantine(spark, lake).count()
    # every deduplicated bronze event lands in exactly one silver output
    assert valid + quarantined == bronze_events == report["silver"]["usage_events"]
    assert (valid, quarantined) == (932, 68)   # SURVEY 7.3 at sf0.001 (52 strict + 16 unknown)
    s = report["silver"]
    assert (s["route_valid"], s["route_quarantine"], s["route_unknown"]) == (932, 52, 16)
    assert s["anomalies_valid"] == 32   # SURVEY 7.3: 32 valid anomalies at sf0.001
    assert s["rule_unit_missing"] > 0 and s["rule_event_id_missing"] > 0

    # M5 reads silver through the status partition and the pushed-down flag
    from cloudmarts.operators import marts
    plan = marts.cost_anomalies(md.silver_valid(spark, lake))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "(dq_status#" in plan and "EqualTo(anomaly_flag,true)" in plan

    # gold daily cost equals silver cost within rounding
    silver_cost = md.silver_valid(spark, lake).agg(F.sum("daily_cost_usd")).first()[0]
    gold_cost = read(lake.zone("gold", "org_daily_usage_by_service")).agg(
        F.sum("total_cost_usd")).first()[0]
    assert abs(silver_cost - gold_cost) < 1e-4 * report["gold"]["org_daily_usage_by_service"]
    assert report["gold"]["org_daily_usage_by_service"] == 754

    # rerun of the whole chain on the same lake: the stream resumes from its checkpoint
    # (no new file, nothing appended), zones are rewritten, serving is upserted again
    name = "org_daily_usage_by_service"
    path = lake.zone("serving", name)
    before = sorted(serving.read_serving(spark, path).collect())
    again = md.run(spark, lake, events_glob="*.json")
    assert read(lake.zone("bronze", "usage_events")).count() == bronze_events
    assert again["gold"] == report["gold"]
    after = serving.read_serving(spark, path)
    assert sorted(after.collect()) == before
    assert serving.duplicate_keys(after, ["org_id", "service", "usage_date"]).count() == 0

    # no master row was lost to the CSV round trip
    assert all(v == 0 for k, v in report["bronze"].items() if k.endswith("_corrupt"))



def test_demo_queries_and_idempotency_check(spark, tmp_dir):
    lake = md.Lake(tmp_dir + "/lake")
    tm.write_landing(spark, SF_SMALL, f"{lake.root}/landing", event_files=2)
    md.run(spark, lake, events_glob="*.json")
    rng = dict(usage_range=("2024-01-01", "2024-01-31"), top_range=("2024-01-10", "2024-01-25"),
               ticket_range=("1995-01-01", "2001-12-31"))
    sample = md.demo_queries(spark, lake, **rng)
    org = sample["daily_range"].first().org_id
    point = md.demo_queries(spark, lake, org_id=org, **rng)
    # the sample-key flow and a point read of the same org agree
    for name in ("top_services", "revenue", "profile"):
        a = sorted(map(tuple, sample[name].drop("service_accumulated_costs").collect()))
        b = sorted(map(tuple, point[name].drop("service_accumulated_costs").collect()))
        assert a == b and a, name
    assert sample["daily_range"].count() <= 10
    # one (org, service), from one bucket, also when only the org is given
    for shown in (sample, point):
        assert shown["daily_range"].select("org_id", "service").distinct().count() == 1
        plan = shown["daily_range"]._jdf.queryExecution().executedPlan().toString()
        assert "_bucket" in plan and "_period" in plan
    report = md.idempotency_check(spark, lake)
    assert len(report) == 4
    for r in report:
        assert r["rows_before"] == r["rows_after"] > 0 and r["keys_unique"] and r["content_equal"], r


def test_silver_without_redup_gives_the_same_marts(spark, tmp_dir):
    lake = md.Lake(tmp_dir + "/lake")
    tm.write_landing(spark, SF_SMALL, f"{lake.root}/landing", event_files=2)
    md.bronze_masters(spark, lake)
    md.bronze_usage(spark, lake, events_glob="*.json")
    with_redup = md.silver(spark, lake, redup=True)
    without = md.silver(spark, lake, redup=False)
    assert with_redup == without


def test_other_files_of_the_landing_folder_are_not_events(spark, tmp_dir):
    lake = md.Lake(tmp_dir + "/lake")
    folder = lake.landing("usage_events_stream")
    spark.createDataFrame([('{"event_id": "e1", "timestamp": "2024-01-01 00:00:00", "service": "01"}',),
                           ('{"event_id": "cut of', )], "value string").coalesce(1).write.text(folder)
    import glob
    import os
    local = folder.removeprefix("file:")
    os.rename(glob.glob(local + "/*.txt")[0], local + "/events.jsonl")
    with open(local + "/notes.md", "w") as f:
        f.write("not an event\n")
    counts = md.bronze_usage(spark, lake)
    rows = md.bronze_events(spark, lake).collect()
    assert [(r["event_id"], r["service"]) for r in rows] == [("e1", "01")]   # T17: not the number 1
    side = md.usage_side(spark, lake).collect()
    assert [(r["outcome"], r["_corrupt"]) for r in side] == [("malformed", '{"event_id": "cut of')]
    assert counts == {"event": 1, "duplicate": 0, "late": 0, "untimed": 0, "malformed": 1, "landed": 2}


def test_incremental_masters_hold_the_same_rows(spark, tmp_dir):
    whole, parts = md.Lake(tmp_dir + "/whole"), md.Lake(tmp_dir + "/parts")
    for lake in (whole, parts):
        tm.write_landing(spark, SF_SMALL, f"{lake.root}/landing", event_files=1)
    names = ["users", "support_tickets"]
    full = md.bronze_masters(spark, whole, names)
    assert md.bronze_masters(spark, parts, names, incremental=True) == full
    assert set(md.bronze_masters(spark, parts, names, incremental=True).values()) == {0}  # nothing new
    for name in names:
        columns = [c for c in md.read_zone(spark, whole, "bronze", name).columns if c not in ("ingest_ts", "source_file")]
        rows = [sorted(map(str, md.read_zone(spark, lake, "bronze", name).select(columns).collect())) for lake in (whole, parts)]
        assert rows[0] == rows[1]


def test_a_master_is_shuffled_once_and_its_corrupt_rows_are_kept(spark, tmp_dir, monkeypatch):
    from cloudmarts.plans import medallion
    lake = medallion.Lake(f"{tmp_dir}/lake-once")
    os.makedirs(lake.landing("users.csv"))
    with open(lake.landing("users.csv") + "/a.csv", "w") as f:
        f.write("user_id,org_id,email,role,active,created_at,last_login\n"
                "u1,o1,e,admin,true,,\nu1,o1,e,admin,true,,\nu2,o1,e,dev,false,,\nu3,short line\n")
    real, plans = medallion.write_table, []

    def write(df, path, *a, **k):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, path, *a, **k)

    monkeypatch.setattr(medallion, "write_table", write)
    assert medallion.bronze_masters(spark, lake, ["users"]) == {"users": 2, "users_corrupt": 1}
    assert plans[0].count("Exchange ") == 1 and "csv" in plans[0].lower()
    bad = spark.read.parquet(lake.zone("quarantine", "bronze_users")).collect()
    assert [r["_corrupt"] for r in bad] == ["u3,short line"]


def test_independent_steps_run_side_by_side(spark, monkeypatch):
    import threading

    from cloudmarts.plans import medallion
    met = threading.Barrier(2, timeout=60)  # breaks unless both steps are under way at once
    for step in ("bronze_masters", "bronze_usage"):
        monkeypatch.setattr(medallion, step, lambda *a, s=step, **k: {s: met.wait() >= 0})
    for step in ("silver", "gold", "serve"):
        monkeypatch.setattr(medallion, step, lambda *a, **k: {})
    report = medallion.run(spark, medallion.Lake("unused"))
    assert report == {"bronze": {"bronze_masters": True}, "bronze_usage": {"bronze_usage": True},
                      "silver": {}, "gold": {}, "serving": {}}


def test_landing_slices_are_staged_without_a_shuffle(spark, tmp_dir, monkeypatch):
    from cloudmarts import sinks
    from cloudmarts.sources import testmap
    events = spark.range(40).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, CAST(id AS INT)) AS ts", "id % 3 AS user_id",
        "'click' AS event_type", "CAST(id AS DOUBLE) AS value", "'{\"k\": 1}' AS props")
    events.write.parquet(f"{tmp_dir}/events.parquet")
    plans, write = [], sinks.write_table
    monkeypatch.setattr(sinks, "write_table", lambda df, *a, **k: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a, **k))[1])
    testmap.write_landing_events(spark, tmp_dir, f"{tmp_dir}/landing")
    assert plans and "Exchange" not in "".join(plans)
    assert spark.read.json(f"{tmp_dir}/landing").count() == 40


def test_the_chain_keeps_little_on_disk(spark):
    import glob
    import os

    from cloudmarts.plans import catalog
    from cloudmarts.session import checkpoint_root
    scratch = checkpoint_root(spark).removeprefix("file:") + "/scratch"
    before = set(glob.glob(f"{scratch}/*"))
    shuffles = _shuffle_files(spark)
    rows = catalog.QUERIES["medallion_end_to_end"](spark, SF_SMALL)
    assert _shuffle_files(spark) <= shuffles          # those of its steps went with the steps
    assert rows.count() == 754
    left = {os.path.basename(p).rsplit("-", 1)[0]: p for p in set(glob.glob(f"{scratch}/*")) - before}
    assert not left.keys() & {"landing-slices", "deduplicated-events"}
    landed = [f for f in glob.glob(f"{left['lake']}/landing/*/*") if os.path.basename(f).startswith("part-")]
    assert landed and all(f.endswith(".lz4") for f in landed)
    tables = [f for f in glob.glob(f"{left['lake']}/*/**/part-*", recursive=True) if "/landing/" not in f]
    assert tables and all(".zstd.parquet" in f for f in tables)
    for key in LITTLE_DISK:                           # the caller's settings are as before
        assert spark.conf.get(key) == {"spark.sql.parquet.compression.codec": "snappy"}.get(key, "false")


def _shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}


def test_settings_are_put_back_after_a_failure(spark):
    import pytest

    from cloudmarts.session import settings
    key = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError, match="step"), settings(spark, {key: "gzip", "cloudmarts.unset": "1"}):
        assert spark.conf.get(key) == "gzip"
        raise RuntimeError("step")
    assert spark.conf.get(key) == before and spark.conf.get("cloudmarts.unset", None) is None


def test_compressed_landing_files_hold_the_same_rows_in_bounded_files(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(tm, "COMPRESSED_ROWS", 300)
    reports = {}
    for compression, suffix in ((None, ""), ("lz4", ".lz4")):
        lake = md.Lake(f"{tmp_dir}/lake{suffix}")
        tm.write_landing(spark, SF_SMALL, f"{lake.root}/landing", event_files=2, compression=compression)
        reports[suffix] = {**md.bronze_masters(spark, lake), **md.bronze_usage(spark, lake, events_glob=f"*.json{suffix}")}
        rows = spark.read.parquet(lake.zone("bronze", "users"))
        per_file = rows.groupBy("source_file").count().agg(F.max("count")).head()[0]
        assert rows.count() > 300 and (per_file <= 300) == bool(suffix)
    assert reports[""] == reports[".lz4"]
