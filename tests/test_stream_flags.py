"""Flags in the stream: fences of earlier batches only, the same after a kill at any step."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cloudmarts.operators import anomaly
from cloudmarts.streaming import flags

from conftest import SF_SMALL

SCHEMA = "event_id string, service string, usage_date date, daily_cost_usd double"
DAY = dt.date(2024, 3, 1)


def _batch(spark, n, costs):
    return spark.createDataFrame([(f"{n}-{i}", "s", DAY + dt.timedelta(days=n), float(c)) for i, c in enumerate(costs)], SCHEMA)


def _flags(spark, root):
    return sorted((r.event_id, r.upper_bound, r.anomaly_flag) for r in flags.flagged_events(spark, root).collect())


def test_each_batch_meets_the_fences_of_those_before_it(spark, tmp_dir, monkeypatch):
    batches = [_batch(spark, 0, range(20)), _batch(spark, 1, [5, 500, -300]), _batch(spark, 2, [500, 5])]
    before = None
    for n, b in enumerate(batches):
        flags.flag_batch(b, n, "q", f"{tmp_dir}/a")
        bounds = None if before is None else anomaly.iqr_bounds(anomaly.group_quartiles(before)).select(
            "service", "upper_bound", "lower_bound")
        rows = flags.flagged_events(spark, f"{tmp_dir}/a").where(f"event_id LIKE '{n}-%'")
        if bounds is None:
            assert rows.where("anomaly_flag").count() == 0
        else:
            want = anomaly.flag_anomalies(b, bounds=bounds)
            assert sorted(map(tuple, rows.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
        before = b if before is None else before.unionByName(b)
    # killed after the events, then after the sketches; then run again
    for n, b in enumerate(batches):
        for step in ("write_day_sketches", "fences_after"):
            real = getattr(flags, step)

            def killed(*a, real=real, **k):
                real(*a, **k)
                raise RuntimeError("killed")

            monkeypatch.setattr(flags, step, killed)
            with pytest.raises(RuntimeError, match="killed"):
                flags.flag_batch(b, n, "q", f"{tmp_dir}/b")
            monkeypatch.setattr(flags, step, real)
        flags.flag_batch(b, n, "q", f"{tmp_dir}/b")
    assert _flags(spark, f"{tmp_dir}/a") == _flags(spark, f"{tmp_dir}/b")


def test_fences_of_the_newest_days(spark, tmp_dir):
    for n, costs in enumerate([[1000] * 30, [1, 2, 3, 4], [5, 6, 7, 8]]):
        flags.flag_batch(_batch(spark, n, costs), n, "q", tmp_dir, last_days=2)
    got = flags.fences_after(spark, f"{tmp_dir}/sketches", 4096, 2).head()
    assert (got.n, got.q1, got.q3) == (8, 2.0, 6.0)


def test_batches_without_rows_keep_the_fences(spark, tmp_dir):
    none, plain = _batch(spark, 0, [5]).limit(0), [range(20), [5, 500], [7, -300]]
    untimed = _batch(spark, 9, [400]).withColumn("usage_date", F.lit(None).cast("date"))
    for n, b in enumerate([none, untimed, _batch(spark, 0, plain[0]), none, _batch(spark, 1, plain[1]), none, _batch(spark, 2, plain[2])]):
        flags.flag_batch(b, n, "q", f"{tmp_dir}/a")
    for n, costs in enumerate(plain):
        flags.flag_batch(_batch(spark, n, costs), n, "q", f"{tmp_dir}/b")
    assert _flags(spark, f"{tmp_dir}/a") == [*_flags(spark, f"{tmp_dir}/b"), ("9-0", None, False)]


def test_exact_fences_of_more_events_than_a_sketch_holds(spark, tmp_dir):
    costs = [[(i * 7919 + n) % 10_007 / 100 for i in range(3000)] for n in range(3)]
    before = None
    for n, c in enumerate(costs):
        b = _batch(spark, n, c)
        flags.flag_batch(b, n, "q", f"{tmp_dir}/all", k=64, exact=True)
        flags.flag_batch(b, n, "q", f"{tmp_dir}/last", k=64, last_days=2, exact=True)
        before = b if before is None else before.unionByName(b)
        for kept, rows in (("all", before), ("last", before.where(f"usage_date > date'{DAY}' + {n - 2}"))):
            got = spark.read.parquet(f"{tmp_dir}/{kept}/fences/q-{n}").head()
            want = anomaly.iqr_bounds(anomaly.group_quartiles(rows)).head()
            assert got.n == rows.count() and (got.q1, got.q3, got.upper_bound) == (want.q1, want.q3, want.upper_bound)


def test_a_slice_of_several_files_is_one_batch(spark, tmp_dir):
    import __spark_entry__ as entry
    from oracle_compare import compare, duck
    for part in range(3):  # so many tasks write each slice
        spark.range(0, 3000).where(f"id % 3 = {part}").selectExpr(
            "id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, CAST(id AS INT)) AS ts", "id % 7 AS user_id",
            "IF(id % 2 = 0, 'click', 'purchase') AS event_type", "CAST((id * 7919) % 1009 AS DOUBLE) AS value",
            "'{\"k\": 1}' AS props").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/events.parquet")
    for name, source in (("part", "p_partkey bigint, p_type string"), ("customer", (
            "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double, c_nationkey int"))):
        spark.createDataFrame([], source).coalesce(1).write.parquet(f"{tmp_dir}/{name}.parquet")
    got = entry.queries()["stream_flags_by_batch"](spark, tmp_dir)
    con = duck(SF_SMALL)
    for name in ("events", "part", "customer"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{tmp_dir}/{name}.parquet/*.parquet')")
    want = con.execute(entry.oracle_sql()["stream_flags_by_batch"])
    ok, _exact, message = compare([tuple(r) for r in got.collect()], got.columns, want.fetchall(), [c[0] for c in want.description])
    assert ok, message


def test_the_first_file_may_be_empty(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/land")
    open(f"{tmp_dir}/land/part-0.json", "w").close()
    os.utime(f"{tmp_dir}/land/part-0.json", (1_700_000_000, 1_700_000_000))
    _batch(spark, 0, range(9)).write.mode("append").json(f"{tmp_dir}/land")
    events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmp_dir}/land")
    flags.flag_stream(events, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    assert flags.flagged_events(spark, f"{tmp_dir}/out").count() == 9
