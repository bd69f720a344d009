"""Stored quantile sketches: merging, day ranges, late days, repeated batches, rank error."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from cloudmarts.operators import anomaly, sketches

DAY = dt.date(2024, 5, 1)
SCHEMA = "service string, usage_date date, daily_cost_usd double"


def _events(spark, n_days=6, per_day=700, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(s, DAY + dt.timedelta(days=d), float(v)) for s in ("a", "b") for d in range(n_days)
            for v in rng.gamma(2.0, 10.0 + d, per_day)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4), rows


def _rank(values, q):
    return np.searchsorted(np.sort(values), q, "right") / len(values)


def test_sketches_that_hold_all_values_are_exact_for_any_range(spark, tmp_dir):
    df, rows = _events(spark)
    sketches.write_day_sketches(df, f"{tmp_dir}/s", "b0", k=20_000)
    for first, last in ((0, 5), (2, 3), (5, 5)):
        lo, hi = DAY + dt.timedelta(days=first), DAY + dt.timedelta(days=last)
        got = sketches.sketch_quantiles(sketches.range_sketches(spark, f"{tmp_dir}/s", lo, hi, k=20_000),
                                        {"q1": 0.25, "q3": 0.75})
        want = anomaly.group_quartiles(df.where(F.col("usage_date").between(lo, hi)))
        assert {(r.service, r.q1, r.q3) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_rank_error_of_merged_sketches(spark, tmp_dir):
    df, rows = _events(spark)
    k = 100
    sketches.write_day_sketches(df, f"{tmp_dir}/s", "b0", k=k)
    for r in sketches.sketch_quantiles(sketches.range_sketches(spark, f"{tmp_dir}/s", k=k), {"q": 0.25, "p": 0.9}).collect():
        own = np.array([v for s, _, v in rows if s == r.service])
        assert r.n == len(own)
        assert abs(_rank(own, r.q) - 0.25) < 2 * sketches.rank_error(k)
        assert abs(_rank(own, r.p) - 0.9) < 2 * sketches.rank_error(k)


def test_repeated_batch_replaces_itself_and_a_late_day_adds(spark, tmp_dir):
    df, rows = _events(spark, n_days=2, per_day=50)
    path = f"{tmp_dir}/s"
    for _ in range(2):
        assert sketches.write_day_sketches(df, path, "b0") == 4
    late = spark.createDataFrame([("a", DAY, 1.0), (None, DAY, 1.0), ("a", None, 1.0), ("b", DAY, float("nan"))], SCHEMA)
    sketches.write_day_sketches(late, path, "b1")
    got = {r.service: r.n for r in sketches.range_sketches(spark, path, DAY, DAY).collect()}
    assert got == {"a": 51, "b": 50}


def test_range_reads_its_days_only(spark, tmp_dir):
    df, _ = _events(spark, n_days=3, per_day=5)
    sketches.write_day_sketches(df, f"{tmp_dir}/s", "b0")
    plan = sketches.range_sketches(spark, f"{tmp_dir}/s", DAY, DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(usage_date" in plan
