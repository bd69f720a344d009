"""Running totals: any range equals the sum over daily rows, through late days and new months."""

import datetime as dt
import random
from collections import defaultdict

from pyspark.sql import functions as F

from cloudmarts.operators import running_totals as rt
from cloudmarts.operators import serving

SCHEMA = "org_id long, service string, usage_date date, total_cost_usd double"
D0 = dt.date(2024, 1, 28)


def _rows(rng, first, n_days, n):
    return {(rng.randrange(6), rng.choice("ab"), D0 + dt.timedelta(days=first + rng.randrange(n_days))):
            round(rng.uniform(-5, 100), 4) for _ in range(n)}


def _check(spark, path, truth, ranges):
    for lo, hi in ranges:
        want = defaultdict(float)
        for (org, service, day), cost in truth.items():
            if str(lo) <= str(day) <= str(hi):
                want[org, service] += cost
        got = {(r.org_id, r.service): r.cumulative_cost_usd for r in rt.range_totals(spark, path, str(lo), str(hi)).collect()}
        assert got == {k: round(v, 4) for k, v in want.items()}, (lo, hi)


def _load(spark, daily_path, path, rows, truth):
    truth.update(rows)
    df = spark.createDataFrame([(*k, v) for k, v in rows.items()], SCHEMA)
    serving.upsert_table(spark, daily_path, df, [*rt.KEY, "usage_date"], n_buckets=3, period_col="usage_date")
    return rt.refresh_running_totals(spark, path, serving.open_serving(spark, daily_path), df, n_buckets=3)


def test_ranges_through_late_days_and_new_months(spark, tmp_dir):
    rng, truth = random.Random(4), {}
    daily, path = f"{tmp_dir}/daily", f"{tmp_dir}/totals"
    day = lambda n: D0 + dt.timedelta(days=n)
    ranges = [(day(0), day(0)), (day(-40), day(400)), (day(2), day(70)), (day(300), day(400)),
              (day(-9), day(-3)), (day(33), day(33))]
    loads = [_rows(rng, 0, 50, 60), _rows(rng, 10, 20, 8),          # late days
             _rows(rng, 50, 60, 15),                                 # new months
             {(99, "new", day(40)): 1.25, (99, "new", day(170)): 2.5},  # a new key, and months after a gap
             {(1, "a", day(-20)): 7.0}]                              # before everything
    for rows in loads:
        _load(spark, daily, path, rows, truth)
        _check(spark, path, truth, ranges)
    table = spark.read.parquet(path)
    assert table.groupBy(*rt.KEY, "as_of", "_period").count().where("count > 1").count() == 0
    whole = f"{tmp_dir}/whole"
    rt.refresh_running_totals(spark, whole, serving.open_serving(spark, daily), n_buckets=3)
    keys = [*rt.KEY, "as_of", "total", "days", "_period", "_bucket"]
    assert sorted(map(str, table.select(keys).collect())) == sorted(map(str, spark.read.parquet(whole).select(keys).collect()))


def test_a_late_day_rewrites_its_bucket_from_its_month_on(spark, tmp_dir):
    rng, truth = random.Random(1), {}
    daily, path = f"{tmp_dir}/daily", f"{tmp_dir}/totals"
    _load(spark, daily, path, _rows(rng, 0, 120, 150), truth)
    files = {f.split("/")[-1] for f in spark.read.parquet(path).inputFiles()}
    _load(spark, daily, path, {(2, "a", D0 + dt.timedelta(days=70)): 3.0}, truth)
    table = spark.read.parquet(path)
    new = table.withColumn("f", F.element_at(F.split(F.input_file_name(), "/"), -1)).where(~F.col("f").isin(list(files)))
    touched = {(str(r[0]), r[1]) for r in new.select("_period", "_bucket").distinct().collect()}
    assert len({b for _, b in touched}) == 1 and min(p for p, _ in touched) == "2024-04-01"
    _check(spark, path, truth, [(D0, D0 + dt.timedelta(days=200))])


def test_a_range_reads_two_months(spark, tmp_dir):
    truth = {}
    _load(spark, f"{tmp_dir}/d", f"{tmp_dir}/t", {(1, "a", D0 + dt.timedelta(days=30 * i)): 1.0 for i in range(12)}, truth)
    df = rt.range_totals(spark, f"{tmp_dir}/t", "2024-03-05", "2024-10-20")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_period" in plan and "PartitionFilters: [" in plan
    rows = rt.range_totals(spark, f"{tmp_dir}/t", "2024-03-05", "2024-10-20", org_id=1).collect()
    assert [r.cumulative_cost_usd for r in rows] == [float(sum("2024-03-05" <= str(k[2]) <= "2024-10-20" for k in truth))]


def test_nothing_to_total(spark, tmp_dir):
    none = spark.createDataFrame([(1, "a", None, 2.0)], SCHEMA)
    assert rt.refresh_running_totals(spark, f"{tmp_dir}/t", none) == 0
