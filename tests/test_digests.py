"""Digest trees: order-free, moved by any change, and only touched partitions are read."""

import datetime as dt

from pyspark.sql import functions as F

from cloudmarts.operators import digests, serving

SCHEMA = "org_id long, service string, usage_date date, total_cost_usd double"
KEYS = ["org_id", "service", "usage_date"]


def _rows(spark, days, cost=1.0, orgs=range(8)):
    return spark.createDataFrame([(o, s, dt.date(2024, 1, 1) + dt.timedelta(days=d), cost + o + d)
                                  for o in orgs for s in "ab" for d in days], SCHEMA)


def _load(spark, path, rows):
    return digests.upsert_digested(spark, path, rows, KEYS, n_buckets=4, period_col="usage_date")


def test_loads_in_any_order_give_the_same_tree(spark, tmp_dir):
    a, b = f"{tmp_dir}/a", f"{tmp_dir}/b"
    for days in (range(40), range(30, 70)):
        _load(spark, a, _rows(spark, days).repartition(3))
    for days in (range(50, 70), range(30, 50), range(30)):
        _load(spark, b, _rows(spark, days))
    assert digests.table_digest(digests.stored_digests(spark, a)) == digests.table_digest(digests.stored_digests(spark, b))
    assert digests.compare_tables(spark, a, b).count() == 0
    fresh = digests.partition_digests(serving.open_serving(spark, a))
    assert sorted(map(str, fresh.collect())) == sorted(map(str, digests.stored_digests(spark, a).select(fresh.columns).collect()))


def test_a_rerun_reads_touched_partitions_and_finds_a_changed_value(spark, tmp_dir):
    path, rows = f"{tmp_dir}/t", _rows(spark, range(70))
    _load(spark, path, rows)
    again = _rows(spark, [40], orgs=[3])
    assert digests.rerun_check(spark, path, again, KEYS, 4, "usage_date").count() == 0
    assert len(digests.partition_values(spark, digests.digest_path(path), "_version")) == 2
    changed = _rows(spark, [40], cost=2.0, orgs=[3])
    found = digests.rerun_check(spark, path, changed, KEYS, 4, "usage_date").collect()
    bucket = changed.select(serving.bucket_of(["org_id"], 4)).head()[0]
    assert [(str(r._period), r._bucket) for r in found] == [("2024-02-01", bucket)] and found[0].rows_a == found[0].rows_b


def test_a_change_behind_the_digests_is_named(spark, tmp_dir):
    a, b = f"{tmp_dir}/a", f"{tmp_dir}/b"
    for path in (a, b):
        _load(spark, path, _rows(spark, range(70)))
    serving.upsert_table(spark, b, _rows(spark, [5], cost=9.0, orgs=[2]), KEYS, n_buckets=4, period_col="usage_date")
    assert digests.changed_partitions(spark, a).count() == 0
    bad = digests.changed_partitions(spark, b).collect()
    assert len(bad) == 1 and str(bad[0]._period) == "2024-01-01"
    part = (bad[0]._period, bad[0]._bucket)
    assert digests.changed_partitions(spark, b, [part]).count() == 1
    assert digests.changed_partitions(spark, b, [(part[0], (part[1] + 1) % 4)]).count() == 0
    assert digests.compare_tables(spark, a, b).count() == 0  # digests alone do not know yet
    digests.record_digests(spark, b, [part])
    assert [(r._period, r._bucket) for r in digests.compare_tables(spark, a, b).collect()] == [part]


def test_lost_and_repeated_rows_move_a_digest(spark):
    rows = _rows(spark, range(3)).withColumn("_bucket", F.lit(0).cast("long"))
    whole = digests.partition_digests(rows).head().digest
    assert digests.partition_digests(rows.unionByName(rows.limit(1))).head().digest != whole
    assert digests.partition_digests(rows.limit(47)).head().digest != whole


def test_tables_without_months(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    rows = _rows(spark, [0]).drop("usage_date")
    _n, touched = digests.upsert_digested(spark, path, rows, ["org_id", "service"], n_buckets=2)
    assert digests.changed_partitions(spark, path).count() == digests.changed_partitions(spark, path, touched).count() == 0
