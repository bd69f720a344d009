"""Writers: observed counts, dynamic overwrite of one partition, partition types."""

from pyspark.sql import functions as F

from cloudmarts.sinks import read_table, write_observed, write_table


def test_observed_counts_and_dynamic_overwrite(spark, tmp_dir):
    path = tmp_dir + "/t"
    df = spark.createDataFrame([("01", 1), ("01", 2), ("02", 3)], "day string, v int")
    got = write_observed(df, path, {"v_sum": F.sum("v")}, ["day"])
    assert got == {"rows": 3, "v_sum": 6}
    # rewrite day 01 only; day 02 must survive
    assert write_table(spark.createDataFrame([("01", 9)], "day string, v int"), path, ["day"],
                       dynamic=True) == 1
    back = read_table(spark, path, df.schema)
    assert sorted((r.day, r.v) for r in back.collect()) == [("01", 9), ("02", 3)]


def test_partition_types_pinned_by_schema(spark, tmp_dir):
    path = tmp_dir + "/t"
    df = spark.createDataFrame([("01", 1)], "day string, v int")
    write_table(df, path, ["day"])
    assert dict(spark.read.parquet(path).dtypes)["day"] == "int"      # re-inferred
    assert dict(read_table(spark, path, df.schema).dtypes)["day"] == "string"
    assert read_table(spark, path, df.schema).first().day == "01"


def test_whole_overwrite_ignores_the_session_mode(spark, tmp_dir):
    path = tmp_dir + "/t"
    write_table(spark.createDataFrame([("a", 1), ("b", 2)], "day string, v int"), path, ["day"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(spark.createDataFrame([("a", 9)], "day string, v int"), path, ["day"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [(r.day, r.v) for r in spark.read.parquet(path).collect()] == [("a", 9)]


def test_a_failing_read_is_not_a_missing_table(spark, tmp_dir):
    import os

    import pytest

    from cloudmarts.sinks import try_read_table
    assert try_read_table(spark, tmp_dir + "/none") is None
    os.makedirs(tmp_dir + "/broken")
    with open(tmp_dir + "/broken/part.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        try_read_table(spark, tmp_dir + "/broken").collect()


def test_upsert_on_a_shared_default_file_system(spark, tmp_dir):
    """A path without a scheme belongs to the default file system, not to the driver's disk."""
    import os

    from cloudmarts.operators import serving
    os.makedirs(tmp_dir + "/store")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.shared.link./lake", f"file://{tmp_dir.removeprefix('file:')}/store")
    conf.set("fs.defaultFS", "viewfs://shared/")
    try:
        rows = spark.createDataFrame([(f"o{i}", float(i)) for i in range(5)], "org_id string, v double")
        serving.upsert_table(spark, "/lake/t", rows, ["org_id"], n_buckets=4)
        serving.upsert_table(spark, "/lake/t", rows.filter("org_id = 'o1'"), ["org_id"], n_buckets=4)
        assert serving.read_serving(spark, "/lake/t").count() == 5
    finally:
        conf.set("fs.defaultFS", before or "file:///")
