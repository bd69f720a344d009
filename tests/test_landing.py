"""CSV ingest: declared schema, corrupt-row capture, lineage, dedup."""

import os

from cloudmarts.sources.landing import ingest_master, read_csv, split_corrupt
from cloudmarts.schemas import NPS

CSV = """org_id,survey_date,nps_score,comment
o1,2025-08-01,9,great
o1,2025-08-01,9,great
o2,2025-08-02,not-a-number,bad cell
o3,2025-08-03
o4,2025-08-04,7,"quoted, with comma"
o5,2025-08-05,8,x,extra
o6,2025-08-06,,
"""


def test_corrupt_rows_are_captured(spark, tmp_dir):
    path = os.path.join(tmp_dir, "nps_surveys.csv")
    with open(path, "w") as f:
        f.write(CSV)
    good, bad = split_corrupt(read_csv(spark, path, NPS))
    assert sorted(r.org_id for r in good.collect()) == ["o1", "o1", "o4", "o6"]
    assert sorted(r._corrupt.split(",")[0] for r in bad.collect()) == ["o2", "o3", "o5"]
    o6 = [r for r in good.collect() if r.org_id == "o6"][0]
    assert o6.nps_score is None and o6.comment is None


def test_ingest_master_dedups_and_stamps(spark, tmp_dir):
    path = os.path.join(tmp_dir, "nps_surveys.csv")
    with open(path, "w") as f:
        f.write(CSV)
    bronze, bad = ingest_master(spark, path, "nps_surveys")
    rows = bronze.collect()
    assert sorted(r.org_id for r in rows) == ["o1", "o4", "o6"]
    assert all(r.source_file.endswith("nps_surveys.csv") and r.ingest_ts is not None for r in rows)
    assert len(bad.collect()) == 3


def test_reordered_header_fails_instead_of_misloading(spark, tmp_dir):
    import pytest
    path = os.path.join(tmp_dir, "nps_surveys.csv")
    with open(path, "w") as f:
        f.write("survey_date,org_id,nps_score,comment\n2025-08-01,o1,9,great\n")
    with pytest.raises(Exception):
        read_csv(spark, path, NPS).collect()


def test_masters_are_parsed_once_unless_rows_are_corrupt(spark, tmp_dir):
    from pyspark.sql import Observation

    from cloudmarts.sources.landing import corrupt_rows
    path = os.path.join(tmp_dir, "users.csv")
    os.mkdir(path)
    head = "user_id,org_id,email,role,active,created_at,last_login\n"
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write(head + "u1,o1,e,admin,true,,\nu1,o1,e,admin,true,,\nu2,o1,e,admin,false,,\n")
    for n_bad in (0, 1):
        seen = Observation()
        good, bad = ingest_master(spark, path, "users", seen=seen)
        plan = good._jdf.queryExecution().executedPlan().toString()
        # rows go from the file split to the dedup, and the stamp is no part of its shuffle
        assert "Scan csv" in plan or "FileScan csv" in plan
        exchange = plan[plan.index("Exchange"):]
        assert "ingest_ts" not in exchange
        assert sorted(r.user_id for r in good.collect()) == ["u1", "u2"]
        rest = corrupt_rows(bad, seen)
        assert rest.dtypes == bad.dtypes and rest.count() == n_bad
        assert ("parquet" in rest._jdf.queryExecution().executedPlan().toString().lower()) == bool(n_bad)
        with open(os.path.join(path, "b.csv"), "w") as f:
            f.write(head + "u9,o9,short line\n")
