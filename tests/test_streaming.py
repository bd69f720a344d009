"""Bronze stream: duplicates, late rows, NULL ids and NULL times over two runs (FIXTURES)."""

import json
import os

from cloudmarts.schemas import USAGE_EVENT
from cloudmarts.sources.landing import parse_event_time
from cloudmarts.streaming.bronze import bronze_usage_stream, file_stream, rows_dropped_by_watermark


def _drop(dirpath, name, rows):
    with open(os.path.join(dirpath, name), "w") as f:
        for eid, ts in rows:
            f.write(json.dumps({"event_id": eid, "timestamp": ts, "org_id": "o", "service": "compute",
                                "metric": "requests", "value": 1.0, "unit": "u",
                                "cost_usd_increment": 0.1}) + "\n")


RUN1 = [("a", "2025-08-10 10:00:00"), ("a", "2025-08-10 10:00:00"), ("a", "2025-08-10 10:30:00"),
        ("old", "2025-07-10 10:00:00"), (None, "2025-08-10 10:00:00"), (None, "2025-08-10 10:00:00"),
        ("nt", None)]
RUN2 = [("late", "2025-08-09 10:00:00"), ("a", "2025-08-10 10:00:00"),
        ("within", "2025-08-10 09:00:00"), ("nt", None), ("nt2", None)]


def _run(spark, land, out, ckpt, null_time, side=None):
    s = parse_event_time(file_stream(spark, land, USAGE_EVENT, "json"))
    return bronze_usage_stream(s, out, ckpt, side_path=side, null_time=null_time)


def test_two_runs_keep_null_times(spark, tmp_dir):
    land, out, ckpt = (os.path.join(tmp_dir, d) for d in ("land", "out", "ckpt"))
    os.makedirs(land)
    _drop(land, "run1.jsonl", RUN1)
    _run(spark, land, out, ckpt, "keep", ckpt + "-bad")
    assert spark.read.parquet(out).count() == 5
    _drop(land, "run2.jsonl", RUN2)
    qs = _run(spark, land, out, ckpt, "keep", ckpt + "-bad")
    got = spark.read.parquet(out)
    assert got.count() == 7
    ids = sorted((r.event_id or "-") for r in got.collect())
    assert ids == ["-", "a", "a", "nt", "nt2", "old", "within"]
    assert rows_dropped_by_watermark(qs[-1]) >= 1


def test_divert_null_times(spark, tmp_dir):
    land, out, side, ckpt = (os.path.join(tmp_dir, d) for d in ("land", "out", "side", "ckpt"))
    os.makedirs(land)
    _drop(land, "run1.jsonl", RUN1)
    _run(spark, land, out, ckpt, "divert", side)
    assert spark.read.parquet(out).count() == 4
    assert spark.read.parquet(side).count() == 1


def test_within_watermark_catches_shifted_resend(spark, tmp_dir):
    from cloudmarts.streaming.bronze import dedup_events, run_available_now
    land, out, ckpt = (os.path.join(tmp_dir, d) for d in ("land", "out", "ckpt"))
    os.makedirs(land)
    _drop(land, "run1.jsonl", [("a", "2025-08-10 10:00:00"), ("a", "2025-08-10 10:00:05"),
                               ("b", "2025-08-10 10:01:00")])
    s = parse_event_time(file_stream(spark, land, USAGE_EVENT, "json"))
    run_available_now(dedup_events(s.drop("_corrupt"), within_watermark=True), out, ckpt)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_a_lost_checkpoint_fails_loudly_instead_of_hiding_new_files(spark, tmp_dir):
    import pytest
    land, out, side = (os.path.join(tmp_dir, d) for d in ("land", "out", "side"))
    os.makedirs(land)
    _drop(land, "run1.jsonl", RUN1)
    _run(spark, land, out, os.path.join(tmp_dir, "ckpt-a"), "keep", side)
    _drop(land, "run2.jsonl", [("b", "2025-08-11 10:00:00")])
    with pytest.raises(RuntimeError, match="checkpoint"):
        _run(spark, land, out, os.path.join(tmp_dir, "ckpt-b"), "keep", side)
    assert spark.read.parquet(out).count() == 5
    # with its own checkpoint the new file arrives
    _run(spark, land, out, os.path.join(tmp_dir, "ckpt-a"), "keep", side)
    assert spark.read.parquet(out).filter("event_id = 'b'").count() == 1


def test_malformed_lines_keep_their_text(spark, tmp_dir):
    land, out, side = (os.path.join(tmp_dir, d) for d in ("land", "out", "side"))
    os.makedirs(land)
    _drop(land, "run1.jsonl", RUN1)
    with open(os.path.join(land, "bad.jsonl"), "w") as f:
        f.write('{"event_id": "x", "timest\n')
    _run(spark, land, out, os.path.join(tmp_dir, "ckpt"), "divert", side)
    rows = spark.read.parquet(side).collect()
    assert sorted((r.reason, r.event_id, r._corrupt) for r in rows if r.reason == "malformed") == [
        ("malformed", None, '{"event_id": "x", "timest')]
    assert [r.event_id for r in rows if r.reason == "untimed"] == ["nt"]
    assert spark.read.parquet(out).count() == 4
