"""Merged batches: every row once at any step of a killed merge, few folders, later drops still right."""

import datetime as dt

import pytest

from cloudmarts.streaming import merging, onepass

SCHEMA = "event_id string, timestamp_parsed timestamp, service string, v int"
T0 = dt.datetime(2024, 5, 1)


def _batch(spark, n):
    """Three events of its own, and the last of the batch before again."""
    rows = [(f"e{n}-{i}", T0 + dt.timedelta(hours=n, minutes=i), "ab"[i % 2], i) for i in range(3)]
    rows += [(f"e{n - 1}-2", T0 + dt.timedelta(hours=n - 1, minutes=2), "a", 2)] if n else []
    return spark.createDataFrame(rows, SCHEMA)


def _ingest(spark, root, numbers):
    for n in numbers:
        onepass.ingest_batch(_batch(spark, n), n, "q", f"{root}/t", f"{root}/l")


def _rows(spark, root, outcome="event"):
    return sorted((r.event_id, r.copies) for r in onepass.outcome_rows(spark, f"{root}/t", outcome).collect())


def test_closed_batches_are_merged_by_levels(spark, tmp_dir):
    _ingest(spark, tmp_dir, range(9))
    before = _rows(spark, tmp_dir), _rows(spark, tmp_dir, "duplicate")
    merges = []
    while n := merging.merge_closed_batches(spark, f"{tmp_dir}/t", f"{tmp_dir}/l", fanout=2):
        merges.append(n)
    names = merging.batch_folders(spark, f"{tmp_dir}/t")
    live = [n for n in names if not n.startswith("merged-")]
    assert len(merges) >= 4 and "q-8" in live and any(n.startswith("merged-2-") for n in names)
    assert (_rows(spark, tmp_dir), _rows(spark, tmp_dir, "duplicate")) == before
    _ingest(spark, tmp_dir, [8, 9])  # a replay of the last batch, and the next one
    assert len(_rows(spark, tmp_dir)) == 30 and len(_rows(spark, tmp_dir, "duplicate")) == 9


@pytest.mark.parametrize("step", ["rows", "record", "clean"])
def test_a_killed_merge_shows_every_row_once(spark, tmp_dir, monkeypatch, step):
    _ingest(spark, tmp_dir, range(5))
    before, path = _rows(spark, tmp_dir), f"{tmp_dir}/t"
    real_write, real_clean, calls = merging.write_table, merging.clean, []

    def write(*a, **k):
        out = real_write(*a, **k)
        calls.append(1)
        if (step, len(calls)) in (("rows", 1), ("record", 2)):
            raise RuntimeError("killed")
        return out

    def clean(*a):
        if calls and step == "clean":
            fs, _ = merging._fs(spark, path)
            fs.delete(merging._folders(spark, path, merging.hidden_batches(spark, path)[0])[0], True)  # one folder went
            raise RuntimeError("killed")
        return real_clean(*a)

    monkeypatch.setattr(merging, "write_table", write)
    monkeypatch.setattr(merging, "clean", clean)
    with pytest.raises(RuntimeError, match="killed"):
        merging.merge_closed_batches(spark, path, f"{tmp_dir}/l", fanout=2)
    assert _rows(spark, tmp_dir) == before
    monkeypatch.setattr(merging, "write_table", real_write)
    monkeypatch.setattr(merging, "clean", real_clean)
    merging.merge_closed_batches(spark, path, f"{tmp_dir}/l", fanout=2)
    assert _rows(spark, tmp_dir) == before and not merging.hidden_batches(spark, path)
