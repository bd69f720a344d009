"""Daily refresh from a stream: several batches a day, untimed rows, a lost checkpoint."""

import json
import os

import pytest

from cloudmarts.operators import marts, serving
from cloudmarts.plans import catalog
from cloudmarts.schemas import USAGE_EVENT
from cloudmarts.sources.landing import parse_event_time
from cloudmarts.streaming.bronze import file_stream, refresh_daily_from_stream


def _drop(land, name, rows):
    os.makedirs(land, exist_ok=True)
    with open(os.path.join(land, name), "w") as f:
        for eid, ts, cost in rows:
            f.write(json.dumps({"event_id": eid, "timestamp": ts, "org_id": "o", "service": "s",
                                "metric": "requests", "unit": "u", "cost_usd_increment": cost}) + "\n")


def _refresh(spark, root, ckpt, mode, side=True):
    parsed = parse_event_time(file_stream(spark, f"{root}/land", USAGE_EVENT, "json", max_files_per_trigger=1))
    kind = (dict(build_daily=catalog._daily_from_events) if mode == "recompute" else
            dict(build_daily=catalog._daily_parts, mode="partials",
                 finish_daily=lambda p: serving.usage_serving(marts.daily_usage_from_partials(p))))
    refresh_daily_from_stream(spark, parsed, f"{root}/events", f"{root}/serving", f"{root}/{ckpt}",
                              side_path=f"{root}/side-{ckpt}" if side else None, n_buckets=4, **kind)
    return {str(r.usage_date): r.total_cost_usd for r in serving.read_serving(spark, f"{root}/serving").collect()}


@pytest.mark.parametrize("mode", ["recompute", "partials"])
def test_batches_of_one_day_add_up_and_a_lost_checkpoint_neither_doubles_nor_hides(spark, tmp_dir, mode):
    land = f"{tmp_dir}/land"
    _drop(land, "1.jsonl", [("a", "2025-08-10 10:00:00", 1.0), ("n", None, 5.0)])
    _drop(land, "2.jsonl", [("b", "2025-08-10 11:00:00", 1.0)])
    assert _refresh(spark, tmp_dir, "ckpt-a", mode) == {"2025-08-10": 2.0}
    side = spark.read.parquet(f"{tmp_dir}/side-ckpt-a").collect()
    assert [(r.reason, r.event_id) for r in side] == [("untimed", "n")]
    _drop(land, "3.jsonl", [("c", "2025-08-11 10:00:00", 4.0)])
    assert _refresh(spark, tmp_dir, "ckpt-b", mode) == {"2025-08-10": 2.0, "2025-08-11": 4.0}


def test_untimed_rows_are_refused_without_a_side_table(spark, tmp_dir):
    _drop(f"{tmp_dir}/land", "1.jsonl", [("n", None, 5.0)])
    with pytest.raises(Exception, match="side_path"):
        _refresh(spark, tmp_dir, "ckpt", "recompute", side=False)
