"""One-pass ingest: the same bronze as the engine's watermarked dedup, nothing lost, replays."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from cloudmarts.schemas import USAGE_EVENT
from cloudmarts.sources.landing import parse_event_time
from cloudmarts.streaming import onepass
from cloudmarts.streaming.bronze import bronze_usage_stream, file_stream


def _line(eid, ts, service="compute"):
    return json.dumps({"event_id": eid, "timestamp": ts, "org_id": "o", "service": service, "value": 1.0})


def _drop(land, name, lines):
    os.makedirs(land, exist_ok=True)
    with open(os.path.join(land, name), "w") as f:
        f.write("".join(line + "\n" for line in lines))


def _random_drops(seed, n_drops=3):
    rng = random.Random(seed)
    for d in range(n_drops):
        lines = []
        for _ in range(60):
            minute = max(0, rng.randrange(-60, 240) + 150 * d)
            eid = rng.choice(["e%d" % rng.randrange(25), None])
            ts = f"2025-08-10 {minute // 60:02d}:{minute % 60:02d}:00"
            lines += [_line(eid, ts)] * rng.choice([1, 1, 2])
        lines += [_line("nt", None), '{"event_id": "cut', _line("bad time", "yesterday")]
        yield lines


def _parsed(spark, land):
    return parse_event_time(file_stream(spark, land, USAGE_EVENT, "json", max_files_per_trigger=1))


def _keys(df):
    return sorted((r.event_id or "", str(r.timestamp_parsed)) for r in df.select("event_id", "timestamp_parsed").collect())


@pytest.mark.parametrize("null_time", ["divert", "keep"])
def test_bronze_is_that_of_the_engine_and_nothing_is_lost(spark, tmp_dir, null_time):
    land, landed = f"{tmp_dir}/land", 0
    for d, lines in enumerate(_random_drops(5)):
        _drop(land, f"{d}.jsonl", lines)
        landed += len(lines)
        bronze_usage_stream(_parsed(spark, land), f"{tmp_dir}/old", f"{tmp_dir}/old-ckpt", f"{tmp_dir}/old-side", null_time)
        onepass.ingest_usage_once(_parsed(spark, land), f"{tmp_dir}/new", f"{tmp_dir}/ledger", f"{tmp_dir}/ckpt", null_time=null_time)
    new = spark.read.parquet(f"{tmp_dir}/new")
    assert _keys(new.where("outcome = 'event'")) == _keys(spark.read.parquet(f"{tmp_dir}/old"))
    assert new.agg(F.sum("copies")).head()[0] == landed
    counts = onepass.landed_counts(spark, f"{tmp_dir}/ledger").head().asDict()
    assert counts["landed"] == landed and counts["late"] > 0 and counts["malformed"] == 3
    assert counts["untimed"] == (6 if null_time == "divert" else 0)
    late = new.where("outcome = 'late'").collect()
    assert len(late) == counts["late"] and all(r.copies == 1 and r.late_by_seconds >= 0 for r in late)


def test_a_kill_between_rows_and_ledger_changes_nothing(spark, tmp_dir, monkeypatch):
    land = f"{tmp_dir}/land"
    drops = list(_random_drops(9, 3))

    def run(to):
        onepass.ingest_usage_once(_parsed(spark, land), f"{tmp_dir}/{to}", f"{tmp_dir}/{to}-ledger", f"{tmp_dir}/{to}-ckpt")

    for d, lines in enumerate(drops):
        _drop(land, f"{d}.jsonl", lines)
        run("whole")
        real = onepass.write_table

        def killed(*a, **k):
            real(*a, **k)
            raise RuntimeError("killed after the rows")

        monkeypatch.setattr(onepass, "write_table", killed)
        with pytest.raises(Exception, match="killed"):
            run("torn")
        monkeypatch.setattr(onepass, "write_table", real)
        run("torn")
    tables = [sorted(tuple(map(str, r)) for r in spark.read.parquet(f"{tmp_dir}/{t}").drop("_batch").collect())
              for t in ("whole", "torn")]
    assert tables[0] == tables[1]
    ledgers = [onepass.landed_counts(spark, f"{tmp_dir}/{t}-ledger").head() for t in ("whole", "torn")]
    assert ledgers[0] == ledgers[1] and ledgers[0]["landed"] == sum(map(len, drops))


def test_a_lost_checkpoint_is_refused(spark, tmp_dir):
    land = f"{tmp_dir}/land"
    _drop(land, "a.jsonl", [_line("a", "2025-08-10 10:00:00")])
    onepass.ingest_usage_once(_parsed(spark, land), f"{tmp_dir}/t", f"{tmp_dir}/l", f"{tmp_dir}/c1")
    with pytest.raises(RuntimeError, match="checkpoint"):
        onepass.ingest_usage_once(_parsed(spark, land), f"{tmp_dir}/t", f"{tmp_dir}/l", f"{tmp_dir}/c2")


def test_a_hot_key_leaves_one_row_a_task(spark):
    rows = spark.createDataFrame([("hot", i % 2) for i in range(1000)], "event_id string, v int").repartition(4)
    tagged = rows.withColumns({"t": F.lit(0), "outcome": F.lit("event"), "_alone": F.lit(None).cast("long")})
    got = onepass._one_per_key(tagged, ["event_id", "t"])
    assert [(r.event_id, r.v, r.copies) for r in got.collect()] == [("hot", 0, 1000)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
