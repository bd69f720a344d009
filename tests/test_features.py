"""Usage features E1-E7 on hand-made rows."""

import datetime as dt

from cloudmarts.operators.events import usage_features

SCHEMA = ("event_id string, timestamp_parsed timestamp_ntz, service string, metric string, "
          "value double, genai_tokens bigint, carbon_kg double, cost_usd_increment double")
T = dt.datetime(2025, 8, 1, 23, 59, 59)


def test_feature_rules(spark):
    rows = [
        ("r1", T, "compute", "requests", None, None, None, None),      # request without value
        ("r2", T, "compute", "requests", 3.0, None, 0.5, 1.25),
        ("c1", T, "compute", "cpu_hours", None, None, None, None),
        ("c2", T, "compute", "cpu_hours", 2.5, None, None, None),
        ("s1", T, "storage", "storage_gb_hours", 7.0, None, None, None),
        ("g1", T, "genai", "requests", 1.0, 900, None, None),
        ("g2", T, "compute", "requests", 1.0, 900, None, None),        # tokens outside genai
        ("x1", T, None, None, 4.0, None, None, None),                   # unknown metric
    ]
    got = {r.event_id: r for r in usage_features(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["r1"].requests == 1.0 and got["r2"].requests == 3.0
    assert got["c1"].cpu_hours == 0.0 and got["c2"].cpu_hours == 2.5 and got["c2"].requests == 0.0
    assert got["s1"].storage_gb_hours == 7.0
    assert got["g1"].genai_tokens_feat == 900 and got["g2"].genai_tokens_feat == 0
    assert got["r2"].carbon_kg_feat == 0.5 and got["r1"].carbon_kg_feat == 0.0
    assert got["r2"].daily_cost_usd == 1.25 and got["r1"].daily_cost_usd == 0.0
    assert got["x1"].requests == got["x1"].cpu_hours == got["x1"].storage_gb_hours == 0.0
    assert all(r.usage_date == dt.date(2025, 8, 1) for r in got.values())
