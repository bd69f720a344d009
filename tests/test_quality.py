"""Quality rules on the hand-made rows of FIXTURES (null, boundary, three-valued AND)."""

from pyspark.sql import functions as F

from cloudmarts.functions.rules import usage_rules, verdict
from cloudmarts.operators import quality

ROWS = [  # event_id, cost, value, unit, expected status
    ("a", 1.0, None, None, "valid"),
    ("f", -0.01, 1.0, "u", "valid"),
    ("c", -5.0, 1.0, "u", "quarantine"),
    ("d", 1.0, 1.0, None, "quarantine"),
    (None, 1.0, 1.0, "u", "quarantine"),
    (None, None, 1.0, "u", "quarantine"),
    ("e", None, 2.0, None, "quarantine"),
    ("b", None, None, None, "unknown"),
]
SCHEMA = "event_id string, cost_usd_increment double, value double, unit string, expected string"


def _tagged(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return quality.tag_quality(df, usage_rules())


def test_status_matches_three_valued_and(spark):
    t = _tagged(spark).withColumn("raw", verdict(usage_rules()))
    for r in t.collect():
        assert r.dq_status == r.expected, r
        expect_raw = {"valid": True, "quarantine": False, "unknown": None}[r.expected]
        assert r.raw == expect_raw, r


def test_reasons(spark):
    got = {r.event_id: sorted(r.dq_errors) for r in _tagged(spark).collect() if r.event_id}
    assert got["c"] == ["cost_negative"]
    assert got["d"] == ["unit_missing"]
    assert got["e"] == ["cost_negative_unknown", "unit_missing"]
    assert got["b"] == ["cost_negative_unknown"]
    assert got["a"] == [] and got["f"] == []


def test_split_policies_and_conservation(spark):
    t = _tagged(spark)
    valid = quality.valid_rows(t).count()
    q_default = quality.quarantined_rows(t).count()
    q_drop = quality.quarantined_rows(t, on_unknown="drop").count()
    assert (valid, q_default, q_drop) == (2, 6, 5)
    # default policy: every input row lands in exactly one output
    assert valid + q_default == t.count()
    # "drop" reproduces the naive filter pair: the unknown row is in neither output
    assert valid + q_drop == t.count() - 1
    routes = {r.route: r.n_rows for r in quality.route_counts(t).collect()}
    assert routes == {"valid": 2, "quarantine": 5, "unknown": 1}


def test_route_column(spark):
    t = _tagged(spark)
    drop = {r.event_id: r.r for r in t.select("event_id", quality.route("drop").alias("r")).collect()}
    assert drop["b"] == "dropped"
    keep = {r.event_id: r.r for r in t.select("event_id", quality.route().alias("r")).collect()}
    assert keep["b"] == "quarantine"
    assert F  # imported for parity with other tests


def test_infinite_costs_follow_the_rule_as_it_stands(spark):
    from cloudmarts.functions.rules import status, usage_rules
    rows = [("a", float("inf")), ("b", float("-inf")), ("c", float("nan")), ("d", -0.0)]
    df = spark.createDataFrame(rows, "event_id string, cost_usd_increment double").selectExpr("*", "1.0 AS value", "'u' AS unit")
    got = {r.event_id: r.s for r in df.select("event_id", status(usage_rules()).alias("s")).collect()}
    assert got == {"a": "valid", "b": "quarantine", "c": "valid", "d": "valid"}
