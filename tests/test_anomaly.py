"""IQR fences: exact quartiles, zero-IQR fallback, fence boundary, NULL group."""

import numpy as np
import pytest

from cloudmarts.operators import anomaly


def _disc(values, q):
    s = np.sort(np.asarray(values))
    # smallest value whose cumulative share reaches q
    k = int(np.ceil(q * len(s))) - 1
    return float(s[max(k, 0)])


def test_quartiles_equal_discrete_quantile(spark):
    rng = np.random.default_rng(7)
    vals = [float(x) for x in rng.integers(0, 500, 1001)]
    df = spark.createDataFrame([("s", v) for v in vals], "service string, daily_cost_usd double")
    r = anomaly.group_quartiles(df).collect()[0]
    assert r.q1 == _disc(vals, 0.25)
    assert r.q3 == _disc(vals, 0.75)


def test_zero_iqr_fallback_and_boundaries(spark):
    rows = [("flat", 5.0)] * 8 + [("flat", 15.0), ("flat", 15.01)]
    rows += [("wide", float(v)) for v in (1, 2, 3, 4, 5, 6, 7, 8)]
    rows += [(None, 1000.0)]
    df = spark.createDataFrame(rows, "service string, daily_cost_usd double")
    out = anomaly.flag_anomalies(df)
    flat = {r.daily_cost_usd: r.anomaly_flag for r in out.filter("service = 'flat'").collect()}
    # q1 = q3 = 5: fences 5 +/- 10; exactly on the fence is not an anomaly
    assert flat == {5.0: False, 15.0: False, 15.01: True}
    b = {r.service: r for r in anomaly.iqr_bounds(anomaly.group_quartiles(df)).collect()}
    assert (b["flat"].upper_bound, b["flat"].lower_bound) == (15.0, -5.0)
    assert b["wide"].iqr == b["wide"].q3 - b["wide"].q1
    assert b["wide"].upper_bound == b["wide"].q3 + 1.5 * b["wide"].iqr
    # a NULL service never meets a fence
    nul = out.filter("service IS NULL").collect()[0]
    assert nul.anomaly_flag is False and nul.upper_bound is None


def test_fences_are_broadcast_not_shuffled(spark):
    df = spark.createDataFrame([("s", float(i)) for i in range(50)], "service string, daily_cost_usd double")
    plan = anomaly.flag_anomalies(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


@pytest.mark.parametrize("sketch_k, rank_rows", [(64, 40), (64, 10**6), (4096, 100)])
def test_quantiles_are_exact_however_often_ranges_are_narrowed(spark, sketch_k, rank_rows):
    rng = np.random.default_rng(3)
    inf = float("inf")
    groups = {"even": rng.random(3000), "tail": np.exp(rng.standard_normal(3000) * 8), "one": np.full(50, 2.5),
              "steps": rng.integers(0, 3, 2000).astype(float), "few": np.array([4.0]),
              "wide": np.array([-1e300, -1.0, 0.0, 1.0, 1e300] * 40),
              "some infinite": np.concatenate([rng.random(1000), [inf]]),
              "mostly infinite": np.concatenate([rng.random(300), np.full(900, inf), np.full(900, -inf)]),
              "all infinite": np.full(500, -inf), "zeros": np.array([0.0, -0.0] * 300),
              "subnormal": np.array([5e-324 * i for i in range(700)])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("even", None), ("even", float("nan")), (None, 1.0)]
    df = spark.createDataFrame(rows, "service string, daily_cost_usd double").repartition(3)
    got = {r.service: r for r in anomaly.group_quantiles(
        df, "daily_cost_usd", "service", {"low": 0.01, "mid": 0.5, "top": 1.0}, sketch_k, rank_rows).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert (got[g].low, got[g].mid, got[g].top) == (_disc(vs, 0.01), _disc(vs, 0.5), _disc(vs, 1.0)), g


def test_missed_bounds_are_found_again(spark, monkeypatch):
    """Ranges that do not hold the rank at all, as if every sketch had failed."""
    vals = [float(v) for v in range(2000)]
    df = spark.createDataFrame([("s", v) for v in vals], "service string, daily_cost_usd double")
    monkeypatch.setattr(anomaly, "rank_error", lambda k: 1e-9)
    for rank_rows in (50, 10**6):
        r = anomaly.group_quantiles(df, "daily_cost_usd", "service", {"q": 0.37}, 64, rank_rows).head()
        assert r.q == _disc(vals, 0.37)


def test_small_groups_take_one_pass(spark, monkeypatch):
    df = spark.createDataFrame([("s", float(i)) for i in range(500)], "service string, daily_cost_usd double")
    for step in ("_sketch_inside", "_count_inside"):
        monkeypatch.setattr(anomaly, step, lambda *a: pytest.fail("a second pass"))
    assert anomaly.group_quartiles(df).head()[1:] == (124.0, 374.0)


def test_silver_takes_quartiles_from_service_and_cost_alone(spark, monkeypatch):
    from cloudmarts.operators import events
    from cloudmarts.sources import testmap as tm
    from conftest import SF_SMALL
    seen, real = [], anomaly.group_quartiles
    monkeypatch.setattr(anomaly, "group_quartiles", lambda df, *a: seen.append(df) or real(df, *a))
    events.silver_usage(tm.usage_events(spark, SF_SMALL), tm.orgs(spark, SF_SMALL), tm.resources(spark, SF_SMALL))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert len(seen) == 1 and "Join" not in plan and "Window" not in plan and seen[0].columns == ["service", "daily_cost_usd"]
