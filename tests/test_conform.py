"""Conformance expressions (Q6-Q8) on hand-made rows."""

import datetime as dt

from cloudmarts.functions.conform import as_percent, round_map_values
from cloudmarts.operators import marts


def test_billing_to_usd(spark):
    rows = [("i1", 100.0, None, 21.0, 2.0), ("i2", None, 5.0, None, 0.5), ("i3", 10.0, 1.0, 2.0, None)]
    df = spark.createDataFrame(rows, "invoice_id string, subtotal double, credits double, "
                                     "taxes double, exchange_rate_to_usd double")
    got = {r.invoice_id: r for r in marts.billing_usd(df).collect()}
    assert (got["i1"].subtotal_usd, got["i1"].credits_usd, got["i1"].taxes_usd,
            got["i1"].net_revenue_usd) == (200.0, 0.0, 42.0, 242.0)
    # a missing subtotal counts as 0; credits are subtracted
    assert got["i2"].net_revenue_usd == -2.5
    # a missing rate gives NULL amounts, never a guess
    assert got["i3"].net_revenue_usd is None and got["i3"].subtotal_usd is None


def test_tickets_and_nps(spark):
    t = spark.createDataFrame([("t1", dt.date(2025, 8, 1), None, None)],
                              "ticket_id string, created_at date, csat double, sla_breached boolean")
    r = marts.conform_tickets(t).collect()[0]
    assert (r.csat, r.sla_breached, r.ticket_date) == (0.0, False, dt.date(2025, 8, 1))
    n = spark.createDataFrame([("o", None)], "org_id string, nps_score double")
    assert marts.conform_nps(n).collect()[0].nps_score == 0.0


def test_display_helpers(spark):
    df = spark.createDataFrame([({"a": 1.005, "b": 2.0}, 0.3333)],
                               "m map<string,double>, rate double")
    r = df.select(round_map_values("m").alias("m"), as_percent("rate").alias("p")).collect()[0]
    assert r.m == {"a": 1.01, "b": 2.0} and r.p == "33.33%"
