"""Marts on hand-made rows, and the golden revenue values from the shipped billing sample."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cloudmarts.operators import marts
from cloudmarts.sources.landing import ingest_master

D = dt.date


def test_tickets_by_day(spark):
    rows = [("t1", "o", "critical", D(2025, 8, 1), None, 4.0, True),
            ("t2", "o", "low", D(2025, 8, 1), None, None, None),
            ("t3", "o", "critical", D(2025, 8, 1), None, 0.0, False),
            ("t4", "o", "low", D(2025, 8, 2), None, None, False)]
    df = spark.createDataFrame(rows, "ticket_id string, org_id string, severity string, "
                                     "created_at date, resolved_at date, csat double, sla_breached boolean")
    out = {r.ticket_date: r for r in marts.tickets_by_day(marts.conform_tickets(df)).collect()}
    a = out[D(2025, 8, 1)]
    assert (a.total_tickets, a.critical_tickets_count, a.avg_csat, a.sla_breach_rate) == (3, 2, 4.0, 0.3333)
    b = out[D(2025, 8, 2)]
    # no answered ticket: the mean stays NULL in gold (filled only in serving)
    assert b.avg_csat is None and b.sla_breach_rate == 0.0


def test_collections(spark):
    users = spark.createDataFrame([("o1", "dev", True), ("o1", "admin", False), ("o1", "dev", True),
                                   ("o1", None, True), ("o2", "ops", True)],
                                  "org_id string, role string, active boolean")
    roles = {r.org_id: r.active_user_roles for r in marts.role_sets(users).collect()}
    assert roles == {"o1": ["admin", "dev"], "o2": ["ops"]}
    active = {r.org_id: r.active_user_roles for r in marts.role_sets(users, only_active=True).collect()}
    assert active["o1"] == ["dev"]

    nps = spark.createDataFrame(
        [("o1", D(2025, 6, i), f"c{i}") for i in range(1, 8)] + [("o1", D(2025, 7, 1), ""),
                                                                ("o1", D(2025, 7, 2), None)],
        "org_id string, survey_date date, comment string")
    rc = marts.recent_comments(nps, limit=3).collect()[0].recent_nps_comments
    assert rc == ["c7", "c6", "c5"]

    daily = spark.createDataFrame([("o1", "compute", 1.25), ("o1", "compute", 2.5), ("o1", "db", 0.1),
                                   ("o1", None, 9.0)], "org_id string, service string, total_cost_usd double")
    m = marts.cost_maps(daily).collect()[0].service_accumulated_costs
    assert m == {"compute": 3.75, "db": 0.1}


GOLDEN_CSV = """invoice_id,org_id,month,subtotal,credits,taxes,currency,exchange_rate_to_usd
inv_1,org_c11ertj5,2025-08-01,1061.88,,223.0,USD,0.92466
inv_2,org_c11ertj5,2025-07-01,1255.59,,263.67,ARS,0.0016
inv_3,org_c11ertj5,2025-06-01,1729.12,9.97,363.11,EUR,1.09935
inv_3,org_c11ertj5,2025-06-01,1729.12,9.97,363.11,EUR,1.09935
"""


def test_golden_revenue(spark, tmp_dir):
    path = os.path.join(tmp_dir, "billing_monthly.csv")
    with open(path, "w") as f:
        f.write(GOLDEN_CSV)
    bronze, corrupt = ingest_master(spark, path, "billing_monthly")
    assert len(corrupt.collect()) == 0 and bronze.count() == 3
    rev = marts.revenue_by_month(marts.billing_usd(bronze))
    got = {r.month: (r.total_subtotal_usd, r.total_credits_usd, r.total_taxes_usd, r.net_revenue_usd)
           for r in rev.collect()}
    assert got[D(2025, 8, 1)] == (981.878, 0.0, 206.1992, 1188.0771)
    assert got[D(2025, 7, 1)] == (2.0089, 0.0, 0.4219, 2.4308)
    assert got[D(2025, 6, 1)] == (1900.9081, 10.9605, 399.185, 2289.1325)
    assert F
