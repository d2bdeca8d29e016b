"""A hot key (one company with a third of all licences and events) gives the same results as the
naive SQL forms, and the plans keep map-side reduction before the shuffles."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from cohortlens.plans import latest_licences, models
from cohortlens.sources import FIXTURE_CONFIG
from tests import frames as fr


def skewed_inputs(spark, n=3000, seed=5):
    rnd = random.Random(seed)
    lic, ev = [], []
    for i in range(n):
        company = "HOT" if i % 3 == 0 else f"C{rnd.randrange(200)}"
        start = dt.date(2019, 1, 1) + dt.timedelta(days=rnd.randrange(700))
        lic.append(dict(license_id=f"L{i}", company=company, addon_name=rnd.choice(["alpha suite", "BETA SUITE"]),
                        status=rnd.choice(["Active", "inactive"]), license_type="COMMERCIAL",
                        last_updated=start, maintenance_start_date=start,
                        maintenance_end_date=None if i % 17 == 0 else start + dt.timedelta(days=rnd.randrange(20, 400))))
        ev.append(dict(event_id=f"e{i}", event_type=rnd.choice(["checklist_item_created", "time_logged", "x"]),
                       event_time=dt.datetime(2020, 1, 1) + dt.timedelta(hours=rnd.randrange(9000)),
                       user_id=f"u{rnd.randrange(500)}", product=rnd.choice(["alpha", "beta"]),
                       user_property_company=company if i % 5 else None, session_id=rnd.randrange(50)))
    return {"licenses": fr.licenses(spark, lic), "events": fr.events(spark, ev),
            "transactions": fr.transactions(spark, [])}


def test_hot_key_results_match_naive_sql(spark):
    m = models(skewed_inputs(spark), FIXTURE_CONFIG, as_of="2021-06-30")
    m["stg_licenses"].createOrReplaceTempView("sk_lic")
    naive_latest = spark.sql("""
      SELECT company, addon_name, license_id FROM (
        SELECT upper(trim(company)) AS company, addon_name, license_id,
               row_number() OVER (PARTITION BY upper(trim(company)), addon_name
                                  ORDER BY last_updated DESC NULLS LAST, license_id DESC NULLS LAST) rk
        FROM sk_lic WHERE company IS NOT NULL) WHERE rk = 1""")
    ent = m["int_customer_entity"].filter(F.col("match_type") != "unresolved")
    got = {(r.company, r.addon_name) for r in ent.collect()}
    assert got == {(r.company, r.addon_name) for r in naive_latest.collect()}
    usage = m["int_feature_usage"].filter(F.col("company") == "HOT").collect()
    assert sum(r.total_events for r in usage) == m["stg_events"].filter(
        (F.upper("user_property_company") == "HOT")
        & ~F.col("event_type").isin("automated_test_run", "api_health_check")).count()
    act = m["fct_active_customers"].collect()
    assert act and all(r.active_customer_count >= 1 for r in act)


def test_hot_key_plans_reduce_before_shuffle(spark):
    m = models(skewed_inputs(spark, n=300), FIXTURE_CONFIG, as_of="2021-06-30")
    # latest-per-key: a partial WindowGroupLimit runs before the exchange
    p = latest_licences(m["stg_licenses"])._jdf.queryExecution().executedPlan().toString()
    assert p.count("WindowGroupLimit") >= 2
    # the licence profile: a partial maximum does
    p = m["int_customer_entity"]._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(struct(last_updated" in p
    p = m["int_feature_usage"]._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in p
