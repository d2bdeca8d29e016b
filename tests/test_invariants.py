"""Model invariants on the sf0.01 fixture views."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF01


@pytest.fixture(scope="module")
def m(spark):
    return entry.fixture_models(spark, SF01)


def test_entity_rows(m):
    lic = m["stg_licenses"].filter(F.upper(F.trim("company")).isNotNull())
    lic_keys = lic.select(F.upper(F.trim("company")), "addon_name").distinct().count()
    ent = m["int_customer_entity"]
    unresolved = ent.filter(F.col("match_type") == "unresolved").count()
    assert ent.count() == lic_keys + unresolved
    known = ent.filter(F.col("company").isNotNull() & F.col("addon_name").isNotNull())
    assert known.count() == known.select("company", "addon_name").distinct().count()


def test_health_bounds(m):
    h = m["fct_customer_health"]
    r = h.agg(F.min("health_score"), F.max("health_score"), F.max("recency_score"),
              F.max("engagement_score"), F.max("feature_adoption_score"),
              F.max("license_health_score"), F.min("engagement_score")).first()
    assert 0 <= r[0] and r[1] <= 100
    assert r[2] <= 25 and r[3] <= 25 and r[4] <= 25 and r[5] <= 25 and r[6] >= 0


def test_conversion_counts(m):
    tc = m["fct_trial_conversion"]
    assert tc.filter(F.col("trials_converted") > F.col("trials_started")).count() == 0
    dated = m["int_trial_lifecycle"].filter(F.col("trial_start_date").isNotNull())
    from cohortlens.plans.insights import conversion_by_product
    a = conversion_by_product(dated).agg(F.sum("total_trials"), F.sum("converted")).first()
    b = tc.agg(F.sum("trials_started"), F.sum("trials_converted")).first()
    assert tuple(a) == tuple(b)


def test_new_customers_cover_all_keys(spark):
    iv = entry._all_intervals(spark, SF01)
    nc = entry.b09_first_period(spark, SF01).agg(F.sum("new_customers")).first()[0]
    assert nc == iv.select("company", "addon_name").distinct().count()


def test_coverage_shares_sum_to_one(m):
    s = m["ins_coverage_by_match_type"].agg(F.sum("share_of_customers")).first()[0]
    assert abs(s - 1.0) < 1e-9


def test_fixture_counts_match_survey(m):
    # FIXTURES.md section 3, sf0.01 column.
    ent = {r.match_type: r[1] for r in m["int_customer_entity"].groupBy("match_type").count().collect()}
    assert ent == {"matched_on_company": 144, "marketplace_only": 4174, "unresolved": 27}
    refunds = m["stg_transactions"].filter(F.upper("sale_type") == "REFUND").count()
    assert refunds == 1384


def test_licence_marts_same_with_dimension(m):
    from cohortlens.plans.marts import active_customers
    from cohortlens.sources import FIXTURE_CONFIG
    via_dim = active_customers(m["stg_licenses"], m["dim_customers"], cfg=FIXTURE_CONFIG)
    via_keys = m["fct_active_customers"]
    assert via_dim.exceptAll(via_keys).count() == 0 and via_keys.exceptAll(via_dim).count() == 0


def test_revenue_mart_same_with_dimension(m):
    from cohortlens.plans.marts import churn_and_nrr
    from cohortlens.sources import FIXTURE_CONFIG
    via_dim = churn_and_nrr(m["stg_transactions"], m["stg_licenses"], m["dim_customers"],
                            m["stg_events"], FIXTURE_CONFIG)
    via_none = m["fct_churn_and_nrr"]
    assert via_dim.exceptAll(via_none).count() == 0 and via_none.exceptAll(via_dim).count() == 0


def test_activity_equals_counts_over_raw_events(m):
    """The two-level aggregate equals plain aggregates of the staged events."""
    from cohortlens.functions.text import normalize_key
    ev = m["stg_events"].select(normalize_key("user_property_company").alias("company"), "product", "event_type",
                                "user_id", "session_id", "event_time")
    user = ~F.col("event_type").isin("automated_test_run", "api_health_check")
    plain = [
        (ev.filter(user).groupBy("company", "product").agg(
            F.count(F.lit(1)).alias("total_events"), F.count_distinct("user_id").alias("distinct_users"),
            F.count_distinct("session_id").alias("distinct_sessions"),
            F.count_distinct(F.to_date("event_time")).alias("active_days")),
         m["int_feature_usage"]),
        (ev.groupBy("company", "product").agg(
            F.count_distinct("user_id").alias("entity_distinct_users"), F.count(F.lit(1)).alias("entity_total_events"),
            F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen")),
         m["int_event_activity"])]
    for a, b in plain:
        b = b.select(*a.columns)
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_profile_takes_the_latest_licence(m):
    from cohortlens.plans.intermediate import ENTITY_LICENCE_COLS, latest_licences
    a = latest_licences(m["stg_licenses"], ENTITY_LICENCE_COLS).select(*ENTITY_LICENCE_COLS)
    b = m["int_customer_entity"].filter("match_type <> 'unresolved'").select(*ENTITY_LICENCE_COLS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_config_without_products_is_an_error(spark, m):
    from cohortlens import Config
    from cohortlens.plans import models
    from cohortlens.sources import raw_inputs
    bare = models(raw_inputs(spark, SF01), Config(), as_of="2001-08-01")
    assert bare["dim_customers"].columns
    for name in ("int_feature_usage", "fct_feature_adoption", "fct_customer_health"):
        with pytest.raises(ValueError, match="with_products"):
            bare[name]
