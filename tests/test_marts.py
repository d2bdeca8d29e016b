"""Data products on hand-written frames: one test per semantic trap of the model."""

from __future__ import annotations

from decimal import Decimal

import pytest

from cohortlens.sources import FIXTURE_CONFIG
from cohortlens.plans import models
from tests import frames as fr
from tests.frames import d, ts

CFG = FIXTURE_CONFIG


def build(spark, lic=(), ev=(), tx=(), cfg=CFG, as_of="2021-01-01"):
    inputs = {"licenses": fr.licenses(spark, list(lic)), "events": fr.events(spark, list(ev)),
              "transactions": fr.transactions(spark, list(tx))}
    return models(inputs, cfg, as_of=as_of)


def lic(company, product, lid, **kw):
    row = dict(company=company, addon_name=product, license_id=lid, license_type="COMMERCIAL",
               status="Active", last_updated=d("2020-01-01"), maintenance_start_date=d("2020-01-01"),
               maintenance_end_date=d("2020-12-31"))
    row.update(kw)
    return row


def ev(company, product, etype, when="2020-12-20 10:00:00", user="u1", session=1, eid="e"):
    return dict(event_id=eid, event_type=etype, event_time=ts(when), user_id=user, product=product,
                user_property_company=company, session_id=session)


def test_product_counters_use_canonical_names(spark):
    # Product-scoped counters compare to the canonical (upper-case) product name.
    m = build(spark, ev=[ev("Acme", "alpha", "checklist_item_created"),
                         ev("Acme", "beta", "time_logged"),
                         ev("Acme", "alpha", "time_logged")])
    rows = {r.product: r for r in m["int_feature_usage"].collect()}
    assert rows["ALPHA SUITE"].checklist_items_created == 1
    assert rows["BETA SUITE"].time_logged == 1
    assert rows["ALPHA SUITE"].time_logged == 0


def test_system_events_excluded_from_usage_but_not_entity(spark):
    # Entity activity counts system events; feature usage does not.
    m = build(spark, lic=[lic("Acme", "Alpha Suite", "L1")],
              ev=[ev("acme ", "alpha", "api_health_check", user="bot"),
                  ev("ACME", "alpha", "checklist_shared", user="u1"),
                  ev("ACME", "alpha", None, user="u2")])
    fu = m["int_feature_usage"].collect()
    assert len(fu) == 1 and fu[0].total_events == 1 and fu[0].distinct_users == 1
    ent = m["int_customer_entity"].collect()
    assert len(ent) == 1 and ent[0].match_type == "matched_on_company"
    assert ent[0].total_events == 3 and ent[0].distinct_users == 3


def test_entity_three_way_and_null_company(spark):
    m = build(spark, lic=[lic("Acme", "Alpha Suite", "L1"),
                          lic("  acme ", "alpha suite", "L2", last_updated=d("2020-05-01")),
                          lic("Beta", "Alpha Suite", "L3"),
                          lic("   ", "Alpha Suite", "L4")],
              ev=[ev("ACME", "alpha", "x"), ev(" ", "alpha", "x"), ev("Gamma", "beta", "x")])
    rows = {(r.company, r.addon_name): r for r in m["dim_customers"].collect()}
    assert rows[("ACME", "ALPHA SUITE")].match_type == "matched_on_company"
    assert rows[("BETA", "ALPHA SUITE")].match_type == "marketplace_only"
    assert rows[(None, "ALPHA SUITE")].match_type == "unresolved"
    assert rows[("GAMMA", "BETA SUITE")].match_type == "unresolved"
    assert len(rows) == 4


def test_transaction_product_case_joins_licences(spark):
    # Mixed-case transaction product names still join the licences' upper-case names.
    m = build(spark, lic=[lic("Acme", "Alpha Suite", "L1")],
              tx=[dict(transaction_id="t1", license_id="L1", addon_name="Alpha Suite",
                       sale_date=d("2020-02-10"), sale_type="New", vendor_amount=Decimal(100))])
    rows = m["fct_churn_and_nrr"].collect()
    assert len(rows) == 1 and rows[0].mrr == Decimal(100)


def test_repeated_licence_rows_do_not_multiply(spark):
    # A licence repeated in the licence table must not multiply the sale.
    m = build(spark, lic=[lic("Acme", "Alpha Suite", "L1"),
                          lic("Acme", "Alpha Suite", "L1", last_updated=d("2020-03-01"))],
              tx=[dict(transaction_id="t1", license_id="L1", addon_name="ALPHA SUITE",
                       sale_date=d("2020-02-10"), sale_type="Renewal", vendor_amount=Decimal(100))])
    assert m["fct_churn_and_nrr"].collect()[0].mrr == Decimal(100)


def _tx(amount, stype, date="2020-02-10"):
    return dict(transaction_id="t", license_id="L1", addon_name="ALPHA SUITE",
                sale_date=d(date), sale_type=stype, vendor_amount=Decimal(amount))


def test_refund_sign_and_nrr(spark):
    # Refunds trigger churn only when positive (configurable); churn takes the whole month.
    l1 = [lic("Acme", "Alpha Suite", "L1")]
    txs = [_tx(100, "New", "2020-01-05"), _tx(200, "Renewal", "2020-02-05"),
           _tx(50, "Upgrade", "2020-02-06"), _tx(-30, "Refund", "2020-02-07"),
           _tx(20, "Downgrade", "2020-02-08")]
    rows = {r.month.isoformat(): r for r in build(spark, l1, tx=txs)["fct_churn_and_nrr"].collect()}
    feb = rows["2020-02-01"]
    assert feb.mrr == Decimal(250) and feb.churned_mrr == Decimal(0)
    assert feb.beginning_mrr == Decimal(100) and feb.expansion_mrr == Decimal(50)
    assert feb.contraction_mrr == Decimal(20)
    assert feb.nrr == pytest.approx((100 + 50 - 20 - 0) / 100) and feb.churn_rate == 0.0
    neg = build(spark, l1, tx=txs, cfg=CFG.with_(refund_sign="<"))["fct_churn_and_nrr"].collect()
    feb2 = {r.month.isoformat(): r for r in neg}["2020-02-01"]
    assert feb2.churned_mrr == Decimal(250 - 30 + 20)


def test_cancel_event_churns_customer_month(spark):
    l1 = [lic("Acme", "Alpha Suite", "L1")]
    txs = [_tx(100, "New", "2020-01-05"), _tx(80, "Renewal", "2020-02-05")]
    evs = [ev("acme", "alpha", "subscription_cancelled", when="2020-02-20 00:00:00")]
    rows = {r.month.isoformat(): r for r in build(spark, l1, evs, txs)["fct_churn_and_nrr"].collect()}
    assert rows["2020-02-01"].churned_mrr == Decimal(80) and rows["2020-01-01"].churned_mrr == 0


def test_active_customers_month_rules(spark):
    # Months without an active customer vanish; T11/T12 follow the original.
    ls = [lic("Acme", "Alpha Suite", "L1", maintenance_start_date=d("2020-01-15"),
              maintenance_end_date=d("2020-03-31")),
          lic("Beta", "Alpha Suite", "L2", status="inactive",
              maintenance_start_date=d("2020-06-01"), maintenance_end_date=d("2020-06-30")),
          lic("Gamma", "Alpha Suite", "L3", maintenance_start_date=d("2020-02-01"),
              maintenance_end_date=None)]
    rows = {r.month.isoformat(): r for r in build(spark, ls)["fct_active_customers"].collect()}
    # spine = start months Jan, Feb, Jun; Acme active Jan-Mar (end is a month end), Gamma open.
    assert set(rows) == {"2020-01-01", "2020-02-01", "2020-06-01"}
    assert rows["2020-01-01"].active_customer_count == 1
    assert rows["2020-02-01"].active_customer_count == 2 and rows["2020-02-01"].mom_change == 1
    assert rows["2020-06-01"].active_customer_count == 1
    assert rows["2020-06-01"].new_customers == 1 and rows["2020-06-01"].churned_customers == 1
    assert rows["2020-01-01"].new_customers == 1 and rows["2020-02-01"].new_customers == 1


def test_health_score_rules(spark):
    # T18 horizon is the latest trial end; T19 max(status) is alphabetical; T20 NULL tier -> 10.
    ls = [lic("Acme", "Alpha Suite", "L1", tier="Standard", license_type="Evaluation",
              evaluation_start_date=d("2020-11-01"), evaluation_end_date=d("2021-03-01")),
          lic("Beta", "Alpha Suite", "L2", tier=None, status=None),
          lic("Beta", "Alpha Suite", "L3", tier=None, status="inactive",
              last_updated=d("2019-01-01")),
          ]
    evs = [ev("acme", "alpha", "checklist_item_created", when="2020-12-20 00:00:00", user=f"u{i}")
           for i in range(5)]
    rows = {r.company: r for r in build(spark, ls, evs, as_of="2021-01-01")["fct_customer_health"].collect()}
    a = rows["ACME"]
    assert a.recency_score == 25 and a.engagement_score == pytest.approx(5 / 25 * 25)
    assert a.feature_adoption_score == 5 and a.license_health_score == 25
    assert a.health_score == pytest.approx(25 + 5 + 5 + 25) and a.health_tier == "at_risk"
    b = rows["BETA"]
    assert b.match_type == "marketplace_only" and b.engagement_score == 10.0
    assert b.recency_score == 0 and b.license_health_score == 0 and b.health_tier == "critical"


def test_feature_adoption_outcomes(spark):
    # active_trial is "everything else", including NULL companies.
    ls = [lic("Acme", "Alpha Suite", "L1", evaluation_sale_date=d("2020-02-01")),
          lic("Beta", "Alpha Suite", "L2", status="INACTIVE")]
    evs = [ev("acme", "alpha", "x", user="a"), ev("beta", "alpha", "x", user="b"),
           ev("Gamma", "alpha", "app_uninstalled", user="c"), ev(None, "alpha", "x", user="d"),
           ev("Delta", "alpha", "x", user="e")]
    rows = {r.company: r for r in build(spark, ls, evs)["fct_feature_adoption"].collect()}
    assert rows["ACME"].outcome == "converted" and rows["BETA"].outcome == "churned"
    assert rows["GAMMA"].outcome == "churned" and rows[None].outcome == "active_trial"
    assert rows["DELTA"].outcome == "active_trial"
    assert rows[None].avg_distinct_users == 1.0


def test_trial_lifecycle_and_days_check(spark):
    ls = [lic("Acme", "Alpha Suite", "L1", license_type="Evaluation",
              evaluation_start_date=d("2020-01-01"), evaluation_sale_date=d("2020-01-11"),
              days_to_convert_eval=10),
          lic("Beta", "Alpha Suite", "L2", license_type=None,
              evaluation_start_date=d("2020-01-01")),
          lic("Gamma", "Alpha Suite", "L3", evaluation_sale_date=d("2020-01-11"),
              days_to_convert_eval=3)]
    m = build(spark, ls)
    tl = {r.license_id: r for r in m["int_trial_lifecycle"].collect()}
    assert set(tl) == {"L1", "L3"}
    assert tl["L1"].is_trial and tl["L1"].converted and tl["L1"].days_to_convert == 10
    assert not tl["L3"].is_trial and tl["L3"].converted and tl["L3"].days_to_convert is None
    chk = m["ins_days_to_convert_check"].first()
    assert (chk.licenses, chk.compared, chk.mismatched) == (3, 1, 1)


def test_blank_names_become_null(spark):
    # Blank-only product and company text become NULL in staging (not '').
    m = build(spark, lic=[lic("  ", "   ", "L1")],
              ev=[ev("   ", "  ", "x"), ev("Acme", None, "x")],
              tx=[dict(transaction_id="t", license_id="L1", addon_name="  ", sale_date=d("2020-01-01"),
                       sale_type=" ", vendor_amount=Decimal(1))])
    s = m["stg_licenses"].first()
    assert s.addon_name is None and s.company is None
    assert {r.product for r in m["stg_events"].collect()} == {None}
    t = m["stg_transactions"].first()
    assert t.addon_name is None and t.sale_type is None
    fu = m["int_feature_usage"].collect()
    assert {(r.company, r.product) for r in fu} == {(None, None), ("ACME", None)}


def test_current_status_applies_to_past_months(spark):
    # A licence that is inactive today counts in no month, even months it once covered.
    ls = [lic("Acme", "Alpha Suite", "L1", status="inactive", maintenance_start_date=d("2020-01-01"),
              maintenance_end_date=d("2020-12-31")),
          lic("Beta", "Alpha Suite", "L2", maintenance_start_date=d("2020-01-01"),
              maintenance_end_date=d("2020-12-31"))]
    rows = build(spark, ls)["fct_active_customers"].collect()
    assert [r.active_customer_count for r in rows] == [1]


def test_billing_period_is_ignored(spark):
    # An annual sale counts in full in its sale month.
    l1 = [lic("Acme", "Alpha Suite", "L1")]
    t = _tx(1200, "New", "2020-03-05")
    t["billing_period"] = "Annual"
    rows = build(spark, l1, tx=[t])["fct_churn_and_nrr"].collect()
    assert len(rows) == 1 and rows[0].mrr == Decimal(1200)


def test_null_product_gives_both_sides(spark):
    # A NULL product yields a licence-side row and a usage-side row for the same company.
    m = build(spark, lic=[lic("Acme", None, "L1")], ev=[ev("Acme", None, "x")])
    rows = sorted(r.match_type for r in m["int_customer_entity"].collect())
    assert rows == ["marketplace_only", "unresolved"]
