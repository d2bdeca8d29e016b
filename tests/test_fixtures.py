"""The fixture views exercise every staged column and the traps that hand-written frames used to hold alone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF01


@pytest.fixture(scope="module")
def m(spark):
    return entry.fixture_models(spark, SF01)


@pytest.mark.parametrize("name", ["stg_events", "stg_licenses", "stg_transactions"])
def test_no_staged_column_is_all_null_or_twice_the_same(m, name):
    df = m[name]
    row = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    assert [c for c in df.columns if row[c] == 0] == []
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    digests = df.agg(*[F.sum(F.xxhash64(c).cast("decimal(38,0)")).alias(c) for c in text]).first()
    assert len(set(digests)) == len(text)


def test_days_to_convert_has_matches_and_mismatches(m):
    both = m["stg_licenses"].select(
        F.datediff("evaluation_sale_date", "evaluation_start_date").alias("derived"),
        F.col("days_to_convert_eval").alias("stored")).dropna()
    assert both.filter("derived = stored").count() > 0 and both.filter("derived <> stored").count() > 0
    assert m["ins_days_to_convert_check"].first().compared == both.count()


def test_cents_negative_refunds_repeated_licences_and_tiers(spark, m):
    cents = entry.m03b_money_scale2(spark, SF01)
    assert cents.filter("vendor_amount <> floor(vendor_amount)").count() > 0
    refunds = cents.filter("upper(sale_type) = 'REFUND'")
    assert refunds.filter("vendor_amount < 0").count() > 0 and refunds.filter("vendor_amount > 0").count() > 0
    lic = m["stg_licenses"]
    assert lic.groupBy("license_id").count().filter("count > 1").count() > 0
    tiers = {r[0] for r in lic.select(F.upper("tier")).distinct().collect()}
    assert {None, "ENTERPRISE", "LEGACY SEAT PACK"} <= tiers
