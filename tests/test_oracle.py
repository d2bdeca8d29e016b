"""Every registered query against its DuckDB oracle (names, types, rows, values)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF001, SF01
from tools.oracle_check import compare

CORE = {**entry.MODEL_QUERIES, **entry.BLOCK_QUERIES}
QUERIES = {q: f for q, f in entry.queries().items() if q in CORE}
SQL = {q: x for q, x in entry.oracle_sql().items() if q in CORE}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, duck001, name):
    r = compare(spark, duck001, name, QUERIES[name], SQL[name], SF001)
    assert r["names_match"], r
    assert r["type_diffs"] == {}, r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", ["m05_customer_entity", "m08_active_customers", "m10_churn_and_nrr",
                                  "m12_customer_health", "m11_feature_adoption"])
def test_query_matches_oracle_sf001(spark, duck01, name):
    r = compare(spark, duck01, name, QUERIES[name], SQL[name], SF01)
    assert r["spark_rows"] == r["oracle_rows"] and r["values_match"], r


def test_fixture_views_match_duckdb(spark, duck001):
    """The Spark fixture views equal the SQL fixture views row for row."""
    import duck_oracle
    from cohortlens.sources import raw_inputs
    from tools.oracle_check import canonical
    raw = raw_inputs(spark, SF001)
    for name, view in (("licenses", "raw_licenses"), ("events", "raw_events"),
                       ("transactions", "raw_transactions")):
        df = raw[name]
        rel = duck001.sql(duck_oracle.sql_for(view))
        assert sorted(df.columns) == sorted(rel.columns)
        a = canonical([tuple(r) for r in df.collect()], df.columns)
        b = canonical(rel.fetchall(), list(rel.columns))
        assert a == b, name


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["company", "addon_name", "match_type", "recency_score",
                          "engagement_score", "feature_adoption_score", "license_health_score",
                          "health_score", "health_tier"]
    assert df.count() > 0


def test_session_time_zone_does_not_matter(spark, duck001):
    """Results are the same in a non-UTC session: timestamps are NTZ, months are dates."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        for name in ("m01_stage_events", "m04_feature_usage", "m10_churn_and_nrr"):
            r = compare(spark, duck001, name, QUERIES[name], SQL[name], SF001)
            assert r["values_match"], r
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
