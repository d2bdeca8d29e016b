"""Layered build (written tables) and the streaming staging entry point."""

from __future__ import annotations

import os

import pytest

from cohortlens.plans import build_all, models
from cohortlens.sources import FIXTURE_AS_OF, FIXTURE_CONFIG, raw_inputs
from cohortlens.streaming.staging import stage_stream
from tests.conftest import SF001
from tools.oracle_check import canonical


def rows(df):
    return canonical([tuple(r) for r in df.collect()], df.columns)


def test_build_all_matches_lazy_models(spark, scratch):
    raw = raw_inputs(spark, SF001)
    inputs = {k: raw[k] for k in ("events", "licenses", "transactions")}
    paths = build_all(spark, inputs, os.path.join(scratch, "out"), FIXTURE_CONFIG, as_of=FIXTURE_AS_OF)
    lazy = models(inputs, FIXTURE_CONFIG, as_of=FIXTURE_AS_OF)
    for name in ("fct_customer_health", "fct_churn_and_nrr", "fct_active_customers",
                 "ins_coverage_by_match_type"):
        written = spark.read.parquet(paths[name])
        assert rows(written) == rows(lazy[name]), name


def test_build_all_to_catalog_tables(spark, scratch):
    raw = raw_inputs(spark, SF001)
    inputs = {k: raw[k] for k in ("events", "licenses", "transactions")}
    for layer in ("core", "marts"):
        spark.sql(f"CREATE DATABASE cl_{layer} LOCATION '{scratch}/{layer}'")
    try:
        names = build_all(spark, inputs, cfg=FIXTURE_CONFIG, as_of=FIXTURE_AS_OF, database="cl_core",
                          layer_databases={"mart": "cl_marts"})
        lazy = models(inputs, FIXTURE_CONFIG, as_of=FIXTURE_AS_OF)
        assert names["fct_customer_health"] == "cl_marts.fct_customer_health"
        for name in ("dim_customers", "fct_customer_health", "ins_coverage_by_match_type"):
            assert rows(spark.read.table(names[name])) == rows(lazy[name]), name
        assert all(spark.catalog.tableExists(t) for t in names.values())
    finally:
        for layer in ("core", "marts"):
            spark.sql(f"DROP DATABASE cl_{layer} CASCADE")


def test_joins_of_a_catalog_build_have_no_exchange(spark, scratch):
    """J1 and J11-J13 over the bucketed key-grain tables of a build."""
    from cohortlens.config import LICENCE_ONLY, MATCHED, UNRESOLVED
    from cohortlens.operators import resolve_entities
    from cohortlens.plans import marts
    raw = raw_inputs(spark, SF001)
    inputs = {k: raw[k] for k in ("events", "licenses", "transactions")}
    spark.sql(f"CREATE DATABASE cl_bucket LOCATION '{scratch}/bucket'")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = build_all(spark, inputs, cfg=FIXTURE_CONFIG, as_of=FIXTURE_AS_OF, database="cl_bucket", buckets=4)
        t = {k: spark.read.table(v) for k, v in names.items()}
        joins = {
            "J1": resolve_entities(t["int_licence_profile"], t["int_event_activity"].withColumnRenamed("product", "addon_name"),
                                   ["company", "addon_name"], "match_type", (MATCHED, LICENCE_ONLY, UNRESOLVED)),
            "J11": marts.feature_outcomes(t["int_feature_usage"], t["int_trial_signals"], FIXTURE_CONFIG),
            "J12": t["int_customer_profile"].select("company", "addon_name", "tier").join(
                t["int_feature_usage"].withColumnRenamed("product", "addon_name"), ["company", "addon_name"], "left"),
            "J13": t["int_customer_profile"].select("company", "addon_name", "tier").join(
                t["int_trial_signals"], ["company", "addon_name"], "left")}
        for name, df in joins.items():
            p = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in p and "Exchange" not in p, (name, p)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP DATABASE cl_bucket CASCADE")


def test_repeated_key_stops_a_build(spark, scratch, monkeypatch):
    """A profile whose licence side repeats a key is not published; the former one stays current."""
    from cohortlens.plans import intermediate
    from cohortlens.sources import read_published
    raw = raw_inputs(spark, SF001)
    inputs = {k: raw[k] for k in ("events", "licenses", "transactions")}
    out = os.path.join(scratch, "out")
    build_all(spark, inputs, out, FIXTURE_CONFIG, as_of=FIXTURE_AS_OF)
    n = read_published(spark, f"{out}/int_customer_profile").count()
    once = intermediate.licence_profile
    monkeypatch.setattr(intermediate, "licence_profile", lambda lic: once(lic).union(once(lic).limit(40)))
    with pytest.raises(ValueError, match="int_customer_profile: .* the left side repeats a key"):
        build_all(spark, inputs, out, FIXTURE_CONFIG, as_of=FIXTURE_AS_OF)
    assert read_published(spark, f"{out}/int_customer_profile").count() == n


def test_build_all_needs_a_target(spark):
    with pytest.raises(ValueError):
        build_all(spark, {}, cfg=FIXTURE_CONFIG)


def test_stage_stream_equals_batch(spark, scratch):
    raw = raw_inputs(spark, SF001)["licenses"]
    src = os.path.join(scratch, "raw_licenses")
    raw.write.parquet(src)
    out, ckpt = os.path.join(scratch, "staged"), os.path.join(scratch, "ckpt")
    q = stage_stream(spark, "licenses", src, out, ckpt, cfg=FIXTURE_CONFIG, available_now=True)
    q.awaitTermination(120)
    from cohortlens.plans import stage_licenses
    assert rows(spark.read.parquet(out)) == rows(stage_licenses(spark.read.parquet(src)))
