"""Physical-plan checks: no cartesian / nested-loop joins, no Python in the plan, pruned scans."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF001
from tools.plan_report import final_plan, summarise

CORE = {**entry.MODEL_QUERIES, **entry.BLOCK_QUERIES}
QUERIES = {q: f for q, f in entry.queries().items() if q in CORE}


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    p = initial_plan(QUERIES[name](spark, SF001))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, (name, bad)


@pytest.fixture()
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    entry._MODELS.clear()  # plans made with broadcasts
    yield
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    entry._MODELS.clear()


@pytest.mark.parametrize("name", ["m04_feature_usage", "m05_customer_entity", "m11_feature_adoption", "m12_customer_health",
                                  "m14_coverage_by_match_type", "m15_engagement_by_outcome", "b14_attach_group_avg"])
def test_events_and_licences_are_read_and_aggregated_once(spark, no_broadcast, name):
    p = final_plan(QUERIES[name](spark, SF001))
    s = summarise(p)
    assert s["reads"].get("events") == 1 and s["reads"].get("orders", 1) == 1, s
    assert s["broadcast_hash_joins"] == 0 and "Expand [" not in p
    # the raw events' aggregate: one partial side however many readers
    raw = re.findall(r"Aggregate\(keys=\[company#\d+, product#\d+, mark#\d+, user_id#\d+, session_id.*functions=\[partial_", p)
    assert len(raw) == 1, raw


def test_distinct_counts_shuffle_the_log_once(spark, no_broadcast):
    """m04: no Expand; the events go through one exchange, below which they are reduced to their distinct marks."""
    lines = initial_plan(QUERIES["m04_feature_usage"](spark, SF001)).splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet [event_id" in x or "FileScan parquet" in x and "user_id" in x)
    above = [x for x in lines[:scan]]
    marks = max(i for i, x in enumerate(above) if "Aggregate(keys=[company" in x and "mark#" in x and "partial_" in x)
    exchanges = [i for i, x in enumerate(above) if " Exchange hashpartitioning(company" in x]
    assert not any("Expand" in x for x in lines)
    assert len([i for i in exchanges if i < marks]) == 2  # marks, then one partial row a task and key
    assert summarise(final_plan(QUERIES["m04_feature_usage"](spark, SF001)))["reads"]["events"] == 1


def test_profile_reads_no_sessions(spark):
    p = initial_plan(QUERIES["m12_customer_health"](spark, SF001))
    assert "props" not in p and "'session'" not in p and "session AS mark" not in p


def test_sweep_line_multiplies_no_interval_by_months(spark, no_broadcast):
    lines = initial_plan(QUERIES["b08_active_by_month"](spark, SF001)).splitlines()
    gens = [i for i, x in enumerate(lines) if "Generate explode(" in x]
    # two generators: the steps (two a run), and the spine months of a level; the latter above all exchanges of runs
    step = [i for i in gens if "array(struct" in lines[i] or "_s#" in lines[i]]
    level = [i for i in gens if "filter(" in lines[i]]
    assert len(level) == 1 and len(step) == 1 and level[0] < step[0]
    runs = [x for x in lines[step[0]:] if " Exchange hashpartitioning(addon_name" in x]
    assert len(runs) == 2  # united by start month, then ordered per entity


def test_bounded_successor_is_one_shuffle_without_join(spark, no_broadcast):
    from cohortlens.operators import without_successor_within
    iv = entry._all_intervals(spark, SF001)
    a = initial_plan(iv)
    p = initial_plan(without_successor_within(iv, iv, ["company", "addon_name"], "maintenance_end_date", "maintenance_start_date", 30))
    extra = p.count(" Exchange hashpartitioning(company") - a.count(" Exchange hashpartitioning(company")
    assert extra == 1 and p.count("Join") == 2 * a.count("Join")  # the fixture's own join, once a side


def test_named_source_prunes_partitions(spark):
    p = QUERIES["s03_named_source"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    at = p.index("PartitionFilters: [isnotnull(event_month")
    assert "event_month" in p[at:at + 200] and ">= 2000-" in p[at:at + 300] and "<= 2001-08" in p[at:at + 300]


def test_sales_are_shuffled_once_below_the_licence_join(spark, no_broadcast):
    lines = initial_plan(QUERIES["m10_churn_and_nrr"](spark, SF001)).splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet [l_orderkey" in x)
    join = max(i for i, x in enumerate(lines[:scan]) if "SortMergeJoin" in x)
    assert sum(" Exchange " in x for x in lines[join:scan]) == 1


def test_scan_is_pruned(spark):
    df = QUERIES["m09_trial_conversion"](spark, SF001)
    p = df._jdf.queryExecution().executedPlan().toString()
    # the trial mart never reads order prices or priorities
    assert "o_totalprice" not in p and "o_orderpriority" not in p


def test_system_event_filter_reaches_plan(spark):
    df = QUERIES["m04_feature_usage"](spark, SF001)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert "automated_test_run" in p
