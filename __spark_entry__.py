"""


Every query reads the driver's tables (orders, customer, lineitem, events) through the fixture
views of ``cohortlens.sources.fixtures`` and runs the whole model over them; nothing is sampled.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StructType  # noqa: E402

from cohortlens.operators import (active_by_month, first_period, month_spine,  # noqa: E402
                                  without_successor)
from cohortlens.plans import intermediate, marts, models  # noqa: E402
from cohortlens.session import checkpoint_dir  # noqa: E402
from cohortlens.sources import (FIXTURE_AS_OF, FIXTURE_CONFIG, in_window, publish, publish_text,  # noqa: E402
                                raw_inputs, read_published, read_source, store_by_month)
from cohortlens.sources.fixtures import app_key  # noqa: E402
from cohortlens.sources.schemas import raw_schema  # noqa: E402

try:  # the training-data operators and their pipeline; the rest works without them
    from cohortlens.llm import queries as llm_queries
    import corpus_pipeline
except ImportError:
    llm_queries = corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"

# query name -> model name in the layered model graph
MODEL_QUERIES = {
    "m01_stage_events": "stg_events",
    "m02_stage_licenses": "stg_licenses",
    "m03_stage_transactions": "stg_transactions",
    "m04_feature_usage": "int_feature_usage",
    "m05_customer_entity": "int_customer_entity",
    "m06_trial_lifecycle": "int_trial_lifecycle",
    "m07_dim_customers": "dim_customers",
    "m08_active_customers": "fct_active_customers",
    "m09_trial_conversion": "fct_trial_conversion",
    "m10_churn_and_nrr": "fct_churn_and_nrr",
    "m11_feature_adoption": "fct_feature_adoption",
    "m12_customer_health": "fct_customer_health",
    "m13_conversion_by_product": "ins_conversion_by_product",
    "m14_coverage_by_match_type": "ins_coverage_by_match_type",
    "m15_engagement_by_outcome": "ins_engagement_by_outcome",
    "m16_days_to_convert_check": "ins_days_to_convert_check",
}


_MODELS: dict = {}


def fixture_models(spark: SparkSession, sf_dir: str):
    """All models, lazily, over the fixture views of ``sf_dir`` (one graph per application)."""
    key = (app_key(spark), sf_dir)
    if key not in _MODELS:
        _MODELS[key] = models(raw_inputs(spark, sf_dir), FIXTURE_CONFIG, as_of=FIXTURE_AS_OF)
    return _MODELS[key]


def _model_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fixture_models(spark, sf_dir)[name]


def _all_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence intervals with known company, product and start (no dimension filter)."""
    lk = intermediate.licence_keys(fixture_models(spark, sf_dir)["stg_licenses"])
    return lk.filter(F.col("addon_name").isNotNull() & F.col("maintenance_start_date").isNotNull()) \
        .select("company", "addon_name", "license_id", "status", "maintenance_start_date",
                "maintenance_end_date")


def b04_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lic = fixture_models(spark, sf_dir)["stg_licenses"]
    cols = ["company", "addon_name", "license_id", "last_updated", "status"]
    return intermediate.latest_licences(lic, cols).select(*cols)


def b07_month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_spine(_all_intervals(spark, sf_dir), "maintenance_start_date")


def b08_active_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = _all_intervals(spark, sf_dir)
    spine = month_spine(iv, "maintenance_start_date")
    active = iv.filter(F.upper("status") == F.lit("ACTIVE"))
    return active_by_month(active, spine, ["addon_name"], "company", "maintenance_start_date",
                           "maintenance_end_date", out="active_customer_count")


def b09_first_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_period(_all_intervals(spark, sf_dir), ["company", "addon_name"],
                        "maintenance_start_date", ["addon_name"], out="new_customers")


def b10_without_successor(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = _all_intervals(spark, sf_dir)
    valid = (F.upper("status") == F.lit("ACTIVE")) & (
        F.coalesce(F.col("maintenance_end_date"), F.lit("2999-12-31").cast("date"))
        >= F.col("maintenance_start_date"))
    out = without_successor(iv, iv, ["company", "addon_name"], "maintenance_end_date",
                            "maintenance_start_date", valid)
    return out.select("company", "addon_name", "license_id", "maintenance_end_date")


def b05_resolve_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity resolution with NULL companies on both sides, which never match."""
    from cohortlens.config import LICENCE_ONLY, MATCHED, UNRESOLVED
    from cohortlens.operators import latest_per_key, resolve_entities
    m = fixture_models(spark, sf_dir)
    lic = m["stg_licenses"].select(F.upper("company").alias("company"), "addon_name", "license_id",
                                   "last_updated", "status")
    latest = latest_per_key(lic, intermediate.KEY, [F.col("last_updated").desc_nulls_last(),
                                                    F.col("license_id").desc_nulls_last()])
    seen = m["int_event_activity"].select("company", F.col("product").alias("addon_name"),
                                          "entity_distinct_users", "entity_total_events")
    return resolve_entities(latest, seen, intermediate.KEY, "match_type",
                            (MATCHED, LICENCE_ONLY, UNRESOLVED))


def _matched_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that lacks most licence keys: customers seen in the event log."""
    from cohortlens.config import MATCHED
    return fixture_models(spark, sf_dir)["dim_customers"].filter(F.col("match_type") == F.lit(MATCHED))


def j03_active_of_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M08 for the customers of a given dimension (semi-join)."""
    m = fixture_models(spark, sf_dir)
    return marts.active_customers(m["stg_licenses"], _matched_customers(spark, sf_dir), FIXTURE_CONFIG)


def j09_churn_of_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 for the customers of a given dimension (semi-join)."""
    m = fixture_models(spark, sf_dir)
    return marts.churn_and_nrr(m["stg_transactions"], m["stg_licenses"], _matched_customers(spark, sf_dir),
                               m["stg_events"], FIXTURE_CONFIG)


def m12b_health_by_maintenance_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 with the licence horizon on the latest maintenance end instead of the latest trial end."""
    m = fixture_models(spark, sf_dir)
    return marts.customer_health(m["int_customer_profile"], FIXTURE_AS_OF,
                                 FIXTURE_CONFIG.with_(license_end="maintenance"))


def m03b_money_scale2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged transactions with the cents kept (``money_type`` of two places)."""
    from cohortlens.plans import stage_transactions
    return stage_transactions(raw_inputs(spark, sf_dir)["transactions"],
                              FIXTURE_CONFIG.with_(money_type="decimal(38,2)"))


def b06_conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per product by type, with zero counts where a type is absent."""
    from cohortlens.operators import conditional_counts
    tx = fixture_models(spark, sf_dir)["stg_transactions"]
    t = F.upper("sale_type")
    counters = {f"n_{k.lower()}": t == F.lit(k) for k in ("NEW", "RENEWAL", "UPGRADE", "DOWNGRADE",
                                                           "REFUND")}
    return conditional_counts(tx, ["addon_name"], counters,
                              aggregates=[F.count(F.lit(1)).alias("n_sales")])


def b11_period_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change in trials started from the previous present cohort month, per product."""
    from cohortlens.operators import period_delta
    tc = fixture_models(spark, sf_dir)["fct_trial_conversion"].select(
        "month", "addon_name", "trials_started")
    return period_delta(tc, ["addon_name"], "month", "trials_started", "trials_started_change")


def b14_attach_group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's recency score next to the mean of its match type."""
    from cohortlens.operators import attach_group_avg
    h = fixture_models(spark, sf_dir)["fct_customer_health"].select(
        "company", "addon_name", "match_type", "recency_score")
    return attach_group_avg(h, ["match_type"], {"avg_recency_of_match_type": "recency_score"})


def b18_exclude_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged events without the system events (NULL event types dropped as well)."""
    from cohortlens.operators import exclude_values
    ev = fixture_models(spark, sf_dir)["stg_events"]
    return exclude_values(ev, "event_type", FIXTURE_CONFIG.system_events).select(
        "event_id", "event_type", "product", "user_property_company")


def j05_not_renewed_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences without a valid ACTIVE licence of the same customer that starts within 30 days after their end."""
    from cohortlens.operators import without_successor_within
    iv = _all_intervals(spark, sf_dir)
    valid = (F.upper("status") == F.lit("ACTIVE")) & (
        F.coalesce(F.col("maintenance_end_date"), F.lit("2999-12-31").cast("date"))
        >= F.col("maintenance_start_date"))
    out = without_successor_within(iv, iv, ["company", "addon_name"], "maintenance_end_date",
                                   "maintenance_start_date", 30, valid)
    return out.select("company", "addon_name", "license_id", "maintenance_end_date")


def m12c_health_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 on the wall clock (no ``as_of``)."""
    m = fixture_models(spark, sf_dir)
    return marts.customer_health(m["int_customer_profile"], None, FIXTURE_CONFIG)


def m10b_churn_by_negative_refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 where refunds are booked as negative amounts."""
    m = fixture_models(spark, sf_dir)
    return marts.churn_and_nrr(m["stg_transactions"], m["stg_licenses"], None, m["stg_events"],
                               FIXTURE_CONFIG.with_(refund_sign="<"))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/sources/{name}-{uuid.uuid4().hex}"


def s01_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table refreshed twice and read back: staged licences without, then with those of no type."""
    lic, path = fixture_models(spark, sf_dir)["stg_licenses"], _scratch(spark, "refresh")
    publish(lic.filter(F.col("license_type").isNotNull()), path)
    publish(lic, path)
    return read_published(spark, path)


TEXT_SALES = ("transaction_id", "license_id", "sale_date", "sale_type", "vendor_amount")


def s02_text_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales written as headered text, some dates and amounts spoilt, and loaded: good rows and rejected lines."""
    path = _scratch(spark, "text")
    tx = raw_inputs(spark, sf_dir)["transactions"].select(*[F.col(c).cast("string") for c in TEXT_SALES])
    number = F.crc32(F.col("transaction_id").cast("binary"))
    tx = tx.withColumn("sale_date", F.when(number % 101 == 0, F.lit("soon")).otherwise(F.col("sale_date"))) \
        .withColumn("vendor_amount", F.when(number % 67 == 0, F.concat("vendor_amount", F.lit("x"))).otherwise(F.col("vendor_amount")))
    tx.write.option("header", "true").csv(path)
    schema = raw_schema("transactions", "decimal(38,2)")
    schema = StructType([f for c in TEXT_SALES for f in schema.fields if f.name == c])
    publish_text(spark, "transactions", path, f"{path}-good", f"{path}-rejected", schema)
    good = read_published(spark, f"{path}-good").withColumns({"raw": F.lit(None).cast("string"), "reason": F.lit(None).cast("string")})
    bad = read_published(spark, f"{path}-rejected").drop("file")
    return good.unionByName(bad, allowMissingColumns=True)


def s03_named_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 over the events of the last 400 days before its date, from a named table partitioned by month."""
    inputs, name = raw_inputs(spark, sf_dir), f"events_by_month_{uuid.uuid4().hex[:8]}"
    store_by_month(inputs["events"], name, path=_scratch(spark, "events"))
    events = read_source(spark, "events", table=name, where=in_window(FIXTURE_AS_OF, 400))
    return models({**{k: inputs[k] for k in ("licenses", "transactions")}, "events": events}, FIXTURE_CONFIG,
                  as_of=FIXTURE_AS_OF)["fct_customer_health"]


BLOCK_QUERIES = {
    "s01_full_refresh": s01_full_refresh,
    "s02_text_load": s02_text_load,
    "s03_named_source": s03_named_source,
    "j05_not_renewed_within": j05_not_renewed_within,
    "m12c_health_today": m12c_health_today,
    "m10b_churn_by_negative_refunds": m10b_churn_by_negative_refunds,
    "m03b_money_scale2": m03b_money_scale2,
    "m12b_health_by_maintenance_end": m12b_health_by_maintenance_end,
    "j03_active_of_dimension": j03_active_of_dimension,
    "j09_churn_of_dimension": j09_churn_of_dimension,
    "b05_resolve_entities": b05_resolve_entities,
    "b06_conditional_counts": b06_conditional_counts,
    "b11_period_delta": b11_period_delta,
    "b14_attach_group_avg": b14_attach_group_avg,
    "b18_exclude_values": b18_exclude_values,
    "b04_latest_per_key": b04_latest_per_key,
    "b07_month_spine": b07_month_spine,
    "b08_active_by_month": b08_active_by_month,
    "b09_first_period": b09_first_period,
    "b10_without_successor": b10_without_successor,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the 0-100 customer health score (M12) on sf0.001."""
    return fixture_models(spark, SMOKE_DIR)["fct_customer_health"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        q: _model_query(m) for q, m in MODEL_QUERIES.items()}
    out.update(BLOCK_QUERIES)
    if llm_queries is not None:
        out.update(llm_queries.QUERIES)
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every query over the pre-registered driver tables."""
    import duck_oracle
    out = {q: duck_oracle.sql_for(m) for q, m in MODEL_QUERIES.items()}
    out.update({q: duck_oracle.sql_for(q) for q in BLOCK_QUERIES})
    if llm_queries is not None:
        out.update(llm_queries.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL is not None:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
