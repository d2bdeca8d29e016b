"""Whole-model build: staging -> intermediate -> marts, as lazy frames or as written tables.

``models()`` wires the data products into one lazy graph (Catalyst fuses each mart's plan from the
raw scans). ``build_all()`` materialises the layers like the original project: each layer is written
as a table and read back before the next layer uses it, which cuts lineage (a lost executor only
recomputes from the last written layer) and lets several marts share one computation of
staging / entity / usage instead of recomputing them per mart.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..config import Config
from ..operators.checks import KeyCheck
from ..sources.publish import publish, publish_table
from . import insights, intermediate, marts, staging

LAYERS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("staging", ("stg_events", "stg_licenses", "stg_transactions")),
    ("intermediate", ("int_event_activity", "int_feature_usage", "int_licence_profile",
                      "int_customer_profile", "int_customer_entity", "int_trial_lifecycle",
                      "int_trial_signals", "int_feature_outcomes")),
    ("mart", ("dim_customers", "fct_active_customers", "fct_trial_conversion", "fct_churn_and_nrr",
              "fct_feature_adoption", "fct_customer_health")),
    ("insight", ("ins_conversion_by_product", "ins_coverage_by_match_type",
                 "ins_engagement_by_outcome", "ins_days_to_convert_check")),
)


# Key-grain tables that a catalog build stores in buckets of their key, so that the joins above them (J1, J2,
# J11-J13) read both sides without an exchange.
BUCKETED = {
    "int_event_activity": ("company", "product"), "int_feature_usage": ("company", "product"),
    "int_licence_profile": ("company", "addon_name"), "int_trial_signals": ("company", "addon_name"),
    "int_customer_profile": ("company", "addon_name"),
}


def model_builders(cfg: Config, as_of=None, checks: dict[str, KeyCheck] | None = None) \
        -> dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """Name -> function of the already-built models it depends on.

    With ``checks`` (a layered build, whose models are tables) joins count their rows there; without, models
    are planned lazily, and those that need no sessions and days read the events without them.
    """
    lazy = checks is None

    def check(name: str) -> KeyCheck | None:
        if checks is not None:
            checks[name] = KeyCheck(name)
            return checks[name]
        return None

    def profile_activity(m):
        if not lazy:
            return m["int_event_activity"]
        return intermediate.event_activity(intermediate.event_marks(m["stg_events"], cfg, moments=False), cfg)

    return {
        "stg_events": lambda m: staging.stage_events(m["events"], cfg),
        "stg_licenses": lambda m: staging.stage_licenses(m["licenses"], cfg),
        "stg_transactions": lambda m: staging.stage_transactions(m["transactions"], cfg),
        # One reduction of the event log serves the feature usage and the entity's activity side in a build.
        "int_event_activity": lambda m: intermediate.event_activity(
            intermediate.event_marks(m["stg_events"], cfg), cfg),
        "int_feature_usage": lambda m: intermediate.feature_usage(m["int_event_activity"], cfg),
        "int_licence_profile": lambda m: intermediate.licence_profile(m["stg_licenses"]),
        "int_customer_profile": lambda m: intermediate.customer_profile(
            m["int_licence_profile"], profile_activity(m), check("int_customer_profile")),
        "int_customer_entity": lambda m: intermediate.customer_entity(m["int_customer_profile"]),
        "int_trial_lifecycle": lambda m: intermediate.trial_lifecycle(m["stg_licenses"], cfg),
        "int_trial_signals": lambda m: marts.lifecycle_signals(m["int_trial_lifecycle"]),
        "int_feature_outcomes": lambda m: marts.feature_outcomes(
            m["int_feature_usage"], m["int_trial_signals"], cfg, check("int_feature_outcomes")),
        "dim_customers": lambda m: marts.dim_customers(m["int_customer_entity"]),
        # The licence marts keep licence rows whose key is a customer of the dimension. The
        # dimension is built from these same licences, so every licence key with a known company
        # and product is in it: no filter is needed, and these marts never compute the dimension's
        # event-activity side (tested equal to filtering by the dimension).
        "fct_active_customers": lambda m: marts.active_customers(m["stg_licenses"], None, cfg=cfg),
        "fct_trial_conversion": lambda m: marts.trial_conversion(m["int_trial_lifecycle"]),
        "fct_churn_and_nrr": lambda m: marts.churn_and_nrr(
            m["stg_transactions"], m["stg_licenses"], None, m["stg_events"], cfg),
        "fct_feature_adoption": lambda m: marts.feature_adoption(m["int_feature_outcomes"]),
        "fct_customer_health": lambda m: marts.customer_health(m["int_customer_profile"], as_of, cfg),
        "ins_conversion_by_product": lambda m: insights.conversion_by_product(
            m["int_trial_lifecycle"]),
        "ins_coverage_by_match_type": lambda m: insights.coverage_by_match_type(
            m["fct_customer_health"]),
        # The roll-up needs each row's outcome only, not the group averages attached by M11.
        "ins_engagement_by_outcome": lambda m: insights.engagement_by_outcome(m["int_feature_outcomes"]),
        "ins_days_to_convert_check": lambda m: insights.days_to_convert_check(m["stg_licenses"]),
    }


class Models(dict):
    """Lazily built models: ``models['fct_churn_and_nrr']`` builds it and what it depends on."""

    def __init__(self, inputs: Mapping[str, DataFrame], cfg: Config, as_of=None):
        super().__init__()
        self._inputs = inputs
        self._builders = model_builders(cfg, as_of)

    def __missing__(self, name: str) -> DataFrame:
        if name not in self._builders:
            return self._inputs[name]
        df = self._builders[name](self)
        self[name] = df
        return df


def models(inputs: Mapping[str, DataFrame], cfg: Config = Config(), as_of=None) -> Models:
    """All models as lazy DataFrames over raw ``inputs`` ('events', 'licenses', 'transactions')."""
    return Models(inputs, cfg, as_of)


def build_all(spark: SparkSession, inputs: Mapping[str, DataFrame], out_dir: str | None = None,
              cfg: Config = Config(), as_of=None, fmt: str = "parquet", database: str | None = None,
              layer_databases: Mapping[str, str] = {}, buckets: int = 64) -> dict[str, str]:
    """Publish every model (full refresh), layer by layer; each model reads the written tables of earlier
    layers.

    Either ``out_dir``, a folder on shared storage, takes the models as ``out_dir/<name>``; or the catalog
    takes them as ``database.<name>``, or in the database that ``layer_databases`` names for the layer
    ('staging', 'intermediate', 'mart', 'insight'); there the key-grain tables are stored in ``buckets`` buckets.
    Returns name -> folder of the current version, or name in the catalog.

    Every model is published atomically (see :mod:`..sources.publish`): one that fails, or whose joins repeat
    keys (:class:`.KeyCheck`, counted while it is written), keeps its former version.
    """
    if (out_dir is None) == (database is None):
        raise ValueError("give out_dir or database")
    checks: dict[str, KeyCheck] = {}
    builders = model_builders(cfg, as_of, checks)
    built: dict[str, DataFrame] = dict(inputs)
    paths: dict[str, str] = {}
    for layer, names in LAYERS:
        for name in names:  # in dependency order; later models read the written tables
            df = builders[name](built)
            verify = checks[name].verify if name in checks else None
            if out_dir is not None:
                paths[name] = publish(df, f"{out_dir.rstrip('/')}/{name}", fmt=fmt, check=verify)
                built[name] = spark.read.format(fmt).load(paths[name])
            else:
                paths[name] = f"{layer_databases.get(layer, database)}.{name}"
                by = (buckets, BUCKETED[name]) if name in BUCKETED else None
                if by is not None:
                    df = df.repartition(buckets, *BUCKETED[name])  # one file a bucket
                publish_table(df, paths[name], fmt=fmt, bucket_by=by, check=verify)
                built[name] = spark.read.table(paths[name])
    return paths
