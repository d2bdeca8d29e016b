"""Feature usage, customer entity, trial lifecycle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LICENCE_ONLY, MATCHED, UNRESOLVED, Config
from ..functions.text import clean_text, exclude_values_predicate, normalize_key
from ..operators.checks import KeyCheck
from ..operators.counting import conditional_counts
from ..operators.ranking import latest_per_key
from ..operators.resolution import resolve_entities

KEY = ["company", "addon_name"]


FEATURE_USAGE_MEASURES = ["total_events", "distinct_users", "distinct_sessions", "first_event_date",
                          "last_event_date", "active_days"]


def event_marks(events: DataFrame, cfg: Config = Config(), moments: bool = True) -> DataFrame:
    """The event log reduced to its distinct users, sessions and days per (company, product).

    A row of mark 'user' holds all that is summed: events, first and last time, and one counter per configured
    feature and lifecycle event; rows of marks 'session' and 'day' only say that a user event (neither
    system nor untyped) had that session or day, and are left out without ``moments``. One scan and one
    aggregate make all of them, combined by the tasks before the only shuffle of the size of the log: it carries
    users, sessions and days, never one row per event, unless every event has a session of its own. A
    hot (or NULL) company is spread over its users, sessions and days.
    """
    user = F.coalesce(exclude_values_predicate("event_type", cfg.system_events), F.lit(False))
    src = events.select(normalize_key("user_property_company").alias("company"), "product", "event_type",
                        "user_id", "session_id", "event_time",
                        F.to_date("event_time").alias("event_date"), user.alias("is_user"))

    def mark(name: str, **known):
        none = {"user_id": "string", "session_id": "bigint", "event_date": "date"}
        return F.struct(F.lit(name).alias("mark"), *[
            (F.col(c) if c in known else F.lit(None).cast(t)).alias(c) for c, t in none.items()])

    one = F.array(mark("user", user_id=1))
    if moments:
        one = F.when(F.col("is_user"), F.array(mark("user", user_id=1), mark("session", session_id=1), mark("day", event_date=1))) \
            .otherwise(one)
    src = src.select("company", "product", "event_type", "event_time", F.col("event_date").alias("_date"), "is_user",
                     F.explode(one).alias("_mark")).select("*", "_mark.*").drop("_mark")
    whole = F.col("mark") == "user"
    u, p, e = whole & F.col("is_user"), F.col("product"), F.col("event_type")
    counters = {name: u & (p == F.lit(prod)) & (e == F.lit(evt))
                for name, prod, evt in cfg.feature_counters}
    counters.update({name: u & (e == F.lit(evt)) for name, evt in cfg.lifecycle_counters})
    day = F.when(u, F.col("_date"))
    return conditional_counts(
        src, ["company", "product", "mark", "user_id", "session_id", "event_date"], counters, aggregates=[
            F.count_if(whole).alias("events"), F.count_if(u).alias("user_events"),
            F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen"),
            F.min(day).alias("first_date"), F.max(day).alias("last_date")])


def event_activity(marks: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Both per-(company, product) views of :func:`event_marks`: the feature-usage measures and counters
    over user events, and the entity activity over all events (``entity_*``, ``first_seen``, ``last_seen``). Marks are
    distinct, so distinct counts are plain counts. Planned lazily, Catalyst prunes the aggregate to the measures
    that are read."""
    user = F.col("mark") == "user"
    return marks.groupBy("company", "product").agg(
        F.sum("user_events").alias("total_events"),
        F.count_if(user & F.col("user_id").isNotNull() & (F.col("user_events") > 0)).alias("distinct_users"),
        F.count_if((F.col("mark") == "session") & F.col("session_id").isNotNull()).alias("distinct_sessions"),
        F.min("first_date").alias("first_event_date"),
        F.max("last_date").alias("last_event_date"),
        F.count_if((F.col("mark") == "day") & F.col("event_date").isNotNull()).alias("active_days"),
        F.count_if(user & F.col("user_id").isNotNull()).alias("entity_distinct_users"),
        F.sum("events").alias("entity_total_events"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        *[F.sum(c).alias(c) for c in cfg.feature_columns + cfg.lifecycle_columns])


def feature_usage(activity: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Per (company, product) with at least one user event: volume, distinct users / sessions / active
    days, first and last day, and the counters (0 when none). NULL companies stay as their own group."""
    cfg.check_products()
    return (activity.filter(F.col("total_events") > 0)
            .select("company", "product", *FEATURE_USAGE_MEASURES, *cfg.feature_columns,
                    *cfg.lifecycle_columns))


def licence_keys(licenses: DataFrame) -> DataFrame:
    """Licence rows with a known company, keyed by (company, addon_name)."""
    return (licenses.withColumn("company", normalize_key("company"))
            .withColumn("addon_name", clean_text("addon_name"))
            .filter(F.col("company").isNotNull()))


def latest_licences(licenses: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """B04 applied to licences: newest ``last_updated``, then highest ``license_id`` (as text).

    Only ``columns`` (default: all) are kept; a full tie is broken on them, so the result is
    deterministic and the scan reads just those columns.
    """
    lk = licence_keys(licenses)
    if columns is not None:
        lk = lk.select(*dict.fromkeys(KEY + ["last_updated", "license_id"] + list(columns)))
    return latest_per_key(lk, KEY, [F.col("last_updated").desc_nulls_last(),
                                    F.col("license_id").desc_nulls_last()])


ENTITY_LICENCE_COLS = ["company", "cloud_id", "cloud_site_hostname", "tech_contact_email",
                       "addon_name", "status", "license_type", "tier", "hosting"]
ENTITY_COLS = ENTITY_LICENCE_COLS + ["distinct_users", "total_events", "first_seen", "last_seen",
                                     "match_type"]


def licence_profile(licenses: DataFrame) -> DataFrame:
    """One row per (company, product) with a known company, in one aggregate: the columns of the latest
    licence (newest ``last_updated``, then highest ``license_id``), and over the key's licences of a known
    type the greatest status and the latest trial end, over all of them the latest maintenance end.

    The latest licence is the maximum of a struct that starts with its order, so each map task sends one
    row a key, however many licences a hot key has.
    """
    rest = [c for c in ENTITY_LICENCE_COLS if c not in KEY]
    typed = F.col("license_type").isNotNull()
    g = licence_keys(licenses).groupBy(*KEY).agg(
        F.max(F.struct("last_updated", "license_id", *rest)).alias("latest"),
        F.max(F.when(typed, F.col("status"))).alias("trial_status"),
        F.max(F.when(typed, F.col("evaluation_end_date"))).alias("latest_trial_end_date"),
        F.max("maintenance_end_date").alias("latest_maintenance_end_date"))
    return g.select(*KEY, *[F.col(f"latest.{c}").alias(c) for c in rest], "trial_status",
                    "latest_trial_end_date", "latest_maintenance_end_date")


def customer_profile(licences: DataFrame, activity: DataFrame, check: KeyCheck | None = None) -> DataFrame:
    """Everything known per (company, product): :func:`licence_profile` and :func:`event_activity` resolved
    by one full outer join, labelled 'matched_on_company' / 'marketplace_only' / 'unresolved'. The entity,
    the dimension and the health score are projections of it, so each reads the events and the licences
    once. ``check``: see :func:`.resolve_entities`."""
    return resolve_entities(licences, activity.withColumnRenamed("product", "addon_name"),
                            KEY, "match_type", (MATCHED, LICENCE_ONLY, UNRESOLVED), check)


def customer_entity(profile: DataFrame) -> DataFrame:
    """One row per (company, product): the latest licence with the activity over all events, plus
    activity keys no licence has ('unresolved')."""
    renamed = {"distinct_users": "entity_distinct_users", "total_events": "entity_total_events"}
    return profile.select(*[F.col(renamed.get(c, c)).alias(c) for c in ENTITY_COLS])


def trial_lifecycle(licenses: DataFrame, cfg: Config = Config()) -> DataFrame:
    """One row per licence with a licence type: trial and conversion flags, days to convert."""
    from ..config import EVALUATION_TYPE
    return licenses.filter(F.col("license_type").isNotNull()).select(
        normalize_key("company").alias("company"),
        "addon_name", "license_id", "evaluation_license_id",
        ((F.upper("license_type") == F.lit(EVALUATION_TYPE))
         | F.col("evaluation_start_date").isNotNull()).alias("is_trial"),
        F.col("evaluation_sale_date").isNotNull().alias("converted"),
        F.datediff("evaluation_sale_date", "evaluation_start_date").cast("bigint")
        .alias("days_to_convert"),
        F.col("evaluation_start_date").alias("trial_start_date"),
        F.col("evaluation_end_date").alias("trial_end_date"),
        F.col("evaluation_sale_date").alias("converted_date"),
        F.col("status").alias("current_status"),
    )
