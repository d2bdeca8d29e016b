"""Raw-source views over the driver's TPC-H-like tables (orders, customer, lineitem, events).

They give the three raw sources of the model (licences, product events, transactions) the shapes and
data-quality defects the model must handle: padded and mixed-case names, blanks, NULL keys, open
intervals, system events, product short names. Each view is a narrow projection of one scan (plus a
join to ``customer`` keyed on its primary key), so Catalyst prunes columns down to the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from .io import conform
from .schemas import EVENTS_RAW, LICENSES_RAW, raw_schema

# --- Fixed values of the fixture views ----------------------------------------------------------
# Event types picked by (event_id * 7 + user_id) % 31 = 0..16; every other residue is a page view.
FIXTURE_EVENT_TYPES = (
    "automated_test_run", "api_health_check", "checklist_item_created", "checklist_item_completed",
    "checklist_template_applied", "checklist_exported", "checklist_shared", "timesheet_submitted",
    "timesheets_approved", "time_logged", "timer_started", "report_generated", "onboarding_started",
    "onboarding_completed", "subscription_activated", "subscription_cancelled", "app_uninstalled",
)
FIXTURE_OTHER_EVENT = "page_viewed"
FIXTURE_EVENT_PRODUCTS = ("alpha", " Beta", "gamma")
FIXTURE_LICENSE_PRODUCTS = ("Alpha Suite", " beta suite ", "GAMMA SUITE")
FIXTURE_SALE_PRODUCTS = ("Alpha Suite", "Beta Suite", "Gamma Suite")
FIXTURE_TIERS = (("HOUSEHOLD", "Free"), ("MACHINERY", "Standard"), ("FURNITURE", "Professional"),
                 ("BUILDING", "Premium"))
# The AUTOMOBILE segment has no tier, the largest tier or one of no known name, by nation.
FIXTURE_OTHER_TIERS = (None, "Enterprise", "Legacy seat pack")
FIXTURE_HOSTING = ("Cloud", " Server ", "Data Center", " ")
FIXTURE_PLATFORMS = ("web", " ios", "android")
FIXTURE_MONEY = "decimal(38,2)"
FIXTURE_AS_OF = "2001-08-01"
# Product vocabulary of the fixtures: short names map to the licence names; checklist features
# belong to ALPHA SUITE, timesheet/time/timer/report features to BETA SUITE.
FIXTURE_CONFIG = Config().with_products(
    checklist="ALPHA SUITE", time_tracking="BETA SUITE",
    aliases=(("ALPHA", "ALPHA SUITE"), ("BETA", "BETA SUITE"), ("GAMMA", "GAMMA SUITE")))
# -----------------------------------------------------------------------------------------------


def _pick(index: Column, values: tuple[str, ...], default=None) -> Column:
    out = F.lit(default).cast("string")
    for i in reversed(range(len(values))):
        out = F.when(index == i, F.lit(values[i])).otherwise(out)
    return out


def _label(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def _money(count: Column, unit: str) -> Column:
    """``count`` times ``unit`` (a decimal literal of two places), exact."""
    return (count.cast("decimal(14,0)") * F.lit(unit).cast("decimal(3,2)")).cast(FIXTURE_MONEY)


_CACHE: dict[tuple[str, str, str], DataFrame] = {}


def app_key(spark: SparkSession) -> str:
    """Identity of the running application (the session object on clients without a context)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # e.g. a Spark Connect session has no SparkContext
        return f"session-{id(spark)}"


def _memo(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Build a view once per (application, folder): the driver tables are immutable, and listing
    files, reading footers and analysing the view would otherwise be repeated by every query."""
    key = (app_key(spark), sf_dir, name)
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _memo(spark, sf_dir, f"table:{name}", lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def licenses_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw licences: one per order, company and tier from the ordering customer; every 43rd comes twice
    (a later row of the same licence)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                              "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner").withColumn("copy", F.explode(
        F.when(F.col("o_orderkey") % 43 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    k, cust, nation = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey")
    d = F.col("o_orderdate").cast("date")
    tier = F.when(F.col("c_mktsegment") == "AUTOMOBILE", _pick(nation % 3, FIXTURE_OTHER_TIERS))
    for seg, label in reversed(FIXTURE_TIERS):
        tier = F.when(F.col("c_mktsegment") == seg, F.lit(label)).otherwise(tier)
    converts = k % 5 < 2
    out = j.select(
        k.cast("string").alias("addon_license_id"),
        _label("L", k).alias("license_id"),
        _label("E", k).alias("app_entitlement_number"),
        _label("H", cust).alias("host_license_id"),
        _label("HE", k % 997).alias("host_entitlement_number"),
        F.when(k % 3 == 0, _label(" cloud-", cust)).alias("cloud_id"),
        F.when(k % 3 == 0, F.concat(_label("site", cust), F.lit(".example.net"))).alias("cloud_site_hostname"),
        _label("app.", k % 3).alias("addon_key"),
        F.when(k % 41 == 0, F.lit("   "))
         .when(k % 4 == 0, F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")))
         .otherwise(F.col("c_name")).alias("company"),
        _pick(k % 3, FIXTURE_LICENSE_PRODUCTS).alias("addon_name"),
        _pick(k % 4, FIXTURE_HOSTING).alias("hosting"),
        F.when(k % 37 == 0, F.lit(None).cast("string"))
         .when(F.col("o_orderstatus") == "F", F.lit("inactive"))
         .otherwise(F.lit("Active")).alias("status"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
         .when(F.col("o_orderstatus") == "P", F.lit("Evaluation"))
         .otherwise(F.lit("COMMERCIAL")).alias("license_type"),
        tier.alias("tier"),
        _label("N", nation).alias("country"), _label("R", nation % 5).alias("region"),
        F.concat(_label("it", cust), F.lit("@example.net")).alias("tech_contact_email"),
        _label("Contact ", cust).alias("tech_contact_name"),
        F.col("o_orderpriority").alias("evaluation_opportunity_size"),
        F.when(k % 2 == 0, _label("EV", k)).alias("evaluation_license"),
        d.alias("maintenance_start_date"),
        F.when(k % 29 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_add(d, (F.lit(30) * (F.lit(1) + k % 13)).cast("int")))
         .alias("maintenance_end_date"),
        F.date_add(d, (k % 60 + F.col("copy") * 90).cast("int")).alias("last_updated"),
        F.when(converts, k % 23 + F.when(k % 7 == 0, F.lit(1)).otherwise(F.lit(0)))
         .alias("days_to_convert_eval"),
        F.when(k % 2 == 0, F.date_sub(d, 30)).alias("evaluation_start_date"),
        F.when(k % 2 == 0, d).alias("evaluation_end_date"),
        F.when(converts, F.date_add(F.date_sub(d, 30), (k % 23).cast("int"))).alias("evaluation_sale_date"),
        _label("channel ", k % 4).alias("channel"), _label("name ", k % 11).alias("campaign_name"),
        _label("source ", k % 13).alias("campaign_source"), _label("medium ", k % 7).alias("campaign_medium"),
        _label("content ", k % 5).alias("campaign_content"),
        _label("referrer ", k % 19).alias("referrer_domain"),
    )
    return conform(out, LICENSES_RAW)


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product events: January-2024 clicks spread back over the order years, users -> customers."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = e.join(c, c.c_custkey == F.floor(e.user_id / F.lit(3)), "left")
    eid, uid = F.col("event_id"), F.col("user_id")
    days = (F.lit(8220) + F.lit(30) * (eid % 80)).cast("int")
    out = j.select(
        eid.cast("string").alias("event_id"),
        _pick((eid * 7 + uid) % 31, FIXTURE_EVENT_TYPES, FIXTURE_OTHER_EVENT).alias("event_type"),
        (F.col("ts") - F.make_dt_interval(days=days)).alias("event_time"),
        _label("u", uid).alias("user_id"),
        _label("device ", uid * 2 + eid % 2).alias("device_id"),
        _pick(eid % 3, FIXTURE_PLATFORMS).alias("platform"), _label("source ", eid % 5).alias("event_source"),
        _pick((eid * 5 + uid) % 3, FIXTURE_EVENT_PRODUCTS).alias("product"),
        F.col("props").alias("event_properties"),
        F.when(eid % 53 == 0, F.lit(" "))
         .when(uid % 25 == 0, F.concat(F.lit("Ghost "), uid.cast("string")))
         .when(eid % 4 == 0, F.concat(F.lower("c_name"), F.lit(" ")))
         .otherwise(F.col("c_name")).alias("user_property_company"),
        _label("plan ", uid % 4).alias("user_property_plan"), _label("tier ", uid % 6).alias("user_property_tier"),
        (eid % 1000).cast("bigint").alias("session_id"),
        _label("N", uid % 25).alias("country"), _label("R", uid % 5).alias("region"),
    )
    return conform(out, EVENTS_RAW)


def transactions_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions: one per line item, on the licence of its order; amounts in whole cents, half of
    the refunds negative."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    ok, pk, sk, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    shipped = F.col("l_shipdate").cast("date")
    cents, percent = F.round(F.col("l_extendedprice") * 100).cast("bigint"), \
        F.round(F.col("l_discount") * 100).cast("bigint")
    refund = (rf == "R") & (ls == "F") & (line == 1)
    paid = F.floor(cents * (F.lit(100) - percent) / F.lit(100)).cast("bigint")
    out = li.select(
        F.concat(ok.cast("string"), F.lit("-"), line.cast("string"), F.lit("-"), pk.cast("string"))
         .alias("transaction_id"),
        ok.cast("string").alias("addon_license_id"),
        _label("L", ok).alias("license_id"),
        _label("E", ok).alias("app_entitlement_number"), _label("app.", ok % 3).alias("addon_key"),
        _pick(ok % 3, FIXTURE_SALE_PRODUCTS).alias("addon_name"),
        _pick(sk % 4, FIXTURE_HOSTING).alias("hosting"),
        F.when(pk % 97 == 0, F.lit(None).cast("date")).otherwise(shipped).alias("sale_date"),
        F.when(refund, F.lit("Refund"))
         .when((rf == "N") & (ls == "O"), F.lit("new"))
         .when((rf == "A") & (ls == "F"), F.lit("Upgrade"))
         .when(rf == "A", F.lit("Downgrade"))
         .otherwise(F.lit("Renewal")).alias("sale_type"),
        _money(cents, "0.01").alias("purchase_price"),
        _money(F.when(refund & (pk % 2 == 0), -paid).otherwise(paid), "0.01").alias("vendor_amount"),
        F.when(line % 2 == 0, F.lit("Annual")).otherwise(F.lit(" Monthly")).alias("billing_period"),
        _label("tier ", sk % 5).alias("tier"),
        shipped.alias("maintenance_start_date"), F.date_add(shipped, 30).alias("maintenance_end_date"),
        _label("channel ", sk % 3).alias("sale_channel"), _label("parent ", ok % 4).alias("parent_product_name"),
        _label("edition ", ok % 6).alias("parent_product_edition"),
        _money(F.round(F.col("l_tax") * 100), "0.25").alias("loyalty_discount"),
        _money(F.col("l_quantity"), "0.10").alias("marketplace_promotion_discount"),
        _money(line, "0.35").alias("expert_discount"), _money(sk % 10, "0.15").alias("manual_discount"),
    )
    return conform(out, raw_schema("transactions", FIXTURE_MONEY))


class _LazyInputs(dict):
    """Raw views built on first use (a query touching only licences never builds the others)."""

    _VIEWS = {"events": events_view, "licenses": licenses_view, "transactions": transactions_view}

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        view = self._VIEWS[name]
        df = _memo(self._spark, self._dir, f"view:{name}", lambda: view(self._spark, self._dir))
        self[name] = df
        return df

    def __contains__(self, name) -> bool:
        return name in self._VIEWS or super().__contains__(name)


def raw_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw sources over ``sf_dir``, built lazily and once per application."""
    return _LazyInputs(spark, sf_dir)
