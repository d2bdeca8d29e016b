"""Explicit schemas of the three raw sources (types are those staging casts to)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, TS = T.StringType(), T.DateType(), T.LongType(), T.TimestampNTZType()
MONEY = T.DecimalType(38, 0)

EVENTS_RAW = T.StructType([
    T.StructField("event_id", S), T.StructField("event_type", S), T.StructField("event_time", TS),
    T.StructField("user_id", S), T.StructField("device_id", S), T.StructField("platform", S),
    T.StructField("event_source", S), T.StructField("product", S),
    T.StructField("event_properties", S), T.StructField("user_property_company", S),
    T.StructField("user_property_plan", S), T.StructField("user_property_tier", S),
    T.StructField("session_id", L), T.StructField("country", S), T.StructField("region", S),
])

LICENSES_RAW = T.StructType([
    T.StructField(n, S) for n in (
        "addon_license_id", "license_id", "app_entitlement_number", "host_license_id",
        "host_entitlement_number", "cloud_id", "cloud_site_hostname", "addon_key", "addon_name",
        "hosting")
] + [
    T.StructField("last_updated", D), T.StructField("license_type", S),
    T.StructField("maintenance_start_date", D), T.StructField("maintenance_end_date", D),
] + [
    T.StructField(n, S) for n in (
        "status", "tier", "company", "country", "region", "tech_contact_email",
        "tech_contact_name", "evaluation_opportunity_size", "evaluation_license")
] + [
    T.StructField("days_to_convert_eval", L), T.StructField("evaluation_start_date", D),
    T.StructField("evaluation_end_date", D), T.StructField("evaluation_sale_date", D),
] + [
    T.StructField(n, S) for n in (
        "channel", "campaign_name", "campaign_source", "campaign_medium", "campaign_content",
        "referrer_domain")
])

TRANSACTIONS_RAW = T.StructType([
    T.StructField(n, S) for n in (
        "transaction_id", "addon_license_id", "license_id", "app_entitlement_number", "addon_key",
        "addon_name", "hosting")
] + [
    T.StructField("sale_date", D), T.StructField("sale_type", S),
    T.StructField("purchase_price", MONEY), T.StructField("vendor_amount", MONEY),
    T.StructField("billing_period", S), T.StructField("tier", S),
    T.StructField("maintenance_start_date", D), T.StructField("maintenance_end_date", D),
    T.StructField("sale_channel", S), T.StructField("parent_product_name", S),
    T.StructField("parent_product_edition", S),
    T.StructField("loyalty_discount", MONEY), T.StructField("marketplace_promotion_discount", MONEY),
    T.StructField("expert_discount", MONEY), T.StructField("manual_discount", MONEY),
])

RAW_SCHEMAS = {"events": EVENTS_RAW, "licenses": LICENSES_RAW, "transactions": TRANSACTIONS_RAW}


def raw_schema(name: str, money_type: str = "decimal(38,0)") -> T.StructType:
    """The declared schema of a raw source with its money columns of ``money_type``."""
    precision, scale = (int(x) for x in money_type.strip()[len("decimal("):-1].split(","))
    money = T.DecimalType(precision, scale)
    return T.StructType([T.StructField(f.name, money if f.dataType == MONEY else f.dataType)
                         for f in RAW_SCHEMAS[name].fields])
