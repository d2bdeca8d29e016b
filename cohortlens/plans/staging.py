"""Staging. Clean text, fix types and names; one row per raw row, no business logic.

Row-wise projections only: they fuse into the scan's whole-stage-codegen stage and add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import alias_map, clean_text, normalize_key

EVENT_TEXT = ("event_id", "event_type")
EVENT_TEXT_2 = ("user_id", "device_id", "platform", "event_source")
EVENT_TEXT_3 = ("event_properties", "user_property_company", "user_property_plan",
                "user_property_tier")


def stage_events(raw: DataFrame, cfg: Config = Config()) -> DataFrame:
    """15 columns; product short names mapped to canonical names (upper case, blank -> NULL)."""
    return raw.select(
        *[clean_text(c).alias(c) for c in EVENT_TEXT],
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        *[clean_text(c).alias(c) for c in EVENT_TEXT_2],
        alias_map("product", cfg.product_aliases).alias("product"),
        *[clean_text(c).alias(c) for c in EVENT_TEXT_3],
        F.col("session_id").cast("bigint").alias("session_id"),
        clean_text("country").alias("country"),
        clean_text("region").alias("region"),
    )


def stage_licenses(raw: DataFrame, cfg: Config = Config()) -> DataFrame:
    """33 columns; product name in key form; ``evaluation_license`` -> ``evaluation_license_id``."""
    text = lambda c, name=None: clean_text(c).alias(name or c)
    date = lambda c: F.col(c).cast("date").alias(c)
    return raw.select(
        text("addon_license_id"), text("license_id"), text("app_entitlement_number"),
        text("host_license_id"), text("host_entitlement_number"), text("cloud_id"),
        text("cloud_site_hostname"), text("addon_key"),
        normalize_key("addon_name").alias("addon_name"),
        text("hosting"), date("last_updated"), text("license_type"),
        date("maintenance_start_date"), date("maintenance_end_date"),
        text("status"), text("tier"), text("company"), text("country"), text("region"),
        text("tech_contact_email"), text("tech_contact_name"), text("evaluation_opportunity_size"),
        text("evaluation_license", "evaluation_license_id"),
        F.col("days_to_convert_eval").cast("bigint").alias("days_to_convert_eval"),
        date("evaluation_start_date"), date("evaluation_end_date"), date("evaluation_sale_date"),
        text("channel"), text("campaign_name"), text("campaign_source"), text("campaign_medium"),
        text("campaign_content"), text("referrer_domain"),
    )


def stage_transactions(raw: DataFrame, cfg: Config = Config()) -> DataFrame:
    """22 columns; amounts in ``cfg.money_type``; product name in key form so it joins the
    licences' (the original trimmed it only, losing mixed-case rows in the revenue join)."""
    text = lambda c: clean_text(c).alias(c)
    date = lambda c: F.col(c).cast("date").alias(c)
    money = lambda c: F.col(c).cast(cfg.money_type).alias(c)
    return raw.select(
        text("transaction_id"), text("addon_license_id"), text("license_id"),
        text("app_entitlement_number"), text("addon_key"),
        normalize_key("addon_name").alias("addon_name"),
        text("hosting"), date("sale_date"), text("sale_type"),
        money("purchase_price"), money("vendor_amount"),
        text("billing_period"), text("tier"),
        date("maintenance_start_date"), date("maintenance_end_date"),
        text("sale_channel"), text("parent_product_name"), text("parent_product_edition"),
        money("loyalty_discount"), money("marketplace_promotion_discount"),
        money("expert_discount"), money("manual_discount"),
    )
