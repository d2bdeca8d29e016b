"""Column helpers (B01-B03, B15, B17, B18) and the semantic traps they guard."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.config import DEFAULT_PRODUCT_ALIASES, DEFAULT_TIER_LIMITS
from cohortlens.functions import (alias_map, clean_text, flags_sum, normalize_key, pattern_map,
                                  recency_points, safe_ratio, saturating_ratio, tier_label)


def one_col(spark, values, typ=T.StringType()):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", typ)]))


def test_clean_text_blank_to_null(spark):
    df = one_col(spark, ["  a b  ", "", "   ", None, "x"])
    assert [r[0] for r in df.select(clean_text("x")).collect()] == ["a b", None, None, None, "x"]


def test_clean_text_casts_numbers(spark):
    df = one_col(spark, [100884, None], T.LongType())
    assert [r[0] for r in df.select(clean_text("x")).collect()] == ["100884", None]


def test_trim_strips_blanks_only(spark):
    # Spark's trim removes spaces only; a tab survives, like the warehouse's trim.
    df = one_col(spark, ["\tx "])
    assert df.select(clean_text("x")).first()[0] == "\tx"


def test_normalize_key(spark):
    df = one_col(spark, ["  acme corp ", "ACME CORP", "  ", None])
    assert [r[0] for r in df.select(normalize_key("x")).collect()] == [
        "ACME CORP", "ACME CORP", None, None]


def test_alias_map(spark):
    aliases = (("ALPHA", "ALPHA SUITE"), ("BETA", "BETA SUITE"))
    df = one_col(spark, ["alpha", " Beta ", "ALPHA SUITE", "other thing", " ", None])
    got = [r[0] for r in df.select(alias_map("x", aliases)).collect()]
    assert got == ["ALPHA SUITE", "BETA SUITE", "ALPHA SUITE", "OTHER THING", None, None]
    assert [r[0] for r in df.select(alias_map("x", DEFAULT_PRODUCT_ALIASES)).collect()][:2] == [
        "ALPHA", "BETA"]


def test_money_cast_rounds_half_up(spark):
    # A scale-0 money type rounds cents away, half away from zero.
    df = one_col(spark, [12.5, -2.5, 12.49], T.DoubleType())
    got = [r[0] for r in df.select(F.col("x").cast("decimal(38,0)")).collect()]
    assert got == [Decimal(13), Decimal(-3), Decimal(12)]


def test_key_read_as_double_breaks_text(spark):
    # A licence key inferred as double prints with '.0' and would not join its text twin.
    df = one_col(spark, [100884.0], T.DoubleType())
    assert df.select(clean_text("x")).first()[0] == "100884.0"


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [0.5, None, None]


def test_saturating_ratio_keeps_null(spark):
    # T5: Spark's least skips NULL; the helper keeps a NULL ratio NULL instead of the cap.
    df = spark.createDataFrame([(5, 10), (50, 10), (5, 0)], "u int, l int")
    got = [r[0] for r in df.select(saturating_ratio("u", "l", 25)).collect()]
    assert got == [12.5, 25.0, None]
    assert spark.range(1).select(F.least(F.lit(25), F.lit(None).cast("int"))).first()[0] == 25


def test_pattern_map_first_match_and_null(spark):
    df = one_col(spark, ["Free", "Professional", "Premium", "Enterprise", "Gold", None])
    got = [r[0] for r in df.select(pattern_map("x", DEFAULT_TIER_LIMITS, 50, None)).collect()]
    assert got == [10, 50, 100, 250, 50, None]


def test_flags_sum_and_tier_label(spark):
    df = spark.createDataFrame([(1, 0, None, 3)], "a int, b int, c int, d int")
    assert df.select(flags_sum(["a", "b", "c", "d"])).first()[0] == 2
    s = spark.createDataFrame([(80.0,), (75.0,), (40.0,), (39.9,)], "s double")
    got = [r[0] for r in s.select(tier_label("s", ((75, "healthy"), (40, "at_risk")), "critical")).collect()]
    assert got == ["healthy", "healthy", "at_risk", "critical"]


def test_recency_points_bands(spark):
    df = spark.createDataFrame([("2001-07-15",), ("2001-06-10",), ("2001-05-10",), ("2000-01-01",),
                                (None,)], "d string").select(F.to_date("d").alias("d"))
    as_of = F.lit("2001-08-01").cast("date")
    got = [r[0] for r in df.select(recency_points("d", as_of, ((30, 25), (60, 15), (90, 5)))).collect()]
    assert got == [25, 15, 5, 0, 0]


def test_not_in_drops_null(spark):
    # NOT IN drops NULL event types too.
    from cohortlens.operators import exclude_values
    df = one_col(spark, ["a", "automated_test_run", None])
    assert [r[0] for r in exclude_values(df, "x", ["automated_test_run"]).collect()] == ["a"]
