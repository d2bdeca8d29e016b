"""DataFrame building blocks (B04-B14, B16), including rewrites against their naive forms."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from cohortlens.operators import (active_by_month, attach_group_avg, cohort_conversion,
                                  conditional_counts, first_period, latest_per_key, month_spine,
                                  outcome_label, period_delta, resolve_entities,
                                  without_successor, without_successor_within)


def test_latest_per_key_nulls_last_and_string_order(spark):
    df = spark.createDataFrame([
        ("A", "2020-01-01", "L9"), ("A", "2020-01-01", "L10"), ("A", None, "L99"),
        ("B", None, "L1"), ("B", None, None),
    ], "k string, u string, id string").withColumn("u", F.to_date("u"))
    out = latest_per_key(df, ["k"], [F.col("u").desc_nulls_last(), F.col("id").desc_nulls_last()])
    got = {r.k: r.id for r in out.collect()}
    # 'L9' > 'L10' as text; NULL dates and ids sort last.
    assert got == {"A": "L9", "B": "L1"}


def test_latest_per_key_full_tie_is_deterministic(spark):
    df = spark.createDataFrame([("A", 1, "x"), ("A", 1, "y")], "k string, o int, v string")
    out = latest_per_key(df, ["k"], [F.col("o").desc()])
    assert [r.v for r in out.collect()] == ["x"]


def test_resolve_entities_null_keys_stay_right_only(spark):
    left = spark.createDataFrame([("A", "P", 1), ("B", "P", 2), ("C", None, 3)],
                                 "c string, p string, l int")
    right = spark.createDataFrame([("A", "P", 10), (None, "P", 20), ("D", "P", 30), ("C", None, 40)],
                                  "c string, p string, r int")
    out = resolve_entities(left, right, ["c", "p"], "m", ("both", "left", "right"))
    key = lambda t: tuple("" if x is None else str(x) for x in t)
    got = sorted(((r.c, r.p, r.l, r.r, r.m) for r in out.collect()), key=key)
    assert got == sorted([("A", "P", 1, 10, "both"), ("B", "P", 2, None, "left"),
                          ("C", None, 3, None, "left"), (None, "P", None, 20, "right"),
                          ("D", "P", None, 30, "right"), ("C", None, None, 40, "right")], key=key)


def test_attach_group_avg_repeated_rows_and_null_groups(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 20.0), (None, 3, 5.0), ("b", 4, None)], "k string, i int, v double")
    rows = attach_group_avg(df.union(df.limit(1)), ["k"], {"m": "v"}, salt=3).collect()
    assert len(rows) == 5 and rows[0].asDict().keys() == {"k", "i", "v", "m"}
    assert {(r.i, r.m) for r in rows} == {(1, 40 / 3), (2, 40 / 3), (3, 5.0), (4, None)}


def test_conditional_counts_zero_not_null(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y")], "k string, e string")
    out = conditional_counts(df, ["k"], {"n_x": F.col("e") == "x"})
    assert {r.k: r.n_x for r in out.collect()} == {"a": 1, "b": 0}


def _random_intervals(seed=7, n=400):
    rnd = random.Random(seed)
    rows = []
    base = dt.date(2000, 1, 1)
    for i in range(n):
        s = base + dt.timedelta(days=rnd.randrange(0, 900))
        e = None if rnd.random() < 0.1 else s + dt.timedelta(days=rnd.randrange(-40, 400))
        rows.append((f"C{rnd.randrange(0, 40)}", f"P{rnd.randrange(0, 3)}",
                     rnd.choice(["Active", "inactive", "ACTIVE", None]), s, e, f"L{i}"))
    return rows


def _interval_frame(spark, rows):
    return spark.createDataFrame(rows, "company string, addon_name string, status string, "
                                       "maintenance_start_date date, maintenance_end_date date, "
                                       "license_id string")


def test_active_by_month_equals_theta_join(spark):
    """B08 rewrite (exploded months + semi-join) = the naive interval join."""
    iv = _interval_frame(spark, _random_intervals())
    iv.createOrReplaceTempView("iv")
    naive = spark.sql("""
      WITH spine AS (SELECT DISTINCT trunc(maintenance_start_date, 'MM') AS month FROM iv)
      SELECT m.month, s.addon_name, count(DISTINCT s.company) AS n
      FROM iv s JOIN spine m
        ON s.maintenance_start_date <= last_day(m.month)
       AND coalesce(s.maintenance_end_date, DATE '2999-12-31') >= m.month
      WHERE upper(s.status) = 'ACTIVE'
        AND coalesce(s.maintenance_end_date, DATE '2999-12-31') >= last_day(m.month)
      GROUP BY 1, 2""")
    spine = month_spine(iv, "maintenance_start_date")
    fast = active_by_month(iv.filter(F.upper("status") == "ACTIVE"), spine, ["addon_name"],
                           "company", "maintenance_start_date", "maintenance_end_date",
                           out="n")
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, naive.collect()))
    assert "CartesianProduct" not in fast._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in fast._jdf.queryExecution().executedPlan().toString()


def test_without_successor_equals_not_exists(spark):
    """B10 rewrite (per-key latest start) = the correlated NOT EXISTS."""
    iv = _interval_frame(spark, _random_intervals(seed=11))
    iv.createOrReplaceTempView("iv2")
    naive = spark.sql("""
      SELECT license_id FROM iv2 s
      WHERE s.maintenance_end_date IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM iv2 n WHERE n.company = s.company AND n.addon_name = s.addon_name
          AND n.maintenance_start_date > s.maintenance_end_date AND upper(n.status) = 'ACTIVE'
          AND coalesce(n.maintenance_end_date, DATE '2999-12-31') >= n.maintenance_start_date)""")
    valid = (F.upper("status") == "ACTIVE") & (
        F.coalesce("maintenance_end_date", F.lit(dt.date(2999, 12, 31))) >= F.col("maintenance_start_date"))
    fast = without_successor(iv, iv, ["company", "addon_name"], "maintenance_end_date",
                             "maintenance_start_date", valid).select("license_id")
    assert sorted(r[0] for r in fast.collect()) == sorted(r[0] for r in naive.collect())


def test_same_day_renewal_counts_as_churn(spark):
    # A renewal starting the day the old licence ends is not "strictly after" -> churn.
    rows = [("C", "P", "Active", dt.date(2020, 1, 1), dt.date(2020, 6, 30), "L1"),
            ("C", "P", "Active", dt.date(2020, 6, 30), dt.date(2020, 12, 31), "L2")]
    iv = _interval_frame(spark, rows)
    valid = F.upper("status") == "ACTIVE"
    out = without_successor(iv, iv, ["company", "addon_name"], "maintenance_end_date",
                            "maintenance_start_date", valid)
    assert sorted(r.license_id for r in out.collect()) == ["L1", "L2"]


def test_first_period_counts_each_key_once(spark):
    iv = _interval_frame(spark, _random_intervals(seed=3))
    out = first_period(iv, ["company", "addon_name"], "maintenance_start_date", ["addon_name"], out="n")
    total = sum(r.n for r in out.collect())
    assert total == iv.select("company", "addon_name").distinct().count()


def test_period_delta_uses_previous_present_row(spark):
    # Lag is the previous present month, not the calendar month.
    df = spark.createDataFrame([("P", "2020-01-01", 5), ("P", "2020-03-01", 8), ("Q", "2020-01-01", 1)],
                               "p string, m string, v int")
    out = period_delta(df, ["p"], "m", "v", "d")
    assert {(r.p, r.m): r.d for r in out.collect()} == {
        ("P", "2020-01-01"): None, ("P", "2020-03-01"): 3, ("Q", "2020-01-01"): None}


def test_cohort_conversion(spark):
    df = spark.createDataFrame([
        ("A", True, True, 10), ("A", True, True, 20), ("A", True, False, None), ("A", False, True, 99),
        ("B", False, False, None),
    ], "g string, t boolean, c boolean, d bigint")
    out = {r.g: r for r in cohort_conversion(df, ["g"], "t", "c", "d").collect()}
    a = out["A"]
    assert (a.trials_started, a.trials_converted) == (3, 2)
    assert abs(a.conversion_rate - 2 / 3) < 1e-12
    # mean and median run over converted rows, trial or not (as the original)
    assert a.avg_days_to_convert == (10 + 20 + 99) / 3 and a.median_days_to_convert == 20.0
    b = out["B"]
    assert b.trials_started == 0 and b.conversion_rate is None and b.median_days_to_convert is None


def test_attach_group_avg_null_group(spark):
    df = spark.createDataFrame([("P", 1), ("P", 3), (None, 10), (None, 20)], "p string, v int")
    out = attach_group_avg(df, ["p"], {"avg_v": "v"})
    assert sorted((r.p or "", r.v, r.avg_v) for r in out.collect()) == [
        ("", 10, 15.0), ("", 20, 15.0), ("P", 1, 2.0), ("P", 3, 2.0)]


def test_outcome_label_precedence(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (None, None)], "conv int, churn int")
    lab = outcome_label([(F.col("conv") == 1, "converted"), (F.col("churn") == 1, "churned")],
                        "active_trial")
    assert [r[0] for r in df.select(lab).collect()] == ["converted", "churned", "active_trial"]


def test_sweep_line_unites_an_entitys_intervals(spark):
    """Nested, touching, overlapping and repeated intervals of one entity count once a month."""
    d = dt.date
    rows = [("A", "P", "x", d(2020, 1, 5), d(2020, 6, 30), "1"), ("A", "P", "x", d(2020, 2, 1), d(2020, 3, 31), "2"),
            ("A", "P", "x", d(2020, 7, 1), d(2020, 7, 31), "3"), ("A", "P", "x", d(2020, 1, 5), d(2020, 6, 30), "4"),
            ("A", "P", "x", d(2020, 5, 1), None, "5"), ("B", "P", "x", d(2020, 3, 2), d(2020, 3, 31), "6"),
            ("B", "P", "x", d(2020, 9, 1), d(2020, 9, 29), "7"), (None, "P", "x", d(2020, 1, 1), None, "8"),
            ("C", None, "x", d(2020, 9, 1), d(2020, 9, 30), "9"), ("D", "P", "x", d(2021, 1, 1), d(2020, 1, 1), "10")]
    iv = _interval_frame(spark, rows)
    spine = month_spine(iv, "maintenance_start_date")
    got = {(r.addon_name, str(r.month)): r.n for r in active_by_month(
        iv, spine, ["addon_name"], "company", "maintenance_start_date", "maintenance_end_date", out="n").collect()}
    assert got == {("P", "2020-01-01"): 1, ("P", "2020-02-01"): 1, ("P", "2020-03-01"): 2, ("P", "2020-05-01"): 1,
                   ("P", "2020-07-01"): 1, ("P", "2020-09-01"): 1, ("P", "2021-01-01"): 1, (None, "2020-09-01"): 1}


def test_successor_within_equals_correlated_not_exists(spark):
    rows = _random_intervals(seed=11, n=700)
    rows += [(None, "P0", "ACTIVE", dt.date(2000, 1, 1), dt.date(2000, 2, 1), "n1"), (None, "P0", "ACTIVE", dt.date(2000, 2, 10), None, "n2")]
    iv = _interval_frame(spark, rows)
    iv.createOrReplaceTempView("ivw")
    for days in (0, 1, 30, 400):
        naive = spark.sql(f"""SELECT * FROM ivw c WHERE maintenance_end_date IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM ivw s WHERE s.company = c.company AND s.addon_name = c.addon_name AND upper(s.status) = 'ACTIVE'
            AND s.maintenance_start_date > c.maintenance_end_date AND s.maintenance_start_date <= date_add(c.maintenance_end_date, {days}))""")
        got = without_successor_within(iv, iv, ["company", "addon_name"], "maintenance_end_date", "maintenance_start_date",
                                       days, F.upper("status") == "ACTIVE")
        assert got.columns == iv.columns
        assert sorted(r.license_id for r in got.collect()) == sorted(r.license_id for r in naive.collect()), days


def test_median_of_a_million_distinct_values(spark):
    n = 1_000_000
    df = spark.range(n + 5).select(
        F.when(F.col("id") < n, "hot").otherwise("cold").alias("g"), F.lit(True).alias("t"), (F.col("id") != 3).alias("c"),
        (F.col("id") * 7 % 1_000_003).alias("d"))
    out = cohort_conversion(df, ["g"], "t", "c", "d")
    got = {r.g: r for r in out.collect()}
    values = sorted(i * 7 % 1_000_003 for i in range(n) if i != 3)
    assert got["hot"].median_days_to_convert == values[(n - 1) // 2] and got["hot"].trials_converted == n - 1
    assert abs(got["hot"].avg_days_to_convert - sum(values) / len(values)) < 1e-6
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in p and "percentile" not in p


def test_median_between_repeated_values(spark):
    rows = [("a", v) for v in (1, 1, 1, 8)] + [("b", 5)] + [("c", v) for v in (2, 2, 3, 3)] + [("d", None)] + [(None, 4), (None, 7)]
    df = spark.createDataFrame([(g, True, v is not None, v) for g, v in rows], "g string, t boolean, c boolean, d bigint")
    got = {r.g: r.median_days_to_convert for r in cohort_conversion(df, ["g"], "t", "c", "d").collect()}
    assert got == {"a": 1.0, "b": 5.0, "c": 2.5, "d": None, None: 5.5}


def test_key_check_finds_a_repeated_key_without_a_job_of_its_own(spark):
    from cohortlens.operators import KeyCheck
    left = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "k string, l int")
    right = spark.createDataFrame([("A", 1), ("C", 2), (None, 3)], "k string, r int")
    tracker = spark.sparkContext.statusTracker()
    for twice, side in ((None, None), ("right", "right"), ("left", "left")):
        a, b = (x.union(x.filter("k = 'A'")) if twice == n else x for x, n in ((left, "left"), (right, "right")))
        check = KeyCheck("j")
        out = resolve_entities(a, b, ["k"], "m", ("both", "left", "right"), check)
        spark.sparkContext.setJobGroup(f"keys-{twice}", "")
        out.write.format("noop").mode("overwrite").save()
        jobs = len(tracker.getJobIdsForGroup(f"keys-{twice}"))
        if twice is None:
            assert check.verify()["joined"] == 5
        else:
            import pytest
            with pytest.raises(ValueError, match=f"the {side} side repeats a key"):
                check.verify()
        assert len(tracker.getJobIdsForGroup(f"keys-{twice}")) == jobs
    spark.sparkContext._jsc.clearJobGroup()
