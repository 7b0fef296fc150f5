"""NULL and unmatched segments, one-row cohorts, hash bootstrap, score events, wide tails."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import tails
from tidewatch.operators import drift, evaluate, inject, monitor, profile
from tidewatch.spec import FeatureSpec


def _cohorts(spark):
    """Segments a and NULL hold the same shifted data, b only a reference, c one row a cohort."""
    rows = []
    for i in range(60):
        for seg in ("a", None):
            rows += [(seg, "ref", float(i % 17), "x" if i % 3 else "y"), (seg, "cur", float(i % 17) + 9, "x" if i % 2 else "y")]
        rows.append(("b", "ref", float(i), "x"))
    rows += [("c", "ref", 1.0, "x"), ("c", "cur", 5.0, "x")]
    return spark.createDataFrame(rows, "seg string, cohort string, v double, c string")


def test_null_segment_is_a_segment(spark):
    spec = FeatureSpec(numerical=("v",), categorical=("c",), keys=("seg",))
    got = {(r.seg, r.feature): r for r in drift.feature_drift(_cohorts(spark), spec).collect()}
    assert len(got) == 8
    for f in ("v", "c"):
        a, null = got["a", f].asDict(), got[None, f].asDict()
        assert {k: v for k, v in a.items() if k != "seg"} == {k: v for k, v in null.items() if k != "seg"}
    assert got[None, "v"].drift_detected and got[None, "v"].ks_statistic > 0.5
    assert got["b", "v"].method == "insufficient_data" and not got["b", "v"].drift_detected


def test_one_row_cohort_has_no_effect_size(spark):
    spec = FeatureSpec(numerical=("v",), keys=("seg",))
    got = {r.seg: r for r in drift.feature_drift(_cohorts(spark), spec).collect()}
    assert got["c"].effect_size is None


def test_null_segment_in_auc_curve_and_boxplot(spark):
    df = spark.createDataFrame([(s, i % 2, i / 10 + (i % 2) * 3) for i in range(20) for s in ("a", None)], "seg string, label int, score double")
    auc = {r.seg: (r.n_pos, r.n_neg, r.roc_auc) for r in evaluate.roc_auc(df, keys=["seg"]).collect()}
    assert len(auc) == 2 and auc["a"] == auc[None] and auc["a"][0] == 10
    points = {r.seg: r.n for r in evaluate.roc_curve(df, keys=["seg"]).groupBy("seg").agg(F.count("*").alias("n")).collect()}
    assert points == {"a": 21, None: 21}
    box = {r.seg: (r.n, r.median, r.whisker_high) for r in profile.boxplot_stats(df, "seg", ["score"]).collect()}
    assert box["a"] == box[None] and box["a"][0] == 20


def test_hot_segment_is_dealt_by_bucket(spark):
    rows = spark.range(2000).select((F.col("id") % 1).cast("string").alias("seg"), F.concat(F.lit("v"), F.col("id") % 1).alias("feature"), F.col("id").cast("double").alias("value"),
                                    F.lit(1).cast("long").alias("c_ref"), F.lit(1).cast("long").alias("c_cur"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = drift.ecdf(rows, ["seg"], buckets=16)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert any("hashpartitioning(seg" in line and "bucket" in line for line in plan.splitlines())
        got = out.orderBy("value").collect()
        assert [r.cum_ref for r in got] == list(range(1, 2001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("n", [1, 63, 64, 65, 300])
def test_bucket_lookup_counts_smaller_bounds(spark, n):
    bounds = [float(i * 2) for i in range(n)]
    df = spark.range(-3, 2 * n + 5).select(F.col("id").cast("double").alias("v"), F.array(*[F.lit(b) for b in bounds]).alias("bounds"))
    for r in df.select("v", drift._bucket("bounds", F.col("v")).alias("k")).collect():
        assert r.k == sum(b < r.v for b in bounds)


def test_window_of_an_unknown_segment_is_reported(spark):
    t = dt.datetime(2024, 1, 1)
    cur = spark.createDataFrame([("a", t, 1.0), ("a", t, 2.0), ("new", t, 3.0), ("new", t, 4.0), (None, t, 2.0), (None, t, 3.0)], "seg string, ts timestamp_ntz, v double")
    ref = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 1.0), (None, 2.0)], "seg string, v double")
    win = monitor.window_moments(cur, ["v"], ["seg"], "ts")
    got = {r.seg: r for r in monitor.window_drift(win, monitor.reference_moments(ref, ["v"], ["seg"]), ["seg"]).collect()}
    assert got["new"].method == "insufficient_data" and got["new"].n_ref == 0 and not got["new"].drift_detected
    assert got["a"].method == got[None].method == "statistical_tests" and got[None].cohens_d is not None


def test_poisson_bootstrap_does_not_depend_on_partitions(spark):
    df = spark.range(5000)
    a, b = (sorted(r.id for r in inject.poisson_bootstrap(df.repartition(n), 0.5, F.col("id")).collect()) for n in (2, 7))
    assert a == b and abs(len(a) - 2500) < 200


def test_extended_cycle_scores_twice(spark):
    rows = [(c, 2, 0.5, True, c == 6, c == 8, False) for c in range(1, 9)] + [(9, 1, 0.2, False, False, False, False), (10, 2, 0.5, False, True, False, True)]
    cyc = spark.createDataFrame(rows, "cycle int, n_drifted_features int, share_drifted_features double, dataset_drift boolean, data_added boolean, retrained boolean, generation_failed boolean")
    got = {r.cycle: round(r.drift_score, 6) for r in monitor.drift_score(cyc).collect()}
    inc = 0.1 * 2 + 0.5 * 0.5 + 0.3
    assert got[5] == round(5 * inc, 6)
    assert got[6] == round(min(5.0, 7 * inc + 0.2), 6)  # before and after the generation
    assert got[8] == round(inc, 6)  # retrained just before
    assert got[9] == round(0.1 + 0.1, 6)  # no dataset flag: reset, then its own increment
    # a failed generation: the check resets, the fallback (1 feature, share 0.1) adds without a reset
    assert got[10] == round((0.2 + 0.25) + (0.1 + 0.05 + 0.2), 6)


def test_recent_retrain_counts_for_300_seconds(spark):
    t = dt.datetime(2024, 1, 1, 12)
    cycles = spark.createDataFrame([(k, t + dt.timedelta(minutes=10 * k)) for k in range(4)], "cycle int, at timestamp_ntz").withColumn("seg", F.lit(None).cast("string"))
    marks = spark.createDataFrame([(t + dt.timedelta(minutes=6),), (t + dt.timedelta(minutes=15),), (t + dt.timedelta(minutes=30),)], "retrained_at timestamp_ntz").withColumn("seg", F.lit(None).cast("string"))
    got = {r.cycle: r.retrained for r in monitor.with_recent_retrain(cycles, marks, ["seg"], "at").collect()}
    assert got == {0: False, 1: True, 2: False, 3: True}


@pytest.mark.parametrize("k", [1e5, 1e6, 1e7, 1e8])
def test_chi_square_tail_at_many_degrees(k):
    # Wilson-Hilferty with its next term is good to 1e-6 here; the median is k (1 - 2 / (9 k)) ** 3
    z = 2.0
    x = k * (1 - 2 / (9 * k) + z * math.sqrt(2 / (9 * k))) ** 3
    assert tails.chi2_upper(x, k) == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=2e-4)
    assert tails.chi2_upper(k * (1 - 2 / (9 * k)) ** 3, k) == pytest.approx(0.5, abs=1e-6)


def test_t_tail_joins_smoothly_and_reaches_the_normal():
    assert tails.t_two_sided(2.5, 999_999.0) == pytest.approx(tails.t_two_sided(2.5, 1_000_001.0), rel=1e-9)
    assert tails.t_two_sided(3.0, 1e12) == pytest.approx(math.erfc(3 / math.sqrt(2)), rel=1e-8)
    assert tails.f_upper(9.0, 1, 1e12) == pytest.approx(math.erfc(3 / math.sqrt(2)), rel=1e-8)


def test_halving_finds_the_bucket_of_the_counted_bounds(spark):
    values = [-math.inf, -1.0, 0.0, 0.5, 1.0, 2.5, 7.0, 99.0, math.inf, math.nan, None]
    for most in (0, 1, 2, 3, 7, 8, 64, 200):
        bounds = [float(i // 2) for i in range(most)]  # some bounds are equal
        df = spark.createDataFrame([(v, bounds) for v in values] + [(1.0, bounds[:1]), (1.0, None)], "value double, bounds array<double>")
        df = df.withColumn("counted", drift._bucket("bounds", F.col("value")))
        found = drift._with_bucket(df, most).where("value is not null and bounds is not null").select("bucket", "counted").collect()
        assert len(found) == len(values) and all(r["bucket"] == r["counted"] for r in found)


def test_sketch_of_the_bounds_runs_once_and_rows_move_once(spark):
    dv = spark.range(400).selectExpr("'a' AS feature", "CAST(id AS DOUBLE) AS value", "1L AS c_ref", "id % 3 AS c_cur", "0L AS n_failed")
    placed = drift._placed(dv, [], 1, 16, 16)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "percentile_approx" not in plan and "lambdafunction" not in plan
    assert plan.count("REPARTITION_BY_COL") == 1
    assert placed.agg(F.sum("off_ref"), F.count("*")).first()[1] == 400
