"""Drift operators: hand-computed tiny frames, edge cases, properties and a
numpy brute-force check on a small fixture."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import drift
from tidewatch.operators.cohorts import tag_cohorts, to_long
from tidewatch.plans import fixtures as fx
from tidewatch.spec import DriftThresholds, FeatureSpec

from conftest import SF_SMALL

EFFECT = DriftThresholds(effect_only=True)


def _frame(spark, ref, cur, col="x"):
    r = spark.createDataFrame([(float(v) if v is not None else None,) for v in ref], f"{col} double")
    c = spark.createDataFrame([(float(v) if v is not None else None,) for v in cur], f"{col} double")
    return tag_cohorts(r, c)


def _numeric(spark, ref, cur, buckets=1, with_p=False):
    df = _frame(spark, ref, cur)
    return drift.numeric_tests(to_long(df, ["x"]), (), 1, buckets, with_p=with_p).first()


def test_identical_cohorts_zero(spark):
    v = [1, 2, 2, 3, 5, 8, 13]
    row = _numeric(spark, v, v)
    assert row["ks_statistic"] == 0.0
    assert row["cohens_d"] == pytest.approx(0.0, abs=1e-12)
    assert row["wasserstein_distance"] == 0.0
    assert row["levene_statistic"] == pytest.approx(0.0, abs=1e-12)


def test_hand_computed_statistics(spark):
    ref, cur = [1, 2, 3, 4], [3, 4, 5, 6, 7]
    row = _numeric(spark, ref, cur)
    a, b = np.array(ref, float), np.array(cur, float)
    # KS: max |F1 - F2| over the pooled values
    grid = np.union1d(a, b)
    d = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    assert row["ks_statistic"] == pytest.approx(d)
    pooled = math.sqrt(((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2))
    assert row["cohens_d"] == pytest.approx((b.mean() - a.mean()) / pooled)
    t = (a.mean() - b.mean()) / math.sqrt(a.var(ddof=1) / len(a) + b.var(ddof=1) / len(b))
    assert row["t_statistic"] == pytest.approx(t)
    # Wasserstein = integral |F1 - F2|
    w = sum(abs((a <= g).mean() - (b <= g).mean()) * (g2 - g) for g, g2 in zip(grid[:-1], grid[1:]))
    assert row["wasserstein_distance"] == pytest.approx(w)
    assert row["normalized_distance"] == pytest.approx(w / (7 - 1))
    # Brown-Forsythe
    za, zb = np.abs(a - np.median(a)), np.abs(b - np.median(b))
    z = np.concatenate([za, zb])
    ssb = len(za) * (za.mean() - z.mean()) ** 2 + len(zb) * (zb.mean() - z.mean()) ** 2
    ssw = ((za - za.mean()) ** 2).sum() + ((zb - zb.mean()) ** 2).sum()
    assert row["levene_statistic"] == pytest.approx((len(z) - 2) * ssb / ssw)
    assert row["median_ref"] == 2.5 and row["median_cur"] == 5.0


def test_swap_negates_d_keeps_ks(spark):
    ref, cur = [1, 2, 3, 9], [2, 4, 6, 8, 10]
    a, b = _numeric(spark, ref, cur), _numeric(spark, cur, ref)
    assert a["cohens_d"] == pytest.approx(-b["cohens_d"])
    assert a["ks_statistic"] == pytest.approx(b["ks_statistic"])
    assert a["levene_statistic"] == pytest.approx(b["levene_statistic"])


def test_bucketed_ecdf_equals_plain_window(spark):
    df = fx.lineitem_cohorts(spark, SF_SMALL)
    long = to_long(df, fx.L_NUM)
    cols = ["feature", "ks_statistic", "wasserstein_distance", "median_ref", "median_cur", "levene_statistic",
            "cohens_d"]
    a = {r["feature"]: r for r in drift.numeric_tests(long, (), 4, 1, False).select(*cols).collect()}
    b = {r["feature"]: r for r in drift.numeric_tests(long, (), 4, 8, False).select(*cols).collect()}
    for f in fx.L_NUM:
        for c in cols[1:]:
            assert a[f][c] == pytest.approx(b[f][c], rel=1e-9, abs=1e-12), (f, c)


def test_scaled_bucket_count_same_statistics(spark, monkeypatch):
    """Data-scaled bucket counts (forced here with a tiny rows-per-bucket)
    give the same statistics as one plain window per feature."""
    df = fx.lineitem_cohorts(spark, SF_SMALL)
    long = to_long(df, fx.L_NUM)
    cols = ["feature", "ks_statistic", "wasserstein_distance", "median_ref", "median_cur", "levene_statistic",
            "cohens_d"]
    a = {r["feature"]: r for r in drift.numeric_tests(long, (), 4, 1, False).select(*cols).collect()}
    monkeypatch.setattr(drift, "ROWS_PER_BUCKET", 50)
    dv = drift.distinct_values(long)
    assert drift.scaled_buckets(dv, (), 16) > 16
    b = {r["feature"]: r for r in drift.numeric_tests(long, (), 4, 1, False).select(*cols).collect()}
    for f in fx.L_NUM:
        for c in cols[1:]:
            assert a[f][c] == pytest.approx(b[f][c], rel=1e-9, abs=1e-12), (f, c)


def levene(a, b):
    za, zb = np.abs(a - np.median(a)), np.abs(b - np.median(b))
    z = np.concatenate([za, zb])
    between = len(za) * (za.mean() - z.mean()) ** 2 + len(zb) * (zb.mean() - z.mean()) ** 2
    return (len(z) - 2) * between / (((za - za.mean()) ** 2).sum() + ((zb - zb.mean()) ** 2).sum())


@pytest.mark.parametrize("buckets", [1, 7])
@pytest.mark.parametrize("shape", ["two hills", "far", "skewed", "tied"])
def test_levene_keeps_its_digits(spark, buckets, shape):
    """Spreads that sums of squares would lose: distances of about 1e8 from the median."""
    rng = np.random.default_rng(5)

    def sample(n, spread):
        x = rng.normal(0, spread, n)
        return {"two hills": np.where(np.arange(n) % 2 == 0, -1e8, 1e8) + x, "far": 1e8 + x, "skewed": np.exp(3 * x / spread) * spread, "tied": np.round(x)}[shape]

    a, b = sample(1500, 1.0), sample(1001, 3.0)
    df = _frame(spark, a.tolist(), b.tolist())
    row = drift.numeric_tests(to_long(df, ["x"]), (), 1, buckets, with_p=False).first()
    assert row["levene_statistic"] == pytest.approx(levene(a, b), rel=1e-7 if shape == "two hills" else 1e-9)
    assert row["median_ref"] == np.median(a) and row["median_cur"] == np.median(b)
    assert row["var_ref"] == pytest.approx(a.var(ddof=1), rel=1e-9) and row["mean_cur"] == pytest.approx(b.mean(), rel=1e-12)


@pytest.mark.parametrize("buckets", [1, 4])
def test_segments_in_buckets_match_brute_force(spark, buckets):
    rng = np.random.default_rng(2)
    rows = [(None if g == 2 else f"g{g}", "ref" if i % 3 else "cur", float(np.round(rng.normal(g, 1 + g), 2)) if i % 11 else None) for g in range(4) for i in range(90 * (g + 1))]
    df = spark.createDataFrame(rows, "seg string, cohort string, x double")
    got = {r["seg"]: r for r in drift.numeric_tests(to_long(df, ["x"], ["seg"]), ("seg",), 1, buckets, with_p=False).collect()}
    for seg in {r[0] for r in rows}:
        a, b = (np.array([r[2] for r in rows if r[0] == seg and r[1] == c and r[2] is not None]) for c in ("ref", "cur"))
        grid = np.union1d(a, b)
        gap = np.abs(np.searchsorted(np.sort(a), grid, side="right") / len(a) - np.searchsorted(np.sort(b), grid, side="right") / len(b))
        r = got[seg]
        assert (r["n_ref"], r["n_cur"], r["median_ref"], r["median_cur"]) == (len(a), len(b), np.median(a), np.median(b))
        assert r["ks_statistic"] == pytest.approx(gap.max(), abs=1e-12)
        assert r["wasserstein_distance"] == pytest.approx((gap[:-1] * np.diff(grid)).sum(), rel=1e-9)
        assert r["levene_statistic"] == pytest.approx(levene(a, b), rel=1e-9)
        assert r["var_cur"] == pytest.approx(b.var(ddof=1), rel=1e-9)


def test_a_bad_feature_is_reported_and_the_others_are_judged(spark):
    ref = spark.createDataFrame([(float(i % 7), str(i), [i], f"c{i % 3}") for i in range(60)], "x double, s string, a array<int>, c string")
    cur = spark.createDataFrame([(float(i % 7) + 3, "n/a" if i == 5 else str(i), [i], f"c{i % 3}") for i in range(60)], "x double, s string, a array<int>, c string")
    spec = FeatureSpec(numerical=("x", "s", "a"), categorical=("c",))
    got = {r["feature"]: r for r in drift.feature_drift(tag_cohorts(ref, cur), spec).collect()}
    assert got["s"]["method"] == "error" and got["s"]["error"] == "1 values are no numbers" and got["s"]["ks_statistic"] is None
    assert got["a"]["method"] == "error" and got["a"]["error"] == "120 values are no numbers"
    assert not got["s"]["drift_detected"] and got["s"]["p_value"] == 1.0 and got["s"]["severity"] == "NONE"
    assert got["x"]["method"] == "statistical_tests" and got["x"]["drift_detected"] and got["x"]["error"] is None
    assert got["c"]["method"] == "categorical_tests"
    only_numbers = tag_cohorts(ref.drop("a"), cur.where("s <> 'n/a'").drop("a"))
    fine = {r["feature"]: r for r in drift.feature_drift(only_numbers, FeatureSpec(numerical=("s",))).collect()}
    assert fine["s"]["method"] == "statistical_tests" and fine["s"]["ks_statistic"] is not None
    features, dataset = drift.detect(tag_cohorts(ref, cur), spec)
    assert dataset.first()["total_features"] == 4 and dataset.first()["n_drifted_features"] == 1


def test_a_spread_only_shift_is_detected(spark):
    rng = np.random.default_rng(8)
    df = _frame(spark, rng.normal(5, 1, 800).tolist(), rng.normal(5, 1.4, 800).tolist())
    row = drift.feature_drift(df, FeatureSpec(numerical=("x",))).first()
    assert abs(row["effect_size"]) < 0.1 and row["levene_p_value"] < 0.001 and row["drift_detected"]


def test_brute_force_on_fixture(spark):
    pdf = fx.lineitem_cohorts(spark, SF_SMALL).toPandas()
    res = {r["feature"]: r for r in
           drift.numeric_tests(to_long(fx.lineitem_cohorts(spark, SF_SMALL), fx.L_NUM), (), 4, 16, False).collect()}
    for f in fx.L_NUM:
        a = pdf.loc[pdf.cohort == "ref", f].to_numpy(float)
        b = pdf.loc[pdf.cohort == "cur", f].to_numpy(float)
        grid = np.union1d(a, b)
        fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
        fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
        assert res[f]["ks_statistic"] == pytest.approx(np.abs(fa - fb).max(), abs=1e-12)
        w = (np.abs(fa - fb)[:-1] * np.diff(grid)).sum()
        assert res[f]["wasserstein_distance"] == pytest.approx(w, rel=1e-9)
        assert res[f]["mean_ref"] == pytest.approx(a.mean(), rel=1e-12)
        assert res[f]["var_cur"] == pytest.approx(b.var(ddof=1), rel=1e-9)


def test_insufficient_and_error_free(spark):
    df = _frame(spark, [1, 2, 3], [None, None])
    feats = drift.feature_drift(df, FeatureSpec(numerical=("x",)))
    row = feats.first()
    assert row["method"] == "insufficient_data"
    assert row["drift_detected"] is False and row["p_value"] == 1.0 and row["severity"] == "NONE"


def _cat(spark, ref, cur, th=drift.DEFAULT_THRESHOLDS):
    r = spark.createDataFrame([(v,) for v in ref], "c string")
    c = spark.createDataFrame([(v,) for v in cur], "c string")
    return drift.feature_drift(tag_cohorts(r, c), FeatureSpec(categorical=("c",)), th).first()


def test_low_count_fallback(spark):
    row = _cat(spark, ["a"] * 3 + ["b"] * 7, ["a"] * 6 + ["b"] * 4)
    assert row["method"] == "proportion_comparison"
    assert row["max_proportion_difference"] == pytest.approx(0.3)
    assert row["drift_detected"] is True and row["p_value"] == 0.05 and row["severity"] == "HIGH"


def test_yates_two_levels(spark):
    ref = ["y"] * 40 + ["n"] * 60
    cur = ["y"] * 55 + ["n"] * 45
    row = _cat(spark, ref, cur)
    obs = np.array([[40, 60], [55, 45]], float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    chi = (np.maximum(np.abs(obs - exp) - 0.5, 0) ** 2 / exp).sum()
    assert row["chi2_statistic"] == pytest.approx(chi)
    assert row["chi2_dof"] == 1
    p = np.array([0.6, 0.4]), np.array([0.45, 0.55])
    assert row["psi"] == pytest.approx(abs(((p[1] - p[0]) * np.log(p[1] / p[0])).sum()))


def test_severity_ladders_and_rollup(spark):
    rows = [("a", True, "HIGH"), ("b", False, "HIGH"), ("c", False, "NONE"), ("d", True, "LOW")]
    f = spark.createDataFrame(rows, "feature string, drift_detected boolean, severity string")
    d = drift.dataset_drift(f).first()
    assert d["n_drifted_features"] == 2 and d["high_severity_features"] == 2
    assert d["dataset_drift"] and d["critical_drift"]  # 2 > 0.4 and 2 > 1.0
    assert d["severity_level"] == "RED"
    h = drift.drift_health(drift.dataset_drift(f)).first()
    assert h["passed_tests"] == 0 and h["overall_health"] == "CRITICAL"


def test_high_severity_without_detection_counts_red(spark):
    # HIGH severity may coexist with drift_detected = false and still drives the light
    f = spark.createDataFrame([(f"f{i}", False, "HIGH" if i < 2 else "NONE") for i in range(20)],
                              "feature string, drift_detected boolean, severity string")
    assert drift.dataset_drift(f).first()["severity_level"] == "RED"


def test_injected_shift_detected(spark):
    from tidewatch.plans.inject_plans import _lstar

    feats = drift.feature_drift(_lstar(spark, SF_SMALL), fx.L_SPEC, EFFECT)
    by = {r["feature"]: r for r in feats.collect()}
    assert by["l_quantity"]["drift_detected"] and by["l_extendedprice"]["drift_detected"]
    assert drift.dataset_drift(feats).first()["severity_level"] in ("RED", "ORANGE")


def test_full_rule_with_pvalues(spark):
    df = fx.lineitem_cohorts(spark, SF_SMALL)
    feats, ds = drift.detect(df, fx.L_SPEC)
    rows = feats.collect()
    assert len(rows) == 6
    for r in rows:
        if r["feature_type"] == "numerical":
            assert 0.0 <= r["ks_p_value"] <= 1.0 and 0.0 <= r["t_p_value"] <= 1.0
    assert ds.first()["total_features"] == 6


def test_keyed_segments(spark):
    e = fx.events_cohorts(spark, SF_SMALL)
    feats = drift.feature_drift(e, FeatureSpec(numerical=("value",), keys=("event_type",)), EFFECT)
    assert feats.select("event_type").distinct().count() == 5


def test_type_inference_router(spark):
    df = fx.lineitem_cohorts(spark, SF_SMALL)
    t = {r["feature"]: r["feature_type"] for r in
         drift.infer_feature_types(df, ["l_extendedprice", "l_returnflag", "l_tax"]).collect()}
    assert t == {"l_extendedprice": "numerical", "l_returnflag": "categorical", "l_tax": "categorical"}
