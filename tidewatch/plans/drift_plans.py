"""Registered drift plans on the L / E / O cohorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import drift
from tidewatch.operators.cohorts import to_long
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import r, register
from tidewatch.plans.sqlparts import categorical_ctes, effect_verdict_sql, numeric_ctes, sev_effect_sql
from tidewatch.spec import DriftThresholds

EFFECT = DriftThresholds(effect_only=True)

L_NUM_SQL = f"WITH {fx.L_SQL},\nlg AS (\n  {fx.long_sql('l', fx.L_NUM)}),{numeric_ctes('lg')}"
L_CAT_SQL = f"WITH {fx.L_SQL},\nlc AS (\n  {fx.long_sql('l', fx.L_CAT, True)}),{categorical_ctes('lc')}"
O_CAT_SQL = f"WITH {fx.O_SQL},\nlc AS (\n  {fx.long_sql('o', fx.O_CAT, True)}),{categorical_ctes('lc')}"
E_CAT_SQL = f"WITH {fx.E_SQL},\nlc AS (\n  {fx.long_sql('e', fx.E_CAT, True)}),{categorical_ctes('lc')}"


def _l_numeric(spark, sf, buckets=16, with_p=False):
    df = fx.lineitem_cohorts(spark, sf)
    return drift.numeric_tests(to_long(df, fx.L_NUM), (), len(fx.L_NUM), buckets, with_p=with_p)


def _cat(df, feats, keys=(), with_p=False):
    counts = drift.category_counts(to_long(df, feats, keys, as_string=True), keys)
    return drift.categorical_tests(counts, keys, len(feats), with_p=with_p)


# ------------------------------------------------------------------ H2
@register("cohens_d", L_NUM_SQL + """
SELECT feature, n_ref, n_cur, round(mean_ref, 6) AS mean_ref, round(mean_cur, 6) AS mean_cur,
  round(sqrt(var_ref), 6) AS sd_ref, round(sqrt(var_cur), 6) AS sd_cur,
  round(pooled_sd, 6) AS pooled_sd, round(cohens_d, 6) AS cohens_d
FROM md""")
def q_cohens_d(spark, sf):
    df = fx.lineitem_cohorts(spark, sf)
    m = drift.with_cohens_d(drift.numeric_moments(to_long(df, fx.L_NUM)))
    return m.select("feature", "n_ref", "n_cur", r("mean_ref"), r("mean_cur"),
                    r(F.sqrt("var_ref"), "sd_ref"), r(F.sqrt("var_cur"), "sd_cur"), r("pooled_sd"), r("cohens_d"))


# ------------------------------------------------------------------ H3
@register("welch_t", L_NUM_SQL + """
SELECT feature, round(t_statistic, 6) AS t_statistic, round(t_df, 4) AS t_df FROM md""")
def q_welch_t(spark, sf):
    df = fx.lineitem_cohorts(spark, sf)
    m = drift.with_welch(drift.numeric_moments(to_long(df, fx.L_NUM)))
    return m.select("feature", r("t_statistic"), r("t_df", digits=4))


# ------------------------------------------------------------------ H1
@register("ks_statistic", L_NUM_SQL + """
SELECT feature, round(ks_statistic, 6) AS ks_statistic FROM ks""")
def q_ks_statistic(spark, sf):
    return _l_numeric(spark, sf).select("feature", r("ks_statistic"))


# asymptotic Kolmogorov series Q(sqrt(en) D) = 2 sum_{k=1..100} (-1)^(k-1) exp(-2 k^2 x^2),
# 1 when the argument is below 0.2 (series form, comparable in SQL)
def _ks_series(lam):
    sq = lam * lam
    terms = F.lit(0.0)
    for k in range(1, 101):
        terms = terms + F.lit(1.0 if k % 2 == 1 else -1.0) * F.exp(F.lit(-2.0 * k * k) * sq)
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * terms)))


@register("ks_pvalue", L_NUM_SQL + """,
lam AS (
  SELECT ks.feature, ks.ks_statistic,
    sqrt(md.n_ref * md.n_cur / (md.n_ref + md.n_cur)) * ks.ks_statistic AS x
  FROM ks JOIN md ON ks.feature = md.feature)
SELECT feature, round(ks_statistic, 6) AS ks_statistic, round(x, 6) AS ks_lambda,
  round(CASE WHEN x < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
    2 * (SELECT sum(CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * k * k * x * x)) FROM range(1, 101) t(k))))
  END, 6) AS ks_p_value
FROM lam""")
def q_ks_pvalue(spark, sf):
    t = _l_numeric(spark, sf)
    lam = F.sqrt(F.col("n_ref").cast("double") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur"))) * F.col("ks_statistic")
    return t.select("feature", r("ks_statistic"), r(lam, "ks_lambda"), r(_ks_series(lam), "ks_p_value"))


# ------------------------------------------------------------------ H4
@register("levene_w", L_NUM_SQL + """
SELECT feature, round(median_ref, 6) AS median_ref, round(median_cur, 6) AS median_cur,
  round(levene_statistic, 6) AS levene_statistic FROM lev""")
def q_levene_w(spark, sf):
    return _l_numeric(spark, sf).select("feature", r("median_ref"), r("median_cur"), r("levene_statistic"))


# ------------------------------------------------------------------ H4 far from zero: two hills at -1e8 and 1e8, spreads that differ by cohort
_FAR_SQL = ("CASE WHEN l_linenumber % 2 = 0 THEN -1e8 ELSE 1e8 END + {v} * CASE WHEN cohort = 'cur' THEN 3 ELSE 1 END")
FAR_SQL = f"WITH {fx.L_SQL},\nlg AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT cohort, '{f}' AS feature, {_FAR_SQL.format(v=f)} AS value FROM l" for f in ("l_quantity", "l_discount")) + f"),{numeric_ctes('lg')}"


@register("levene_far", FAR_SQL + """
SELECT feature, n_ref, n_cur, round(levene_statistic, 2) AS levene_statistic FROM lev JOIN m USING (feature)""")
def q_levene_far(spark, sf):
    df = fx.lineitem_cohorts(spark, sf, ("l_linenumber",))
    hill = F.when(F.col("l_linenumber") % 2 == 0, -1e8).otherwise(1e8)
    wide = F.when(F.col("cohort") == "cur", 3).otherwise(1)
    df = df.select("cohort", *[(hill + F.col(f) * wide).alias(f) for f in ("l_quantity", "l_discount")])
    t = drift.numeric_tests(to_long(df, ("l_quantity", "l_discount")), (), 2, with_p=False)
    return t.select("feature", "n_ref", "n_cur", r("levene_statistic", digits=2))


# ------------------------------------------------------------------ H5
@register("wasserstein", L_NUM_SQL + """
SELECT feature, round(wasserstein_distance, 6) AS wasserstein_distance,
  round(normalized_distance, 6) AS normalized_distance FROM num""")
def q_wasserstein(spark, sf):
    return _l_numeric(spark, sf).select("feature", r("wasserstein_distance"), r("normalized_distance"))


# ------------------------------------------------------------------ H6 (O: 3 and 5 levels; L: 2 and 3)
@register("chi_square", O_CAT_SQL + """
SELECT feature, n_ref, n_cur, n_categories, chi2_dof, round(chi2_statistic, 6) AS chi2_statistic FROM cat""")
def q_chi_square(spark, sf):
    t = _cat(fx.orders_cohorts(spark, sf), fx.O_CAT)
    return t.select("feature", "n_ref", "n_cur", "n_categories", "chi2_dof", r("chi2_statistic"))


@register("chi_square_yates", L_CAT_SQL + """
SELECT feature, n_categories, chi2_dof, round(chi2_statistic, 6) AS chi2_statistic FROM cat""")
def q_chi_square_yates(spark, sf):
    t = _cat(fx.lineitem_cohorts(spark, sf), fx.L_CAT)
    return t.select("feature", "n_categories", "chi2_dof", r("chi2_statistic"))


# ------------------------------------------------------------------ H8
@register("psi", E_CAT_SQL + """
SELECT feature, round(psi, 6) AS psi, round(max_proportion_difference, 6) AS max_proportion_difference FROM cat""")
def q_psi(spark, sf):
    t = _cat(fx.events_cohorts(spark, sf), fx.E_CAT)
    return t.select("feature", r("psi"), r("max_proportion_difference"))


# ------------------------------------------------------------------ H7 (segments: one per user)
PF_SQL = (f"WITH {fx.E_SQL},\nlc AS (\n  {fx.long_sql('e', fx.E_CAT, True, ('user_id',))}),"
          f"{categorical_ctes('lc', ('user_id',))}" + """
SELECT user_id, feature, n_ref, n_cur, low_count,
  CASE WHEN low_count THEN 'proportion_comparison' ELSE 'categorical_tests' END AS method,
  round(max_proportion_difference, 6) AS max_proportion_difference,
  CASE WHEN n_ref = 0 OR n_cur = 0 THEN false
       WHEN low_count THEN coalesce(max_proportion_difference > 0.1, false) ELSE coalesce(psi > 0.05, false) END
    AS drift_detected,
  CASE WHEN n_ref = 0 OR n_cur = 0 THEN 'NONE'
       WHEN low_count THEN CASE WHEN max_proportion_difference > 0.2 THEN 'HIGH'
                                WHEN max_proportion_difference > 0.1 THEN 'MEDIUM' ELSE 'LOW' END
       ELSE CASE WHEN psi > 0.25 THEN 'HIGH' WHEN psi > 0.2 THEN 'MEDIUM' WHEN psi > 0.1 THEN 'LOW' ELSE 'NONE' END
  END AS severity
FROM cat""")


@register("proportion_fallback", PF_SQL)
def q_proportion_fallback(spark, sf):
    keys = ("user_id",)
    t = _cat(fx.events_cohorts(spark, sf), fx.E_CAT, keys)
    v = drift._insufficient(drift.categorical_verdict(t, EFFECT))
    return v.select("user_id", "feature", "n_ref", "n_cur", "low_count", "method",
                    r("max_proportion_difference"), "drift_detected", "severity")


# ------------------------------------------------------------------ C1 / E10
@register("category_align", O_CAT_SQL + """
SELECT feature, category, c_ref, c_cur FROM cc WHERE category IS NOT NULL""")
def q_category_align(spark, sf):
    df = fx.orders_cohorts(spark, sf)
    c = drift.category_counts(to_long(df, fx.O_CAT, as_string=True))
    return c.where(F.col("category").isNotNull())


@register("category_union", f"WITH {fx.E_SQL}" + """
SELECT DISTINCT 'event_type' AS feature, event_type AS category FROM e WHERE cohort = 'ref'
UNION
SELECT DISTINCT 'event_type' AS feature, event_type AS category FROM e WHERE cohort = 'cur'""")
def q_category_union(spark, sf):
    e = fx.events_cohorts(spark, sf)
    a = e.where(F.col("cohort") == "ref").select(F.lit("event_type").alias("feature"), F.col("event_type").alias("category"))
    b = e.where(F.col("cohort") == "cur").select(F.lit("event_type").alias("feature"), F.col("event_type").alias("category"))
    return a.union(b).distinct()


# ------------------------------------------------------------------ H9-H11 full verdicts (p-values: rows-only)
@register("numeric_drift")
def q_numeric_drift(spark, sf):
    df = fx.lineitem_cohorts(spark, sf)
    t = drift.numeric_tests(to_long(df, fx.L_NUM), (), len(fx.L_NUM), with_p=True)
    v = drift.numeric_verdict(t)
    return v.select("feature", "drift_detected", "severity", r("p_value"), r("ks_p_value"), r("t_p_value"),
                    r("levene_p_value"), r("cohens_d"), r("normalized_distance"))


NDE_SQL = L_NUM_SQL + f"""
SELECT feature, {effect_verdict_sql('num')} AS drift_detected, {sev_effect_sql('num')} AS severity,
  round(cohens_d, 6) AS effect_size, round(normalized_distance, 6) AS normalized_distance
FROM num"""


@register("numeric_drift_effect", NDE_SQL)
def q_numeric_drift_effect(spark, sf):
    t = _l_numeric(spark, sf)
    v = drift.numeric_verdict(t, EFFECT)
    return v.select("feature", "drift_detected", "severity", r("effect_size"), r("normalized_distance"))


@register("categorical_drift")
def q_categorical_drift(spark, sf):
    t = _cat(fx.orders_cohorts(spark, sf), fx.O_CAT, with_p=True)
    v = drift.categorical_verdict(t)
    return v.select("feature", "method", "drift_detected", "severity", r("p_value"), r("psi"),
                    r("chi2_statistic"), "chi2_dof", r("chi2_p_value"))


@register("categorical_drift_psi", O_CAT_SQL + """
SELECT feature,
  CASE WHEN low_count THEN 'proportion_comparison' ELSE 'categorical_tests' END AS method,
  CASE WHEN low_count THEN max_proportion_difference > 0.1 ELSE coalesce(psi > 0.05, false) END AS drift_detected,
  CASE WHEN low_count THEN NULL ELSE round(psi, 6) END AS psi,
  CASE WHEN low_count THEN CASE WHEN max_proportion_difference > 0.2 THEN 'HIGH'
                                WHEN max_proportion_difference > 0.1 THEN 'MEDIUM' ELSE 'LOW' END
       ELSE CASE WHEN psi > 0.25 THEN 'HIGH' WHEN psi > 0.2 THEN 'MEDIUM' WHEN psi > 0.1 THEN 'LOW' ELSE 'NONE' END
  END AS severity
FROM cat""")
def q_categorical_drift_psi(spark, sf):
    t = _cat(fx.orders_cohorts(spark, sf), fx.O_CAT)
    v = drift.categorical_verdict(t, EFFECT)
    return v.select("feature", "method", "drift_detected", r("psi"), "severity")


# ------------------------------------------------------------------ H13 / D12 / H14 on effect flags
def _dataset_sql(prefix: str = f"WITH {fx.L_SQL}", src: str = "l") -> str:
    """Effect-only per-feature verdicts (CTE feat) and roll-up (CTE lvl) over
    cohort CTE ``src`` with the L features."""
    cat = categorical_ctes("lc")
    return (f"{prefix},\nlg AS (\n  {fx.long_sql(src, fx.L_NUM)}),\n"
            f"lc AS (\n  {fx.long_sql(src, fx.L_CAT, True)}),{numeric_ctes('lg')},{cat}" + f""",
feat AS (
  SELECT feature, 'numerical' AS feature_type, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur,
    CASE WHEN n_ref = 0 OR n_cur = 0 THEN false ELSE {effect_verdict_sql('num')} END AS drift_detected,
    CASE WHEN n_ref = 0 OR n_cur = 0 THEN 'NONE' ELSE {sev_effect_sql('num')} END AS severity,
    CASE WHEN n_ref = 0 OR n_cur = 0 THEN 'insufficient_data' ELSE 'statistical_tests' END AS method,
    CASE WHEN n_ref = 0 OR n_cur = 0 THEN 1.0 END AS p_value,
    cohens_d AS effect_size, CAST(NULL AS DOUBLE) AS psi
  FROM num
  UNION ALL
  SELECT feature, 'categorical', n_ref, n_cur,
    CASE WHEN n_ref = 0 OR n_cur = 0 THEN false
         WHEN low_count THEN max_proportion_difference > 0.1 ELSE coalesce(psi > 0.05, false) END,
    CASE WHEN n_ref = 0 OR n_cur = 0 THEN 'NONE'
         WHEN low_count THEN CASE WHEN max_proportion_difference > 0.2 THEN 'HIGH'
                                  WHEN max_proportion_difference > 0.1 THEN 'MEDIUM' ELSE 'LOW' END
         ELSE CASE WHEN psi > 0.25 THEN 'HIGH' WHEN psi > 0.2 THEN 'MEDIUM' WHEN psi > 0.1 THEN 'LOW' ELSE 'NONE' END
    END,
    CASE WHEN n_ref = 0 OR n_cur = 0 THEN 'insufficient_data'
         WHEN low_count THEN 'proportion_comparison' ELSE 'categorical_tests' END,
    CASE WHEN n_ref = 0 OR n_cur = 0 THEN 1.0
         WHEN low_count THEN CASE WHEN max_proportion_difference > 0.1 THEN 0.05 ELSE 0.5 END END,
    CAST(NULL AS DOUBLE), CASE WHEN low_count THEN NULL ELSE psi END
  FROM cat),
agg AS (
  SELECT count(*) AS total_features, count(*) FILTER (WHERE drift_detected) AS n_drifted_features,
    count(*) FILTER (WHERE severity = 'HIGH') AS high_severity_features FROM feat),
ds AS (
  SELECT *, CASE WHEN total_features > 0 THEN n_drifted_features / total_features ELSE 0.0 END AS share_drifted_features,
    n_drifted_features > total_features * 0.10 AS dataset_drift,
    n_drifted_features > total_features * 0.25 AS critical_drift
  FROM agg),
lvl AS (
  SELECT *, CASE WHEN share_drifted_features >= 0.25 OR high_severity_features >= 2 THEN 'RED'
                 WHEN share_drifted_features >= 0.10 OR high_severity_features >= 1 THEN 'ORANGE'
                 WHEN share_drifted_features >= 0.05 THEN 'YELLOW' ELSE 'GREEN' END AS severity_level
  FROM ds),
hl AS (
  SELECT *, NOT dataset_drift AS dataset_drift_test, share_drifted_features < 0.10 AS feature_drift_test,
    NOT critical_drift AS critical_drift_test, severity_level IN ('GREEN', 'YELLOW') AS severity_test
  FROM lvl),
hp AS (
  SELECT *, CAST(dataset_drift_test AS INTEGER) + CAST(feature_drift_test AS INTEGER)
    + CAST(critical_drift_test AS INTEGER) + CAST(severity_test AS INTEGER) AS passed_tests FROM hl)""")


DATASET_SQL = _dataset_sql()


def _l_dataset(spark, sf):
    df = fx.lineitem_cohorts(spark, sf)
    feats = drift.feature_drift(df, fx.L_SPEC, EFFECT)
    return drift.dataset_drift(feats, (), EFFECT)


@register("dataset_drift", DATASET_SQL + """
SELECT total_features, n_drifted_features, high_severity_features,
  round(share_drifted_features, 6) AS share_drifted_features, dataset_drift, critical_drift, severity_level
FROM lvl""")
def q_dataset_drift(spark, sf):
    d = _l_dataset(spark, sf)
    return d.select("total_features", "n_drifted_features", "high_severity_features",
                    r("share_drifted_features"), "dataset_drift", "critical_drift", "severity_level")


@register("drift_health", DATASET_SQL + """,
h AS (
  SELECT *, NOT dataset_drift AS dataset_drift_test, share_drifted_features < 0.10 AS feature_drift_test,
    NOT critical_drift AS critical_drift_test, severity_level IN ('GREEN', 'YELLOW') AS severity_test
  FROM lvl)
SELECT dataset_drift_test, feature_drift_test, critical_drift_test, severity_test,
  CAST(dataset_drift_test AS INTEGER) + CAST(feature_drift_test AS INTEGER)
    + CAST(critical_drift_test AS INTEGER) + CAST(severity_test AS INTEGER) AS passed_tests,
  CASE WHEN CAST(dataset_drift_test AS INTEGER) + CAST(feature_drift_test AS INTEGER)
    + CAST(critical_drift_test AS INTEGER) + CAST(severity_test AS INTEGER) >= 3 THEN 'HEALTHY'
       WHEN CAST(dataset_drift_test AS INTEGER) + CAST(feature_drift_test AS INTEGER)
    + CAST(critical_drift_test AS INTEGER) + CAST(severity_test AS INTEGER) >= 2 THEN 'WARNING'
       ELSE 'CRITICAL' END AS overall_health
FROM h""")
def q_drift_health(spark, sf):
    h = drift.drift_health(_l_dataset(spark, sf))
    return h.select("dataset_drift_test", "feature_drift_test", "critical_drift_test", "severity_test",
                    "passed_tests", "overall_health")


# ------------------------------------------------------------------ B3: insufficient data / NULL handling
IN_SQL = (f"WITH {fx.LN_SQL},\nlg AS (\n  "
          f"{fx.long_sql('ln', ('l_tax', 'l_discount_ref_only', 'l_linestatus_bin'))}),{numeric_ctes('lg')}" + """
SELECT feature, n_ref, n_cur,
  CASE WHEN n_ref = 0 OR n_cur = 0 THEN 'insufficient_data' ELSE 'statistical_tests' END AS method,
  CASE WHEN n_ref = 0 OR n_cur = 0 THEN false
       ELSE coalesce(abs(cohens_d) > 0.1, false) OR coalesce(normalized_distance > 0.05, false) END AS drift_detected,
  round(cohens_d, 6) AS effect_size
FROM num""")


@register("insufficient_data", IN_SQL)
def q_insufficient_data(spark, sf):
    df = fx.lineitem_nulls(spark, sf)
    feats = ("l_tax", "l_discount_ref_only", "l_linestatus_bin")
    t = drift.numeric_tests(to_long(df, feats), (), len(feats), with_p=False)
    v = drift._insufficient(drift.numeric_verdict(t, EFFECT))
    return v.select("feature", "n_ref", "n_cur", "method", "drift_detected", r("effect_size"))
