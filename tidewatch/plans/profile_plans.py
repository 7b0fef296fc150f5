"""Registered profile plans and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.scalar import clip
from tidewatch.operators import profile
from tidewatch.operators.cohorts import to_long
from tidewatch.operators.drift import infer_feature_types
from tidewatch.operators.small import bound, join_small
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import r, register
from tidewatch.sources.tables import read_table


def _l(spark, sf):
    return fx.lineitem_cohorts(spark, sf)


_L_NUM_UNION = fx.long_sql("l", fx.L_NUM)
_L_CAT_UNION = fx.long_sql("l", fx.L_CAT, True)


# ------------------------------------------------------------------ D2
@register("baseline_profile", f"WITH {fx.L_SQL}," + f"""
lg AS ({_L_NUM_UNION}),
lc AS ({_L_CAT_UNION})
SELECT feature, 'numerical' AS kind, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(max(value), 6) AS max, CAST(NULL AS VARCHAR) AS category,
  CAST(NULL AS BIGINT) AS count
FROM lg GROUP BY feature
UNION ALL
SELECT feature, 'categorical', NULL, NULL, NULL, NULL, value, count(*)
FROM lc WHERE value IS NOT NULL GROUP BY feature, value""")
def q_baseline_profile(spark, sf):
    p = profile.baseline_profile(_l(spark, sf), fx.L_NUM, fx.L_CAT)
    return p.select("feature", "kind", r("mean"), r("std"), r("min"), r("max"), "category", "count")


# ------------------------------------------------------------------ D3
@register("value_counts", f"WITH {fx.O_SQL}," + f"""
lc AS ({fx.long_sql('o', fx.O_CAT, True)})
SELECT feature, value AS category, count(*) AS count FROM lc WHERE value IS NOT NULL GROUP BY 1, 2""")
def q_value_counts(spark, sf):
    return profile.value_counts(fx.orders_cohorts(spark, sf), fx.O_CAT)


# ------------------------------------------------------------------ D4 (on L-empty-set: derived NULLs)
_NULL_COLS = ("cohort", "l_quantity", "l_extendedprice", "l_tax", "l_linestatus_bin", "l_discount_ref_only")


@register("null_counts", f"WITH {fx.LN_SQL}\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM ln" for c in _NULL_COLS))
def q_null_counts(spark, sf):
    return profile.null_counts(fx.lineitem_nulls(spark, sf), _NULL_COLS)


# ------------------------------------------------------------------ B2
@register("dropna_any", f"WITH {fx.LN_SQL}" + """
SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE cohort IS NOT NULL AND l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL
                   AND l_tax IS NOT NULL AND l_linestatus_bin IS NOT NULL AND l_discount_ref_only IS NOT NULL)
    AS n_complete
FROM ln""")
def q_dropna_any(spark, sf):
    df = fx.lineitem_nulls(spark, sf).select(*_NULL_COLS)
    n_complete = df.na.drop("any").agg(F.count("*").alias("n")).scalar()
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_complete", n_complete)


# ------------------------------------------------------------------ D5
@register("describe", f"WITH {fx.L_SQL}," + f"""
lg AS ({_L_NUM_UNION})
SELECT feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(min(value), 6) AS min, round(quantile_cont(value, 0.25), 6) AS p25,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75,
  round(max(value), 6) AS max
FROM lg GROUP BY feature""")
def q_describe(spark, sf):
    d = profile.describe(_l(spark, sf), fx.L_NUM)
    return d.select("feature", "count", r("mean"), r("std"), r("min"), r("p25"), r("p50"), r("p75"), r("max"))


# ------------------------------------------------------------------ D6
def _corr_sql():
    fs = fx.L_NUM
    parts = []
    for a in fs:
        for b in fs:
            if a == b:
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, CAST(1.0 AS DOUBLE) AS r")
            else:
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("corr_matrix", _corr_sql())
def q_corr_matrix(spark, sf):
    df = read_table(spark, sf, "lineitem", list(fx.L_NUM))
    return profile.corr_matrix(df, fx.L_NUM).select("x", "y", r("r"))


# ------------------------------------------------------------------ D7
@register("boxplot_stats", f"WITH {fx.L_SQL}," + f"""
lg AS ({fx.long_sql('l', fx.L_NUM, keys=('l_returnflag',))}),
q AS (
  SELECT l_returnflag, feature, count(value) AS n, quantile_cont(value, 0.25) AS q1,
    quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
  FROM lg WHERE value IS NOT NULL GROUP BY 1, 2),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.l_returnflag, f.feature, f.n, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
  round(f.iqr, 6) AS iqr,
  round(min(lg.value) FILTER (WHERE lg.value >= f.lo AND lg.value <= f.hi), 6) AS whisker_low,
  round(max(lg.value) FILTER (WHERE lg.value >= f.lo AND lg.value <= f.hi), 6) AS whisker_high,
  count(*) FILTER (WHERE lg.value < f.lo OR lg.value > f.hi) AS n_outliers
FROM f JOIN lg ON lg.l_returnflag = f.l_returnflag AND lg.feature = f.feature
GROUP BY f.l_returnflag, f.feature, f.n, f.q1, f.median, f.q3, f.iqr""")
def q_boxplot_stats(spark, sf):
    b = profile.boxplot_stats(_l(spark, sf), "l_returnflag", fx.L_NUM)
    return b.select("l_returnflag", "feature", "n", r("q1"), r("median"), r("q3"), r("iqr"),
                    r("whisker_low"), r("whisker_high"), "n_outliers")


# ------------------------------------------------------------------ D8
_INFER = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")


@register("infer_feature_type", f"WITH {fx.L_SQL}," + f"""
lc AS ({fx.long_sql('l', _INFER, True)}),
s AS (
  SELECT feature, count(value) AS n, count(DISTINCT value) AS n_distinct FROM lc WHERE cohort = 'ref'
  GROUP BY feature)
SELECT feature, n, n_distinct, round(n_distinct / n, 6) AS distinct_ratio,
  CASE WHEN n_distinct / n < 0.05 OR feature IN ('l_returnflag') THEN 'categorical' ELSE 'numerical' END
    AS feature_type
FROM s""")
def q_infer_feature_type(spark, sf):
    t = infer_feature_types(_l(spark, sf), _INFER)
    return t.select("feature", "n", "n_distinct", r("distinct_ratio"), "feature_type")


# ------------------------------------------------------------------ D9 / K11
@register("class_ratio", """
SELECT o_orderstatus, count(*) AS count, sum(count(*)) OVER () AS total,
  round(count(*) / sum(count(*)) OVER (), 6) AS ratio
FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus""".replace(
    "sum(count(*)) OVER () AS total", "CAST(sum(count(*)) OVER () AS BIGINT) AS total"))
def q_class_ratio(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderstatus"])
    return profile.class_ratio(o, "o_orderstatus").select("o_orderstatus", "count", "total", r("ratio"))


# ------------------------------------------------------------------ C2: baseline lookup + clip bounds
@register("baseline_join", f"WITH {fx.L_SQL}," + f"""
lg AS ({_L_NUM_UNION}),
b AS (
  SELECT feature, greatest(0, min(value)) AS lo, max(value) AS hi FROM lg WHERE cohort = 'ref' GROUP BY feature)
SELECT lg.feature, round(b.lo, 6) AS lo, round(b.hi, 6) AS hi, count(lg.value) AS n_cur,
  count(*) FILTER (WHERE lg.value < b.lo) AS n_below, count(*) FILTER (WHERE lg.value > b.hi) AS n_above,
  round(sum(least(greatest(lg.value, b.lo), b.hi)), 4) AS sum_clipped
FROM lg JOIN b ON lg.feature = b.feature WHERE lg.cohort = 'cur'
GROUP BY lg.feature, b.lo, b.hi""")
def q_baseline_join(spark, sf):
    long = to_long(_l(spark, sf), fx.L_NUM)
    base = (long.where(F.col("cohort") == "ref").groupBy("feature")
            .agg(F.greatest(F.lit(0.0), F.min("value")).alias("lo"), F.max("value").alias("hi")))
    cur = long.where(F.col("cohort") == "cur")
    j = join_small(cur, base, "feature", bound_rows=bound(len(fx.L_NUM), 1, ()))
    return (j.groupBy("feature", "lo", "hi")
            .agg(F.count("value").alias("n_cur"), F.count_if(F.col("value") < F.col("lo")).alias("n_below"),
                 F.count_if(F.col("value") > F.col("hi")).alias("n_above"),
                 F.round(F.sum(clip("value", F.col("lo"), F.col("hi"))), 4).alias("sum_clipped"))
            .select("feature", r("lo"), r("hi"), "n_cur", "n_below", "n_above", "sum_clipped"))
