"""Table profiles: baseline statistics, counts, exact quantiles, correlations.

Exact quantiles never gather a column into one aggregation buffer: values are
collapsed to distinct values, ranked with bucketed running sums (the same
machinery as the drift ECDF) and the k-th value is picked by a filtered
``min``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.cohorts import REF, to_long
from tidewatch.operators.drift import distinct_values, ecdf
from tidewatch.operators.small import bound, join_on, join_small
from tidewatch.session import cut_lineage


def numeric_summary(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """count / mean / sample sd / min / max per feature (one pass)."""
    long = to_long(df.withColumn("cohort", F.lit(REF)), features, keys)
    return long.groupBy(*keys, "feature").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))


def value_counts(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, feature, category, count), NULLs excluded; order by count desc when shown."""
    long = to_long(df.withColumn("cohort", F.lit(REF)), features, keys, as_string=True)
    return (long.where(F.col("value").isNotNull())
            .groupBy(*keys, "feature", F.col("value").alias("category")).agg(F.count("*").alias("count")))


def baseline_profile(df: DataFrame, numerical: Sequence[str], categorical: Sequence[str],
                     target: str | None = None) -> DataFrame:
    """Long baseline: numeric rows carry mean/std/min/max, categorical rows one
    row per (feature, category) with its count."""
    num = numeric_summary(df, numerical).select(
        "feature", F.lit("numerical").alias("kind"), "mean", "std", "min", "max",
        F.lit(None).cast("string").alias("category"), F.lit(None).cast("bigint").alias("count"))
    cats = list(categorical) + ([target] if target else [])
    vc = value_counts(df, cats).select(
        "feature", F.lit("categorical").alias("kind"), *[F.lit(None).cast("double").alias(c)
                                                         for c in ("mean", "std", "min", "max")],
        "category", "count")
    return num.unionByName(vc)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count) for every column in one aggregate."""
    cols = list(columns or df.columns)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stacked}) AS (`column`, null_count)")


def exact_quantiles(long: DataFrame, qs: Sequence[float], keys: Sequence[str] = (),
                    buckets: int = 16, n_features: int = 1) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas default) per (keys, feature).

    ``long`` has (keys, feature, value); returns one column ``q_<i>`` per q.
    """
    k = [*keys, "feature"]
    dv = cut_lineage(distinct_values(long.withColumn("cohort", F.lit(REF)), keys))
    e = ecdf(dv, keys, buckets, n_features)
    n = dv.groupBy(*k).agg(F.sum("c_ref").alias("n"))
    e = join_small(e, n, k, bound_rows=bound(n_features, 1, keys))

    def at_rank(r: Column) -> Column:
        return F.min(F.when(F.col("cum_ref") >= r, F.col("value")))

    aggs = []
    for i, q in enumerate(qs):
        h = (F.col("n") - 1) * q
        lo = F.floor(h)
        aggs += [at_rank(lo + 1).alias(f"_a{i}"), at_rank(F.least(lo + 2, F.col("n"))).alias(f"_b{i}"),
                 F.first(h - lo).alias(f"_f{i}")]
    out = e.groupBy(*k).agg(F.first("n").alias("n"), *aggs)
    cols = [F.col(c) for c in k] + [F.col("n")]
    for i in range(len(qs)):
        a, b, f = F.col(f"_a{i}"), F.col(f"_b{i}"), F.col(f"_f{i}")
        cols.append((a + f * (b - a)).alias(f"q_{i}"))
    return out.select(*cols)


def describe(df: DataFrame, features: Sequence[str], buckets: int = 16) -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max per feature (exact quantiles)."""
    s = numeric_summary(df, features)
    long = to_long(df.withColumn("cohort", F.lit(REF)), features)
    q = exact_quantiles(long, [0.25, 0.5, 0.75], (), buckets, len(features))
    return (s.join(q.select("feature", F.col("q_0").alias("p25"), F.col("q_1").alias("p50"),
                            F.col("q_2").alias("p75")), "feature", "left"))


def corr_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson correlation for every ordered pair, all pairs in one aggregate."""
    fs = list(features)
    aggs = []
    for i, a in enumerate(fs):
        for b in fs[i + 1:]:
            aggs.append(F.corr(a, b).alias(f"{a}__{b}"))
    wide = df.agg(*aggs) if aggs else df.agg(F.lit(1))
    parts = []
    for i, a in enumerate(fs):
        for j, b in enumerate(fs):
            if i == j:
                v = "CAST(1.0 AS DOUBLE)"
            else:
                x, y = (a, b) if i < j else (b, a)
                v = f"`{x}__{y}`"
            parts.append(f"'{a}', '{b}', {v}")
    return wide.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) AS (x, y, r)")


def boxplot_stats(df: DataFrame, by: str, features: Sequence[str], whis: float = 1.5,
                  buckets: int = 16) -> DataFrame:
    """Quartiles, whiskers (most extreme data within 1.5 IQR) and outlier count per class."""
    long = to_long(df.withColumn("cohort", F.lit(REF)), features, [by])
    q = exact_quantiles(long, [0.25, 0.5, 0.75], [by], buckets, len(features))
    q = q.select(by, "feature", "n", F.col("q_0").alias("q1"), F.col("q_1").alias("median"),
                 F.col("q_2").alias("q3")).withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_f = F.col("q1") - whis * F.col("iqr")
    hi_f = F.col("q3") + whis * F.col("iqr")
    j = join_small(long.where(F.col("value").isNotNull()), q, [by, "feature"])
    inside = (F.col("value") >= lo_f) & (F.col("value") <= hi_f)
    w = j.groupBy(by, "feature").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))
    return join_on(q, w, [by, "feature"])


def class_ratio(df: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Per class count and share of the (segment) total; empty totals give no rows."""
    c = df.where(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.count("*").alias("count"))
    t = c.groupBy(*keys).agg(F.sum("count").alias("total"))  # totals: one row per segment
    j = join_small(c, t, list(keys))
    return j.where(F.col("total") > 0).withColumn("ratio", F.col("count") / F.col("total"))
