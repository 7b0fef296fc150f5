"""Two-sample drift tests and decisions, expressed as DataFrame aggregates.

Plan shape for one cohort-tagged table (any number of segment keys):

* numeric features are unpivoted to ``(keys, cohort, feature, value)``;
  - one aggregate to distinct values gives ``(value, c_ref, c_cur)``;
  - one pass over that table, dealt by value bucket, gives every statistic:
    running sums inside a bucket plus the bucket's offsets are the two ECDFs
    (KS D, Wasserstein, exact medians), and each bucket's rows below and above
    the cohort's median rank leave a mergeable state (count, mean, M2), from
    which mean, variance and Levene (Brown-Forsythe) follow without sums of
    squares that cancel and without a second pass;
  - a value that is no number is counted, not thrown: its feature is reported
    with method ``error`` and the others are judged;
* categorical features are unpivoted as strings and counted per
  ``(feature, category)`` (chi-square with Yates for 2 levels, PSI,
  low-count proportion fallback);
* tail probabilities run in a pandas UDF on the per-feature table only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.tails import tail_prob
from tidewatch.operators.cohorts import CUR, REF, as_number, to_long
from tidewatch.operators.small import bound, join_on, join_small
from tidewatch.session import cut_lineage, cut_lineage_sized
from tidewatch.spec import DEFAULT_THRESHOLDS, DriftThresholds, FeatureSpec



def _is_ref() -> Column:
    return F.col("cohort") == REF


def _is_cur() -> Column:
    return F.col("cohort") == CUR

_UNB = Window.unboundedPreceding
_NOW = Window.currentRow


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def _nan_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


# ----------------------------------------------------------------- moments
def numeric_moments(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per (keys, feature): non-null counts, means, sample variances, range."""
    v = F.col("value")
    return long.groupBy(*keys, "feature").agg(
        F.count(F.when(_is_ref(), v)).alias("n_ref"),
        F.count(F.when(_is_cur(), v)).alias("n_cur"),
        F.avg(F.when(_is_ref(), v)).alias("mean_ref"),
        F.avg(F.when(_is_cur(), v)).alias("mean_cur"),
        F.var_samp(F.when(_is_ref(), v)).alias("var_ref"),
        F.var_samp(F.when(_is_cur(), v)).alias("var_cur"),
        F.min(v).alias("min_value"),
        F.max(v).alias("max_value"),
    )


def with_cohens_d(m: DataFrame) -> DataFrame:
    """d = (mean_cur - mean_ref) / pooled sd; 0 when the pooled sd is 0."""
    n1, n2 = F.col("n_ref"), F.col("n_cur")
    pooled = F.sqrt(_div((n1 - 1) * F.col("var_ref") + (n2 - 1) * F.col("var_cur"),
                         (n1 + n2 - 2).cast("double")))
    return (m.withColumn("pooled_sd", pooled)
            .withColumn("cohens_d", F.when(F.col("pooled_sd") == 0, F.lit(0.0))
                        .otherwise(_div(F.col("mean_cur") - F.col("mean_ref"), F.col("pooled_sd")))))


def with_welch(m: DataFrame) -> DataFrame:
    """Welch t (reference minus current) and Satterthwaite df."""
    a = _div(F.col("var_ref"), F.col("n_ref").cast("double"))
    b = _div(F.col("var_cur"), F.col("n_cur").cast("double"))
    se2 = a + b
    df = _div(se2 * se2, _div(a * a, (F.col("n_ref") - 1).cast("double"))
              + _div(b * b, (F.col("n_cur") - 1).cast("double")))
    return (m.withColumn("t_statistic", _div(F.col("mean_ref") - F.col("mean_cur"), F.sqrt(se2)))
            .withColumn("t_df", df))


# -------------------------------------------------------------------- ECDF
def distinct_values(long: DataFrame, keys: Sequence[str] = (), keep_null: bool = False) -> DataFrame:
    """Collapse to one row per distinct value: (keys, feature, value, c_ref, c_cur).

    Partial aggregation runs map-side, so a hot value costs one row per task.
    With ``keep_null`` the NULL value row is kept (feature presence).
    """
    src = long if keep_null else long.where(F.col("value").isNotNull())
    return (src.groupBy(*keys, "feature", "value")
            .agg(F.count_if(_is_ref()).alias("c_ref"), F.count_if(_is_cur()).alias("c_cur")))


def value_table(df: DataFrame, numerical: Sequence[str], categorical: Sequence[str],
                keys: Sequence[str] = ()) -> DataFrame:
    """ONE scan and ONE shuffle for every feature of a cohort-tagged frame:
    (keys, feature, value DOUBLE, category STRING, failed, c_ref, c_cur), one
    row per distinct numeric value / category (NULL rows kept for presence).
    Values of a numeric feature that are no numbers share one row, ``failed``."""
    null_s = F.lit(None).cast("string")
    cols = []
    for f in numerical:
        value, failed = as_number(df, f)
        cols.append(F.struct(value.alias("num"), null_s.alias("cat"), failed.alias("failed")).alias(f))
    cols += [F.struct(F.lit(None).cast("double").alias("num"), F.col(f).cast("string").alias("cat"), F.lit(False).alias("failed")).alias(f)
             for f in categorical]
    wide = df.select(*[F.col(k) for k in keys], F.col("cohort"), *cols)
    long = wide.unpivot([*keys, "cohort"], [*numerical, *categorical], "feature", "v")
    return (long.groupBy(*keys, "feature", F.col("v.num").alias("value"), F.col("v.cat").alias("category"), F.col("v.failed").alias("failed"))
            .agg(F.count_if(_is_ref()).alias("c_ref"), F.count_if(_is_cur()).alias("c_cur")))


# Scale rule of the bucketed passes: one window task sorts about this many
# distinct values of a group at most.
ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4096
MAX_BOUND_CELLS = 20_000_000


def _bounds_expr(buckets: int) -> Column:
    qs = [i / buckets for i in range(1, buckets)]
    # rank error 1/accuracy stays well inside one bucket
    return F.percentile_approx("value", qs, max(10_000, 20 * buckets))


_STEP = 64


def _bucket(bounds: str, value: Column) -> Column:
    """How many of the sorted bounds are below the value: every 64th bound
    first, then the 64 after the last of those that is below."""
    coarse = F.size(F.filter(F.filter(bounds, lambda x, i: (i + 1) % _STEP == 0), lambda x: x < value))
    fine = F.size(F.filter(F.slice(bounds, coarse * _STEP + 1, F.lit(_STEP)), lambda x: x < value))
    return coarse * _STEP + fine


def _with_bucket(df: DataFrame, most: int) -> DataFrame:
    """:func:`_bucket` of ``bounds`` (``most`` at most) and ``value`` as column
    ``bucket``, for passes over all values: the search halves the bounds in plain
    columns, so a row costs the logarithm of their number, and no lambda runs."""
    df, step = df.withColumn("bucket", F.lit(0)), 1 << max(0, most.bit_length() - 1)
    while step:
        at = F.col("bucket")
        df = df.withColumn("bucket", F.when(F.get("bounds", at + (step - 1)) < F.col("value"), at + step).otherwise(at))
        step //= 2
    return df


def scaled_buckets(dv: DataFrame, keys: Sequence[str] = (), buckets: int = 16) -> int:
    """Bucket count for the ECDF of a distinct-value table: at least
    ``buckets``, more when the largest (keys, feature) group would put over
    ``ROWS_PER_BUCKET`` values into one window task. Reads one aggregate row
    (a planning statistic, like the sizes AQE measures); ``dv`` is normally a
    materialised table, so this is a cheap scan."""
    if buckets <= 1:
        return buckets
    k = [*keys, "feature"]
    st = (dv.groupBy(*k).agg(F.count("*").alias("n"))
          .agg(F.max("n").alias("m"), F.count("*").alias("g")).first())
    largest, groups = int(st["m"] or 0), int(st["g"] or 0)
    want = -(-largest // ROWS_PER_BUCKET)
    cap = max(buckets, MAX_BOUND_CELLS // max(groups, 1))
    return int(max(buckets, min(want, MAX_BUCKETS, cap)))


def ecdf(dv: DataFrame, keys: Sequence[str] = (), buckets: int = 16,
         n_features: int = 1, bounds: DataFrame | None = None) -> DataFrame:
    """Cumulative counts per cohort at each distinct value, plus the next value.

    With ``buckets > 1`` the running sums are computed inside value buckets
    (approximate-quantile boundaries of the distinct values, a deterministic
    function of the value), and each bucket's offset comes from a small
    per-bucket totals table. No task ever holds more than one bucket.
    ``dv`` must hold non-NULL values only; ``bounds`` (keys, feature, bounds)
    may be passed when already computed.
    """
    k = [*keys, "feature"]
    if bounds is None:
        buckets = scaled_buckets(dv, keys, buckets)
    if buckets <= 1:
        w = Window.partitionBy(*k).orderBy("value")
        run = w.rowsBetween(_UNB, _NOW)
        return dv.select(*k, "value", "c_ref", "c_cur",
                         F.sum("c_ref").over(run).alias("cum_ref"),
                         F.sum("c_cur").over(run).alias("cum_cur"),
                         F.lead("value").over(w).alias("next_value"))
    if bounds is None:
        bounds = dv.groupBy(*k).agg(_bounds_expr(buckets).alias("bounds"))
    b = join_small(dv, bounds.select(*k, "bounds"), k, bound_rows=bound(n_features, 1, keys))
    b = _with_bucket(b, buckets - 1).drop("bounds")
    kb = [*k, "bucket"]
    if keys:
        # the join leaves rows dealt by (keys, feature), which would satisfy the windows
        # below and keep a hot segment in one task: deal them by bucket as well
        b = b.repartition(*[F.col(c) for c in kb])
    w = Window.partitionBy(*kb).orderBy("value")
    run = w.rowsBetween(_UNB, _NOW)
    inner = b.select(*kb, "value", "c_ref", "c_cur",
                     F.sum("c_ref").over(run).alias("lcum_ref"),
                     F.sum("c_cur").over(run).alias("lcum_cur"),
                     F.lead("value").over(w).alias("lnext"))
    totals = b.groupBy(*kb).agg(F.sum("c_ref").alias("b_ref"), F.sum("c_cur").alias("b_cur"),
                                F.min("value").alias("b_first"))
    wb = Window.partitionBy(*k).orderBy("bucket")
    offsets = totals.select(
        *kb,
        (F.sum("b_ref").over(wb.rowsBetween(_UNB, _NOW)) - F.col("b_ref")).alias("off_ref"),
        (F.sum("b_cur").over(wb.rowsBetween(_UNB, _NOW)) - F.col("b_cur")).alias("off_cur"),
        F.lead("b_first").over(wb).alias("next_first"))
    out = join_small(inner, offsets, kb, bound_rows=bound(n_features, buckets, keys))
    return out.select(*k, "value", "c_ref", "c_cur",
                      (F.col("off_ref") + F.col("lcum_ref")).alias("cum_ref"),
                      (F.col("off_cur") + F.col("lcum_cur")).alias("cum_cur"),
                      F.coalesce("lnext", "next_first").alias("next_value"))


# ------------------------------------------------------------ numeric tests
def _placed(dv: DataFrame, keys: Sequence[str], n_features: int, buckets: int, least: int) -> DataFrame:
    """Rows of a distinct-value table with their value bucket, the cohorts'
    sizes, the counts below the bucket (``off_*``) and the next bucket's first
    value. Small tables are one bucket per group: one exchange, no join. Larger
    ones are cut at quantiles of a sketch, a group into as many buckets as its
    own distinct values need; rows without a value get a bucket of their own."""
    k = [*keys, "feature"]
    if buckets <= 1:
        group = f"OVER (PARTITION BY {_names(k)})"
        return dv.selectExpr("*", "0 AS bucket", f"sum(c_ref) {group} AS n_ref", f"sum(c_cur) {group} AS n_cur", "0L AS off_ref", "0L AS off_cur",
                             f"min(value) {group} AS anchor", "CAST(NULL AS DOUBLE) AS next_first")
    sketch = dv.groupBy(*k).agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"), F.count("value").alias("_m"),
                                _bounds_expr(buckets).alias("bounds"))
    share = F.least(F.lit(1.0), F.greatest(F.lit(least), F.ceil(F.col("_m") / ROWS_PER_BUCKET)) / buckets)
    thinned = F.filter("bounds", lambda x, i: F.floor((i + 1) * share) > F.floor(i * share))
    # written: rows and totals below must see the same bounds, and the sketch is a pass over all values
    sketch = cut_lineage(sketch.select(*k, "n_ref", "n_cur", thinned.alias("bounds")), "bounds")
    b = _with_bucket(join_small(dv, sketch, k, bound_rows=bound(n_features, buckets, keys)), buckets - 1)
    b = b.withColumn("bucket", F.when(F.col("value").isNull() | F.col("bounds").isNull(), -1).otherwise(F.col("bucket"))).drop("bounds")
    kb = [*k, "bucket"]
    # dealt by bucket: a join by segment left rows dealt by (keys, feature), which would keep a hot segment in one task
    dealt = b.repartition(*[F.col(c) for c in kb])
    # without segments the totals need no row dealt, only partial sums
    totals = (dealt if keys else b).groupBy(*kb).agg(F.sum("c_ref").alias("_ref"), F.sum("c_cur").alias("_cur"), F.min("value").alias("_first"))
    before = Window.partitionBy(*k).orderBy("bucket")
    offsets = totals.select(*kb, F.col("_first").alias("anchor"), *[(F.sum(f"_{c}").over(before.rowsBetween(_UNB, _NOW)) - F.col(f"_{c}")).alias(f"off_{c}") for c in ("ref", "cur")],
                            F.lead("_first").over(before).alias("next_first"))
    return join_small(dealt, offsets, kb, bound_rows=bound(n_features, buckets + 1, keys))


_COHORTS = ("ref", "cur")
_STATES = [f"{c}_{s}" for c in _COHORTS for s in ("lo", "hi")]


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _bucket_states(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (keys, feature, bucket): parts of KS D and Wasserstein, the
    middle values, and for each cohort the states of its rows up to the median
    rank (``lo``) and beyond (``hi``): count ``w``, sum above the bucket's first
    value ``s``, and M2 ``q``, which grows by one non-negative term a row (its
    distance from the mean of the rows before)."""
    kb = [*keys, "feature", "bucket"]
    ordered = f"OVER (PARTITION BY {_names(kb)} ORDER BY value"
    running = f"{ordered} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    e = placed.selectExpr("*", f"coalesce(lead(value) {ordered}), next_first) AS next", "coalesce(value - anchor, 0D) AS dev",
                          *[f"off_{c} + sum(c_{c}) {running} AS cum_{c}" for c in _COHORTS])
    low = {c: f"cum_{c} - c_{c} < (n_{c} + 1) div 2" for c in _COHORTS}
    e = e.selectExpr("*", *[f"if({low[c]}, c_{c}, 0L) AS w_{c}_lo" for c in _COHORTS], *[f"if({low[c]}, 0L, c_{c}) AS w_{c}_hi" for c in _COHORTS])
    e = e.selectExpr("*", *[f"sum(w_{x}) {running} - w_{x} AS before_{x}" for x in _STATES], *[f"sum(w_{x} * dev) {running} - w_{x} * dev AS moved_{x}" for x in _STATES])
    gap = "if(n_ref > 0 AND n_cur > 0, abs(cum_ref / n_ref - cum_cur / n_cur), NULL)"
    aggs = ["max(n_ref) AS n_ref", "max(n_cur) AS n_cur", "min(anchor) AS anchor", "sum(n_failed) AS n_failed", "min(value) AS min_value",
            "max(value) AS max_value", f"max(if(value IS NULL, NULL, {gap})) AS ks_statistic", f"sum({gap} * (next - value)) AS wasserstein_distance"]
    for c in _COHORTS:
        aggs += [f"max(if(w_{c}_lo > 0, value, NULL)) AS v1_{c}", f"min(if(cum_{c} >= n_{c} div 2 + 1, value, NULL)) AS v2_{c}"]
    for x in _STATES:
        aggs += [f"CAST(sum(w_{x}) AS DOUBLE) AS w_{x}", f"sum(w_{x} * dev) AS s_{x}",
                 f"sum(if(before_{x} > 0 AND w_{x} > 0, w_{x} * (before_{x} / (before_{x} + w_{x})) * pow(dev - moved_{x} / before_{x}, 2), 0D)) AS q_{x}"]
    return e.groupBy(*kb).agg(*[F.expr(x) for x in aggs])


def _merged_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Statistics per (keys, feature) from the states of its buckets, merged as
    counts, means and M2 (means taken from a common origin, so that values far
    from zero lose nothing)."""
    k = [*keys, "feature"]
    group = f"OVER (PARTITION BY {_names(k)})"
    out = states.selectExpr("*", f"min(anchor) {group} AS origin", *[f"(max(v1_{c}) {group} + min(v2_{c}) {group}) / 2 AS median_{c}" for c in _COHORTS])
    terms = []
    for x in _STATES:
        mean, middle = f"s_{x} / nullif(w_{x}, 0)", f"(median_{x[:3]} - anchor)"
        terms += [f"anchor - origin + {mean} AS x_{x}",
                  # mean distance to the median
                  f"{f'{middle} - {mean}' if x.endswith('lo') else f'{mean} - {middle}'} AS z_{x}"]
    out = out.selectExpr("*", *terms)
    out = out.selectExpr("*", *[
        f"sum(coalesce(w_{c}_lo * {v}_{c}_lo, 0D) + coalesce(w_{c}_hi * {v}_{c}_hi, 0D)) {group} / nullif(n_{c}, 0) AS {v}_{c}" for c in _COHORTS for v in "xz"])
    aggs = [f"max({c}) AS {c}" for c in ("n_ref", "n_cur", "median_ref", "median_cur", "origin", "x_ref", "x_cur", "z_ref", "z_cur", "max_value", "ks_statistic")]
    aggs += ["min(min_value) AS min_value", "coalesce(sum(wasserstein_distance), 0D) AS wasserstein_distance", "sum(n_failed) AS n_failed"]
    for c in _COHORTS:
        for v in "xz":
            parts = [f"q_{x} + coalesce(w_{x} * pow({v}_{x} - {v}_{c}, 2), 0D)" for x in (f"{c}_lo", f"{c}_hi")]
            aggs.append(f"sum({parts[0]} + {parts[1]}) AS m2{v}_{c}")
    return out.groupBy(*k).agg(*[F.expr(x) for x in aggs])


def numeric_tests_from_values(dv: DataFrame, keys: Sequence[str] = (), n_features: int = 1,
                              buckets: int = 1, with_p: bool = True, rows: int | None = None) -> DataFrame:
    """All five numeric statistics per (keys, feature) from a distinct-value
    table (columns keys, feature, value, c_ref, c_cur and optionally
    ``n_failed``) in one pass. ``rows`` is the table's size: every
    ``ROWS_PER_BUCKET`` of them may need a bucket more; ``buckets`` at least."""
    dv = dv.selectExpr(*[f"`{c}`" for c in keys], "feature", "value", *[f"if(value IS NULL, 0L, c_{c}) AS c_{c}" for c in _COHORTS],
                       f"CAST({'n_failed' if 'n_failed' in dv.columns else '0'} AS BIGINT) AS n_failed")
    n_buckets = max(buckets, -(-(rows or 0) // ROWS_PER_BUCKET))
    out = _merged_states(_bucket_states(_placed(dv, keys, n_features, n_buckets, buckets), keys), keys)
    # one row has no variance (NULL), so no effect size either
    out = out.selectExpr("*", *[f"origin + x_{c} AS mean_{c}" for c in _COHORTS], *[f"if(n_{c} > 1, m2x_{c} / (n_{c} - 1), NULL) AS var_{c}" for c in _COHORTS],
                         "CAST(n_ref + n_cur AS DOUBLE) AS n", "try_divide(n_ref * z_ref + n_cur * z_cur, n_ref + n_cur) AS z")
    out = with_welch(with_cohens_d(out)).selectExpr(
        "*", "if(n_ref > 0 AND n_cur > 0 AND n > 2, try_divide((n - 2) * (n_ref * pow(z_ref - z, 2) + n_cur * pow(z_cur - z, 2)), m2z_ref + m2z_cur), NULL) AS levene_statistic",
        "n - 2 AS levene_df2", "if(max_value > min_value, wasserstein_distance / (max_value - min_value), 0D) AS normalized_distance")
    out = out.drop("origin", "n", "z", *[f"{v}_{c}" for v in ("x", "z", "m2x", "m2z") for c in _COHORTS])
    if with_p:
        out = (out.withColumn("ks_p_value", tail_prob("ks", F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur")))
               .withColumn("t_p_value", tail_prob("t", F.col("t_statistic"), F.col("t_df")))
               .withColumn("levene_p_value", tail_prob("f", F.col("levene_statistic"), F.lit(1.0),
                                                       F.col("levene_df2"))))
    return out


def numeric_tests(long: DataFrame, keys: Sequence[str] = (), n_features: int = 1,
                  buckets: int = 1, with_p: bool = True) -> DataFrame:
    """Numeric statistics from an unpivoted frame: one shuffle to distinct
    values, written (lineage cut), then one pass over that table."""
    dv, rows = cut_lineage_sized(distinct_values(long, keys, keep_null=True), "values")
    return numeric_tests_from_values(dv, keys, n_features, buckets, with_p, rows)


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def numeric_verdict(t: DataFrame, th: DriftThresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """ANY-of rule and severity ladder (reference decision logic)."""
    a = th.significance_level
    d = F.abs(F.col("cohens_d"))
    ks_p, t_p, lv_p = (_nan_null(F.col(c)) if c in t.columns else F.lit(None).cast("double")
                       for c in ("ks_p_value", "t_p_value", "levene_p_value"))
    effect = [_flag(d > th.effect_size_threshold), _flag(F.col("normalized_distance") > th.distance_threshold)]
    tests = [_flag(ks_p < a), _flag((t_p < a) & (d > th.t_effect_floor)), _flag(lv_p < a)]
    conds = effect if th.effect_only else effect + tests
    detected = conds[0]
    for c in conds[1:]:
        detected = detected | c
    p_min = F.least(ks_p, t_p, lv_p)
    p_sev = F.lit(None).cast("double") if th.effect_only else p_min
    sev = (F.when(_flag((d > 0.5) | (p_sev < 0.001)), "HIGH")
           .when(_flag((d > 0.3) | (p_sev < 0.01)), "MEDIUM")
           .when(_flag((d > 0.1) | (p_sev < 0.05)), "LOW")
           .otherwise("NONE"))
    return (t.withColumn("drift_detected", detected)
            .withColumn("p_value", p_min)
            .withColumn("severity", sev)
            .withColumn("effect_size", F.col("cohens_d"))
            .withColumn("method", F.lit("statistical_tests")))


# -------------------------------------------------------- categorical tests
def category_counts(long_str: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, feature, category, c_ref, c_cur): the FULL OUTER alignment of the
    two cohorts' value counts, obtained from one aggregate (no join)."""
    return (long_str.groupBy(*keys, "feature", F.col("value").alias("category"))
            .agg(F.count_if(_is_ref()).alias("c_ref"), F.count_if(_is_cur()).alias("c_cur")))


def categorical_tests(counts: DataFrame, keys: Sequence[str] = (), n_features: int = 1,
                      th: DriftThresholds = DEFAULT_THRESHOLDS, with_p: bool = True) -> DataFrame:
    """Chi-square (Yates when dof=1), PSI and the low-count fallback inputs."""
    k = [*keys, "feature"]
    present = F.col("category").isNotNull()
    tot = counts.groupBy(*k).agg(
        F.coalesce(F.sum(F.when(present, F.col("c_ref"))), F.lit(0)).alias("n_ref"),
        F.coalesce(F.sum(F.when(present, F.col("c_cur"))), F.lit(0)).alias("n_cur"),
        F.count("category").alias("n_categories"),
        _flag(F.bool_or(F.when(present, (F.col("c_ref") < th.low_count) | (F.col("c_cur") < th.low_count))))
        .alias("low_count"))
    j = join_small(counts.where(present), tot, k, bound_rows=bound(n_features, 1, keys))
    n1, n2 = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    p1, p2 = _div(F.col("c_ref").cast("double"), n1), _div(F.col("c_cur").cast("double"), n2)
    total = n1 + n2
    col_total = (F.col("c_ref") + F.col("c_cur")).cast("double")
    e1, e2 = _div(n1 * col_total, total), _div(n2 * col_total, total)
    yates = F.col("n_categories") == 2

    def term(o: Column, e: Column) -> Column:
        dev = F.when(yates, F.greatest(F.abs(o - e) - 0.5, F.lit(0.0))).otherwise(F.abs(o - e))
        return _div(dev * dev, e)

    q1 = F.when(p1 == 0, F.lit(1e-7)).otherwise(p1)
    q2 = F.when(p2 == 0, F.lit(1e-7)).otherwise(p2)
    stats = j.groupBy(*k).agg(
        F.sum(term(F.col("c_ref"), e1) + term(F.col("c_cur"), e2)).alias("chi2_statistic"),
        F.abs(F.sum((q2 - q1) * F.log(q2 / q1))).alias("psi"),
        F.max(F.abs(p1 - p2)).alias("max_proportion_difference"))
    out = join_on(tot, stats, k, "left").withColumn("chi2_dof", (F.col("n_categories") - 1).cast("int"))
    if with_p:
        out = out.withColumn("chi2_p_value", tail_prob("chi2", F.col("chi2_statistic"), F.col("chi2_dof")))
    return out


def categorical_verdict(t: DataFrame, th: DriftThresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    psi, mpd = F.col("psi"), F.col("max_proportion_difference")
    chi_p = _nan_null(F.col("chi2_p_value")) if "chi2_p_value" in t.columns else F.lit(None).cast("double")
    low = F.col("low_count")
    fb_detected = mpd > th.proportion_threshold
    fb_sev = F.when(mpd > 0.2, "HIGH").when(mpd > 0.1, "MEDIUM").otherwise("LOW")
    tests = _flag(psi > th.psi_threshold)
    if not th.effect_only:
        tests = tests | _flag(chi_p < th.significance_level)
    sev = F.when(psi > 0.25, "HIGH").when(psi > 0.2, "MEDIUM").when(psi > 0.1, "LOW").otherwise("NONE")
    return (t.withColumn("method", F.when(low, "proportion_comparison").otherwise("categorical_tests"))
            .withColumn("drift_detected", F.when(low, _flag(fb_detected)).otherwise(tests))
            .withColumn("p_value", F.when(low, F.when(fb_detected, 0.05).otherwise(0.5)).otherwise(chi_p))
            .withColumn("severity", F.when(low, fb_sev).otherwise(sev))
            .withColumn("psi", F.when(low, F.lit(None).cast("double")).otherwise(psi)))


# ------------------------------------------------------- per-feature result
FEATURE_COLUMNS = [
    ("feature_type", "string"), ("method", "string"), ("n_ref", "bigint"), ("n_cur", "bigint"),
    ("drift_detected", "boolean"), ("severity", "string"), ("p_value", "double"),
    ("effect_size", "double"), ("normalized_distance", "double"), ("wasserstein_distance", "double"),
    ("ks_statistic", "double"), ("ks_p_value", "double"), ("t_statistic", "double"),
    ("t_p_value", "double"), ("levene_statistic", "double"), ("levene_p_value", "double"),
    ("psi", "double"), ("chi2_statistic", "double"), ("chi2_dof", "int"), ("chi2_p_value", "double"),
    ("max_proportion_difference", "double"), ("error", "string"),
]


def _insufficient(t: DataFrame) -> DataFrame:
    """Empty side after dropping NULLs -> no drift, p=1, method insufficient_data."""
    empty = (F.col("n_ref") == 0) | (F.col("n_cur") == 0)
    return t.withColumns({c: F.when(empty, v).otherwise(F.col(c)) for c, v in (
        ("drift_detected", False), ("p_value", 1.0), ("method", "insufficient_data"), ("severity", "NONE"))})


def _errors(t: DataFrame) -> DataFrame:
    """A feature with values that are no numbers is reported, not judged."""
    broken = F.col("n_failed") > 0
    verdict = (("drift_detected", False), ("p_value", 1.0), ("method", "error"), ("severity", "NONE"))
    statistics = [c for c, kind in FEATURE_COLUMNS if kind == "double" and c != "p_value" and c in t.columns]
    return t.withColumns({**{c: F.when(broken, v).otherwise(F.col(c)) for c, v in verdict}, **{c: F.when(~broken, F.col(c)) for c in statistics},
                          "error": F.when(broken, F.format_string("%d values are no numbers", "n_failed"))})


def _conform(t: DataFrame, keys: Sequence[str], feature_type: str) -> DataFrame:
    t = t.withColumn("feature_type", F.lit(feature_type))
    cols = [F.col(c) for c in keys] + [F.col("feature")]
    for name, typ in FEATURE_COLUMNS:
        cols.append((F.col(name) if name in t.columns else F.lit(None)).cast(typ).alias(name))
    return t.select(*cols)


def feature_drift(df: DataFrame, spec: FeatureSpec, th: DriftThresholds = DEFAULT_THRESHOLDS,
                  numerical: Sequence[str] | None = None,
                  categorical: Sequence[str] | None = None) -> DataFrame:
    """Per-feature drift results for a cohort-tagged frame (column ``cohort``).

    One scan and one shuffle build the distinct-value table of all features;
    it is written and every test reads it.
    """
    num = list(spec.numerical if numerical is None else numerical)
    cat = list(spec.categorical if categorical is None else categorical)
    vt, rows = cut_lineage_sized(value_table(df, num, cat, list(spec.keys)), "values")
    return feature_drift_from_values(vt, rows, spec, th, num, cat)


def feature_drift_from_values(vt: DataFrame, rows: int, spec: FeatureSpec, th: DriftThresholds = DEFAULT_THRESHOLDS,
                              numerical: Sequence[str] | None = None, categorical: Sequence[str] | None = None) -> DataFrame:
    """:func:`feature_drift` from a :func:`value_table` of ``rows`` rows. Tables
    of several parts of the data may be merged with :func:`merge_values` first."""
    keys = list(spec.keys)
    num = list(spec.numerical if numerical is None else numerical)
    cat = list(spec.categorical if categorical is None else categorical)
    parts = []
    if num:
        dv = vt.where(F.col("feature").isin(num)).select(
            *keys, "feature", "value", "c_ref", "c_cur", F.when(F.col("failed"), F.col("c_ref") + F.col("c_cur")).otherwise(0).alias("n_failed"))
        t = numeric_tests_from_values(dv, keys, len(num), th.ecdf_buckets, not th.effect_only, rows)
        parts.append(_conform(_errors(_insufficient(numeric_verdict(t, th))), keys, "numerical"))
    if cat:
        counts = vt.where(F.col("feature").isin(cat)).select(*keys, "feature", "category", "c_ref", "c_cur")
        t = categorical_tests(counts, keys, len(cat), th, with_p=not th.effect_only)
        parts.append(_conform(_insufficient(categorical_verdict(t, th)), keys, "categorical"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merge_values(tables: Sequence[DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """Sum of value tables (e.g. a stored reference and a new batch)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy(*keys, "feature", "value", "category", "failed").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur"))


# ----------------------------------------------------------- dataset level
def dataset_drift(features: DataFrame, keys: Sequence[str] = (),
                  th: DriftThresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Roll-up over features + traffic light (per segment)."""
    n = F.col("total_features")
    share = F.when(n > 0, F.col("n_drifted_features") / n).otherwise(F.lit(0.0))
    g = features.groupBy(*keys) if keys else features.groupBy()
    out = g.agg(F.count("*").alias("total_features"),
                F.count_if(F.col("drift_detected")).alias("n_drifted_features"),
                F.count_if(F.col("severity") == "HIGH").alias("high_severity_features"))
    out = (out.withColumn("share_drifted_features", share)
           .withColumn("dataset_drift", F.col("n_drifted_features") > n * th.feature_drift_threshold)
           .withColumn("critical_drift", F.col("n_drifted_features") > n * th.critical_drift_threshold))
    s, h = F.col("share_drifted_features"), F.col("high_severity_features")
    level = (F.when((s >= 0.25) | (h >= 2), "RED").when((s >= 0.10) | (h >= 1), "ORANGE")
             .when(s >= 0.05, "YELLOW").otherwise("GREEN"))
    # recommended actions (fixed values)
    action = (F.when(level == "RED", "URGENT: Stop predictions, retrain model immediately")
              .when(level == "ORANGE", "Investigate data pipeline, consider retraining")
              .when(level == "YELLOW", "Increase monitoring frequency")
              .otherwise("Continue monitoring"))
    return out.withColumn("severity_level", level).withColumn("recommended_action", action)


def drift_health(dataset: DataFrame, th: DriftThresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Four pass/fail checks and the HEALTHY / WARNING / CRITICAL verdict."""
    t1 = ~F.col("dataset_drift")
    t2 = F.col("share_drifted_features") < th.feature_drift_threshold
    t3 = ~F.col("critical_drift")
    t4 = F.col("severity_level").isin("GREEN", "YELLOW")
    passed = sum(c.cast("int") for c in (t1, t2, t3, t4))
    return (dataset.withColumn("dataset_drift_test", t1).withColumn("feature_drift_test", t2)
            .withColumn("critical_drift_test", t3).withColumn("severity_test", t4)
            .withColumn("total_tests", F.lit(4)).withColumn("passed_tests", passed)
            .withColumn("test_success_rate", F.col("passed_tests") / 4.0)
            .withColumn("overall_health", F.when(F.col("passed_tests") >= 3, "HEALTHY")
                        .when(F.col("passed_tests") >= 2, "WARNING").otherwise("CRITICAL")))


def infer_feature_types(df: DataFrame, features: Sequence[str], ratio: float = 0.05,
                        approximate: bool = False) -> DataFrame:
    """Distinct ratio on the reference cohort -> categorical if < ratio or string."""
    dtypes = dict(df.dtypes)
    long = to_long(df.where(_is_ref()), features, as_string=True)
    nd = F.approx_count_distinct("value") if approximate else F.countDistinct("value")
    out = long.groupBy("feature").agg(F.count("value").alias("n"), nd.alias("n_distinct"))
    strings = [f for f in features if dtypes[f] == "string"]
    out = out.withColumn("is_string", F.col("feature").isin(strings) if strings else F.lit(False))
    r = _div(F.col("n_distinct").cast("double"), F.col("n").cast("double"))
    return (out.withColumn("distinct_ratio", r)
            .withColumn("feature_type", F.when(_flag(r < ratio) | F.col("is_string"), "categorical")
                        .otherwise("numerical")))


def detect(df: DataFrame, spec: FeatureSpec, th: DriftThresholds = DEFAULT_THRESHOLDS
           ) -> tuple[DataFrame, DataFrame]:
    """Full check: route undeclared features, per-feature results, roll-up."""
    num, cat = list(spec.numerical), list(spec.categorical)
    if spec.infer:  # router: one tiny collect of per-feature type decisions
        for row in infer_feature_types(df, spec.infer, th.categorical_ratio).collect():
            (cat if row["feature_type"] == "categorical" else num).append(row["feature"])
    # the per-feature results feed the roll-up and any report: write them once
    feats = cut_lineage(feature_drift(df, spec, th, num, cat), "feature-drift")
    return feats, dataset_drift(feats, spec.keys, th)
