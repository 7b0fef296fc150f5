"""Monitoring as table operators: gauges, accumulated drift score, tumbling
drift against a reference, event counters, cumulative histograms, retrain
decisions and metric-name filtering.

Everything is keyed by segment so one job monitors many datasets; windows
over a segment's cycle history are bounded by the number of cycles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.cohorts import REF, to_long
from tidewatch.operators.small import join_on

# score parameters (fixed values, reference defaults)
SCORE_PER_FEATURE = 0.1
SCORE_PER_SHARE = 0.5
SCORE_DATASET_FLAG = 0.3
SCORE_DATA_ADDED = 0.2
SCORE_CAP = 5.0
# metric-name keep / drop patterns (fixed values of the reference's scrape config)
KEEP_PATTERN = ("model_.*|system_.*|data_drift_.*|dataset_drift_.*|predictions_.*|prediction_duration_.*"
                "|synthetic_.*|monitoring_cycles_.*")
DROP_PATTERN = "prometheus_.*|go_.*|process_.*|net_conntrack_.*|python_gc_.*"
# default latency histogram bounds (fixed values of the metrics client library)
DEFAULT_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def drift_gauges(dataset: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One dataset-drift row -> (metric, value) rows."""
    def g(name: str, v: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), v.cast("double").alias("value"))

    return dataset.select(*keys, F.explode(F.array(
        g("data_drift_features_count", F.col("n_drifted_features")),
        g("data_drift_share_percent", F.col("share_drifted_features") * 100.0),
        g("dataset_drift_flag", F.col("dataset_drift")),
    )).alias("g")).select(*keys, "g.metric", "g.value")


def score_increment(n_drifted: Column, share: Column, flag: Column, data_added: Column) -> Column:
    inc = F.when(n_drifted > 0, SCORE_PER_FEATURE * n_drifted + SCORE_PER_SHARE * share
                 + F.when(flag, SCORE_DATASET_FLAG).otherwise(0.0)).otherwise(0.0)
    return inc + F.when(data_added, SCORE_DATA_ADDED).otherwise(0.0)


def drift_score(cycles: DataFrame, keys: Sequence[str] = (), order: str = "cycle") -> DataFrame:
    """Score after each cycle: score = min(cap, (reset ? 0 : score) + inc) over
    the cycle's score events.

    Every cycle scores its drift check; a cycle that adds data scores a second
    check after the generation, with the bonus for added data. A check without
    the dataset flag resets the gauge first, and so does a retrain shortly
    before the cycle (its first check only). Where the optional column
    ``generation_failed`` is true, the second event is the failure default
    (one feature, a share of 0.1) and does not reset. Increments are
    non-negative, so the recursion equals ``least(cap, sum(inc) since the last
    reset)``. Input columns: n_drifted_features, share_drifted_features,
    dataset_drift, data_added, retrained. ``increment`` is the cycle's total.
    """
    failed = F.col("generation_failed") if "generation_failed" in cycles.columns else F.lit(False)
    n, share, flag = F.col("n_drifted_features"), F.col("share_drifted_features"), F.col("dataset_drift")
    first = score_increment(n, share, flag, F.lit(False))
    second = F.when(failed, score_increment(F.lit(1), F.lit(0.1), F.lit(False), F.lit(True))).otherwise(
        score_increment(n, share, flag, F.lit(True)))
    checks = F.array(F.struct(F.lit(0).alias("phase"), first.alias("inc"), (~flag | F.col("retrained")).alias("reset")))
    again = F.array(F.struct(F.lit(1).alias("phase"), second.alias("inc"), (~flag & ~failed).alias("reset")))
    events = cycles.select("*", F.explode(F.when(F.col("data_added"), F.concat(checks, again)).otherwise(checks)).alias("_e"))
    w = Window.partitionBy(*keys).orderBy(order, "_e.phase").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    events = events.withColumn("score_epoch", F.sum(F.col("_e.reset").cast("int")).over(w))
    w2 = (Window.partitionBy(*keys, "score_epoch").orderBy(order, "_e.phase")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scored = events.withColumn("drift_score", F.least(F.lit(SCORE_CAP), F.sum("_e.inc").over(w2)))
    return (scored.where(F.col("_e.phase") == F.col("data_added").cast("int"))
            .withColumn("increment", first + F.when(F.col("data_added"), second).otherwise(0.0))
            .withColumn("reset", ~flag | F.col("retrained")).drop("_e"))


def reference_moments(ref: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    long = to_long(ref.withColumn("cohort", F.lit(REF)), features, keys)
    return long.groupBy(*keys, "feature").agg(F.count("value").alias("n_ref"), F.avg("value").alias("mean_ref"),
                                              F.var_samp("value").alias("var_ref"))


def window_moments(cur: DataFrame, features: Sequence[str], keys: Sequence[str], ts: str,
                   width: str = "1 day") -> DataFrame:
    """Per tumbling window and segment: count, mean, var of each feature."""
    w = cur.withColumn("window_start", F.window(F.col(ts), width).start)
    long = to_long(w.withColumn("cohort", F.lit("cur")), features, [*keys, "window_start"])
    return long.groupBy(*keys, "window_start", "feature").agg(
        F.count("value").alias("n_cur"), F.avg("value").alias("mean_cur"), F.var_samp("value").alias("var_cur"))


def window_drift(win: DataFrame, ref_m: DataFrame, keys: Sequence[str], effect: float = 0.1) -> DataFrame:
    """Cohen d and Welch t of each window against the reference moments.
    A segment that the reference lacks keeps its rows (``insufficient_data``)."""
    k = [*keys, "feature"]
    j = join_on(win, ref_m, k, "left").withColumn("n_ref", F.coalesce("n_ref", F.lit(0)))
    n1, n2 = F.col("n_ref"), F.col("n_cur")
    pooled = F.sqrt(F.try_divide((n1 - 1) * F.col("var_ref") + (n2 - 1) * F.col("var_cur"),
                                 (n1 + n2 - 2).cast("double")))
    d = F.when(pooled == 0, F.lit(0.0)).otherwise(F.try_divide(F.col("mean_cur") - F.col("mean_ref"), pooled))
    se = F.sqrt(F.try_divide(F.col("var_ref"), n1.cast("double")) + F.try_divide(F.col("var_cur"), n2.cast("double")))
    return (j.withColumn("cohens_d", d)
            .withColumn("t_statistic", F.try_divide(F.col("mean_ref") - F.col("mean_cur"), se))
            .withColumn("drift_detected", F.coalesce(F.abs(F.col("cohens_d")) > effect, F.lit(False)))
            .withColumn("severity", F.when(F.abs(F.col("cohens_d")) > 0.5, "HIGH")
                        .when(F.abs(F.col("cohens_d")) > 0.3, "MEDIUM")
                        .when(F.abs(F.col("cohens_d")) > 0.1, "LOW").otherwise("NONE"))
            .withColumn("method", F.when((F.col("n_ref") == 0) | (F.col("n_cur") == 0), "insufficient_data")
                        .otherwise("statistical_tests")))


def window_rollup(per_feature: DataFrame, keys: Sequence[str], feature_threshold: float = 0.10,
                  critical_threshold: float = 0.25) -> DataFrame:
    """Dataset roll-up per (segment, window) + traffic light + retrain decision."""
    g = per_feature.groupBy(*keys, "window_start").agg(
        F.count("*").alias("total_features"),
        F.count_if(F.col("drift_detected")).alias("n_drifted_features"),
        F.count_if(F.col("severity") == "HIGH").alias("high_severity_features"))
    n = F.col("total_features")
    g = (g.withColumn("share_drifted_features", F.when(n > 0, F.col("n_drifted_features") / n).otherwise(0.0))
         .withColumn("dataset_drift", F.col("n_drifted_features") > n * feature_threshold)
         .withColumn("critical_drift", F.col("n_drifted_features") > n * critical_threshold))
    s, h = F.col("share_drifted_features"), F.col("high_severity_features")
    lvl = (F.when((s >= 0.25) | (h >= 2), "RED").when((s >= 0.10) | (h >= 1), "ORANGE")
           .when(s >= 0.05, "YELLOW").otherwise("GREEN"))
    return g.withColumn("severity_level", lvl).withColumn("retrain", lvl.isin("RED", "ORANGE"))


def with_fallback(calendar: DataFrame, rollup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every (segment, window) of ``calendar`` gets a roll-up row; a window
    whose drift check produced nothing reports zeros and no dataset flag
    (the monitor's failure defaults), so the score resets there."""
    on = [*keys, "window_start"]
    j = join_on(calendar.select(*on).distinct(), rollup, on, "left")
    return (j.withColumn("failed", F.col("total_features").isNull())
            .fillna({"total_features": 0, "n_drifted_features": 0, "high_severity_features": 0,
                     "share_drifted_features": 0.0, "dataset_drift": False, "critical_drift": False,
                     "severity_level": "GREEN", "retrain": False}))


def monitor_cycles(rollup: DataFrame, keys: Sequence[str], every: int = 5) -> DataFrame:
    """Cycle index per segment and data generation in every ``every``-th cycle
    after the initial one (cycles 6, 11, ...)."""
    w = Window.partitionBy(*keys).orderBy("window_start")
    return (rollup.withColumn("cycle", F.row_number().over(w))
            .withColumn("data_added", (F.col("cycle") > 1) & ((F.col("cycle") - 1) % every == 0)))


# a retrain counts for a cycle that starts less than this many seconds later (fixed value)
RETRAIN_SECONDS = 300


def with_recent_retrain(cycles: DataFrame, retrains: DataFrame, keys: Sequence[str], time: str,
                        within: int = RETRAIN_SECONDS) -> DataFrame:
    """Adds ``retrained``: the newest retrain (``retrained_at`` in ``retrains``)
    not after the cycle's ``time`` is less than ``within`` seconds old. One
    union and one running window per segment, bounded by its cycles."""
    marks = retrains.select(*keys, F.col("retrained_at").alias("_at"), F.col("retrained_at").alias("_seen"))
    rows = cycles.withColumn("_at", F.col(time)).unionByName(marks, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_at", F.col("_seen").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_last", F.last("_seen", ignorenulls=True).over(w)).where(F.col(time).isNotNull())
    age = F.unix_micros(F.col("_at").cast("timestamp")) - F.unix_micros(F.col("_last").cast("timestamp"))
    return rows.withColumn("retrained", F.coalesce(age < within * 1_000_000, F.lit(False))).drop("_at", "_seen", "_last")


def event_counts(events: DataFrame, ts: str = "ts", keys: Sequence[str] = ("event_type",),
                 width: str = "1 day") -> DataFrame:
    return (events.groupBy(F.window(F.col(ts), width).start.alias("window_start"), *keys)
            .agg(F.count("*").alias("n")))


def cumulative_histogram(df: DataFrame, value: str, bounds: Sequence[float] = DEFAULT_BUCKETS,
                         keys: Sequence[str] = ()) -> DataFrame:
    """Cumulative ``le`` buckets (+Inf), sum and count in one aggregate."""
    v = F.col(value)
    aggs = [F.count_if(v <= b).alias(f"le_{i}") for i, b in enumerate(bounds)]
    g = df.groupBy(*keys) if keys else df.groupBy()
    wide = g.agg(*aggs, F.count(v).alias("_inf"), F.sum(v).alias("_sum"))
    rows = [F.struct(F.lit(float(b)).alias("le"), F.col(f"le_{i}").alias("count")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("_inf").alias("count")))
    return wide.select(*keys, "_sum", "_inf", F.explode(F.array(*rows)).alias("b")).select(
        *keys, "b.le", "b.count", F.col("_sum").alias("sum"), F.col("_inf").alias("total"))


def metric_filter(df: DataFrame, name: str = "metric", keep: str = KEEP_PATTERN, drop: str = DROP_PATTERN) -> DataFrame:
    """Keep then drop by fully anchored regular expressions."""
    n = F.col(name)
    return df.where(n.rlike(f"^(?:{keep})$") & ~n.rlike(f"^(?:{drop})$"))


def info_labels(**cols: Column) -> Column:
    """String label map (info metric)."""
    parts = []
    for k, c in cols.items():
        parts += [F.lit(k), c.cast("string")]
    return F.create_map(*parts)
