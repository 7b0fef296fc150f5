"""Registered monitoring plans on fixture E (events by type and day)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import monitor as mon
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import r, register
from tidewatch.sources.tables import read_table

_K = ("event_type",)


def _windows(spark, sf):
    e = fx.events_cohorts(spark, sf)
    ref_m = mon.reference_moments(e.where(F.col("cohort") == "ref"), fx.E_NUM, _K)
    win = mon.window_moments(e.where(F.col("cohort") == "cur"), fx.E_NUM, _K, "ts")
    return mon.window_drift(win, ref_m, _K)


def _rollup(spark, sf):
    return mon.window_rollup(_windows(spark, sf), _K)


def _cycles(spark, sf):
    # every (event type, day) of the current period gets a cycle; a day without a
    # drift result would report the failure defaults (zeros, no flag)
    e = fx.events_cohorts(spark, sf).where(F.col("cohort") == "cur")
    calendar = e.select(*_K, F.window("ts", "1 day").start.alias("window_start"))
    cycles = mon.monitor_cycles(mon.with_fallback(calendar, _rollup(spark, sf), _K), _K)
    # a cycle runs when its day is over; a decided retrain is done two minutes before the next day's cycle
    day = F.expr("INTERVAL 1 DAY")
    cycles = cycles.withColumn("cycle_time", F.col("window_start") + day)
    retrains = cycles.where("retrain").select(*_K, (F.col("cycle_time") + day - F.expr("INTERVAL 2 MINUTES")).alias("retrained_at"))
    return mon.with_recent_retrain(cycles, retrains, _K, "cycle_time")


_E_LONG = "\n  UNION ALL ".join(
    f"SELECT cohort, event_type, ts, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM e" for f in fx.E_NUM)

WIN_SQL = f"WITH {fx.E_SQL},\nlg AS (\n  {_E_LONG})," + """
rm AS (
  SELECT event_type, feature, count(value) AS n_ref, avg(value) AS mean_ref, var_samp(value) AS var_ref
  FROM lg WHERE cohort = 'ref' GROUP BY 1, 2),
wm AS (
  SELECT event_type, time_bucket(INTERVAL 1 day, ts) AS window_start, feature, count(value) AS n_cur,
    avg(value) AS mean_cur, var_samp(value) AS var_cur
  FROM lg WHERE cohort = 'cur' GROUP BY 1, 2, 3),
wj AS (
  SELECT wm.*, rm.n_ref, rm.mean_ref, rm.var_ref,
    sqrt(((n_ref - 1) * var_ref + (n_cur - 1) * var_cur) / (n_ref + n_cur - 2)) AS pooled,
    (mean_ref - mean_cur) / sqrt(var_ref / n_ref + var_cur / n_cur) AS t_statistic
  FROM wm LEFT JOIN rm ON wm.event_type IS NOT DISTINCT FROM rm.event_type AND wm.feature = rm.feature),
wd AS (
  SELECT *, CASE WHEN pooled = 0 THEN 0 ELSE (mean_cur - mean_ref) / pooled END AS cohens_d FROM wj),
wf AS (
  SELECT *, coalesce(abs(cohens_d) > 0.1, false) AS drift_detected,
    CASE WHEN abs(cohens_d) > 0.5 THEN 'HIGH' WHEN abs(cohens_d) > 0.3 THEN 'MEDIUM'
         WHEN abs(cohens_d) > 0.1 THEN 'LOW' ELSE 'NONE' END AS severity
  FROM wd),
ru AS (
  SELECT event_type, window_start, count(*) AS total_features,
    count(*) FILTER (WHERE drift_detected) AS n_drifted_features,
    count(*) FILTER (WHERE severity = 'HIGH') AS high_severity_features
  FROM wf GROUP BY 1, 2),
rl AS (
  SELECT *, CASE WHEN total_features > 0 THEN n_drifted_features / total_features ELSE 0.0 END AS share_drifted_features,
    n_drifted_features > total_features * 0.10 AS dataset_drift,
    n_drifted_features > total_features * 0.25 AS critical_drift
  FROM ru),
lv AS (
  SELECT *, CASE WHEN share_drifted_features >= 0.25 OR high_severity_features >= 2 THEN 'RED'
                 WHEN share_drifted_features >= 0.10 OR high_severity_features >= 1 THEN 'ORANGE'
                 WHEN share_drifted_features >= 0.05 THEN 'YELLOW' ELSE 'GREEN' END AS severity_level
  FROM rl),
cy AS (
  SELECT *, severity_level IN ('RED', 'ORANGE') AS retrain,
    row_number() OVER (PARTITION BY event_type ORDER BY window_start) AS cycle
  FROM lv),
cz AS (
  -- the initial cycle comes before the counting, so cycles 6, 11, ... generate data; a retrain
  -- resets a cycle only when it was done less than five minutes before it
  SELECT *, cycle > 1 AND (cycle - 1) % 5 = 0 AS data_added,
    coalesce(lag(retrain) OVER (PARTITION BY event_type ORDER BY window_start)
      AND lag(window_start) OVER (PARTITION BY event_type ORDER BY window_start) = window_start - INTERVAL 1 day, false) AS retrained
  FROM cy),
sp AS (
  -- a cycle that generates data is scored twice: before, and after with the bonus
  SELECT *, CASE WHEN n_drifted_features > 0
                 THEN 0.1 * n_drifted_features + 0.5 * share_drifted_features + CASE WHEN dataset_drift THEN 0.3 ELSE 0.0 END
                 ELSE 0.0 END AS base_inc, (NOT dataset_drift) OR retrained AS reset
  FROM cz),
sc AS (
  SELECT *, 0 AS phase, base_inc AS inc, reset AS event_reset FROM sp
  UNION ALL
  SELECT *, 1, base_inc + 0.2, NOT dataset_drift FROM sp WHERE data_added),
se AS (
  SELECT *, sum(CAST(event_reset AS INTEGER)) OVER (PARTITION BY event_type ORDER BY window_start, phase
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS score_epoch
  FROM sc),
sl AS (
  SELECT *, least(5.0, sum(inc) OVER (PARTITION BY event_type, score_epoch ORDER BY window_start, phase
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS drift_score
  FROM se),
ss AS (
  SELECT *, base_inc + CASE WHEN data_added THEN base_inc + 0.2 ELSE 0.0 END AS increment
  FROM sl WHERE phase = CAST(data_added AS INTEGER))"""


# ------------------------------------------------------------------ K8
@register("windowed_drift", WIN_SQL + """
SELECT event_type, window_start, feature, n_cur, round(cohens_d, 6) AS cohens_d,
  round(t_statistic, 6) AS t_statistic, drift_detected, severity
FROM wf""")
def q_windowed_drift(spark, sf):
    w = _windows(spark, sf)
    return w.select("event_type", "window_start", "feature", "n_cur", r("cohens_d"), r("t_statistic"),
                    "drift_detected", "severity")


# ------------------------------------------------------------------ K9
@register("retrain_decision", WIN_SQL + """
SELECT event_type, window_start, n_drifted_features, round(share_drifted_features, 6) AS share_drifted_features,
  dataset_drift, severity_level, retrain
FROM cy""")
def q_retrain_decision(spark, sf):
    return _rollup(spark, sf).select("event_type", "window_start", "n_drifted_features",
                                     r("share_drifted_features"), "dataset_drift", "severity_level", "retrain")


# ------------------------------------------------------------------ K2 / K3
@register("drift_score", WIN_SQL + """
SELECT event_type, window_start, CAST(cycle AS INTEGER) AS cycle, data_added, retrained, reset,
  round(increment, 6) AS increment, round(drift_score, 6) AS drift_score
FROM ss""")
def q_drift_score(spark, sf):
    s = mon.drift_score(_cycles(spark, sf), _K, "window_start")
    return s.select("event_type", "window_start", "cycle", "data_added", "retrained", "reset",
                    r("increment"), r("drift_score"))


# ------------------------------------------------------------------ K1
@register("drift_gauges", WIN_SQL + """
SELECT event_type, window_start, 'data_drift_features_count' AS metric, CAST(n_drifted_features AS DOUBLE) AS value FROM lv
UNION ALL SELECT event_type, window_start, 'data_drift_share_percent', round(share_drifted_features * 100.0, 6) FROM lv
UNION ALL SELECT event_type, window_start, 'dataset_drift_flag', CAST(dataset_drift AS DOUBLE) FROM lv""")
def q_drift_gauges(spark, sf):
    g = mon.drift_gauges(_rollup(spark, sf), [*_K, "window_start"])
    return g.select("event_type", "window_start", "metric", r("value"))


# ------------------------------------------------------------------ K4
@register("event_counts", """
SELECT time_bucket(INTERVAL 1 day, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def q_event_counts(spark, sf):
    return mon.event_counts(read_table(spark, sf, "events", ["ts", "event_type"]))


# ------------------------------------------------------------------ K5 (bounds sized for events.value)
VALUE_BOUNDS = (1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 100.0)


@register("latency_histogram", "SELECT * FROM (\n" + "\nUNION ALL\n".join(
    [f"SELECT event_type, CAST({b} AS DOUBLE) AS le, count(*) FILTER (WHERE value <= {b}) AS count, "
     f"round(sum(value), 6) AS sum, count(value) AS total FROM events GROUP BY event_type" for b in VALUE_BOUNDS]
    + ["SELECT event_type, CAST('inf' AS DOUBLE), count(value), round(sum(value), 6), count(value) "
       "FROM events GROUP BY event_type"]) + ")")
def q_latency_histogram(spark, sf):
    e = read_table(spark, sf, "events", ["event_type", "value"])
    h = mon.cumulative_histogram(e, "value", VALUE_BOUNDS, _K)
    return h.select("event_type", "le", "count", r("sum"), "total")


# ------------------------------------------------------------------ A12 on the monitor's metric table
@register("metric_filter", WIN_SQL + """,
metrics AS (
  SELECT event_type, window_start, 'data_drift_features_count' AS metric, CAST(n_drifted_features AS DOUBLE) AS value FROM lv
  UNION ALL SELECT event_type, window_start, 'data_drift_share_percent', round(share_drifted_features * 100.0, 6) FROM lv
  UNION ALL SELECT event_type, window_start, 'dataset_drift_flag', CAST(dataset_drift AS DOUBLE) FROM lv
  UNION ALL SELECT event_type, time_bucket(INTERVAL 1 day, ts), 'predictions_' || event_type, CAST(count(*) AS DOUBLE)
    FROM events GROUP BY 1, 2
  UNION ALL SELECT event_type, time_bucket(INTERVAL 1 day, ts), 'process_' || event_type || '_events', CAST(count(*) AS DOUBLE)
    FROM events GROUP BY 1, 2)
SELECT event_type, window_start, metric, value FROM metrics
WHERE regexp_full_match(metric, '""" + mon.KEEP_PATTERN + """')
  AND NOT regexp_full_match(metric, '""" + mon.DROP_PATTERN + "')")
def q_metric_filter(spark, sf):
    g = mon.drift_gauges(_rollup(spark, sf), [*_K, "window_start"]).withColumn("value", r("value"))
    c = mon.event_counts(read_table(spark, sf, "events", ["ts", "event_type"]))
    p = c.select("event_type", "window_start", F.concat(F.lit("predictions_"), "event_type").alias("metric"),
                 F.col("n").cast("double").alias("value"))
    q = c.select("event_type", "window_start", F.concat(F.lit("process_"), "event_type", F.lit("_events")).alias("metric"),
                 F.col("n").cast("double").alias("value"))
    return mon.metric_filter(g.unionByName(p).unionByName(q))


# ------------------------------------------------------------------ K6
@register("info_labels", WIN_SQL + """
SELECT event_type, window_start, 'cycle' AS label, CAST(cycle AS VARCHAR) AS value FROM ss
UNION ALL SELECT event_type, window_start, 'severity', severity_level FROM ss
UNION ALL SELECT event_type, window_start, 'drift_share', printf('%.3f', CAST(share_drifted_features AS DOUBLE)) FROM ss
UNION ALL SELECT event_type, window_start, 'last_generation',
  CASE WHEN data_added THEN strftime(window_start, '%Y-%m-%d') ELSE 'Never' END FROM ss""")
def q_info_labels(spark, sf):
    c = _cycles(spark, sf)
    labels = mon.info_labels(
        cycle=F.col("cycle"), severity=F.col("severity_level"),
        drift_share=F.format_string("%.3f", F.col("share_drifted_features")),
        last_generation=F.when(F.col("data_added"), F.date_format("window_start", "yyyy-MM-dd")).otherwise("Never"))
    return c.select("event_type", "window_start", F.explode(labels).alias("label", "value"))


# ------------------------------------------------------------------ K7 (batch): one metrics snapshot per segment
def _snapshot_sql() -> str:
    from tidewatch.plans.history_plans import _GROWTH_SQL

    growth = _GROWTH_SQL[len("WITH "):]
    return WIN_SQL + ",\n" + growth + """,
last AS (
  SELECT event_type, arg_max(n_drifted_features, window_start) AS n_drifted,
    arg_max(share_drifted_features, window_start) AS share, arg_max(drift_score, window_start) AS score
  FROM ss GROUP BY event_type),
gen AS (
  SELECT event_type, max(cycle) + 1 AS cycle, arg_max(least(0.1 * power(1.2, total_failures), 0.8), cycle) AS strength,
    arg_max(failed_detections, cycle) AS failed, arg_max(data_size, cycle) AS size
  FROM fe GROUP BY event_type)
SELECT event_type, 'data_drift_features_count' AS metric, CAST(n_drifted AS DOUBLE) AS value FROM last
UNION ALL SELECT event_type, 'data_drift_share_percent', round(share * 100.0, 6) FROM last
UNION ALL SELECT event_type, 'dataset_drift_detected', round(score, 6) FROM last
UNION ALL SELECT event_type, 'synthetic_drift_cycle', CAST(cycle AS DOUBLE) FROM gen
UNION ALL SELECT event_type, 'synthetic_drift_strength', round(strength, 6) FROM gen
UNION ALL SELECT event_type, 'synthetic_failed_detections', CAST(failed AS DOUBLE) FROM gen
UNION ALL SELECT event_type, 'synthetic_data_size_total', CAST(size AS DOUBLE) FROM gen"""


@register("monitor_snapshot", _snapshot_sql())
def q_monitor_snapshot(spark, sf):
    from tidewatch.plans.history_plans import q_generator_status

    s = mon.drift_score(_cycles(spark, sf), _K, "window_start")
    last = s.groupBy(*_K).agg(F.max_by("n_drifted_features", "window_start").alias("n_drifted"),
                              F.max_by("share_drifted_features", "window_start").alias("share"),
                              F.max_by("drift_score", "window_start").alias("score"))
    gen = q_generator_status(spark, sf)

    def metric(df, name, value):
        return df.select(*_K, F.lit(name).alias("metric"), value.cast("double").alias("value"))

    # metric names of the reference's monitor (fixed values)
    parts = [metric(last, "data_drift_features_count", F.col("n_drifted")),
             metric(last, "data_drift_share_percent", F.round(F.col("share") * 100.0, 6)),
             metric(last, "dataset_drift_detected", F.round("score", 6)),
             metric(gen, "synthetic_drift_cycle", F.col("cycle")),
             metric(gen, "synthetic_drift_strength", F.col("drift_strength")),
             metric(gen, "synthetic_failed_detections", F.col("failed_detections")),
             metric(gen, "synthetic_data_size_total", F.col("current_data_size"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
