"""Registered history plans on fixture H."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import history as hist
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import r, register
from tidewatch.sources.tables import read_table

_K = ("event_type",)

_GROWTH_SQL = f"WITH {fx.H_SQL}," + """
g AS (
  SELECT *, lag(data_size) OVER (PARTITION BY event_type ORDER BY cycle) AS prev_size,
    row_number() OVER (PARTITION BY event_type ORDER BY cycle) AS rn
  FROM h),
gs AS (
  SELECT *, CASE WHEN rn > 2 THEN CASE WHEN prev_size > 0 THEN (data_size - prev_size) / prev_size ELSE 0.0 END
                 END AS growth_rate,
    CASE WHEN rn <= 2 THEN 'unknown'
         WHEN (CASE WHEN prev_size > 0 THEN (data_size - prev_size) / prev_size ELSE 0.0 END) > 0.1
           THEN 'detected' ELSE 'not_detected' END AS drift_state
  FROM g),
fs AS (
  SELECT *, sum(CAST(drift_state = 'detected' AS INTEGER)) OVER (PARTITION BY event_type ORDER BY cycle
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reset_epoch,
    sum(CAST(drift_state = 'not_detected' AS INTEGER)) OVER (PARTITION BY event_type ORDER BY cycle
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total_failures
  FROM gs),
fe AS (
  SELECT *, sum(CAST(drift_state = 'not_detected' AS INTEGER)) OVER (PARTITION BY event_type, reset_epoch
              ORDER BY cycle ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS failed_detections
  FROM fs)"""


def _h(spark, sf):
    return fx.history_table(spark, sf)


def _streak(spark, sf):
    return hist.failure_streak(hist.growth_state(_h(spark, sf), _K), _K)


# ------------------------------------------------------------------ E3
@register("growth_state", _GROWTH_SQL + """
SELECT event_type, cycle, data_size, prev_size, round(growth_rate, 6) AS growth_rate, drift_state FROM gs""")
def q_growth_state(spark, sf):
    g = hist.growth_state(_h(spark, sf), _K)
    return g.select("event_type", "cycle", "data_size", "prev_size", r("growth_rate"), "drift_state")


# ------------------------------------------------------------------ E4
@register("failure_streak", _GROWTH_SQL + """
SELECT event_type, cycle, drift_state, CAST(reset_epoch AS BIGINT) AS reset_epoch,
  CAST(failed_detections AS BIGINT) AS failed_detections, CAST(total_failures AS BIGINT) AS total_failures
FROM fe""")
def q_failure_streak(spark, sf):
    s = _streak(spark, sf)
    return s.select("event_type", "cycle", "drift_state", "reset_epoch", "failed_detections", "total_failures")


# ------------------------------------------------------------------ I10
@register("strength_ladder", _GROWTH_SQL + """
SELECT event_type, cycle, CAST(total_failures AS BIGINT) AS total_failures,
  round(least(0.1 * power(1.2, total_failures), 0.8), 6) AS drift_strength
FROM fe""")
def q_strength_ladder(spark, sf):
    s = hist.strength_ladder(_streak(spark, sf), _K)
    return s.select("event_type", "cycle", "total_failures", r("drift_strength"))


# ------------------------------------------------------------------ B18
@register("drift_rotation", f"WITH {fx.H_SQL}" + """
SELECT event_type, cycle, drift_type FROM h""")
def q_drift_rotation(spark, sf):
    return _h(spark, sf).select("event_type", "cycle", "drift_type")


# ------------------------------------------------------------------ E5
@register("last_n_history", f"WITH {fx.H_SQL}" + """
SELECT event_type, cycle, drift_type, new_samples, data_size FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY cycle DESC) AS rk FROM h) WHERE rk <= 5""")
def q_last_n_history(spark, sf):
    return hist.last_n(_h(spark, sf), 5, _K).select("event_type", "cycle", "drift_type", "new_samples",
                                                    "data_size")


# ------------------------------------------------------------------ A3/A4: state document -> rows
@register("history_flatten", f"WITH {fx.H_SQL}" + """
SELECT event_type, cycle, timestamp, drift_type, new_samples, data_size, data_size AS total_size FROM h""")
def q_history_flatten(spark, sf):
    h = _h(spark, sf)
    # one state document per monitored segment: its history array is bounded by the number of cycles
    rec = F.struct("cycle", "timestamp", "drift_type", "new_samples", "total_size", "data_size")
    docs = h.groupBy("event_type").agg(F.array_sort(F.collect_list(rec)).alias("drift_history"))
    flat = docs.select("event_type", F.explode("drift_history").alias("e")).select("event_type", "e.*")
    return flat.select("event_type", "cycle", "timestamp", "drift_type", "new_samples", "data_size", "total_size")


# ------------------------------------------------------------------ E2
RET_CUT = "2024-01-30 00:00:00"


@register("retention_tail", f"""
WITH cur AS (SELECT event_id, event_type FROM events WHERE ts < TIMESTAMP '{RET_CUT}'),
nw AS (SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '{RET_CUT}'),
kept AS (
  SELECT event_id, event_type FROM (
    SELECT *, row_number() OVER (ORDER BY event_id DESC) AS rn FROM cur)
  WHERE rn <= greatest({hist.RETENTION_CAP} - (SELECT count(*) FROM nw), 0))
SELECT event_id, event_type FROM kept UNION ALL SELECT event_id, event_type FROM nw""")
def q_retention_tail(spark, sf):
    e = read_table(spark, sf, "events", ["event_id", "ts", "event_type"])
    cut = fx.ntz(RET_CUT)
    cur = e.where(F.col("ts") < cut).select("event_id", "event_type")
    new = e.where(F.col("ts") >= cut).select("event_id", "event_type")
    return hist.retention_tail(cur, new, "event_id", hist.RETENTION_CAP)


# ------------------------------------------------------------------ E6
@register("head_n", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate LIMIT 5""")
def q_head_n(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return (li.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
            .limit(5).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                             "l_extendedprice"))


# ------------------------------------------------------------------ E9 / J1
@register("append_by_name", f"WITH {fx.L_SQL}," + """
old AS (SELECT l_quantity, l_returnflag, cohort FROM l WHERE cohort = 'ref'),
new AS (SELECT l_tax, cohort, l_quantity FROM l WHERE cohort = 'cur'),
u AS (SELECT * FROM old UNION ALL BY NAME SELECT * FROM new)
SELECT cohort, count(*) AS n_rows, count(l_returnflag) AS n_returnflag, count(l_tax) AS n_tax,
  round(sum(l_quantity), 4) AS sum_quantity
FROM u GROUP BY cohort""")
def q_append_by_name(spark, sf):
    l_ = fx.lineitem_cohorts(spark, sf, ("l_tax",))
    old = l_.where(F.col("cohort") == "ref").select("l_quantity", "l_returnflag", "cohort")
    new = l_.where(F.col("cohort") == "cur").select("l_tax", "cohort", "l_quantity")
    u = old.unionByName(new, allowMissingColumns=True)
    return u.groupBy("cohort").agg(F.count("*").alias("n_rows"), F.count("l_returnflag").alias("n_returnflag"),
                                   F.count("l_tax").alias("n_tax"),
                                   F.round(F.sum("l_quantity"), 4).alias("sum_quantity"))


# ------------------------------------------------------------------ I11: one status row per monitored segment
@register("generator_status", _GROWTH_SQL + """,
st AS (SELECT *, least(0.1 * power(1.2, total_failures), 0.8) AS drift_strength FROM fe)
SELECT event_type, CAST(max(cycle) + 1 AS INTEGER) AS cycle, round(arg_max(drift_strength, cycle), 6) AS drift_strength,
  CAST(arg_max(failed_detections, cycle) AS BIGINT) AS failed_detections,
  CAST(count(*) FILTER (WHERE cycle > 0) AS BIGINT) AS total_adaptations,
  max(timestamp) FILTER (WHERE drift_state = 'detected') AS last_drift_detected,
  CAST(arg_max(data_size, cycle) AS BIGINT) AS current_data_size
FROM st GROUP BY event_type""")
def q_generator_status(spark, sf):
    s = hist.strength_ladder(_streak(spark, sf), _K)
    return s.groupBy("event_type").agg(
        (F.max("cycle") + 1).cast("int").alias("cycle"),
        F.round(F.max_by("drift_strength", "cycle"), 6).alias("drift_strength"),
        F.max_by("failed_detections", "cycle").cast("long").alias("failed_detections"),
        F.count_if(F.col("cycle") > 0).alias("total_adaptations"),
        F.max(F.when(F.col("drift_state") == "detected", F.col("timestamp"))).alias("last_drift_detected"),
        F.max_by("data_size", "cycle").alias("current_data_size"))
