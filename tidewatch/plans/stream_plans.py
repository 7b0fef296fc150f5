"""Registered Structured Streaming plans.

The rows arrive in parts and the stream runs after each, from its checkpoint.
Twins are the batch plans' SQL: a stream over the same rows must end in the
same table (windows that the watermark has not closed yet are not part of it).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.functions.scalar import uniform, uniform_sql
from tidewatch.operators import inject
from tidewatch.plans import fixtures as fx
from tidewatch.plans import monitor_plans as mp
from tidewatch.plans.inject_plans import _base_sql, _shift_cols
from tidewatch.plans.monitor_plans import WIN_SQL
from tidewatch.plans.registry import ORACLE, r, register
from tidewatch.plans.sqlparts import categorical_ctes, effect_verdict_sql, numeric_ctes, sev_effect_sql
from tidewatch.session import cut_lineage
from tidewatch.sources.tables import read_table
from tidewatch.sources.versions import VersionedTables
from tidewatch.spec import DriftThresholds, FeatureSpec
from tidewatch.streaming import monitor as sm
from tidewatch.streaming.cycle import MonitorCycle, run_available

_K = ("event_type",)


BINS, PARTS = 50, 2


def _reference(spark, sf):
    e = fx.events_cohorts(spark, sf)
    return e.where(F.col("cohort") == "ref")


def _event_parts(df, ts="ts"):
    """The rows in ``PARTS`` parts by time, as they arrive."""
    ends = df.agg(F.unix_seconds(F.min(ts).cast("timestamp")).alias("lo"), F.unix_seconds(F.max(ts).cast("timestamp")).alias("hi")).first()
    step = (ends["hi"] - ends["lo"]) // PARTS + 1
    part = F.floor((F.unix_seconds(F.col(ts).cast("timestamp")) - ends["lo"]) / step)
    return [df.where(part == k) for k in range(PARTS)]


# ------------------------------------------------------------------ K8: closed windows, sketches of BINS equal parts of the reference's range
_B = f"{BINS}"
WINDOWED_SQL = WIN_SQL + f""",
rng AS (SELECT event_type, feature, min(value) AS lo, max(value) AS hi FROM lg WHERE cohort = 'ref' GROUP BY 1, 2),
cut AS (SELECT rng.*, i, lo + (hi - lo) / {_B} * i AS edge FROM rng, range(1, {_B}) t(i)),
bn AS (
  SELECT lg.event_type, lg.feature, cohort, CASE WHEN cohort = 'cur' THEN time_bucket(INTERVAL 1 day, ts) END AS window_start,
    (SELECT count(*) FROM cut WHERE cut.event_type = lg.event_type AND cut.feature = lg.feature AND cut.edge < lg.value) AS bin
  FROM lg WHERE value IS NOT NULL),
wins AS (SELECT DISTINCT event_type, feature, window_start FROM bn WHERE cohort = 'cur'),
ecdf AS (
  SELECT w.event_type, w.feature, w.window_start, c.i, c.edge, c.hi - (c.hi - c.lo) / {_B} - (c.lo + (c.hi - c.lo) / {_B}) AS extent,
    (SELECT count(*) FILTER (WHERE bin < c.i) / count(*) FROM bn WHERE cohort = 'ref' AND bn.event_type = w.event_type AND bn.feature = w.feature) AS f_ref,
    (SELECT count(*) FILTER (WHERE bin < c.i) / count(*) FROM bn WHERE cohort = 'cur' AND bn.event_type = w.event_type AND bn.feature = w.feature
       AND bn.window_start = w.window_start) AS f_cur
  FROM wins w JOIN cut c ON c.event_type = w.event_type AND c.feature = w.feature),
shape AS (
  SELECT event_type, feature, window_start, max(abs(f_ref - f_cur)) AS ks_statistic,
    sum(abs(f_ref - f_cur) * (CASE WHEN i < {_B} - 1 THEN nx - edge ELSE 0 END)) / max(extent) AS normalized_distance
  FROM (SELECT *, lead(edge) OVER (PARTITION BY event_type, feature, window_start ORDER BY i) AS nx FROM ecdf) GROUP BY 1, 2, 3)
SELECT wf.event_type, wf.window_start, wf.feature, n_cur, round(cohens_d, 6) AS cohens_d, round(t_statistic, 6) AS t_statistic,
  round(shape.ks_statistic, 6) AS ks_statistic, round(normalized_distance, 6) AS normalized_distance,
  drift_detected OR normalized_distance > 0.05 AS drift_detected, severity
FROM wf JOIN shape ON wf.event_type = shape.event_type AND wf.feature = shape.feature AND wf.window_start = shape.window_start
WHERE wf.window_start + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 2 DAYS"""


@register("windowed_drift_stream", WINDOWED_SQL)
def q_windowed_drift_stream(spark, sf):
    cur = fx.events_cohorts(spark, sf).where(F.col("cohort") == "cur").select("event_type", "ts", *fx.E_NUM)
    ref, root = _reference(spark, sf), sm.scratch(spark, "windowed-drift")
    cuts = cut_lineage(sm.width_cuts(ref, fx.E_NUM, _K, BINS), "cuts")
    sketch = cut_lineage(sm.reference_sketch(ref, cuts, fx.E_NUM, _K), "reference-sketch")
    store = VersionedTables(spark, f"{root}/tables")
    for stream in sm.arrivals(spark, _event_parts(cur), f"{root}/arrived"):
        sm.windowed_drift_stream(stream, sketch, cuts, fx.E_NUM, _K, store, f"{root}/checkpoint")
    return store.read("windows").select("event_type", "window_start", "feature", "n_cur", r("cohens_d"), r("t_statistic"), r("ks_statistic"),
                                        r("normalized_distance"), "drift_detected", "severity")


# ------------------------------------------------------------------ K2 / K3: cycles and retrains as two kinds of one stream
@register("drift_score_stream", ORACLE["drift_score"])
def q_drift_score_stream(spark, sf):
    cycles, root = cut_lineage(mp._cycles(spark, sf), "cycles"), sm.scratch(spark, "drift-score")
    rows = cycles.select(*_K, F.lit(sm.CYCLE).alias("kind"), F.col("cycle_time").cast("timestamp").alias("at"), F.col("cycle").cast("int").alias("cycle"),
                         F.col("n_drifted_features").cast("long").alias("n_drifted_features"), F.col("share_drifted_features").cast("double").alias("share_drifted_features"),
                         "dataset_drift", "data_added", F.lit(False).alias("generation_failed"))
    done = (F.col("cycle_time") + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 2 MINUTES")).cast("timestamp")
    marks = cycles.where("retrain").select(*_K, F.lit(sm.RETRAIN).alias("kind"), done.alias("at"))
    rows = rows.unionByName(marks, allowMissingColumns=True)
    # one later row of no kind, so that the watermark passes the last cycles
    last = rows.agg(F.max("at").alias("at")).select(F.lit("tick").alias("kind"), (F.col("at") + F.expr("INTERVAL 1 DAY")).alias("at"))
    parts = [*_event_parts(rows, "at"), rows.limit(0).unionByName(last, allowMissingColumns=True)]
    for stream in sm.arrivals(spark, parts, f"{root}/arrived"):
        sm.drift_score_stream(stream, f"{root}/scores", f"{root}/checkpoint", _K)
    s = spark.read.parquet(f"{root}/scores")
    return s.select("event_type", (F.col("at").cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")).alias("window_start"), "cycle", "data_added", "retrained", "reset",
                    r("increment"), r("drift_score"))


@register("event_counts_stream", ORACLE["event_counts"])
def q_event_counts_stream(spark, sf):
    events, root = read_table(spark, sf, "events", ["ts", "event_type"]), sm.scratch(spark, "event-counts")
    store = VersionedTables(spark, f"{root}/tables")
    for stream in sm.arrivals(spark, _event_parts(events), f"{root}/arrived"):
        sm.event_counts_stream(stream, store, f"{root}/checkpoint")
    return sm.newest_counts(store)


# ------------------------------------------------------------------ K7: the full cycle per micro-batch
SLICE_DAYS, GENERATE_EVERY, GENERATED_SHARE, GENERATED_STRENGTH = 5, 2, 0.2, 0.3
CYCLE_SPEC = FeatureSpec(numerical=fx.E_NUM, categorical=("user_group",), keys=_K)
CYCLE_SHIFTS = {"value": 1.5, "k": 0.8}


def _cycle_events(spark, sf):
    e = fx.events_cohorts(spark, sf).withColumn("user_group", (F.col("user_id") % 3).cast("string"))
    days = F.datediff(F.col("ts").cast("date"), F.lit(fx.E_CUT[:10]).cast("date"))
    return e.withColumn("slice", F.floor(days / SLICE_DAYS).cast("int"))


def run_monitor(spark, sf, generate=None) -> VersionedTables:
    """Feeds the current events to the stream slice by slice, as they would
    arrive, and runs the cycle after each arrival."""
    events = _cycle_events(spark, sf)
    reference = events.where(F.col("cohort") == "ref").drop("slice")
    arriving = events.where(F.col("cohort") == "cur")
    base = inject.wide_stats(reference, fx.E_NUM, "b")

    def shifted(batch, due):
        rows = reference.join(due, list(_K)).withColumn("_key", F.concat_ws("|", "event_id", "cycle"))
        rows = rows.where(uniform(F.col("_key"), "gen") < GENERATED_SHARE)
        return inject.input_shift(rows, CYCLE_SHIFTS, GENERATED_STRENGTH, F.col("_key"), base, step=None, sd_units=True)

    def retrained(decided):  # done two minutes before the next cycle
        return decided.select(*_K, (F.col("cycle_time") + F.expr(f"INTERVAL {SLICE_DAYS} DAYS") - F.expr("INTERVAL 2 MINUTES")).alias("retrained_at"))

    begin = dt.datetime.fromisoformat(fx.E_CUT)
    root = sm.scratch(spark, "monitor")
    cycle = MonitorCycle(CYCLE_SPEC, VersionedTables(spark, f"{root}/tables"), DriftThresholds(effect_only=True), GENERATE_EVERY,
                         clock=lambda batch_id: begin + dt.timedelta(days=SLICE_DAYS * (batch_id + 1)), generate=generate or shifted, retrain=retrained)
    cycle.set_reference(reference)
    columns = ["event_id", "event_type", "ts", *fx.E_NUM, "user_group"]
    last = arriving.agg(F.max("slice")).first()[0]
    slices = [arriving.where(F.col("slice") == k).select(*columns) for k in range(0 if last is None else last + 1)]
    for stream in sm.arrivals(spark, slices, f"{root}/arrived"):
        run_available(stream, cycle, f"{root}/checkpoint")
    return cycle.store


def _monitor_sql() -> str:
    keys = ("event_type", "batch_id", "checked")
    generated = _shift_cols(CYCLE_SHIFTS, GENERATED_STRENGTH, "gkey", True, False)
    numeric = "\n  UNION ALL ".join(f"SELECT event_type, batch_id, checked, cohort, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM rows_" for f in fx.E_NUM)
    return f"""WITH {fx.E_SQL},
ev AS (
  SELECT event_id, event_type, cohort, value, k, CAST(user_id % 3 AS VARCHAR) AS user_group,
    CAST(floor(date_diff('day', DATE '{fx.E_CUT[:10]}', CAST(ts AS DATE)) / {SLICE_DAYS}) AS BIGINT) AS slice FROM e),
runs AS (
  SELECT event_type, slice AS batch_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY slice) AS INTEGER) AS cycle
  FROM (SELECT DISTINCT event_type, slice FROM ev WHERE cohort = 'cur')),
due AS (SELECT * FROM runs WHERE cycle > 1 AND (cycle - 1) % {GENERATE_EVERY} = 0),
checks AS (SELECT event_type, batch_id, 'batch' AS checked FROM runs UNION ALL SELECT event_type, batch_id, 'generated' FROM due),
{_base_sql('ev', fx.E_NUM)},
drawn AS (
  SELECT ev.event_type, due.batch_id, value, k, user_group, CAST(event_id AS VARCHAR) || '|' || CAST(due.cycle AS VARCHAR) AS gkey
  FROM ev JOIN due ON ev.event_type = due.event_type WHERE cohort = 'ref'),
gen AS (SELECT event_type, batch_id, {generated}, user_group FROM drawn, b WHERE {uniform_sql('gkey', 'gen')} < {GENERATED_SHARE}),
rows_ AS (
  SELECT c.event_type, c.batch_id, c.checked, 'ref' AS cohort, value, k, user_group
  FROM ev JOIN checks c ON ev.event_type = c.event_type WHERE ev.cohort = 'ref'
  UNION ALL SELECT c.event_type, c.batch_id, c.checked, 'cur', value, k, user_group
  FROM ev JOIN checks c ON ev.event_type = c.event_type AND ev.slice = c.batch_id WHERE ev.cohort = 'cur'
  UNION ALL SELECT event_type, batch_id, 'generated', 'cur', value, k, user_group FROM gen),
lg AS (
  {numeric}),{numeric_ctes('lg', keys)},
lc AS (SELECT event_type, batch_id, checked, cohort, 'user_group' AS feature, user_group AS value FROM rows_),{categorical_ctes('lc', keys)},
ft AS (
  SELECT event_type, batch_id, checked, feature, ks_statistic, normalized_distance, cohens_d AS effect_size, levene_statistic, NULL AS psi,
    {effect_verdict_sql('num')} AS drift_detected, {sev_effect_sql('num')} AS severity FROM num
  UNION ALL SELECT event_type, batch_id, checked, feature, NULL, NULL, NULL, NULL, CASE WHEN NOT low_count THEN psi END,
    CASE WHEN low_count THEN coalesce(max_proportion_difference > 0.1, false) ELSE coalesce(psi > 0.05, false) END,
    CASE WHEN low_count THEN CASE WHEN max_proportion_difference > 0.2 THEN 'HIGH' WHEN max_proportion_difference > 0.1 THEN 'MEDIUM' ELSE 'LOW' END
         ELSE CASE WHEN psi > 0.25 THEN 'HIGH' WHEN psi > 0.2 THEN 'MEDIUM' WHEN psi > 0.1 THEN 'LOW' ELSE 'NONE' END END FROM cat),
ru AS (
  SELECT event_type, batch_id, checked, count(*) AS total, count(*) FILTER (WHERE drift_detected) AS n, count(*) FILTER (WHERE severity = 'HIGH') AS high
  FROM ft GROUP BY 1, 2, 3),
rl AS (
  SELECT *, n / total AS share, n > total * 0.10 AS flag,
    CASE WHEN n / total >= 0.25 OR high >= 2 THEN 'RED' WHEN n / total >= 0.10 OR high >= 1 THEN 'ORANGE' WHEN n / total >= 0.05 THEN 'YELLOW' ELSE 'GREEN' END AS level,
    CASE WHEN n > 0 THEN 0.1 * n + 0.5 * (n / total) + CASE WHEN n > total * 0.10 THEN 0.3 ELSE 0 END ELSE 0 END
      + CASE WHEN checked = 'generated' THEN 0.2 ELSE 0 END AS gain FROM ru),
final AS (SELECT * FROM rl QUALIFY row_number() OVER (PARTITION BY event_type, batch_id ORDER BY checked DESC) = 1),
marks AS (
  SELECT event_type, batch_id, coalesce(lag(level) OVER w IN ('RED', 'ORANGE') AND lag(batch_id) OVER w = batch_id - 1, false) AS retrained
  FROM final WINDOW w AS (PARTITION BY event_type ORDER BY batch_id)),
sc AS (
  SELECT rl.event_type, rl.batch_id, rl.checked, gain, NOT flag OR (rl.checked = 'batch' AND retrained) AS reset
  FROM rl JOIN marks m ON rl.event_type = m.event_type AND rl.batch_id = m.batch_id),
se AS (SELECT *, sum(CAST(reset AS INTEGER)) OVER (PARTITION BY event_type ORDER BY batch_id, checked ROWS UNBOUNDED PRECEDING) AS epoch FROM sc),
sl AS (
  SELECT *, least(5.0, sum(gain) OVER (PARTITION BY event_type, epoch ORDER BY batch_id, checked ROWS UNBOUNDED PRECEDING)) AS score,
    sum(gain) OVER (PARTITION BY event_type, batch_id) AS increment FROM se),
cy AS (
  SELECT f.event_type, f.batch_id, runs.cycle, m.retrained, f.n, f.share, f.flag, f.level, sl.score, sl.increment,
    due.cycle IS NOT NULL AS data_added
  FROM final f JOIN marks m ON f.event_type = m.event_type AND f.batch_id = m.batch_id
  JOIN runs ON f.event_type = runs.event_type AND f.batch_id = runs.batch_id
  LEFT JOIN due ON f.event_type = due.event_type AND f.batch_id = due.batch_id
  JOIN sl ON f.event_type = sl.event_type AND f.batch_id = sl.batch_id AND f.checked = sl.checked)
SELECT ft.event_type, ft.batch_id, ft.checked, ft.feature, round(ks_statistic, 6) AS ks_statistic, round(normalized_distance, 6) AS normalized_distance,
  round(effect_size, 6) AS effect_size, round(levene_statistic, 4) AS levene_statistic, round(psi, 6) AS psi, ft.drift_detected, ft.severity,
  cycle, data_added, retrained, n AS n_drifted_features, round(share, 6) AS share_drifted_features, flag AS dataset_drift, level AS severity_level,
  level IN ('RED', 'ORANGE') AS retrain, round(increment, 6) AS increment, round(score, 6) AS drift_score
FROM ft JOIN cy ON ft.event_type = cy.event_type AND ft.batch_id = cy.batch_id"""


@register("stream_monitor", _monitor_sql())
def q_stream_monitor(spark, sf):
    store = run_monitor(spark, sf)
    features, cycles = store.read("features"), store.read("cycles")
    cycles = cycles.select(*_K, "batch_id", "cycle", "data_added", "retrained", "n_drifted_features", r("share_drifted_features"), "dataset_drift",
                           "severity_level", "retrain", r("increment"), r("drift_score"))
    features = features.select(*_K, "batch_id", "checked", "feature", r("ks_statistic"), r("normalized_distance"), r("effect_size"),
                               r("levene_statistic", digits=4), r("psi"), "drift_detected", "severity")
    return features.join(cycles, [*_K, "batch_id"])
