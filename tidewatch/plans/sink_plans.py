"""Registered sink / source plans: report lines, result JSON,
run log, fingerprint, JSON records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import drift, report
from tidewatch.plans import fixtures as fx
from tidewatch.plans.drift_plans import EFFECT, _dataset_sql
from tidewatch.plans.inject_plans import LSTAR_SQL, _lstar
from tidewatch.plans.registry import r, register
from tidewatch.sources.tables import read_table

LSTAR_DATASET_SQL = _dataset_sql(f"WITH {LSTAR_SQL}", "lstar")


def _lstar_results(spark, sf):
    ls = _lstar(spark, sf)
    feats, ds = drift.detect(ls, fx.L_SPEC, EFFECT)
    return ls, feats, ds


def _b(x: str) -> str:
    return f"CASE WHEN {x} THEN 'True' ELSE 'False' END"


# ------------------------------------------------------------------ A6
_ACTION = """CASE severity_level WHEN 'RED' THEN 'URGENT: Stop predictions, retrain model immediately'
  WHEN 'ORANGE' THEN 'Investigate data pipeline, consider retraining'
  WHEN 'YELLOW' THEN 'Increase monitoring frequency' ELSE 'Continue monitoring' END"""

REPORT_SQL = LSTAR_DATASET_SQL + f""",
shape AS (SELECT count(*) FILTER (WHERE cohort = 'ref') AS nr, count(*) FILTER (WHERE cohort = 'cur') AS nc FROM lstar),
head AS (
  SELECT 0 AS block, 0 AS line_no, 'Robust Data Drift Detection Summary' AS line
  UNION ALL SELECT 0, 1, repeat('=', 50)
  UNION ALL SELECT 0, 2, 'Reference data shape: (' || nr || ', 6)' FROM shape
  UNION ALL SELECT 0, 3, 'Current data shape: (' || nc || ', 6)' FROM shape
  UNION ALL SELECT 0, 4, ''
  UNION ALL SELECT 0, 5, 'Overall Drift Metrics:'
  UNION ALL SELECT 0, 6, '- Number of drifted features: ' || n_drifted_features FROM lvl
  UNION ALL SELECT 0, 7, '- Share of drifted features: ' || printf('%.2f%%', share_drifted_features * 100.0) FROM lvl
  UNION ALL SELECT 0, 8, '- Dataset drift detected: ' || {_b('dataset_drift')} FROM lvl
  UNION ALL SELECT 0, 9, '- Critical drift detected: ' || {_b('critical_drift')} FROM lvl
  UNION ALL SELECT 0, 10, '- High severity features: ' || high_severity_features FROM lvl
  UNION ALL SELECT 0, 11, '- Severity level: ' || severity_level FROM lvl
  UNION ALL SELECT 0, 12, '- Recommended action: ' || {_ACTION} FROM lvl
  UNION ALL SELECT 0, 13, ''
  UNION ALL SELECT 0, 14, 'Feature-level Results:'
  UNION ALL SELECT 0, 15, repeat('=', 30)),
fr AS (SELECT *, CAST(row_number() OVER (ORDER BY feature) AS INTEGER) AS block FROM feat),
body AS (
  SELECT block, 0 AS line_no, '' AS line FROM fr
  UNION ALL SELECT block, 1, feature || ':' FROM fr
  UNION ALL SELECT block, 2, '  - Drift detected: ' || {_b('drift_detected')} FROM fr
  UNION ALL SELECT block, 3, '  - Severity: ' || severity FROM fr
  UNION ALL SELECT block, 4, '  - P-value: ' || coalesce(printf('%.6f', p_value), 'N/A') FROM fr
  UNION ALL SELECT block, 5, '  - Method: ' || method FROM fr
  UNION ALL SELECT block, 6, '  - Effect size (Cohen''s d): ' || printf('%.4f', effect_size) FROM fr
    WHERE effect_size IS NOT NULL
  UNION ALL SELECT block, 6, '  - PSI: ' || printf('%.4f', psi) FROM fr WHERE psi IS NOT NULL)
SELECT block, line_no, line FROM head UNION ALL SELECT block, line_no, line FROM body"""


@register("drift_report_lines", REPORT_SQL)
def q_drift_report_lines(spark, sf):
    ls, feats, ds = _lstar_results(spark, sf)
    shape = ls.agg(F.count_if(F.col("cohort") == "ref").alias("n_ref_rows"),
                   F.count_if(F.col("cohort") == "cur").alias("n_cur_rows"),
                   F.lit(len(fx.L_SPEC.features)).alias("n_columns"))
    out = report.report_lines(feats, ds, shape)
    return out.select(F.col("block").cast("int"), F.col("line_no").cast("int"), "line")


# ------------------------------------------------------------------ A5 (nested document: rows-only)
@register("drift_result_json")
def q_drift_result_json(spark, sf):
    ls, feats, ds = _lstar_results(spark, sf)
    return report.result_json(feats, drift.drift_health(ds))


# ------------------------------------------------------------------ A11
_RUN_KEYS = ("total_features", "n_drifted_features", "high_severity_features", "share_drifted_features",
             "dataset_drift", "critical_drift", "passed_tests", "dataset_drift_test", "feature_drift_test",
             "critical_drift_test", "severity_test")


@register("run_log_long", LSTAR_DATASET_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT 'drift-check' AS run_id, 'metric' AS kind, '{k}' AS key, round(CAST({k} AS DOUBLE), 6) AS value FROM hp"
    for k in _RUN_KEYS))
def q_run_log_long(spark, sf):
    _, _, ds = _lstar_results(spark, sf)
    h = drift.drift_health(ds).select(*_RUN_KEYS)
    return report.run_log(h, F.lit("drift-check"), "metric").select("run_id", "kind", "key", r("value"))


# ------------------------------------------------------------------ A13
_O_ROW_SQL = ("CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus || '|' || "
              "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) || '|' || "
              "CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS VARCHAR) || '|' || o_orderpriority")


@register("dataset_fingerprint", f"""
SELECT 'lineitem' AS table_name, count(*) AS n_rows,
  bit_xor(CAST(('0x' || substr(md5({fx.L_KEY_SQL}), 1, 15)) AS BIGINT)) AS fingerprint FROM lineitem
UNION ALL
SELECT 'orders', count(*), bit_xor(CAST(('0x' || substr(md5({_O_ROW_SQL}), 1, 15)) AS BIGINT)) FROM orders""")
def q_dataset_fingerprint(spark, sf):
    li = read_table(spark, sf, "lineitem")
    o = read_table(spark, sf, "orders")
    orow = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus",
                       F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"),
                       F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("string"),
                       "o_orderpriority")
    a = report.fingerprint(li, fx.lineitem_key()).select(F.lit("lineitem").alias("table_name"), "*")
    b = report.fingerprint(o, orow).select(F.lit("orders").alias("table_name"), "*")
    return a.unionByName(b)


# ------------------------------------------------------------------ A9
@register("json_records", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def q_json_records(spark, sf):
    e = read_table(spark, sf, "events", ["event_id", "props"])
    return report.parse_json_records(e, "props", "k BIGINT").select("event_id", "k")


# ------------------------------------------------------------------ A9: scoring requests of up to five records, some of them broken
@register("record_batches", f"""
WITH q AS (
  SELECT event_id // 5 AS request, event_id, user_id, event_type, json_extract_string(props, '$.k') AS k FROM events),
p AS (SELECT *, row_number() OVER (PARTITION BY request ORDER BY event_id) - 1 AS position FROM q)
SELECT request, CASE WHEN request % 17 <> 0 THEN CAST(position AS INTEGER) END AS position,
  CASE WHEN request % 17 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 THEN CAST(user_id AS BIGINT) END AS user,
  CASE WHEN request % 17 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 THEN event_type END AS kind,
  CASE WHEN request % 17 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 THEN TRY_CAST(k AS DOUBLE) END AS k,
  request % 17 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 AS is_broken
FROM p WHERE request % 17 <> 0 OR position = 0""")
def q_record_batches(spark, sf):
    e = read_table(spark, sf, "events", ["event_id", "user_id", "event_type", "props"])
    good = F.format_string('{"user":%d,"kind":"%s","k":%s}', F.col("user_id").cast("long"), "event_type", F.coalesce(F.get_json_object("props", "$.k"), F.lit("null")))
    record = (F.when(F.col("event_id") % 11 == 0, F.format_string('{"user":"many","kind":%d}', F.col("user_id").cast("long")))
              .when(F.col("event_id") % 13 == 0, F.lit("[1]")).otherwise(good))
    # the requests as a client sends them: one document per five events
    rows = e.select(F.floor(F.col("event_id") / 5).alias("request"), "event_id", record.alias("record"))
    records = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "record"))), lambda r: r["record"]), ",")
    requests = rows.groupBy("request").agg(F.concat(F.lit('{"dataframe_records":['), records, F.lit("]}")).alias("body"))
    requests = requests.withColumn("body", F.when(F.col("request") % 17 == 0, F.substring("body", 1, 30)).otherwise(F.col("body")))
    out = report.record_batches(requests, "body", "user BIGINT, kind STRING, k DOUBLE", ["request"])
    return out.select("request", "position", "user", "kind", "k", F.col("broken").isNotNull().alias("is_broken"))
