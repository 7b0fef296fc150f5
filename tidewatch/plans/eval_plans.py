"""Registered evaluation and model-lifecycle plans."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewatch.functions.scalar import uniform, uniform_sql
from tidewatch.operators import drift, inject
from tidewatch.operators import evaluate as ev
from tidewatch.operators import lifecycle as lc
from tidewatch.operators.small import attach_row
from tidewatch.plans import fixtures as fx
from tidewatch.plans.registry import r, register
from tidewatch.session import cut_lineage, ensure_checkpoint_dir
from tidewatch.sources.versions import VersionedTables
from tidewatch.spec import DriftThresholds, FeatureSpec

_S = f"WITH {fx.S_SQL}"


def _s(spark, sf):
    return fx.scored_documents(spark, sf)


# ------------------------------------------------------------------ J7
@register("accuracy", _S + """
SELECT round(avg(CAST(label = pred AS DOUBLE)), 6) AS accuracy, count(*) AS n FROM s""")
def q_accuracy(spark, sf):
    return ev.accuracy(_s(spark, sf)).select(r("accuracy"), "n")


_ROC_CTE = _S + """,
sc AS (SELECT score, count(*) FILTER (WHERE label <> 1) AS neg, count(*) FILTER (WHERE label = 1) AS pos
       FROM s GROUP BY score),
cu AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg,
              sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cpos FROM sc),
tt AS (SELECT sum(neg) AS n_neg, sum(pos) AS n_pos FROM sc)"""


# ------------------------------------------------------------------ J8
@register("roc_auc", _ROC_CTE + """
SELECT CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg,
  round((SELECT sum(pos * (cneg - neg + neg / 2.0)) FROM cu) / (n_pos * n_neg), 6) AS roc_auc
FROM tt""")
def q_roc_auc(spark, sf):
    return ev.roc_auc(_s(spark, sf)).select("n_pos", "n_neg", r("roc_auc"))


# ------------------------------------------------------------------ J9
@register("roc_curve", _ROC_CTE + """
SELECT score AS threshold, round((n_neg - cneg + neg) / n_neg, 6) AS fpr, round((n_pos - cpos + pos) / n_pos, 6) AS tpr
FROM cu, tt
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")
def q_roc_curve(spark, sf):
    return ev.roc_curve(_s(spark, sf)).select("threshold", r("fpr"), r("tpr"))


# ------------------------------------------------------------------ J10
_CM_SQL = _S + """,
cls AS (SELECT label AS c FROM s UNION SELECT pred FROM s),
cnt AS (SELECT label AS actual, pred AS predicted, count(*) AS n FROM s GROUP BY 1, 2),
cm AS (
  SELECT a.c AS actual, b.c AS predicted, coalesce(cnt.n, 0) AS n
  FROM cls a CROSS JOIN cls b LEFT JOIN cnt ON cnt.actual = a.c AND cnt.predicted = b.c)"""


@register("confusion_matrix", _CM_SQL + "\nSELECT actual, predicted, CAST(n AS BIGINT) AS n FROM cm")
def q_confusion_matrix(spark, sf):
    return ev.confusion_matrix(_s(spark, sf), "label", "pred")


# ------------------------------------------------------------------ J11
@register("classification_report", _CM_SQL + """,
per AS (
  SELECT c.c AS cls,
    (SELECT n FROM cm WHERE actual = c.c AND predicted = c.c) AS tp,
    (SELECT sum(n) FROM cm WHERE actual = c.c) AS support,
    (SELECT sum(n) FROM cm WHERE predicted = c.c) AS n_pred
  FROM cls c),
pr AS (
  SELECT cls, tp, support,
    coalesce(tp / nullif(n_pred, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall
  FROM per),
pf AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM pr),
tot AS (SELECT sum(support) AS n, sum(tp) AS tp FROM pf)
SELECT CAST(cls AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pf
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT)
FROM pf
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pf
UNION ALL
SELECT 'accuracy', round(tp / n, 6), round(tp / n, 6), round(tp / n, 6), CAST(n AS BIGINT) FROM tot""")
def q_classification_report(spark, sf):
    cm = ev.confusion_matrix(_s(spark, sf), "label", "pred")
    return ev.classification_report(cm).select("class", r("precision"), r("recall"), r("f1"), "support")


# ------------------------------------------------------------------ J13
@register("score_bands", _S + """
SELECT doc_id, score, CASE WHEN score >= 0.5 THEN '1' ELSE '0' END AS predicted_class,
  round(greatest(score, 1 - score), 6) AS confidence,
  CASE WHEN greatest(score, 1 - score) >= 0.8 THEN 'very_confident'
       WHEN greatest(score, 1 - score) >= 0.6 THEN 'confident'
       WHEN greatest(score, 1 - score) >= 0.4 THEN 'fairly_confident' ELSE 'not_confident' END AS band,
  printf('%.2f%%', (1 - score) * 100.0) AS pct_0, printf('%.2f%%', score * 100.0) AS pct_1,
  repeat('█', CAST(floor((1 - score) * 20) AS INTEGER)) || repeat('░', 20 - CAST(floor((1 - score) * 20) AS INTEGER)) AS bar_0,
  repeat('█', CAST(floor(score * 20) AS INTEGER)) || repeat('░', 20 - CAST(floor(score * 20) AS INTEGER)) AS bar_1
FROM s""")
def q_score_bands(spark, sf):
    b = ev.score_bands(_s(spark, sf).select("doc_id", "score"), "score")
    return b.select("doc_id", "score", "predicted_class", r("confidence"), "band", "pct_0", "pct_1", "bar_0", "bar_1")


# ------------------------------------------------------------------ J2
@register("stratified_split", f"WITH {fx.M_SQL}," + f"""
q AS (SELECT o_orderkey, segment, {uniform_sql('o_orderkey', 'split')} AS u FROM m),
k AS (SELECT segment, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS k FROM q GROUP BY segment),
rk AS (SELECT q.*, row_number() OVER (PARTITION BY q.segment ORDER BY u, o_orderkey) AS rn FROM q)
SELECT rk.o_orderkey, rk.segment, CASE WHEN rn <= k.k THEN 'test' ELSE 'train' END AS split
FROM rk JOIN k ON rk.segment = k.segment""")
def q_stratified_split(spark, sf):
    m = fx.model_table(spark, sf)
    return lc.stratified_split(m, fx.M_TARGET, "o_orderkey").select("o_orderkey", fx.M_TARGET, "split")


# ------------------------------------------------------------------ J3
@register("standardize", f"WITH {fx.M_SQL}," + """
st AS (SELECT """ + ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in fx.M_NUM) + """ FROM m)
SELECT o_orderkey, """ + ", ".join(f"round(({f} - m_{f}) / s_{f}, 6) AS {f}" for f in fx.M_NUM) + """
FROM m, st""")
def q_standardize(spark, sf):
    m = fx.model_table(spark, sf)
    return lc.standardize(m, fx.M_NUM).select("o_orderkey", *[r(f) for f in fx.M_NUM])


# ------------------------------------------------------------------ J4-J6, J12, J15 (model-dependent: rows-only)
_FEATS = (*fx.M_NUM, *fx.M_CAT)
# the reference's depths; "unlimited" is Spark's cap of 30
_DEPTHS = (10, 20, 30)


_FITTED: dict = {}  # (application, sf) -> (model, metrics): one fit serves the model-dependent keys


def _train(spark, sf):
    m = lc.encode_features(fx.model_cohorts(spark, sf), fx.M_CAT)
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        ref = m.where(F.col("cohort") == "ref")
        _FITTED[key] = lc.train_run(ref, _FEATS, fx.M_TARGET, "o_orderkey")
    return _FITTED[key], m


@register("rf_predict")
def q_rf_predict(spark, sf):
    (model, _), m = _train(spark, sf)
    cur = m.where(F.col("cohort") == "cur")
    return lc.predict(model, cur).select("o_orderkey", fx.M_TARGET, "predicted_label", r("p1"))


@register("cv_scores")
def q_cv_scores(spark, sf):
    m = lc.encode_features(fx.model_cohorts(spark, sf), fx.M_CAT).where(F.col("cohort") == "ref")
    found = lc.grid_search(m, _FEATS, fx.M_TARGET, {"maxDepth": _DEPTHS}, "o_orderkey")
    rows = [(int(p["maxDepth"]), float(s)) for p, s in zip(found.points, found.scores, strict=True)]
    return spark.createDataFrame(rows, "max_depth int, cv_accuracy double")


@register("feature_importance")
def q_feature_importance(spark, sf):
    (model, _), _m = _train(spark, sf)
    return lc.feature_importance(model, _FEATS).select("feature", r("importance"), "rank")


@register("train_metrics")
def q_train_metrics(spark, sf):
    (model, metrics), m = _train(spark, sf)
    text = lc.metrics_text(metrics)
    sig = lc.schema_signature(model, m.where(F.col("cohort") == "cur").limit(1), _FEATS)
    return spark.createDataFrame(
        [(metrics["accuracy"], metrics["auc"], metrics["cv_score"], text, sig["inputs"], sig["outputs"])],
        "accuracy double, auc double, cv_score double, metrics_text string, input_schema string, "
        "output_schema string")


# ------------------------------------------------------------------ K9 / J1 / J15 / A11: a retrain behind the drift check, both branches
@register("gated_retrain")
def q_gated_retrain(spark, sf):
    """Two checks of the reference: against a random half of itself (nothing to
    do), and against shifted current rows (a retrain on old and new rows)."""
    m = cut_lineage(lc.encode_features(fx.model_cohorts(spark, sf), fx.M_CAT), "retrain-input")
    old, new = (m.where(F.col("cohort") == c) for c in ("ref", "cur"))
    half = old.withColumn("cohort", F.when(uniform(F.col("o_orderkey"), "half") < 0.5, "ref").otherwise("cur"))
    shifted = inject.input_shift(new, {f: 1.0 for f in fx.M_NUM}, 0.8, F.col("o_orderkey"), inject.wide_stats(old, fx.M_NUM, "b"), sd_units=True)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidewatch/retrain-{uuid.uuid4().hex}"
    store = VersionedTables(spark, f"{root}/tables")
    effect = DriftThresholds(effect_only=True)
    for run_id, rows in (("stable", half), ("shifted", old.unionByName(shifted))):
        _, dataset = drift.detect(rows, FeatureSpec(numerical=_FEATS), effect)
        lc.gated_retrain(dataset, old, shifted, _FEATS, fx.M_TARGET, "o_orderkey", store, f"{root}/models", run_id)
    # durations and paths differ from run to run
    return store.read("runs").where("kind <> 'artifact' and key <> 'training_duration_seconds'")


# ------------------------------------------------------------------ A7 / A8: metrics text -> parsed values
_METRICS_SQL = _ROC_CTE + """,
met AS (
  SELECT round(avg(CAST(label = pred AS DOUBLE)), 4) AS acc,
    round((SELECT sum(pos * (cneg - neg + neg / 2.0)) FROM cu) / ((SELECT n_pos FROM tt) * (SELECT n_neg FROM tt)), 4)
      AS auc
  FROM s),
txt AS (
  SELECT 'train' AS variant, 'Accuracy = ' || CAST(acc AS VARCHAR) || ', AUC = ' || CAST(auc AS VARCHAR)
           || chr(10) || 'CV Score = ' || CAST(acc AS VARCHAR) AS metrics_text FROM met
  UNION ALL
  SELECT 'notebook', 'Accuracy = ' || CAST(acc AS VARCHAR) || ', AUC Score = ' || CAST(auc AS VARCHAR) FROM met)
SELECT variant, metrics_text,
  coalesce(TRY_CAST(trim(regexp_extract(metrics_text, 'Accuracy = ([^,]*)', 1)) AS DOUBLE), 0.0) AS accuracy,
  coalesce(TRY_CAST(trim(regexp_extract(metrics_text, 'AUC = ([^,\\n]*)', 1)) AS DOUBLE), 0.0) AS auc
FROM txt"""


def parse_metric(text, name: str, stop: str):
    """``name = <value>`` up to ``stop`` characters; 0.0 when missing or unparsable."""
    v = F.trim(F.regexp_extract(text, f"{name} = ([^{stop}]*)", 1))
    return F.coalesce(v.try_cast("double"), F.lit(0.0))


@register("parse_metrics", _METRICS_SQL)
def q_parse_metrics(spark, sf):
    s = _s(spark, sf)
    acc = ev.accuracy(s).select(F.round("accuracy", 4).alias("acc"))
    auc = ev.roc_auc(s).select(F.round("roc_auc", 4).alias("auc"))
    met = attach_row(acc, auc)
    a, u = F.col("acc").cast("string"), F.col("auc").cast("string")
    t1 = met.select(F.lit("train").alias("variant"),
                    F.concat(F.lit("Accuracy = "), a, F.lit(", AUC = "), u, F.lit("\nCV Score = "), a)
                    .alias("metrics_text"))
    t2 = met.select(F.lit("notebook").alias("variant"),
                    F.concat(F.lit("Accuracy = "), a, F.lit(", AUC Score = "), u).alias("metrics_text"))
    t = t1.unionByName(t2)
    return t.select("variant", "metrics_text", parse_metric(F.col("metrics_text"), "Accuracy", ",").alias("accuracy"),
                    parse_metric(F.col("metrics_text"), "AUC", ",\\n").alias("auc"))


# ------------------------------------------------------------------ D13: class counts per split
@register("split_class_counts", f"WITH {fx.M_SQL}," + f"""
q AS (SELECT o_orderkey, segment, {uniform_sql('o_orderkey', 'split')} AS u FROM m),
k AS (SELECT segment, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS k FROM q GROUP BY segment),
rk AS (SELECT q.*, row_number() OVER (PARTITION BY q.segment ORDER BY u, o_orderkey) AS rn FROM q)
SELECT CASE WHEN rn <= k.k THEN 'test' ELSE 'train' END AS split, rk.segment, count(*) AS n
FROM rk JOIN k ON rk.segment = k.segment GROUP BY 1, 2""")
def q_split_class_counts(spark, sf):
    m = fx.model_table(spark, sf)
    sp = lc.stratified_split(m, fx.M_TARGET, "o_orderkey")
    return sp.groupBy("split", fx.M_TARGET).agg(F.count("*").alias("n"))
