"""Plan-shape guards: no pair-producing joins, pruned scans."""

import re

import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

QUERIES = entry.queries()
# model fits and streams are planned inside the query function (covered elsewhere)
SKIP = {"cv_scores", "rf_predict", "feature_importance", "train_metrics", "windowed_drift_stream",
        "drift_score_stream", "event_counts_stream", "stream_monitor"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in SKIP))
def test_no_cross_or_nested_loop_join(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan, key
    assert "BroadcastNestedLoopJoin" not in plan, key


def test_drift_scan_reads_only_feature_columns(spark):
    from tidewatch.operators import drift
    from tidewatch.plans import fixtures as fx

    df = fx.lineitem_cohorts(spark, SF_SMALL)
    vt = drift.value_table(df, fx.L_NUM, fx.L_CAT)
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # print the whole ReadSchema
    try:
        plan = _plan(vt)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    cols = {c.split(":")[0] for c in schema.split(",")}
    assert cols == {"l_shipdate", *fx.L_NUM, *fx.L_CAT}


def test_cohort_filter_reaches_scan(spark):
    from pyspark.sql import functions as F

    from tidewatch.plans import fixtures as fx

    ref = fx.lineitem_cohorts(spark, SF_SMALL).where(F.col("cohort") == "ref")
    plan = _plan(ref)
    assert "l_shipdate" in re.search(r"DataFilters: \[([^\]]*)\]", plan).group(1)
