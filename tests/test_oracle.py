"""Every registered plan against its DuckDB twin (rows-only where no twin) on sf0.001."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

from conftest import SF_SMALL

from tidewatch.plans import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    status, msg = compare(key, QUERIES[key](spark, SF_SMALL), con, ORACLE.get(key))
    assert status in ("OK", "ROWS"), msg


def test_every_key_has_a_twin_or_is_declared_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only <= {"numeric_drift", "categorical_drift", "shifted_drift", "rf_predict",
                         "cv_scores", "feature_importance", "train_metrics", "drift_result_json", "gated_retrain"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 6 and {r["feature"] for r in rows} >= {"l_quantity", "l_returnflag"}


def test_entry_offers_every_plan():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
