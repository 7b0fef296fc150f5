"""The generator's versions, the gated retrain and request batches."""

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import lifecycle as lc
from tidewatch.operators import report
from tidewatch.operators.generator import Generator, Recipe
from tidewatch.plans import fixtures as fx
from tidewatch.plans.inject_plans import M_SHIFTS
from tidewatch.sources.versions import VersionedTables

from conftest import SF_SMALL

FEATS = (*fx.M_NUM, *fx.M_CAT)


def reference(spark):
    return fx.model_cohorts(spark, SF_SMALL).where(F.col("cohort") == "ref").drop("cohort")


def test_generator_adapts_publishes_and_resets(spark, tmp_path, monkeypatch):
    recipe = Recipe(fx.M_NUM, "o_orderkey", M_SHIFTS, fx.M_TARGET, "quiet", "busy", "n_lines", "qty_band", first_rows=120, new_rows=30, cap=160)
    made = Generator(VersionedTables(spark, f"file://{tmp_path}/g"), recipe)
    with pytest.raises(RuntimeError):
        made.step()
    made.reset(reference(spark))
    assert made.status().first().asDict()["cycle"] == 0
    n = reference(spark).count()
    assert made.store.read("data").count() == n
    for cycle in range(3):
        assert made.step() == cycle
    # a writer that dies before its version is published leaves data and history of the last cycle
    move = VersionedTables._move_in
    monkeypatch.setattr(VersionedTables, "_move_in", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        made.step()
    monkeypatch.setattr(VersionedTables, "_move_in", move)
    assert made.store.read("data").count() == 160 and made.store.read("history").count() == 3
    assert made.step() == 3
    rows = made.history()
    assert [(r.total_size, r.new_samples, r.drift_state, r.failed_detections) for r in rows] == [
        (120, 120, None, 0), (150, 30, "unknown", 0), (160, 30, "not_detected", 1), (160, 30, "not_detected", 2)]
    assert [round(r.drift_strength, 6) for r in rows] == [0.1, 0.1, 0.12, 0.144]
    status = made.status().first()
    assert status.cycle == 4 and status.total_adaptations == 3 and sum(status.class_counts.values()) == status.current_data_size == 160
    # every version shows the data and the history of one cycle
    for version in made.store.versions()[1:]:
        assert made.store.read("data", version).count() == made.store.read("history", version).agg(F.max_by("total_size", "cycle")).first()[0]
    # data that has grown by more than a tenth counts as detected
    assert made.adapted(rows, 200) == {"drift_strength": rows[-1].drift_strength, "failed_detections": 0, "drift_state": "detected"}
    made.reset(reference(spark))
    assert made.history() == [] and made.store.read("data").count() == n


def test_retrain_takes_both_branches(spark, tmp_path):
    m = lc.encode_features(fx.model_cohorts(spark, SF_SMALL), fx.M_CAT)
    old, new = (m.where(F.col("cohort") == c) for c in ("ref", "cur"))
    store = VersionedTables(spark, f"file://{tmp_path}/t")
    level = lambda v: spark.createDataFrame([(v,)], "severity_level string")

    def run(v, run_id, rows, trees=5):
        return lc.gated_retrain(level(v), old, rows, FEATS, fx.M_TARGET, "o_orderkey", store, f"file://{tmp_path}/models", run_id, num_trees=trees, max_depth=6)

    quiet = run("YELLOW", "r1", new)
    assert not quiet.decided and not quiet.accepted and store.read("model") is None
    first = run("RED", "r2", new)
    assert first.decided and first.accepted and store.read("model").first().version == 1
    log = {(r.kind, r.key): r.value for r in first.log.collect()}
    assert int(log["param", "data_size"]) == m.na.drop("any", subset=["o_orderkey"]).count() and ("artifact", "model") in log
    assert lc.load_model(store.read("model").first().path).stages[-1].getNumTrees == 5
    # a worse model is measured, logged and not published
    worse = lc.gated_retrain(level("ORANGE"), old, new, FEATS, fx.M_TARGET, "o_orderkey", store, f"file://{tmp_path}/models", "r3", num_trees=1, max_depth=0)
    log = {(r.kind, r.key): r.value for r in worse.log.collect()}
    assert worse.decided and float(log["metric", "accuracy"]) < float(log["metric", "current_accuracy"]) and not worse.accepted
    assert store.read("model").first().version == 1 and store.read("model").first().run_id == "r2"
    assert {r.run_id for r in store.read("runs").select("run_id").distinct().collect()} == {"r1", "r2", "r3"}


def test_newest_rows_count_by_key(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, s string, x double")
    new = spark.createDataFrame([("c", 2, 7), ("d", 3, 8)], "s string, id int, extra int")
    got = sorted(tuple(r) for r in lc.newest_by_key(old, new, "id").select("id", "s", "x", "extra").collect())
    assert got == [(1, "a", 1.0, None), (2, "c", None, 7), (3, "d", None, 8)]


def test_request_batches_keep_broken_parts_aside(spark):
    bodies = ['{"dataframe_records":[{"a":1,"b":"x"},{"a":"no number","b":"y"},{"b":"z"},[1],null]}', '{"dataframe_records":[]}', "not json", None, '{"other":1}',
              '{"dataframe_records":[{"a":2,"b":"é \\" ]"}],"more":true}']
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    got = sorted((r.id, -1 if r.position is None else r.position, r.a, r.b, r.broken is not None) for r in report.record_batches(df, "body", "a INT, b STRING", ["id"]).collect())
    assert got == [(0, 0, 1, "x", False), (0, 1, None, None, True), (0, 2, None, "z", False), (0, 3, None, None, True), (0, 4, None, None, True),
                   (2, -1, None, None, True), (3, -1, None, None, False), (4, -1, None, None, True), (5, 0, 2, 'é " ]', False)]
