"""Versioned tables and the monitoring cycle: replay, failure, conflicts, spread-only drift."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.sources import versions
from tidewatch.sources.versions import Conflict, VersionedTables
from tidewatch.spec import FeatureSpec
from tidewatch.streaming.cycle import MonitorCycle, run_available

START = dt.datetime(2024, 1, 1)


def table(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def values(df):
    return sorted(r.v for r in df.collect())


def test_versions_are_published_whole(spark, tmp_path):
    store = VersionedTables(spark, f"file://{tmp_path}/t")
    assert store.manifest() is None and store.read("a") is None and store.versions() == []
    store.publish(1, {"a": table(spark, [1])}, {"log": table(spark, [1])})
    before = store.manifest()
    # a writer that dies after its data files leaves no version
    store._write("a", table(spark, [99]))
    assert store.manifest() == before and values(store.read("a")) == [1]
    store.publish(2, {"a": table(spark, [2])}, {"log": table(spark, [2, 3])})
    assert values(store.read("a")) == [2] and values(store.read("log")) == [1, 2, 3]
    assert values(store.read("a", 1)) == [1] and values(store.read("log", 1)) == [1]  # earlier versions stay readable
    store.publish(cleared=["log"])
    assert store.read("log") is None and store.batch() == 2 and store.versions() == [1, 2, 3]


def test_only_one_writer_gets_a_version(spark, tmp_path):
    store = VersionedTables(spark, f"file://{tmp_path}/t")
    store.publish(1, {"a": table(spark, [1])})
    other = {"version": 1, "batch": 1, "tables": {}}
    with pytest.raises(Conflict):
        store._move_in(1, other)
    assert values(store.read("a")) == [1] and not list((tmp_path / "t" / "manifests").glob("_*"))


def test_appended_tables_are_rewritten_when_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "MAX_PATHS", 3)
    store = VersionedTables(spark, f"file://{tmp_path}/t")
    for k in range(6):
        store.publish(k, appended={"log": table(spark, [k])})
    assert len(store.manifest()["tables"]["log"]) <= 4 and values(store.read("log")) == list(range(6))


def batch(spark, shift=0.0, spread=1.0, segments=("a", None), n=300, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(s, float(rng.normal(5 + shift, spread)), str(rng.integers(3))) for s in segments for _ in range(n)]
    return spark.createDataFrame(rows, "seg string, x double, c string")


SPEC = FeatureSpec(numerical=("x",), categorical=("c",), keys=("seg",))


def monitor(spark, path, **options):
    cycle = MonitorCycle(SPEC, VersionedTables(spark, f"file://{path}"), clock=lambda k: START + dt.timedelta(days=k), **options)
    cycle.set_reference(batch(spark, n=900, seed=9, segments=("a", None, "quiet")))
    return cycle


def rows(store, name):
    return sorted((tuple(map(str, r)) for r in store.read(name).collect()))


def test_batches_and_a_replay_give_the_same_tables(spark, tmp_path):
    cycle = monitor(spark, tmp_path / "m")
    batches = [batch(spark, seed=1), batch(spark, spread=1.6, seed=2), batch(spark, shift=2.0, seed=3, segments=("a",))]
    for k, b in enumerate(batches):
        cycle.run_batch(b, k)
    before = {t: rows(cycle.store, t) for t in ("cycles", "features", "state")}
    version = cycle.store.versions()[-1]
    for k, b in enumerate(batches):
        cycle.run_batch(b, k)  # replay
    assert {t: rows(cycle.store, t) for t in before} == before and cycle.store.versions()[-1] == version
    cycles = {(r.seg, r.batch_id): r for r in cycle.store.read("cycles").collect()}
    assert set(cycles) == {("a", 0), (None, 0), ("a", 1), (None, 1), ("a", 2)}
    # a shift of the spread alone is reported
    spread = {(r.seg, r.feature): r for r in cycle.store.read("features").where("batch_id = 1").collect()}
    assert spread["a", "x"].drift_detected and abs(spread["a", "x"].effect_size) < 0.2 and spread["a", "x"].levene_p_value < 1e-3
    assert cycles["a", 1].dataset_drift and cycles["a", 1].retrain
    # scores accumulate, and a segment that is away keeps its state
    gain = lambda r: 0.1 * r.n_drifted_features + 0.5 * r.share_drifted_features + 0.3 if r.n_drifted_features else 0.0
    score = 0.0
    for k in range(3):
        score = (score if cycles["a", k].dataset_drift else 0.0) + gain(cycles["a", k])
        assert cycles["a", k].drift_score == pytest.approx(score) and cycles["a", k].cycle == k + 1
    state = {r.seg: r for r in cycle.store.read("state").collect()}
    assert state[None].cycle == 2 and state[None].drift_score == cycles[None, 1].drift_score and state["a"].cycle == 3


def test_a_cycle_that_dies_is_run_again(spark, tmp_path, monkeypatch):
    cycle = monitor(spark, tmp_path / "m")
    cycle.run_batch(batch(spark, shift=1.0, seed=1), 0)
    move = VersionedTables._move_in
    monkeypatch.setattr(VersionedTables, "_move_in", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        cycle.run_batch(batch(spark, shift=1.0, seed=2), 1)
    monkeypatch.setattr(VersionedTables, "_move_in", move)
    assert cycle.store.batch() == 0 and cycle.store.read("cycles").count() == 2
    cycle.run_batch(batch(spark, shift=1.0, seed=2), 1)
    assert cycle.store.batch() == 1 and {r.cycle for r in cycle.store.read("state").collect()} == {2}


def test_generation_scores_twice_and_a_failed_one_falls_back(spark, tmp_path):
    calls = []

    def generate(b, due):
        calls.append(sorted(str(r.seg) for r in due.collect()))
        if len(calls) == 2:
            raise ValueError("no data")
        return b.join(due.select("seg"), b["seg"].eqNullSafe(due["seg"])).select(b["seg"], (b["x"] + 50).alias("x"), b["c"])

    cycle = monitor(spark, tmp_path / "m", every=1, generate=generate, retrain=lambda decided: decided.select("seg", F.lit(START + dt.timedelta(days=2, minutes=-3)).alias("retrained_at")))
    for k in range(3):
        cycle.run_batch(batch(spark, shift=1.0, seed=k, segments=("a",)), k)
    got = {r.batch_id: r for r in cycle.store.read("cycles").collect()}
    assert [got[k].data_added for k in range(3)] == [False, True, True] and len(calls) == 2
    checks = {(r.batch_id, r.checked) for r in cycle.store.read("features").select("batch_id", "checked").distinct().collect()}
    assert checks == {(0, "batch"), (1, "batch"), (1, "generated"), (2, "batch")}
    first = 0.1 * got[0].n_drifted_features + 0.5 * got[0].share_drifted_features + 0.3
    again = 0.1 * got[1].n_drifted_features + 0.5 * got[1].share_drifted_features + 0.3 + 0.2
    assert got[1].increment - again > 0 and got[1].drift_score == pytest.approx(first + got[1].increment)
    # cycle 3: retrained three minutes before it, so it starts from nothing; the failure defaults follow
    assert got[2].retrained and got[2].generation_failed and got[2].generation_error == "ValueError: no data"
    assert got[2].increment == pytest.approx(0.1 * got[2].n_drifted_features + 0.5 * got[2].share_drifted_features + 0.3 + 0.1 + 0.05 + 0.2)
    assert got[2].drift_score == pytest.approx(got[2].increment)


def test_an_unsegmented_stream_and_an_empty_batch(spark, tmp_path):
    spec = FeatureSpec(numerical=("x",), categorical=("c",))
    cycle = MonitorCycle(spec, VersionedTables(spark, f"file://{tmp_path}/m"), clock=lambda k: START)
    with pytest.raises(RuntimeError):
        cycle.run_batch(batch(spark), 0)
    cycle.set_reference(batch(spark, seed=5))
    cycle.run_batch(batch(spark).limit(0), 0)
    source = f"{tmp_path}/in"
    for k in range(2):
        batch(spark, shift=3.0, seed=k).write.mode("append").parquet(source)
        stream = spark.readStream.schema("seg string, x double, c string").parquet(source)
        run_available(stream, cycle, f"{tmp_path}/ckpt")
    # the stream's first batch has identifier 0 as well, which is done: only the second is new
    assert [r.cycle for r in cycle.store.read("cycles").collect()] == [1] and cycle.store.batch() == 1
    assert cycle.store.read("state").count() == 1
