"""Streams: windows are closed once, late rows are dropped, the score does not depend on the order of arrival."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import monitor as mon
from tidewatch.sources.versions import VersionedTables
from tidewatch.streaming import monitor as sm

DAY = dt.datetime(2024, 3, 1)


def events(spark, rows):
    return spark.createDataFrame(rows, "seg string, ts timestamp_ntz, x double")


@pytest.mark.parametrize("cut", [sm.width_cuts, sm.quantile_cuts])
def test_closed_windows_are_written_once_and_late_rows_dropped(spark, tmp_path, cut):
    rng = np.random.default_rng(4)
    base = rng.normal(10, 2, 2000)
    reference = spark.createDataFrame([("a", float(v)) for v in base], "seg string, x double")
    cuts = cut(reference, ["x"], ["seg"], 40).cache()
    sketch = sm.reference_sketch(reference, cuts, ["x"], ["seg"]).cache()
    days = {0: rng.normal(10, 2, 300), 1: rng.normal(10, 4, 300), 2: rng.normal(11, 2, 300), 6: rng.normal(10, 2, 50), 9: rng.normal(10, 2, 50)}
    rows = [("a", DAY + dt.timedelta(days=d, minutes=i), float(v)) for d, vs in days.items() for i, v in enumerate(vs)]
    late = [("a", DAY + dt.timedelta(hours=23), 1e6), ("a", DAY + dt.timedelta(days=6, hours=2), 10.0)]  # too late, and in time
    parts = [events(spark, [r for r in rows if r[1] < DAY + dt.timedelta(days=2)]), events(spark, [r for r in rows if DAY + dt.timedelta(days=2) <= r[1] < DAY + dt.timedelta(days=7)]),
             events(spark, late + [r for r in rows if r[1] >= DAY + dt.timedelta(days=9)]), events(spark, [("b", DAY + dt.timedelta(days=20), 1.0)])]
    store = VersionedTables(spark, f"file://{tmp_path}/t")
    seen = []
    for stream in sm.arrivals(spark, parts, f"{tmp_path}/in"):
        sm.windowed_drift_stream(stream, sketch, cuts, ["x"], ["seg"], store, f"{tmp_path}/ckpt")
        got = store.read("windows")
        seen.append([] if got is None else sorted(r.window_start for r in got.collect()))
    for before, after in zip(seen, seen[1:], strict=False):
        assert set(before) <= set(after) and len(after) == len(set(after))
    windows = {(r.window_start - DAY).days: r for r in store.read("windows").collect()}
    assert set(windows) == {0, 1, 2, 6, 9} and [windows[d].n_cur for d in (0, 1, 2, 6, 9)] == [300, 300, 300, 51, 50]
    for d in (0, 1, 2):
        grid = np.union1d(base, days[d])
        gap = np.abs(np.searchsorted(np.sort(base), grid, side="right") / 2000 - np.searchsorted(np.sort(days[d]), grid, side="right") / 300)
        heaviest = max(r.n for r in sketch.collect()) / 2000
        assert gap.max() - heaviest - 0.02 <= windows[d].ks_statistic <= gap.max() + 1e-12
        pooled = np.sqrt((1999 * base.var(ddof=1) + 299 * days[d].var(ddof=1)) / 2298)
        assert windows[d].cohens_d == pytest.approx((days[d].mean() - base.mean()) / pooled, rel=1e-9)
    # a shift of the spread alone: no effect on the mean, but a distance
    assert abs(windows[1].cohens_d) < 0.25 and windows[1].normalized_distance > windows[0].normalized_distance * 2
    state = next((tmp_path / "ckpt" / "state").iterdir())
    assert state.is_dir()
    # the batch that is run again changes nothing
    version = store.versions()[-1]
    sm.once(store, "windows", lambda b: b)(store.read("windows"), store.batch())
    assert store.versions()[-1] == version


def test_counters_are_updated(spark, tmp_path):
    store = VersionedTables(spark, f"file://{tmp_path}/t")
    rows = [("a" if i % 3 else None, DAY + dt.timedelta(hours=i), 1.0) for i in range(100)]
    parts = [events(spark, rows[:30]), events(spark, rows[30:35]), events(spark, rows[35:])]
    for stream in sm.arrivals(spark, parts, f"{tmp_path}/in"):
        sm.event_counts_stream(stream, store, f"{tmp_path}/ckpt", keys=["seg"])
    got = {((r.window_start - DAY).days, r.seg): r.n for r in sm.newest_counts(store, ["seg"]).collect()}
    want = {}
    for s, t, _ in rows:
        want[(t - DAY).days, s] = want.get(((t - DAY).days, s), 0) + 1
    assert got == want
    changed = {}
    for r in store.read("counts").collect():
        changed.setdefault(r.batch_id, set()).add((r.window_start - DAY).days)
    assert sorted(map(sorted, changed.values())) == [[0, 1], [1], [1, 2, 3, 4]]  # a batch writes what it has changed


def test_score_stream_equals_the_batch_whatever_the_order(spark, tmp_path):
    rng = random.Random(6)
    cycles, marks = [], []
    for seg in ("a", "b"):
        for c in range(1, 13):
            at = DAY + dt.timedelta(minutes=10 * c)
            n = rng.randrange(4)
            added = c > 1 and (c - 1) % 5 == 0
            cycles.append((seg, c, at, n, n / 4, n > 0 and rng.random() < 0.8, added, added and seg == "b"))
            if rng.random() < 0.3:
                marks.append((seg, at - dt.timedelta(seconds=rng.choice([0, 120, 299, 300, 400]))))
    frame = spark.createDataFrame(cycles, "seg string, cycle int, at timestamp_ntz, n_drifted_features long, share_drifted_features double, dataset_drift boolean, data_added boolean, generation_failed boolean")
    retrains = spark.createDataFrame(marks, "seg string, retrained_at timestamp_ntz")
    batch = mon.drift_score(mon.with_recent_retrain(frame, retrains, ["seg"], "at"), ["seg"], "at")
    want = {(r.seg, r.cycle): (r.retrained, r.reset, round(r.increment, 9), round(r.drift_score, 9)) for r in batch.collect()}
    rows = frame.withColumns({"kind": F.lit(sm.CYCLE), "at": F.col("at").cast("timestamp")}).unionByName(
        retrains.select("seg", F.lit(sm.RETRAIN).alias("kind"), F.col("retrained_at").cast("timestamp").alias("at")), allowMissingColumns=True).cache()
    early = rows.where("minute(at) % 20 < 10")  # half of the rows arrives first, the times interleave
    tick = spark.createDataFrame([("tick", DAY + dt.timedelta(days=1))], "kind string, at timestamp")
    parts = [early, rows.exceptAll(early), rows.limit(0).unionByName(tick, allowMissingColumns=True)]
    for stream in sm.arrivals(spark, parts, f"{tmp_path}/in"):
        sm.drift_score_stream(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt", ["seg"], delay="1 day")
    got = {(r.seg, r.cycle): (r.retrained, r.reset, round(r.increment, 9), round(r.drift_score, 9)) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    # a delay of a day holds every row back until the tick, which is no later than that itself
    assert got == {}
    later = rows.limit(0).unionByName(tick.withColumn("at", F.col("at") + F.expr("INTERVAL 2 DAYS")), allowMissingColumns=True)
    for stream in sm.arrivals(spark, [later], f"{tmp_path}/in"):
        sm.drift_score_stream(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt", ["seg"], delay="1 day")
    got = {(r.seg, r.cycle): (r.retrained, r.reset, round(r.increment, 9), round(r.drift_score, 9)) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == want and any(v[0] for v in want.values())
