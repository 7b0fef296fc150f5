"""The monitoring cycle of a stream: every micro-batch is one cycle.

A cycle runs the full drift check of the batch against the stored reference
(value tables are merged, so the reference is never scanned again), rolls it up
per segment, adds to the accumulated drift score, decides on a retrain and, in
every ``every``-th cycle, generates data and checks once more with it. Its rows
and the new state are published as one version of :class:`VersionedTables`:

* ``state`` (replaced): one row per segment with cycle, score and last decision;
* ``cycles``, ``features`` (appended): the roll-up and the per-feature results;
* ``retrains`` (appended): marks ``(keys, retrained_at)`` that later cycles read.

A batch that is run again after it was published changes nothing; one that
failed before starts over from the state of the version before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import drift
from tidewatch.operators import monitor as mon
from tidewatch.operators.cohorts import CUR, REF
from tidewatch.operators.small import join_on, join_small
from tidewatch.session import cut_lineage, cut_lineage_sized
from tidewatch.sources.versions import VersionedTables
from tidewatch.spec import DEFAULT_THRESHOLDS, DriftThresholds, FeatureSpec
from tidewatch.streaming.monitor import drain

# the failure defaults of a cycle whose generated data could not be checked (fixed values)
FAILED_FEATURES, FAILED_SHARE = 1, 0.1


def _now(batch_id: int) -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


@dataclass
class MonitorCycle:
    """``generate(batch, due)`` returns new rows for the segments in ``due``
    (keys and ``cycle``); ``retrain(decided)`` is given the cycle rows whose
    decision is to retrain and returns ``(keys, retrained_at)``."""

    spec: FeatureSpec
    store: VersionedTables
    th: DriftThresholds = DEFAULT_THRESHOLDS
    every: int = 5
    clock: Callable[[int], dt.datetime] = _now
    generate: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    retrain: Callable[[DataFrame], DataFrame] | None = None
    _keys: list[str] = field(init=False)

    def __post_init__(self):
        self._keys = list(self.spec.keys)

    # ------------------------------------------------------------ reference
    def set_reference(self, reference: DataFrame) -> None:
        """Stores the reference's value table (version 1)."""
        self.store.publish(replaced={"reference": self._values(reference, REF)})

    def _values(self, rows: DataFrame, cohort: str) -> DataFrame:
        return drift.value_table(rows.withColumn("cohort", F.lit(cohort)), list(self.spec.numerical), list(self.spec.categorical), self._keys)

    def _check(self, parts: Sequence[DataFrame], name: str) -> tuple[DataFrame, DataFrame]:
        """Per-feature results and roll-up of the segments with current rows."""
        values, rows = cut_lineage_sized(drift.merge_values(parts, self._keys), f"cycle-{name}-values")
        present = values.groupBy(*self._keys).agg(F.max("c_cur").alias("_c")).where("_c > 0").drop("_c")
        if self._keys:
            values = join_on(values, present, self._keys)
        found = cut_lineage(drift.feature_drift_from_values(values, rows, self.spec, self.th), f"cycle-{name}-features")
        return found, drift.dataset_drift(found, self._keys, self.th)

    # ------------------------------------------------------------ one cycle
    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body."""
        done = self.store.batch()
        if done is not None and batch_id <= done:
            return
        reference = self.store.read("reference")
        if reference is None:
            raise RuntimeError("set_reference first")
        current = cut_lineage(self._values(batch, CUR), "cycle-batch")
        if not current.take(1):
            self.store.publish(batch=batch_id)
            return
        at = F.lit(self.clock(batch_id)).cast("timestamp_ntz")
        features, rollup = self._check([reference, current], "first")
        cycles = cut_lineage(self._first_score(rollup, at), "cycle-first")
        features = features.withColumn("checked", F.lit("batch"))
        cycles = cycles.withColumns({"generation_failed": F.lit(False), "generation_error": F.lit(None).cast("string")})
        if self.generate is not None:
            cycles, again = self._generated(cycles, batch, [reference, current])
            if again is not None:
                features = features.unionByName(again.withColumn("checked", F.lit("generated")))
        cycles = cycles.withColumn("retrain", F.col("severity_level").isin("RED", "ORANGE"))
        cycles = cut_lineage(cycles.withColumns({"batch_id": F.lit(batch_id).cast("long"), "cycle_time": at}), "cycle-rows")
        appended = {"cycles": cycles, "features": features.withColumn("batch_id", F.lit(batch_id).cast("long"))}
        if self.retrain is not None:
            appended["retrains"] = self.retrain(cycles.where("retrain")).select(*self._keys, F.col("retrained_at").cast("timestamp_ntz"))
        self.store.publish(batch_id, {"state": self._state(cycles)}, appended)

    def _state(self, cycles: DataFrame) -> DataFrame:
        """Segments of this batch with their new state, others as they were."""
        columns = [*self._keys, "cycle", "drift_score", "severity_level", "retrain", "batch_id"]
        now, before = cycles.select(*columns), self.store.read("state")
        if before is None or not self._keys:
            return now
        seen = now.select(*self._keys, F.lit(True).alias("_seen"))
        return join_on(before, seen, self._keys, "left").where("_seen is null").select(*columns).unionByName(now)

    def _first_score(self, rollup: DataFrame, at: Column) -> DataFrame:
        """The cycle's number and the score after the batch's own check."""
        before, marks = self.store.read("state"), self.store.read("retrains")
        if before is None:
            rows = rollup.withColumns({"_cycle": F.lit(0), "_score": F.lit(0.0)})
        else:
            rows = join_small(rollup, before.select(*self._keys, F.col("cycle").alias("_cycle"), F.col("drift_score").alias("_score")), self._keys, "left")
        rows = rows.withColumn("cycle", (F.coalesce("_cycle", F.lit(0)) + 1).cast("int"))
        if marks is None:
            rows = rows.withColumn("retrained", F.lit(False))
        else:
            newest = marks.where(F.col("retrained_at") <= at).groupBy(*self._keys).agg(F.max("retrained_at").alias("_at"))
            age = F.unix_micros(at.cast("timestamp")) - F.unix_micros(F.col("_at").cast("timestamp"))
            rows = join_small(rows, newest, self._keys, "left").withColumn("retrained", F.coalesce(age < mon.RETRAIN_SECONDS * 1_000_000, F.lit(False)))
            rows = rows.drop("_at")
        reset = ~F.col("dataset_drift") | F.col("retrained")
        gain = mon.score_increment(F.col("n_drifted_features"), F.col("share_drifted_features"), F.col("dataset_drift"), F.lit(False))
        score = F.least(F.lit(mon.SCORE_CAP), F.when(reset, 0.0).otherwise(F.coalesce("_score", F.lit(0.0))) + gain)
        due = (F.col("cycle") > 1) & ((F.col("cycle") - 1) % self.every == 0) if self.generate is not None else F.lit(False)
        return rows.withColumns({"reset": reset, "increment": gain, "drift_score": score, "data_added": due}).drop("_cycle", "_score")

    def _generated(self, cycles: DataFrame, batch: DataFrame, parts: list[DataFrame]) -> tuple[DataFrame, DataFrame | None]:
        """Second check of the segments that generate data in this cycle. A
        generation that fails adds the failure defaults and resets nothing."""
        due = cycles.where("data_added").select(*self._keys, "cycle")
        if not due.take(1):
            return cycles, None
        try:
            added = cut_lineage(self._values(self.generate(batch, due), CUR), "cycle-generated")
        except Exception as e:  # whatever the generator raised is reported in the cycle's row
            gain = mon.score_increment(F.lit(FAILED_FEATURES), F.lit(FAILED_SHARE), F.lit(False), F.lit(True))
            return self._second_score(cycles, gain, F.lit(False)).withColumns(
                {"generation_failed": F.col("data_added"), "generation_error": F.when(F.col("data_added"), F.lit(f"{type(e).__name__}: {e}"[:500]))}), None
        features, rollup = self._check([*parts, added], "second")
        due = due.drop("cycle").withColumn("_due", F.lit(True))
        features = join_small(features, due, self._keys).drop("_due")
        second = [c for c in rollup.columns if c not in self._keys]
        rollup = rollup.select(*self._keys, F.struct(*second).alias("_second"))
        cycles = join_small(cycles, rollup, self._keys, "left")
        cycles = cycles.withColumns({c: F.when(F.col("data_added"), F.col("_second")[c]).otherwise(F.col(c)) for c in second}).drop("_second")
        gain = mon.score_increment(F.col("n_drifted_features"), F.col("share_drifted_features"), F.col("dataset_drift"), F.lit(True))
        return self._second_score(cycles, gain, ~F.col("dataset_drift")), features

    @staticmethod
    def _second_score(cycles: DataFrame, gain: Column, reset: Column) -> DataFrame:
        added = F.col("data_added")
        score = F.least(F.lit(mon.SCORE_CAP), F.when(reset, 0.0).otherwise(F.col("drift_score")) + gain)
        return cycles.withColumns({"drift_score": F.when(added, score).otherwise(F.col("drift_score")),
                                   "increment": F.col("increment") + F.when(added, gain).otherwise(0.0)})


def run_available(events: DataFrame, cycle: MonitorCycle, checkpoint: str) -> None:
    """Runs the cycle over all input that has arrived since the last run of this checkpoint."""
    drain(events.writeStream.foreachBatch(cycle.run_batch), checkpoint)
