"""The adaptive generator as a chain of published versions.

Tables of one :class:`VersionedTables`: ``reference`` (never changed), ``data``
(the current data, replaced by every step) and ``history`` (one appended row per
cycle). A step adapts the drift strength to what the history says, generates a
cycle's rows, keeps the newest of the old ones and publishes data and history
together: a reader sees both of one cycle or both of the next.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import history as hist
from tidewatch.operators import inject
from tidewatch.session import cut_lineage
from tidewatch.sources.versions import VersionedTables


@dataclass(frozen=True)
class Recipe:
    """What a cycle does to the rows it draws from the reference."""

    numerical: Sequence[str]
    order: str
    shifts: Mapping[str, float]
    label: str
    source: str
    target: str
    up: str
    down: str
    first_rows: int = 1000
    new_rows: int = 200
    cap: int = hist.RETENTION_CAP


class Generator:
    def __init__(self, store: VersionedTables, recipe: Recipe):
        self.store, self.recipe = store, recipe

    def reset(self, reference: DataFrame) -> None:
        """Baseline again: the reference is the data, and there is no history."""
        rows = cut_lineage(reference.withColumn("seq", F.col(self.recipe.order).cast("long")), "generator-reference")
        self.store.publish(replaced={"reference": rows, "data": rows}, cleared=["history"])

    def history(self) -> list:
        """One row per cycle, oldest first (its length is the number of cycles)."""
        rows = self.store.read("history")
        return [] if rows is None else sorted(rows.collect(), key=lambda r: r["cycle"])

    def adapted(self, rows: Sequence, size: int) -> dict:
        """Strength and counters for the next cycle. The check needs two earlier
        cycles; data that has grown by more than the threshold since the last
        one counts as detected, otherwise the strength escalates."""
        if not rows:
            return {"drift_strength": hist.BASE_STRENGTH, "failed_detections": 0, "drift_state": None}
        last = rows[-1]
        out = {"drift_strength": last["drift_strength"], "failed_detections": last["failed_detections"], "drift_state": "unknown"}
        if len(rows) < 2:
            return out
        growth = (size - last["data_size"]) / last["data_size"] if last["data_size"] else 0.0
        if growth > hist.GROWTH_THRESHOLD:
            return out | {"failed_detections": 0, "drift_state": "detected"}
        return {"drift_strength": min(out["drift_strength"] * hist.ESCALATION, hist.MAX_STRENGTH), "failed_detections": out["failed_detections"] + 1,
                "drift_state": "not_detected"}

    def step(self) -> int:
        """Adapt, generate, publish; returns the cycle's number."""
        r, reference, data = self.recipe, self.store.read("reference"), self.store.read("data")
        if reference is None:
            raise RuntimeError("reset with a reference first")
        rows = self.history()
        cycle = len(rows)
        state = self.adapted(rows, data.count() if rows else 0)
        n = r.new_rows if cycle else r.first_rows
        made = inject.augment_step(data, reference.drop("seq"), cycle, state["drift_strength"], n, r.numerical, r.order, r.shifts, r.label,
                                   r.source, r.target, r.up, r.down, r.cap)
        made = cut_lineage(made, "generator-data")
        row = inject.history_row(made, cycle, state["drift_strength"], n).withColumns(
            {"failed_detections": F.lit(state["failed_detections"]).cast("long"), "drift_state": F.lit(state["drift_state"]).cast("string")})
        self.store.publish(cycle, {"data": made}, {"history": row})
        return cycle

    def status(self) -> DataFrame:
        """One row: cycle, strength, failures, adaptations, size and the class counts."""
        data, rows = self.store.read("data"), self.store.read("history")
        counts = data.groupBy(self.recipe.label).agg(F.count("*").alias("n"))
        classes = counts.agg(F.sum("n").alias("current_data_size"),
                             F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(self.recipe.label).cast("string").alias("class"), "n")))).alias("class_counts"))
        if rows is None:
            return classes.select(F.lit(0).alias("cycle"), F.lit(hist.BASE_STRENGTH).alias("drift_strength"), F.lit(0).cast("long").alias("failed_detections"),
                                  F.lit(0).cast("long").alias("total_adaptations"), "current_data_size", "class_counts")
        last = rows.agg((F.max("cycle") + 1).alias("cycle"), F.max_by("drift_strength", "cycle").alias("drift_strength"),
                        F.max_by("failed_detections", "cycle").alias("failed_detections"), F.count_if(F.col("cycle") > 0).alias("total_adaptations"))
        return inject.with_stats(last, classes)
