"""Drift-history operators: growth state, failure streaks, strength ladder,
retention by order key, newest-n views.

Every window is partitioned by the monitored segment (``keys``) and ordered
by cycle, so thousands of monitored datasets run in one job; one segment's
history has one row per cycle, which is bounded by the cycle cadence, not by
data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.ranks import kth_smallest
from tidewatch.operators.small import join_small

# adaptive-strength parameters (fixed values, reference defaults)
BASE_STRENGTH = 0.1
MAX_STRENGTH = 0.8
ESCALATION = 1.2
GROWTH_THRESHOLD = 0.1
# drift types in rotation order (fixed values)
DRIFT_TYPES = ("input_drift", "label_drift", "concept_drift", "combined_drift")
RETENTION_CAP = 4000


def _w(keys: Sequence[str], order: str = "cycle") -> Window:
    return Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)


def growth_state(h: DataFrame, keys: Sequence[str] = (), size: str = "data_size",
                 threshold: float = GROWTH_THRESHOLD) -> DataFrame:
    """(size - previous size) / previous size; 'unknown' with fewer than two
    earlier entries, 'detected' above the threshold, else 'not_detected'."""
    w = _w(keys)
    prev = F.lag(size).over(w)
    rn = F.row_number().over(w)
    growth = F.when(prev > 0, (F.col(size) - prev) / prev).otherwise(F.lit(0.0))
    return (h.withColumn("prev_size", prev).withColumn("_rn", rn)
            .withColumn("growth_rate", F.when(F.col("_rn") > 2, growth))
            .withColumn("drift_state", F.when(F.col("_rn") <= 2, "unknown")
                        .when(F.col("growth_rate") > threshold, "detected").otherwise("not_detected"))
            .drop("_rn"))


def failure_streak(h: DataFrame, keys: Sequence[str] = (), state: str = "drift_state") -> DataFrame:
    """Counter +1 on not_detected, reset to 0 on detected, unchanged on unknown
    (gaps-and-islands: epoch = running count of resets)."""
    w = _w(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    epoch = F.sum((F.col(state) == "detected").cast("int")).over(w)
    h = h.withColumn("reset_epoch", epoch)
    w2 = Window.partitionBy(*keys, "reset_epoch").orderBy("cycle").rowsBetween(Window.unboundedPreceding,
                                                                                  Window.currentRow)
    return (h.withColumn("failed_detections", F.sum((F.col(state) == "not_detected").cast("int")).over(w2))
            .withColumn("total_failures", F.sum((F.col(state) == "not_detected").cast("int")).over(w)))


def strength_ladder(h: DataFrame, keys: Sequence[str] = (), failures: str = "total_failures",
                    base: float = BASE_STRENGTH, factor: float = ESCALATION, cap: float = MAX_STRENGTH) -> DataFrame:
    """Closed form of 'multiply by 1.2 per undetected cycle, cap 0.8'."""
    return h.withColumn("drift_strength", F.least(F.lit(base) * F.pow(F.lit(factor), F.col(failures)), F.lit(cap)))


def drift_type_for(cycle: Column, types: Sequence[str] = DRIFT_TYPES) -> Column:
    """types[cycle mod len(types)]."""
    return F.element_at(F.array(*[F.lit(t) for t in types]), (F.pmod(cycle, F.lit(len(types))) + 1).cast("int"))


def last_n(h: DataFrame, n: int = 5, keys: Sequence[str] = (), order: str = "cycle") -> DataFrame:
    """Newest ``n`` entries per segment (listed oldest first by the caller)."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc()) if keys else Window.orderBy(F.col(order).desc())
    return h.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= n).drop("_rk")


def newest_threshold(df: DataFrame, order: str, keep: DataFrame | int, keys: Sequence[str] = ()) -> DataFrame:
    """Per segment, the smallest order value among the ``keep`` newest rows
    (NULL for none). ``keep`` is a count or a table ``(keys..., _keep)`` (one row
    when unsegmented). Works from refined range counts over the order key, so no
    task sorts a whole segment. ``order`` must be unique within a segment."""
    keys = list(keys)
    n = df.groupBy(*keys).agg(F.count(order).alias("_n"))  # one row per segment
    if isinstance(keep, int):
        n = n.withColumn("_keep", F.lit(keep))
    else:
        n = join_small(n, keep, keys, "left").withColumn("_keep", F.coalesce(F.col("_keep"), F.lit(0)))
    rows = join_small(df.select(*keys, order), n, keys)
    found = kth_smallest(rows, order, F.greatest(F.col("_n") - F.col("_keep") + 1, F.lit(1)), keys)
    return found.select(*keys, F.col("_t").alias("threshold"))


def retention_tail(current: DataFrame, new: DataFrame, order: str, cap: int = RETENTION_CAP,
                   keys: Sequence[str] = ()) -> DataFrame:
    """Keep the newest ``cap - |new|`` rows of ``current`` (0 if negative) and append ``new``."""
    on = list(keys)
    # unsegmented this is a global count: one row even when `new` is empty
    keep = (new.groupBy(*on).agg(F.count("*").alias("n_new"))
            .select(*on, F.greatest(F.lit(cap) - F.col("n_new"), F.lit(0)).alias("_keep")))
    if on:  # segments without new rows keep `cap` rows
        seg = current.select(*on).distinct().join(keep, on, "left")
        keep = seg.select(*on, F.coalesce(F.col("_keep"), F.lit(cap)).alias("_keep"))
    thr = newest_threshold(current, order, keep, on)
    kept = (join_small(current, thr, on, "left")
            .where(F.col("threshold").isNotNull() & (F.col(order) >= F.col("threshold")))
            .drop("threshold"))
    return kept.unionByName(new, allowMissingColumns=True)
