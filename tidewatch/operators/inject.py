"""Resampling and drift injection as table transforms.

All randomness is a hash of (row key, purpose, column): the same row gets
the same noise on every retry, every partitioning and in SQL engines with
md5, so a lost executor recomputes identical values. Baseline bounds come
from a one-row aggregate attached as a scalar subquery (computed once, no
join).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scalar import clip, domain_repair, normal, round_half_even, uniform
from tidewatch.operators.history import DRIFT_TYPES, RETENTION_CAP, retention_tail
from tidewatch.operators.ranks import kth_smallest, values_at
from tidewatch.operators.small import attach_row, join_small

# reference input-shift multipliers are per-feature (fixed values in the
# reference); callers pass their own feature -> multiplier map.
SEQ_STRIDE = 10 ** 12


def wide_stats(df: DataFrame, features: Sequence[str], prefix: str = "b") -> DataFrame:
    """One row: {prefix}_{f}_min/max/std/mean for each feature."""
    aggs = []
    for f in features:
        c = F.col(f).cast("double")
        aggs += [F.min(c).alias(f"{prefix}_{f}_min"), F.max(c).alias(f"{prefix}_{f}_max"),
                 F.stddev_samp(c).alias(f"{prefix}_{f}_std"), F.avg(c).alias(f"{prefix}_{f}_mean")]
    return df.agg(*aggs)


def with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach a one-row stats table to every row (scalar subquery, no join)."""
    return attach_row(df, stats)


def _drop_prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix + "_")])


def jitter(df: DataFrame, features: Sequence[str], key: Column, baseline: DataFrame,
           fraction: float = 0.1, step: float | None = 1.0, salt: str = "jitter") -> DataFrame:
    """x + N(0, fraction * sd(x in df)), clip to [max(0, base min), base max], round."""
    own = wide_stats(df, features, "s")
    out = with_stats(with_stats(df, baseline), own)
    for f in features:
        # the noisy value is its own column: the hash is evaluated once per row
        out = out.withColumn(f"_nz_{f}", F.col(f) + normal(key, f"{salt}|{f}", 0.0, F.col(f"s_{f}_std") * fraction))
        lo = F.greatest(F.lit(0.0), F.col(f"b_{f}_min"))
        out = out.withColumn(f, round_half_even(clip(f"_nz_{f}", lo, F.col(f"b_{f}_max")), step)).drop(f"_nz_{f}")
    return _drop_prefixed(_drop_prefixed(out, "s"), "b")


def input_shift(df: DataFrame, shifts: Mapping[str, float], strength: float | Column, key: Column,
                baseline: DataFrame, noise: float = 0.3, upper: float = 1.2, step: float | None = 1.0,
                sd_units: bool = False, salt: str = "shift") -> DataFrame:
    """x + N(m * strength * u, noise * strength * u), clip [0, upper * base max], round.

    ``u`` is 1 (absolute shifts, the reference's choice) or the baseline sd.
    """
    s = strength if isinstance(strength, Column) else F.lit(float(strength))
    out = with_stats(df, baseline)
    for f, m in shifts.items():
        u = F.col(f"b_{f}_std") if sd_units else F.lit(1.0)
        out = out.withColumn(f"_nz_{f}", F.col(f) + normal(key, f"{salt}|{f}", s * m * u, s * noise * u))
        out = out.withColumn(f, round_half_even(clip(f"_nz_{f}", 0.0, F.col(f"b_{f}_max") * upper), step)
                             ).drop(f"_nz_{f}")
    return _drop_prefixed(out, "b")


def smallest_k(df: DataFrame, value: Column, k, keys: Sequence[str] = (), tiebreak: str | None = None) -> DataFrame:
    """Mark (``_take``) the k rows with the smallest ``value`` per segment.

    The threshold comes from refined range counts (``operators/ranks.py``); the
    rows are not shuffled. Rows tied at the threshold are resolved the same way
    on the numeric ``tiebreak`` (unique within a segment), so even a tie group
    holding a third of the rows is never sorted in one task; without
    ``tiebreak`` all tied rows are taken. ``k`` is a per-row column (constant within a
    segment) or a function of the segment's row count, evaluated on the
    per-segment aggregate (no count table is joined back to the rows).
    """
    on = list(keys)
    d = df.withColumn("_v", value)
    single = None  # without segments the per-segment tables have one row: attached as scalars
    thr = kth_smallest(d, "_v", k, on)
    d = (join_small(d, thr, on, "left", bound_rows=single)
         .withColumn("_below", F.coalesce(F.col("_below"), F.lit(0)))
         .withColumn("_k", F.coalesce(F.col("_kk"), F.lit(0))).drop("_kk"))
    want = F.col("_k") > 0
    everything = want & F.col("_t").isNull()  # k at least the segment size
    strict = F.coalesce(F.col("_v") < F.col("_t"), F.lit(False))
    tied = F.coalesce(F.col("_v") == F.col("_t"), F.lit(False))
    if tiebreak is None:
        out = d.withColumn("_take", want & (strict | tied | everything))
    else:
        need = F.col("_k") - F.col("_below")
        ties = d.where(tied & (need > 0)).withColumn("_k2", need)
        thr2 = kth_smallest(ties, tiebreak, F.col("_k2"), on).select(*on, F.col("_t").alias("_t2"))
        out = join_small(d, thr2, on, "left", bound_rows=single)
        tie_take = tied & (need > 0) & F.coalesce(F.col(tiebreak) <= F.col("_t2"), F.lit(False))
        out = out.withColumn("_take", want & (strict | tie_take | everything)).drop("_t2")
    return out.drop("_v", "_k", "_t", "_below")


def label_flip(df: DataFrame, label: str, source: str, target: str, strength: float, key: str,
               factor: float = 0.3, cap: float = 0.4, keys: Sequence[str] = (), salt: str = "flip") -> DataFrame:
    """Flip exactly floor(n_source * min(factor * strength, cap)) source labels to target,
    the chosen rows being those with the smallest hash of their key."""
    rate = min(factor * strength, cap)
    on = list(keys)
    src = F.col(label) == source
    cand = df.where(src)
    rest = df.where(~src | F.col(label).isNull())
    # k from the per-segment count of source rows, inside smallest_k's own aggregate
    marked = smallest_k(cand, uniform(F.col(key), salt), lambda n: F.floor(n * rate).cast("long"), on,
                        tiebreak=key)
    flipped = marked.withColumn(label, F.when(F.col("_take"), F.lit(target)).otherwise(F.col(label))).drop("_take")
    return flipped.unionByName(rest)


def concept_shift(df: DataFrame, label: str, cls: str, strength: float, key: Column, up: str, down: str,
                  lo: float = 0.0, hi: float = 11.0, step: float | None = 1.0, salt: str = "concept") -> DataFrame:
    """Within one class: up += N(3s, s), down += N(-2.5s, 0.5s), clip [lo, hi], round."""
    s = float(strength)
    inside = F.col(label) == cls
    d = (df.withColumn("_nz_up", F.col(up) + normal(key, f"{salt}|{up}", 3 * s, s))
         .withColumn("_nz_down", F.col(down) + normal(key, f"{salt}|{down}", -2.5 * s, 0.5 * s)))
    u = round_half_even(clip("_nz_up", lo, hi), step)
    dn = round_half_even(clip("_nz_down", lo, hi), step)
    return (d.withColumn(up, F.when(inside, u).otherwise(F.col(up)))
            .withColumn(down, F.when(inside, dn).otherwise(F.col(down))).drop("_nz_up", "_nz_down"))


def repair_rows(df: DataFrame, numerical: Sequence[str], binary: Sequence[str], baseline: DataFrame,
                target: str | None, valid: Sequence[str], key: Column, step: float | None = 1.0) -> DataFrame:
    """Numeric: round then clip to [max(0, base min), base max]; binary: round,
    clip [0, 1], int; target: invalid values -> hash-uniform valid value."""
    out = with_stats(df, baseline)
    for f in numerical:
        lo = F.greatest(F.lit(0.0), F.col(f"b_{f}_min"))
        out = out.withColumn(f, clip(round_half_even(F.col(f), step), lo, F.col(f"b_{f}_max")))
    for f in binary:
        out = out.withColumn(f, clip(F.rint(F.col(f).cast("double")), 0.0, 1.0).cast("int"))
    if target:
        out = out.withColumn(target, domain_repair(target, valid, key))
    return _drop_prefixed(out, "b")


def bootstrap_exact(df: DataFrame, n: int, order: str, cycle: int, salt: str = "boot") -> DataFrame:
    """Exactly ``n`` rows drawn with replacement; draw i gets new unique key
    ``seq = (cycle + 1) * 10^12 + i`` so later noise differs between duplicates."""
    spark = df.sparkSession
    total = df.agg(F.count("*").alias("_N"))
    draws = attach_row(spark.range(n).withColumnRenamed("id", "_draw"), total)
    u = uniform(F.concat_ws("|", F.lit(str(cycle)), F.col("_draw").cast("string")), salt)
    draws = draws.select(
        "_draw", (F.floor(u * F.col("_N")) + 1).cast("long").alias("_idx"))
    # only order values are ranked; the rows meet the draws by their key
    drawn = values_at(df, order, draws, n)
    out = join_small(df, drawn, [order], bound_rows=n).withColumn("seq", F.lit((cycle + 1) * SEQ_STRIDE) + F.col("_draw"))
    return out.drop("_idx", "_draw")


def poisson_steps(fraction: float) -> list[float]:
    """Cumulative Poisson(fraction) probabilities P(X <= j), until 1 in 52 bits."""
    out, term, total, j = [], math.exp(-fraction), 0.0, 0
    while total < 1 - 2.0 ** -52 and j < 20 + 10 * fraction:
        total += term
        out.append(total)
        j += 1
        term *= fraction / j
    return out


def poisson_bootstrap(df: DataFrame, fraction: float, key: Column, salt: str = "poisson") -> DataFrame:
    """Scalable bootstrap (row count ~ fraction * N): each row repeated
    Poisson(fraction) times. The count is the inverse of the Poisson law at a
    hash of the row's key, so it is the same in every partitioning and retry."""
    u = uniform(key, salt)
    copies = sum((u > p).cast("int") for p in poisson_steps(fraction))
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).drop("_copy")


def inject(df: DataFrame, drift_type: str, strength: float, key: str, baseline: DataFrame,
           shifts: Mapping[str, float], label: str, source: str, target: str, up: str, down: str,
           combined_factor: float = 0.6, step: float | None = 1.0, sd_units: bool = False) -> DataFrame:
    """Dispatch one drift type (input, label, concept, combined)."""
    k = F.col(key)
    if drift_type == "input_drift":
        return input_shift(df, shifts, strength, k, baseline, step=step, sd_units=sd_units)
    if drift_type == "label_drift":
        return label_flip(df, label, source, target, strength, key)
    if drift_type == "concept_drift":
        return concept_shift(df, label, source, strength, k, up, down, step=step)
    if drift_type == "combined_drift":
        s = strength * combined_factor
        out = input_shift(df, shifts, s, k, baseline, step=step, sd_units=sd_units)
        out = label_flip(out, label, source, target, s, key)
        return concept_shift(out, label, source, s, k, up, down, step=step)
    raise ValueError(f"unknown drift type {drift_type}")


def augment_step(current: DataFrame, reference: DataFrame, cycle: int, strength: float, n_new: int,
                 numerical: Sequence[str], order: str, shifts: Mapping[str, float], label: str,
                 source: str, target: str, up: str, down: str, cap: int = RETENTION_CAP) -> DataFrame:
    """One generator cycle: bootstrap + jitter from the reference, inject the
    cycle's drift type, keep the newest ``cap - n_new`` current rows, append."""
    baseline = wide_stats(reference, numerical, "b")
    base = bootstrap_exact(reference, n_new, order, cycle)
    base = jitter(base, numerical, F.col("seq"), baseline)
    drift_type = DRIFT_TYPES[cycle % len(DRIFT_TYPES)]
    new = inject(base, drift_type, strength, "seq", baseline, shifts, label, source, target, up, down)
    cur = current if "seq" in current.columns else current.withColumn("seq", F.col(order).cast("long"))
    if cycle == 0:  # the first cycle replaces the current data (no append)
        return new.select(*cur.columns)
    return retention_tail(cur, new.select(*cur.columns), "seq", cap)


def history_row(combined: DataFrame, cycle: int, strength: float, n_new: int) -> DataFrame:
    """The cycle's drift-history record (one row) for the append-only history table."""
    drift_type = DRIFT_TYPES[cycle % len(DRIFT_TYPES)]
    return combined.agg(F.count("*").alias("total_size")).select(
        F.lit(cycle).alias("cycle"), F.current_timestamp().alias("timestamp"), F.lit(drift_type).alias("drift_type"),
        F.lit(float(strength)).alias("drift_strength"), F.lit(n_new).cast("long").alias("new_samples"),
        "total_size", F.col("total_size").alias("data_size"))
