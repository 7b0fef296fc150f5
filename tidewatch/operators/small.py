"""Joins against small, derived tables (per-feature stats, bounds, offsets).

A broadcast hint is only given when the caller can bound the small side's
row count from parameters (e.g. features x buckets without segment keys).
Otherwise the plain join is left to AQE, which converts it to a broadcast at
runtime only if the measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps the shuffle join
beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 2_000_000
# columns that our own plans make and never leave NULL
NEVER_NULL = frozenset({"feature", "bucket", "_idx"})


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL segment keys match each other: a NULL segment is
    a segment like any other."""
    names = {k: f"_on_{i}" for i, k in enumerate(on)}
    right = right.select(*[F.col(c).alias(names.get(c, c)) for c in right.columns])
    same = [(F.col(k) == F.col(n)) if k in NEVER_NULL else F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    out = left.join(right, reduce(lambda a, b: a & b, same), how)
    return out.drop(*names.values())


def attach_row(df: DataFrame, one_row: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Add the columns of a table that holds at most one row (a global
    aggregate) to every row of ``df``.

    This is an uncorrelated scalar subquery: Spark runs it once and the plan
    sees a constant, so there is no join at all (a join on a literal key is
    folded by the optimizer into a keyless nested-loop join). An empty
    ``one_row`` gives NULLs, i.e. left-join semantics.
    """
    cols = list(cols or one_row.columns)
    if not cols:
        return df
    # one subquery column, then its fields: referencing the subquery once per
    # field would copy its plan into every field (and nest the copies when the
    # next step's stats are computed over this frame)
    row = one_row.select(F.struct(*cols).alias("_row")).scalar()
    out = df.select("*", row.alias("_row"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col("_row").getField(c).alias(c) for c in cols])


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "inner",
               bound_rows: int | None = None, limit: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Join ``big`` with a derived small table on ``on``. Without join keys
    ``small`` must be a one-row table: it is attached as a scalar subquery."""
    on = [on] if isinstance(on, str) else list(on)
    if not on:
        if how not in ("inner", "left"):
            raise ValueError("a keyless join needs a one-row table and how='inner' or 'left'")
        return attach_row(big, small)
    if bound_rows is not None and bound_rows <= limit and how in ("inner", "left", "left_semi", "left_anti"):
        small = F.broadcast(small)
    return join_on(big, small, on, how)


def bound(n_features: int, per_feature: int, keys: Sequence[str]) -> int | None:
    """Row bound of a per-(feature[, bucket]) table; unknown when segmented."""
    if keys:
        return None
    return max(1, n_features) * max(1, per_feature)
