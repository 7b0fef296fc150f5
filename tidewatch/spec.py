"""Driver-side configuration: feature roles and decision thresholds."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FeatureSpec:
    """Roles of the columns of a monitored table.

    ``numerical`` / ``categorical`` are declared roles; any other common column
    (minus ``target`` and ``keys``) is routed by distinct-ratio inference.
    ``keys`` are segment columns (dataset id, region, ...): every statistic is
    computed per key, so one job monitors any number of segments.
    """

    numerical: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    target: str | None = None
    keys: tuple[str, ...] = ()
    infer: tuple[str, ...] = ()

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.numerical) + tuple(self.categorical) + tuple(self.infer)


@dataclass(frozen=True)
class DriftThresholds:
    """Decision thresholds. Defaults are the reference's values (fixed values)."""

    significance_level: float = 0.05
    effect_size_threshold: float = 0.1
    t_effect_floor: float = 0.05
    psi_threshold: float = 0.05
    distance_threshold: float = 0.05
    feature_drift_threshold: float = 0.10
    critical_drift_threshold: float = 0.25
    low_count: int = 5
    proportion_threshold: float = 0.1
    categorical_ratio: float = 0.05
    effect_only: bool = False
    # value buckets per feature at least; more follow from the size of the value
    # table, so no single task holds all distinct values of a continuous feature
    ecdf_buckets: int = 1


DEFAULT_THRESHOLDS = DriftThresholds()
