"""Registered query plans. Importing this package fills the registry."""

from tidewatch.plans import (  # noqa: F401
    drift_plans, eval_plans, history_plans, inject_plans, monitor_plans, profile_plans, scalar_plans, sink_plans, stream_plans)
from tidewatch.plans.registry import ORACLE, QUERIES  # noqa: F401
