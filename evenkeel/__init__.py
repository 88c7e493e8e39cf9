"""Reconciliation of table pairs on Spark."""

from evenkeel.plans.compare import Comparison, Options, compare
from evenkeel.plans.run import Outcome, ReconcileSpec, run, run_many, summarize
from evenkeel.sinks.differences import Labels, read_differences, save_differences
from evenkeel.sources.scan import SideSpec, scan

__all__ = [
    "Comparison",
    "Labels",
    "Options",
    "Outcome",
    "ReconcileSpec",
    "SideSpec",
    "compare",
    "read_differences",
    "run",
    "run_many",
    "save_differences",
    "scan",
    "summarize",
]
