"""Table reconciliation and repair on Spark."""

from tallymend.config import Compare, Job, Side, job_from, load_job
from tallymend.plans.job import (
    Outcome,
    apply_to,
    reconcile,
    reconcile_tables,
    repair,
    repair_destination,
    run,
)
from tallymend.plans.scope import Scope, tag_partition

__all__ = [
    "Compare",
    "Job",
    "Outcome",
    "Scope",
    "Side",
    "apply_to",
    "job_from",
    "load_job",
    "reconcile",
    "reconcile_tables",
    "repair",
    "repair_destination",
    "run",
    "tag_partition",
]
