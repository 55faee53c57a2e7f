"""End-to-end plans: the batch run and the reports."""

from labweave.plans.pipeline import RunResult, run, standardise
from labweave.plans.replay import replay
from labweave.plans.reports import (
    dashboard, five_column_view, flagged_queue, record_detail, record_search, repeated_values,
    restatement_audit,
)

__all__ = [
    "RunResult", "dashboard", "five_column_view", "flagged_queue", "record_detail",
    "record_search", "repeated_values", "replay", "restatement_audit", "run", "standardise",
]
