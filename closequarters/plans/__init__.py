"""Composite plans (clean, detect, report, staged batch run) and the query catalogue."""
from .batch import run_batch
from .clean import clean_pings, stage_funnel
from .report import encounter_report, rankings

__all__ = ["run_batch", "clean_pings", "stage_funnel", "encounter_report", "rankings"]
