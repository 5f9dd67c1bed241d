"""Q2/Q3: detection over a clean table and the full encounter report."""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.encounters import detect_encounters
from ..operators.ranking import encounter_result, three_rankings
from ..params import DEFAULTS, Params
from .clean import clean_pings
from .materialize import persist_pings


def rankings(clean: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Top N of the three lists for a clean table (T2 over Q2)."""
    return three_rankings(detect_encounters(clean, p, keep_copies=True), p)


def encounter_report(raw: DataFrame, mids, p: Params = DEFAULTS) -> DataFrame:
    """Q3: raw pings -> clean (persisted, lineage cut) -> detect -> three
    rankings -> result records."""
    clean = persist_pings(clean_pings(raw, mids, p), "clean")
    return encounter_result(rankings(clean, p), p)
