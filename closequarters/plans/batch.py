"""The batch run as plain stage functions.

Each stage reads the previous stage's output from the shared folder and
writes its own, so a stage can be rerun alone, a lost executor costs only
tasks of the running stage, and no stage keeps another's lineage.

    ingest      raw CSV exports            -> pings/   (day-partitioned Parquet)
                                              ingest_summary/ (rows and days, observed by the write)
    clean       pings/                     -> clean/   (day-partitioned Parquet)
                                              funnel/  (rows after each clean step)
    detect      clean/                     -> ranked/  (three top-N lists, Parquet)
    report      ranked/                    -> results/ (result records, JSON lines)
    trajectory  ranked/ + clean/           -> trajectories/ (window reports, Parquet)
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.encounters import detect_encounters
from ..operators.ranking import encounter_result, three_rankings
from ..operators.trajectory import pair_trajectories
from ..params import DEFAULTS, Params
from ..sources.readers import normalize_pings, read_pings_csv
from ..sources.sinks import write_pairs_json, write_pings
from .clean import CleanStages, clean_stages, stage_funnel, summary_from_write


def ingest_stage(spark: SparkSession, csv_path: str, out: str, summary_out: str | None = None) -> str:
    written = write_pings(normalize_pings(read_pings_csv(spark, csv_path)), out)
    if summary_out:
        summary_from_write(spark, written).write.mode("overwrite").parquet(summary_out)
    return out


def clean_stage(spark: SparkSession, pings_path: str, out: str, mids, p: Params = DEFAULTS) -> CleanStages:
    """Writes the clean table; the returned stages let the funnel reuse what was written."""
    stages = clean_stages(spark.read.parquet(pings_path), mids, p, cut=True)
    write_pings(stages.clean.select(*stages.raw.columns), out)
    return stages


def funnel_stage(stages: CleanStages, out: str) -> str:
    stage_funnel(stages.raw, stages.mids, stages.p, stages).write.mode("overwrite").parquet(out)
    return out


def detect_stage(spark: SparkSession, clean_path: str, out: str, p: Params = DEFAULTS) -> str:
    three_rankings(detect_encounters(spark.read.parquet(clean_path), p, keep_copies=True), p).write.mode("overwrite").parquet(out)
    return out


def report_stage(spark: SparkSession, ranked_path: str, out: str, p: Params = DEFAULTS) -> DataFrame:
    ranked = spark.read.parquet(ranked_path)
    result = encounter_result(ranked, p)
    write_pairs_json(result, out)
    return spark.read.schema(result.schema).json(out)


def trajectory_stage(spark: SparkSession, ranked_path: str, clean_path: str, out: str,
                     p: Params = DEFAULTS) -> str:
    (pair_trajectories(spark.read.parquet(ranked_path), spark.read.parquet(clean_path), p)
        .write.mode("overwrite").parquet(out))
    return out


def run_batch(spark: SparkSession, csv_path: str, out_dir: str, mids, p: Params = DEFAULTS) -> dict[str, str]:
    """All stages in order; returns the output path of each."""
    paths = {k: f"{out_dir.rstrip('/')}/{k}" for k in ("pings", "ingest_summary", "clean", "funnel", "ranked", "results",
                                                     "trajectories")}
    ingest_stage(spark, csv_path, paths["pings"], paths["ingest_summary"])
    funnel_stage(clean_stage(spark, paths["pings"], paths["clean"], mids, p), paths["funnel"])
    detect_stage(spark, paths["clean"], paths["ranked"], p)
    report_stage(spark, paths["ranked"], paths["results"], p)
    trajectory_stage(spark, paths["ranked"], paths["clean"], paths["trajectories"], p)
    return paths
