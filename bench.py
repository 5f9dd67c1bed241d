"""Headline timings: python bench.py  ->  one JSON line.

/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``.  As in production, every
stage reads the previous stage's Parquet output from the shared folder
(``spark.checkpoint.dir``); each timing covers plan building and full
execution of that stage.  Untimed setup: the ping table derived from
``events`` is exported as raw CSV (the ingest input).

``BENCH_REPEAT=n`` repeats ``events`` n times with running event ids (n = 100 at
sf0.1 is 10 million pings), for the marginal cost per row; the JSON line then
also has the row counts.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from closequarters.operators import trajectory  # noqa: E402
from closequarters.params import DEFAULTS, FIXTURE_MID_CODES  # noqa: E402
from closequarters.plans.batch import (clean_stage, detect_stage, funnel_stage, ingest_stage, report_stage,  # noqa: E402
                                       trajectory_stage)
from closequarters.plans.clean import clean_pings, ingest_summary  # noqa: E402
from closequarters.session import clear_shared, local_session, shared_dir  # noqa: E402
from closequarters.sources import derived_pings  # noqa: E402
from closequarters.sources.sinks import write_pings_csv  # noqa: E402


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def repeated_events(spark, sf: str, n: int) -> str:
    """A folder whose ``events`` are those of ``sf`` n times, ids running on."""
    out = shared_dir(spark, "bench-events")
    ev = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "user_id", "event_type")
    span = ev.agg(F.max("event_id") + 1).scalar()
    rounds = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_round")
    (ev.repartition(32).select("*", rounds)
       .select((F.col("event_id") + F.col("_round") * span).alias("event_id"), "user_id", "event_type")
       .write.parquet(f"{out}/events.parquet"))
    return out


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    name = os.path.basename(sf.rstrip("/")).replace("sf", "")
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus.isdigit() else "8"))
    spark = local_session(cpus, shuffle_partitions=parts, app="closequarters-bench")
    p, mids = DEFAULTS, FIXTURE_MID_CODES

    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    if repeat > 1:
        sf = repeated_events(spark, sf, repeat)

    csv_dir, pings_dir = shared_dir(spark, "bench-raw-csv"), shared_dir(spark, "bench-pings")
    clean_dir, ranked_dir = shared_dir(spark, "bench-clean"), shared_dir(spark, "bench-ranked")
    write_pings_csv(derived_pings(spark, sf), csv_dir)                      # setup, untimed
    noop(clean_pings(derived_pings(spark, sf), mids, p))                    # warm-up, untimed

    times: dict[str, float] = {}

    def stage(name, fn):
        t = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t, 3)

    traj_dir = shared_dir(spark, "bench-traj")
    stage("ingest_csv_to_parquet", lambda: ingest_stage(spark, csv_dir, pings_dir))
    stage("ingest_summary", lambda: noop(ingest_summary(spark.read.parquet(pings_dir))))
    stages = []
    stage("clean", lambda: stages.append(clean_stage(spark, pings_dir, clean_dir, mids, p)))
    stage("stage_funnel", lambda: funnel_stage(stages[0], shared_dir(spark, "bench-funnel")))
    stage("detect_and_rank", lambda: detect_stage(spark, clean_dir, ranked_dir, p))
    stage("report", lambda: report_stage(spark, ranked_dir, shared_dir(spark, "bench-results"), p))

    def trajectories():
        trajectory_stage(spark, ranked_dir, clean_dir, traj_dir, p)
        traj = spark.read.parquet(traj_dir)
        for f in (trajectory.nearest_ping, trajectory.trajectory_label, trajectory.trajectory_polyline,
                  trajectory.trajectory_extent, trajectory.trajectory_headings):
            noop(f(traj))

    stage("trajectories", trajectories)
    line = {"metric": "encounter_pipeline_total", "value": round(sum(times.values()), 3), "unit": "sec",
            "queries": times, "sf": name}
    if repeat > 1:
        line |= {"repeat": repeat, "pings": spark.read.parquet(pings_dir).count(),
                 "clean_pings": spark.read.parquet(clean_dir).count()}
    print(json.dumps(line))
    clear_shared(spark)
    spark.stop()


if __name__ == "__main__":
    main()
