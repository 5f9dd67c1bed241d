"""Q1: the clean ping table, and its per-stage views and row funnel.

Stage order is the published one: circle -> SOG sentinels -> id checks and
moving vessels -> GPS-jump outliers -> thin tracks -> name/type backfill.

Physical plan at scale: the jump test needs each vessel's pings in time
order, which is one exchange of the pings by (vessel, time chunk).  Everything
else is per-vessel statistics (partial aggregation) joined back once.  Because
the moving-vessel and thin-track tests drop whole vessels and the jump test
only looks inside one vessel, the jump test can run before them with the same
result.  ``clean_pings`` writes the checked rows, the jump-kept rows and the
vessel table to the shared folder, so the raw table is scanned and the window
runs once, and the vessel table, the final join and the row funnel start from
those copies; the per-stage views stay lazy.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_s
from ..operators.filters import in_circle, mmsi_checks, within_radius
from ..operators.jumps import gps_jump_filter
from ..operators.projections import backfill_static, normalize_sog
from ..params import DEFAULTS, UNDEFINED_SHIP_TYPE, Params
from ..session import shared_dir


class CleanStages:
    """The clean pipeline's intermediate tables, built on first use (each is
    a lazy DataFrame; building only the ones asked for keeps plan analysis
    cheap).  With ``cut`` the checked rows (read four times: track sizes, chunk
    edges, jump window, vessel statistics), the jump-kept rows and the vessel
    table are written once and reread, so the raw table is scanned once and the
    clean rows and the row funnel of one object share the jump window and the
    per-vessel statistics; these writes run when a stage is first asked for."""

    def __init__(self, raw: DataFrame, mids, p: Params = DEFAULTS, cut: bool = False):
        self.raw, self.mids, self.p, self.cut = raw, mids, p, cut
        self.in_circle = Observation() if cut else None

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        if not self.cut:
            return df
        path = shared_dir(df.sparkSession, name)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    @cached_property
    def spatial_rows(self) -> int:
        """Rows inside the circle, counted while the checked rows were written
        (only with ``cut``; the write has no shuffle, so every task counts once)."""
        _ = self.checked
        return self.in_circle.get["rows"]

    @cached_property
    def spatial(self) -> DataFrame:          # F2
        return within_radius(self.raw, self.p)

    @cached_property
    def checked(self) -> DataFrame:          # F2 + P1 + F3-F6
        inside = self.spatial
        if self.cut:
            inside = inside.observe(self.in_circle, F.count(F.lit(1)).alias("rows"))
        return self._written(mmsi_checks(normalize_sog(inside, self.p), self.mids, self.p), "checked")

    @cached_property
    def kept(self) -> DataFrame:             # W1 on every vessel (before J1, same rows)
        return self._written(gps_jump_filter(self.checked, self.p), "jump-kept")

    @cached_property
    def vessels(self) -> DataFrame:          # one row per vessel
        return self._written(vessel_table(self.checked, self.kept, self.p), "vessels")

    @cached_property
    def moving_ids(self) -> DataFrame:
        return self.vessels.filter("is_moving").select("mmsi")

    @cached_property
    def moving(self) -> DataFrame:           # + J1 (the "id + moving" stage)
        return self.checked.join(self.moving_ids, "mmsi", "left_semi")

    @cached_property
    def jump_free(self) -> DataFrame:        # + W1
        return self.kept.join(self.moving_ids, "mmsi", "left_semi")

    @cached_property
    def keep(self) -> DataFrame:
        return self.vessels.filter(F.col("is_moving") & F.col("is_dense"))

    @cached_property
    def dense(self) -> DataFrame:            # + J2
        return self.kept.join(self.keep.select("mmsi"), "mmsi", "left_semi")

    @cached_property
    def clean(self) -> DataFrame:            # + J3 backfill (Q1 output)
        look = self.keep.select("mmsi", F.col("vessel_name").alias("_vessel_name"),
                                F.col("modal_type").alias("_vessel_type"))
        return backfill_static(self.kept.join(look, "mmsi", "inner"))


def vessel_table(checked: DataFrame, kept: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """One row per vessel from two partial aggregations: number and highest
    speed of all checked pings; pings kept by the jump test, their first name
    and their modal specific type (``mode`` keeps a small value->count map per
    vessel; ties go to the smallest type)."""
    named = F.when(F.col("name").isNotNull(), F.struct(epoch_s("ts").alias("t"), F.col("name").alias("n")))
    specific = F.when(F.col("ship_type").isNotNull() & (F.col("ship_type") != UNDEFINED_SHIP_TYPE), F.col("ship_type"))
    vmax = checked.groupBy("mmsi").agg(F.max("sog").alias("max_sog"), F.count(F.lit(1)).alias("n_checked"))
    vkept = kept.groupBy("mmsi").agg(F.count(F.lit(1)).alias("n_kept"), F.min(named).getField("n").alias("vessel_name"),
                                     F.mode(specific, True).alias("modal_type"))
    v = vmax.join(vkept, "mmsi", "left")
    return v.select("*", (F.col("max_sog") > F.lit(p.min_vessel_max_sog_kn)).alias("is_moving"),
                    (F.coalesce(F.col("n_kept"), F.lit(0)) >= F.lit(p.min_pings_per_vessel)).alias("is_dense"))


def clean_stages(raw: DataFrame, mids, p: Params = DEFAULTS, cut: bool = False) -> CleanStages:
    return CleanStages(raw, mids, p, cut)


def clean_pings(raw: DataFrame, mids, p: Params = DEFAULTS, cut: bool = True) -> DataFrame:
    """Q1: the clean ping table (same 13 columns as the input).  ``cut`` writes
    three intermediate tables to the shared folder, running their Spark jobs
    while the plan is built; without it the plan is lazy, scans the raw table
    several times and runs the jump window twice."""
    return clean_stages(raw, mids, p, cut).clean.select(*raw.columns)


def stage_funnel(raw: DataFrame, mids, p: Params = DEFAULTS, stages: CleanStages | None = None) -> DataFrame:
    """A10: rows after each clean stage, rows dropped and % of the previous stage.

    Input and in-circle rows come from one scan of the raw table; the three
    later stages are sums over the vessel table (checked and kept pings per
    vessel), so the jump window is the only wide step; given the ``stages`` of a
    clean run with ``cut``, their written vessel table is summed and no window
    runs at all, and the rows in the circle are those observed during that
    write: the raw table is only counted, which Parquet answers from its footers.
    The counts of one side enter as a scalar subquery and all five are unpivoted
    with ``inline``."""
    v = (stages or clean_stages(raw, mids, p)).vessels
    moving, dense = F.col("is_moving"), F.col("is_moving") & F.col("is_dense")

    def rows(col, cond):
        return F.coalesce(F.sum(F.when(cond, F.col(col))), F.lit(0))

    later = v.agg(F.struct(rows("n_checked", moving).alias("m"), rows("n_kept", moving).alias("j"),
                           rows("n_kept", dense).alias("s")).alias("c")).scalar()
    observed = stages is not None and stages.cut
    n1 = F.lit(stages.spatial_rows) if observed else F.count_if(in_circle(p))
    first = raw.agg(F.count(F.lit(1)).alias("n0"), n1.alias("n1"))
    counts = first.select("n0", "n1", later.alias("c")).select("n0", "n1", "c.*").select(
        F.inline(F.array(*[F.struct(F.lit(no).cast("long").alias("stage_no"), F.lit(name).alias("stage"),
                                    F.col(c).cast("long").alias("rows"))
                           for no, name, c in ((1, "input", "n0"), (2, "spatial", "n1"), (3, "mmsi_moving", "m"),
                                               (4, "gps_jump", "j"), (5, "sparsity", "s"))])))
    w = Window.orderBy("stage_no")  # five rows
    prev = F.lag("rows").over(w)
    return counts.select("stage_no", "stage", "rows", (prev - F.col("rows")).alias("dropped"),
                         F.round(F.try_divide((prev - F.col("rows")) * F.lit(100.0), prev), 4).alias("pct_of_previous"))


def clean_summary(clean: DataFrame) -> DataFrame:
    """Rows and distinct vessels of a clean table."""
    return clean.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("mmsi").alias("vessels"))


def summary_from_vessels(stages: CleanStages) -> DataFrame:
    """A8 of the clean table from the vessel table: kept pings and number of the
    vessels that stay, without reading the pings again."""
    return stages.keep.agg(F.coalesce(F.sum("n_kept"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("vessels"))


def summary_from_write(spark: SparkSession, written: dict) -> DataFrame:
    """A9 from what ``write_pings`` observed."""
    days = written["days"]
    row = (written["rows"], len(days), days[0] if days else None, days[-1] if days else None)
    return spark.createDataFrame([row], "rows long, days long, first_day date, last_day date")


def ingest_summary(pings: DataFrame) -> DataFrame:
    """Rows, number of days and first/last day of an ingested table
    (from the data, not by listing directories)."""
    return pings.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("day").alias("days"),
                     F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def clean_from_parquet(spark: SparkSession, path: str, mids, p: Params = DEFAULTS) -> DataFrame:
    """Q1 over a day-partitioned table; the box predicate reaches the scan."""
    return clean_pings(spark.read.parquet(path).filter(in_circle(p)), mids, p)
