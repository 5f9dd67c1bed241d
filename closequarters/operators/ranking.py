"""Closest-per-pair, top-N lists and the result records.

Arg-min per vessel pair is a ``min`` over a struct whose leading fields are
the ranking key, so it aggregates map-side (a pair that holds a third of all
encounters is reduced in each task before the shuffle).  The three lists are
ranked in one pass: each pair row is tagged with the lists it belongs to,
exploded, reduced per (list, pair), and cut to N per list by a ``row_number``
filter that Spark plans as a partial ``WindowGroupLimit`` before the shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timecols import epoch_s, iso_millis
from ..params import DEFAULTS, Params
from ..session import shared_dir
from .filters import is_civilian, is_operational, is_silenced

LISTS = ("all", "civilian", "silenced")
# Ranking key: distance rounded to a micrometre (so last-bit trig differences
# between engines cannot reorder near-equal distances), then both timestamps,
# then the ids; the remaining columns only make the order total.
PAIR_KEY = ("_d6", "ts_a", "ts_b", "mmsi_a", "mmsi_b")
PAIR_REST = ("lat_a", "lon_a", "lat_b", "lon_b", "sog_a", "sog_b", "name_a", "name_b",
             "ship_type_a", "ship_type_b", "dist_m", "silenced_a", "silenced_b")


def _keyed(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("_d6", F.round("dist_m", 6))


def _row_struct(df: DataFrame) -> Column:
    cols = [c for c in PAIR_KEY + PAIR_REST if c in df.columns]
    return F.struct(*[F.col(c) for c in cols])


def closest_per_pair(pairs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The closest ping pair per vessel pair (per ``by`` group)."""
    k = _keyed(pairs)
    best = k.groupBy(*by, "mmsi_a", "mmsi_b").agg(F.min(_row_struct(k)).alias("_best"))
    return best.select(*by, "_best.*")


def _order(prefix: tuple[str, ...] = ()) -> list[Column]:
    return [F.col(c) for c in prefix + PAIR_KEY]


def top_encounters(pairs: DataFrame, n: int = DEFAULTS.top_n) -> DataFrame:
    """Global top N vessel pairs by closest distance, with ``rank`` 1..N.
    ``orderBy().limit()`` plans as TakeOrderedAndProject (per-task top N)."""
    best = closest_per_pair(pairs).orderBy(*_order()).limit(n)
    w = Window.orderBy(*_order())  # over at most N rows
    return best.withColumn("rank", F.row_number().over(w)).drop("_d6")


def list_tags(p: Params = DEFAULTS) -> Column:
    """The lists a pair row belongs to; unknown membership (null) excludes."""
    return F.array_compact(F.array(F.lit("all"), F.when(is_civilian(p), F.lit("civilian")),
                                   F.when(is_silenced(), F.lit("silenced"))))


def three_rankings(pairs: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """Top ``p.top_n`` of all / civilian / silenced in one pass.  The list
    filter comes before the closest-per-pair reduction, so a pair can show a
    different ping pair in different lists.  Everything downstream takes the
    rows of this frame as they are, so ``top_n`` is the only bound."""
    tagged = pairs.withColumn("list", F.explode(list_tags(p)))
    best = closest_per_pair(tagged, by=("list",))
    w = Window.partitionBy("list").orderBy(*_order())
    return (best.withColumn("rank", F.row_number().over(w))
                .filter(F.col("rank") <= p.top_n).drop("_d6"))


def ranked_pair(ranked: DataFrame, list_name: str, k: int = 1) -> DataFrame:
    """Rank ``k`` (1-indexed) of one list."""
    if k < 1:
        raise ValueError("rank must be >= 1")
    return ranked.filter((F.col("list") == list_name) & (F.col("rank") == k))


def encounter_result(ranked: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """K3: the 13-field result record per ranked pair (plus ``list``/``rank``)."""
    keep = [c for c in ("list", "rank") if c in ranked.columns]
    return ranked.select(*keep, "mmsi_a", "mmsi_b", "name_a", "name_b", "ship_type_a", "ship_type_b",
                         iso_millis(epoch_s("ts_a")).alias("timestamp_utc"),
                         "lat_a", "lon_a", "lat_b", "lon_b", F.col("dist_m").alias("distance_m"),
                         F.lit(p.trajectory_half_window_min).alias("window_minutes"))


def identified_encounter(ranked: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """K4: the answer - rank 1 of the silenced list as a result record."""
    return encounter_result(ranked_pair(ranked, "silenced", 1), p).drop("list", "rank")


def pair_counts(pairs: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """A11 (part 1): encounters and distinct vessel pairs per list.  Pairs that
    carry a multiplicity (``n_copies``) count as often as that."""
    each = F.sum("n_copies") if "n_copies" in pairs.columns else F.count(F.lit(1))
    tagged = pairs.withColumn("list", F.explode(list_tags(p)))
    per_pair = tagged.groupBy("list", "mmsi_a", "mmsi_b").agg(each.alias("_e"))
    return per_pair.groupBy("list").agg(F.sum("_e").alias("encounters"), F.count(F.lit(1)).alias("pairs"))


def rank_in_all(pairs: DataFrame, ranked: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """A11 (part 2): for every ranked pair of every list, its rank in the full
    all-types ordering and how many operational pairs sit ahead of it.

    A distributed order statistic: vessel pairs and ranked keys are dealt
    together into ranges of the ordering (the whole key, so equal distances do
    not share a range) and written once to the shared folder with the number of
    their range, which runs a job while the plan is built.  A rank is the rows
    ahead inside the range (a window per range) and the rows of all earlier
    ranges; of these prefix counts there are as many as ranges, so they travel as
    one small array whatever the number of pairs or of ranked rows."""
    spark = pairs.sparkSession
    targets = (_keyed(ranked).filter(F.col("rank") >= 1)
               .select(F.struct(*_order()).alias("_k"), F.lit(0).alias("_pair"), F.lit(0).alias("_ops"), "list", "rank"))
    best = closest_per_pair(pairs).select(F.struct(*_order()).alias("_k"), F.lit(1).alias("_pair"),
                                          F.coalesce(is_operational(p), F.lit(False)).cast("int").alias("_ops"))
    both = best.unionByName(targets, allowMissingColumns=True)
    path = shared_dir(spark, "pair-order")
    # the number of ranges is given, so that they are not merged by size
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartitionByRange(ranges, "_k", "_pair").withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    rows = spark.read.schema(dealt.schema).parquet(path)
    sums = (rows.groupBy("_range").agg(F.sum("_pair").alias("_pair"), F.sum("_ops").alias("_ops"))
            .agg(F.collect_list(F.struct("_range", "_pair", "_ops")).alias("s")).scalar())
    # a pair that equals a ranked key is not ahead of it: ranked rows (0) come first
    w = Window.partitionBy("_range").orderBy("_k", "_pair").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (rows.withColumns({f"{c}_in": F.sum(c).over(w) for c in ("_pair", "_ops")})
              .filter(F.col("rank").isNotNull()).withColumn("_sums", sums))
    earlier = F.filter("_sums", lambda x: x["_range"] < F.col("_range"))

    def ahead(c):
        return F.col(f"{c}_in") + F.aggregate(earlier, F.lit(0).cast("long"), lambda n, x: n + x[c])

    return placed.select("list", "rank", (ahead("_pair") + 1).alias("rank_in_all"), ahead("_ops").alias("operational_ahead"))
