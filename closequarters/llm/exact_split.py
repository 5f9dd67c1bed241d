"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

1. One scan gives (id, SHA-256 of the text); the narrow table is cut.
2. Frequent digests come from mergeable Misra-Gries counters: Spark's
   ``approx_top_k`` sketch keeps ``max_tracked`` counters per task, lowers all
   of them together when they run out, and merges by addition.  A digest with
   more than about n / max_tracked rows cannot be missed; combining runs in two
   levels so the last task sees ``FAN_IN`` sketches, not one per input split.
3. Candidates are verified by an exact count; the verified winners (at most
   ``max_tracked`` rows, a proven bound) are broadcast and settle their rows on
   the map side.
4. All other digests take an ordinary shuffled aggregation and join; none of
   their groups is large.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

FAN_IN = 32
MAX_TRACKED = 1024
MIN_HEAVY = 128


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("text_sha256"))


def frequent_digests(digests: DataFrame, max_tracked: int = MAX_TRACKED, key: str = "text_sha256") -> DataFrame:
    """At most ``max_tracked`` candidate digests that may be frequent."""
    level1 = (digests.groupBy((F.spark_partition_id() % FAN_IN).alias("g"))
              .agg(F.expr(f"approx_top_k_accumulate({key}, {max_tracked})").alias("state")))
    # grouped, since a task without rows has no sketch that an ungrouped combine could take
    level2 = (level1.groupBy((F.col("g") % 1).alias("all"))
              .agg(F.expr(f"approx_top_k_combine(state, {max_tracked})").alias("state")))
    top = level2.select(F.explode(F.expr(f"approx_top_k_estimate(state, {max_tracked})")).alias("e"))
    return top.select(F.col("e.item").alias(key)).filter(F.col(key).isNotNull()).distinct()


def verified_winners(digests: DataFrame, candidates: DataFrame, min_heavy: int) -> DataFrame:
    """Exact group of every candidate that really has ``min_heavy`` rows."""
    return (digests.join(F.broadcast(candidates), "text_sha256", "left_semi").groupBy("text_sha256")
            .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
            .filter(F.col("group_size") >= min_heavy))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                max_tracked: int = MAX_TRACKED, min_heavy: int = MIN_HEAVY) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as the empty text.  Of equal
    texts the largest id stays.  A null id never wins over a real one and is
    kept only in a group without any id.  Repeated rows of one id and text are
    counted in ``group_size`` and carry the same verdict.  Only the two named
    columns are read, so further columns (also ``keep_id`` or ``kept``) do not
    matter; an empty table gives an empty result.
    """
    digests = cut(text_digests(docs, id_col, text_col), "op4-digests")
    winners = cut(verified_winners(digests, frequent_digests(digests, max_tracked), min_heavy), "op4-winners")
    heavy = digests.join(F.broadcast(winners), "text_sha256")
    light = digests.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    groups = light.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"),
                                              F.count(F.lit(1)).alias("group_size"))
    settled = heavy.unionByName(light.join(groups, "text_sha256"))
    return settled.select("doc_id", "keep_id", "group_size",
                          F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
