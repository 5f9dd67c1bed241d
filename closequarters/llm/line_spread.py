"""Cross-site line deduplication by distinct-site spread.

1. Every line of every document is keyed by two hashes (96 bits); blank lines
   are never touched.
2. Per key, HyperLogLog sketches of the sites merge by (partial) aggregation:
   constant state per line, however many rows a hot line or a hot site has.
3. A line is boilerplate if it stands on at least ``min_sites`` distinct sites.
   Estimates within ``BAND`` standard errors of the threshold are not trusted:
   only those lines get an exact distinct count.
4. Boilerplate lines are removed everywhere but at their first place (smallest
   document id, then line number; merged along with the sketch), so no content
   is lost altogether.

Lines meet the boilerplate keys by key and salt, so the rows of one hot line are
spread over ``SALTS`` groups; each key is repeated that often.

The line table holds keys, not texts; texts are read only in the last step,
which joins (document, removed line numbers) back to the documents.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

MIN_SITES = 8
LG_K = 10
BAND = 5.0
SALTS = 16
RELATIVE_ERROR = 1.04 / 2 ** (LG_K / 2)


def line_keys(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """_id, site, pos, h1, h2 for every line that is not blank."""
    lines = docs.select(F.col(id_col).alias("_id"), F.col(site_col).cast("string").alias("site"),
                        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("pos", "line"))
    return (lines.filter(F.col("_id").isNotNull() & (F.trim("line") != ""))
            .select("_id", "site", "pos", F.xxhash64("line").alias("h1"), F.hash(F.reverse("line")).alias("h2")))


def _salted(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_salt", F.pmod(F.xxhash64("_id", "pos"), F.lit(SALTS)))


def _for_all_salts(keys: DataFrame) -> DataFrame:
    return keys.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def wide_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """h1, h2, first (struct of document id and line number) of every line on
    at least ``min_sites`` distinct sites; a null site counts as no site."""
    spread = (lines.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"hll_sketch_agg(site, {LG_K})").alias("sketch"),
        F.min(F.struct("_id", "pos")).alias("first"))
        .filter(F.col("n") >= min_sites)
        .select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("sites")))
    margin = BAND * RELATIVE_ERROR * min_sites + 0.5
    # an estimate this close to the threshold may lie on either side of it
    spread = cut(spread.filter(F.col("sites") >= min_sites - margin)
                 .select("h1", "h2", "first", (F.col("sites") > min_sites + margin).alias("sure")), "op3-spread")
    unsure = spread.filter("not sure").drop("sure")
    near = _salted(lines.filter("site is not null")).join(_for_all_salts(unsure.select("h1", "h2")),
                                                          ["h1", "h2", "_salt"], "left_semi")
    exact = (near.select("h1", "h2", "site").distinct()
             .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites")).filter(F.col("sites") >= min_sites))
    return spread.filter("sure").drop("sure").unionByName(unsure.join(exact.select("h1", "h2"), ["h1", "h2"], "left_semi"))


def removed_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """_id, gone (line numbers to remove) for documents that lose a line."""
    wide = cut(wide_lines(lines, min_sites), "op3-wide")
    hits = _salted(lines).join(_for_all_salts(wide), ["h1", "h2", "_salt"])
    gone = hits.filter(F.struct("_id", "pos") != F.col("first"))
    return gone.groupBy("_id").agg(F.collect_set("pos").alias("gone"))


def dedup_lines(docs: DataFrame, *, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text",
                site_col: str = "source") -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text column, and the
    column ``_gone`` (removed line numbers, null if none).

    A null text stays null, a null id keeps its text; a document whose every
    line goes keeps its row with the empty text.  Repeated rows of one id are
    one place: they keep or lose a line together.  Further columns pass
    through whatever their names (but ``_id`` and ``_gone``).
    """
    gone = removed_lines(line_keys(docs, id_col, text_col, site_col), min_sites)
    joined = docs.join(gone.withColumnRenamed("gone", "_gone"), F.col(id_col) == F.col("_id"), "left").drop("_id")
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda x, i: ~F.array_contains("_gone", i))
    return joined.withColumn(text_col, F.when(F.col("_gone").isNull(), F.col(text_col))
                             .otherwise(F.array_join(kept, "\n")))


def line_report(docs: DataFrame, *, min_sites: int = MIN_SITES) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, n_chars, text_sha256 (of the
    text that stays)."""
    before = docs.withColumn("_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long"))
    out = dedup_lines(before.select("doc_id", "source", "text", "_lines"), min_sites=min_sites)
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", F.col("_lines").alias("n_lines"),
                      F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long").alias("n_removed"),
                      F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"))
