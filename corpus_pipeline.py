"""Corpus pipeline: quality, toxicity, line and near-duplicate stages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet in the shared folder and hands the reread table
to the next one.  All stages but the last return the columns of ``documents``.

In every stage a null text counts as empty; a row without id is judged like any
other (null-safe matching), but neither learned from nor deduplicated; rows that
repeat an id are kept or dropped together; an empty table gives an empty table;
further columns pass through whatever their names.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closequarters.llm.common import cut, read_table
from closequarters.llm.hyperminhash import near_duplicates
from closequarters.llm.kneser_ney import toxicity_scores
from closequarters.llm.line_spread import dedup_lines
from closequarters.llm.nnls_pack import pack_documents
from closequarters.llm.pairwise_quality import quality_scores
from closequarters.llm.queries import tokenizer_file


def _keep(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is among ``ids`` (column doc_id); a row without
    id is matched by null-safe equality."""
    name = "_kept_id"
    while name in docs.columns:
        name += "_"
    ids = ids.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Bradley-Terry classifier rejects go."""
    return _keep(docs, quality_scores(docs, read_table(spark, sf_dir, "labels")).filter("predicted = 1"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney classifier calls toxic go."""
    return _keep(docs, toxicity_scores(docs, read_table(spark, sf_dir, "labels")).filter("predicted = 0"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site lines go (their first place stays); every document stays."""
    own = ["doc_id", "text", "source", "n_chars"]
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in own])  # their names stay out of the way
    out = dedup_lines(docs.select(*own, rest.alias("rest")))
    chars = F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    out = out.withColumn("n_chars", chars)
    return out.select(*[F.col(c) if c in own else F.col("rest").getField(c).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (the smallest id)."""
    return _keep(docs, near_duplicates(docs).filter("kept"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("packing", packing)]

# Trained classifiers and a tokenizer decide the rows, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
