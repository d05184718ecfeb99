"""Corpus pipeline: documents through five of the training-data operators,
stage by stage. Each stage works on all that its predecessor kept; its result
is written as Parquet in the shared folder and read again as the next one's
input. The last stage gives token ids instead of documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from plume.llm import decontaminate, jaccard_join, line_dedup, piece_lattice, quality_rules
from plume.llm.common import stored, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand elsewhere before go; a document goes with its last word."""
    out = line_dedup.dedup(docs)
    words = r"[^\\x20\\x09-\\x0D]"
    out = out.where(F.expr(f"text RLIKE '{words}'"))
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.keep_one(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, whether they decode to its text, and which segmentation they are: the best one of the
    lattice, not the library's merges."""
    out = piece_lattice.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)
    return out.withColumn("segmentation", F.lit("lattice"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", rules),
    ("line_dedup", lines),
    ("jaccard_join", near_copies),
    ("decontaminate", benchmarks),
    ("piece_lattice", tokens),
]

#: The classifier and the N-best search have no SQL form; tests/llm holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
