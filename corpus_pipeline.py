"""Corpus pipeline: quality classifier, line dedup, near-duplicate join, mixing, packing.

Every stage takes the documents its predecessor kept and, but for the last,
returns the columns of ``documents``.  Columns that a stage doesn't use travel
in one struct, so their names can't clash with an operator's own.  A stage
that changes a text sets ``n_chars`` anew.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import jaccard, lines, mixing, packing, quality
from tablewright.llm.common import parquet_table, table

REST = "__rest"


def _folded(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with all columns but ``used`` in one struct."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(F.lit(0).alias("__any"), *others).alias(REST))


def _unfolded(folded: DataFrame, docs: DataFrame, new_text: bool = False) -> DataFrame:
    """The columns of ``docs`` again, in their order."""
    def column(c: str):
        if new_text and c == "n_chars":
            return F.length("text").cast(docs.schema[c].dataType).alias(c)
        return F.col(c) if c in folded.columns else F.col(REST).getField(c).alias(c)
    return folded.select(*[column(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts; it learns from the labels of rows not held out."""
    model = quality.train_quality(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    scored = quality.score_quality(_folded(docs, "doc_id", "text"), model)
    return _unfolded(scored.where("predicted = 1").drop("score", "predicted"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document (or line) holds already."""
    return _unfolded(lines.dedup_lines(_folded(docs, "doc_id", "text")).drop("n_lines", "n_removed"), docs, new_text=True)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return _unfolded(jaccard.one_of_each_group(_folded(docs, "doc_id", "text")), docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each pass that takes words of a document, with those words."""
    return _unfolded(mixing.mixed_documents(_folded(docs, "doc_id", "text", "source")), docs, new_text=True)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("source_mix", source_mix),
    ("packing", packing_stage),
]
ORACLE_SQL = None  # learned weights and token ids are beyond SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = parquet_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
