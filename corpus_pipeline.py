"""From raw documents to packed sequences: quality rules, line dedup, near duplicates, PII, packing.

Each stage takes all that its predecessor kept. All but the last return the columns of documents. In every stage null
texts count as empty, rows that repeat stay rows of their own unless the stage says otherwise, an empty table gives an
empty one, and columns besides doc_id, text and lang pass through as they are, whatever their names, but n_chars, which
follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gossamr.llm.line_dedup import dedup_lines
from gossamr.llm.packing import pack_documents
from gossamr.llm.parity_join import dedup_near
from gossamr.llm.pii import redact
from gossamr.llm.quality_rules import filter_documents
from gossamr.session import materialize

#: Documents that a line must be found in to be dropped from all.
LINE_DOCS = 10


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the risk-controlled cutoffs reject go; null and empty texts are among them.

    Rows that repeat are judged alike. Null languages are a stratum like others, or part of the pooled one.
    """
    return filter_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents go; a document left without any text goes too. A repeated row counts as a document."""
    out = dedup_lines(docs, min_docs=LINE_DOCS).drop("n_lines", "n_dropped")
    out = out.filter(F.length("text") > 0)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 of their five-word shingles, the one of least id stays.

    Rows are told apart by id and text; one that is repeated whole stays once, one without words stays as it is.
    """
    return dedup_near(docs, k=5, p=80, q=100)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and what reveals it are masked in the texts; every row stays."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in the sequences; rows that repeat are packed as often."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("packing", packing),
]

#: SQL cannot express the last stages (sketch join, sanitisation, genetic packing); tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for documents; each stage is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
