"""A corpus pipeline of five operators: quality, line dedup, near-duplicates,
decontamination, packing. Every stage reads what the stage before it kept.

``STAGES`` lists ``(name, function)``; a function takes (spark, docs, sf_dir)
and returns a DataFrame. All but the last return the columns of ``docs``.
Cases (nulls, empty texts, ties, repeated rows, empty tables, further columns)
are defined in the operators' docstrings.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridewise.llm import decontaminate, line_dedup, near_dedup, packing, quality_classifier  # noqa: E402
from ridewise.llm.common import cut_lineage, id_value, prepare, read_table  # noqa: E402
from ridewise.llm.queries import END_ID, QUALITY_THRESHOLD, SEQUENCE, TOKENIZER  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least ``QUALITY_THRESHOLD``, unchanged."""
    prepare(spark)
    return quality_classifier.keep_good(docs, read_table(spark, sf_dir, "labels"), QUALITY_THRESHOLD)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that a larger id holds; ``n_chars``, if
    there is such a column, is counted anew."""
    prepare(spark)
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the smallest id."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    prepare(spark)
    out = packing.pack_documents(docs, TOKENIZER, END_ID, SEQUENCE)
    return out.withColumn("doc_id", id_value()).select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                       "sequence_id", "offset")


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_duplicates),
          ("decontamination", decontamination), ("packing", pack)]

#: Compression and tokenizers have no SQL form; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
