"""Corpus pipeline: five operators in a row, from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of their input.

Defined results: the stages take nulls in any column, empty texts, repeated
rows and empty tables as their operators define them (see their modules);
columns beyond the named ones pass through under whatever name they have, up
to the packing stage, which returns pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import host_rules, line_dedup, minhash, mixing, packing
from ledgerlight.llm.common import materialise, ship_package, with_rest
from ledgerlight.sources.tables import read_table

#: No SQL form: tokenisation and best-fit packing. tests/llm/test_llm_pipeline.py holds the run against a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or come from a rejected host go."""
    ship_package(spark)
    return host_rules.keep_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-equal lines one stays in the corpus; ``n_chars`` follows the text. No document goes."""
    if "n_chars" not in docs.columns:
        return line_dedup.dedup_lines(docs)
    kind = docs.schema["n_chars"].dataType

    def measured(rows: DataFrame) -> DataFrame:
        out = line_dedup.dedup_lines(rows, n_dropped="n_dropped")
        return out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))

    return with_rest(docs, ["doc_id", "text", "n_chars"], measured)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8) stays."""
    ship_package(spark)
    return minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those it does not take, or without words, go."""
    return mixing.take(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in a sequence of 1024 tokens."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two stages is written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
