"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on all rows that its predecessor kept. All but the last return the columns of the
table they are given; the last returns the placements of the packed pieces. Nulls, repeated rows, empty tables
and extra columns are handled as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokloom.llm import bbit_minhash, best_fit_pack, decontam, lang_id, pii_offsets
from tokloom.llm.common import stored, table
from tokloom.session import ship_package

#: Documents whose language is less sure than this are rejected, like those in no language at all.
LEAST_LANGUAGE_SCORE = 0.2
#: Texts this similar are near-duplicates (the query of the operator alone has its own contract).
NEAR_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the learnable rows teach."""
    ship_package(spark)
    model = lang_id.fit(docs, lang_id.learnable_rows())
    return lang_id.keep_known(docs, model, LEAST_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose word shingles are alike from ``NEAR_PERCENT`` on."""
    ship_package(spark)
    return bbit_minhash.keep_one(docs, NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of the benchmark table; rows without id, or with the same, are judged apart."""
    return decontam.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind."""
    ship_package(spark)
    return pii_offsets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequence and offset of every piece of every document."""
    ship_package(spark)
    return best_fit_pack.pack_documents(docs)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("packing", packing),
]

#: SQL can express neither the learned language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
