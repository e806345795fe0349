"""The corpus pipeline: stages from documents to packed token sequences.

Each stage works on all rows that the one before kept. All but the last return the
columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shiftwell.llm.cotrain import classified
from shiftwell.llm.mixing import cut_to_taken
from shiftwell.llm.packing import packed
from shiftwell.llm.queries import mix
from shiftwell.llm.simhash import deduplicated
from shiftwell.llm.tables import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return classified(docs, table(spark, sf_dir, "labels")).where("kept").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return deduplicated(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the weights of the mix, a row per epoch.

    A text at the end of its leaf's budget is cut there; n_chars stays what the source
    gave.
    """
    return cut_to_taken(mix(docs)).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, each with its ids."""
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The classifier is fitted and fingerprints are compared by programs, not by SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each reading what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
