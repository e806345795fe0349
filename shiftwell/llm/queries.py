"""The registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwell.llm import (
    bloom_lm,
    cotrain,
    divergence,
    html_text,
    infilling,
    mixing,
    packing,
    permutation,
    pstable,
    simhash,
    slots,
    token_counts,
    url_templates,
)
from shiftwell.llm.tables import table
from shiftwell.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The tree of the mix: kinds of sources, languages, sources.
DOMAIN = """CASE WHEN source = 'src0' THEN 'web'
 WHEN try_cast(substr(source, 4) AS INT) % 2 = 0 THEN 'reference' ELSE 'forum' END"""
WEIGHTS = {("web",): 3, ("reference",): 4, ("forum",): 3, ("*", "en"): 6, ("*", "de"): 2}
MAX_EPOCHS = 2
SEED = 42
SHARDS = 16
QUERY_EVERY = 50
URL_RULES = (
    url_templates.Rule("allow", "org", "/"),
    url_templates.Rule("block", "example.org", "/es/"),
    url_templates.Rule("block", "example.org", "/en/1"),
    url_templates.Rule("allow", "com", "/fr/"),
    url_templates.Rule("block", "com", "/de/"),
)


def _register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def mix(documents: DataFrame) -> DataFrame:
    """The mix of the query and of the pipeline."""
    levels = {"domain": DOMAIN, "language": "lang", "origin": "source"}
    return mixing.mixed(documents, levels, WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED)


@_register
def op1_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "domain", "language", "origin", "tokens", "epoch", "taken")


@_register
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(documents, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@_register
def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(table(spark, folder, "pages"))


@_register
def op4_retrieval_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return packing.packed(documents, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


@_register
def op5_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return permutation.nearest(vectors, F.col("vec_id") % QUERY_EVERY == 0)


@_register
def op6_slot_sharding(spark: SparkSession, folder: str) -> DataFrame:
    # Version 1 is dealt without knowing bytes; the bytes found edit it into version 2.
    path = scratch_path(spark, "slot-map")
    slots.store_map(slots.even_map(spark, SHARDS), path)
    rows = slots.assigned(table(spark, folder, "documents"), SHARDS, map_path=path)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "version",
    )


@_register
def op7_bloom_lm(spark: SparkSession, folder: str) -> DataFrame:
    learning = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    return bloom_lm.scored(table(spark, folder, "documents"), learning)


@_register
def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@_register
def op9_vector_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return pstable.near_vectors(table(spark, folder, "embeddings"))


@_register
def op10_cotrained_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = (table(spark, folder, name) for name in ("documents", "labels"))
    scored = cotrain.classified(documents, labels)
    return scored.select("doc_id", "text_score", "metadata_score", "score", "kept")


@_register
def op11_seekable_infilling(spark: SparkSession, folder: str) -> DataFrame:
    return infilling.transformed(table(spark, folder, "documents"), outputs=False)


@_register
def op12_path_templates(spark: SparkSession, folder: str) -> DataFrame:
    return url_templates.url_verdicts(table(spark, folder, "pages"), URL_RULES)


@_register
def op13_skyband_audit(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))
