"""Token counts by a two-tier lookup of pre-token lengths, in the map stage alone."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwell.llm.workers import kept

SAMPLE_ROWS = 2000
FREQUENT = 1 << 16
LONGEST_FREQUENT = 32
WORKER_ENTRIES = 1 << 19

# A pre-token: the spaces before a word and the word. No piece of the vocabulary has
# a space behind another character, so no merge joins two of them.
UNIT = re.compile(" *[^ ]+| +")


class UnitLengths(dict):
    """Lengths of pre-tokens met before; others are encoded and kept, up to a bound."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        super().__init__()
        self.encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
        # The library puts a space before each text, so a lone space cannot be given
        # to it as it is; behind a word it is one piece more.
        self.lone = len(self.encode("a ")) - len(self.encode("a"))

    def __missing__(self, unit: str) -> int:
        n = self.lone if unit == " " else len(self.encode(unit[1:]))
        if len(self) >= WORKER_ENTRIES:
            self.clear()
        self[unit] = n
        return n


def n_pieces(text: str, frequent: dict[str, int], rest: UnitLengths) -> int:
    """Tokens of a text: its pre-tokens' lengths, frequent ones first."""
    if not text:
        return 0
    units = UNIT.findall(" " + text.replace("▁", " "))
    return sum([frequent.get(unit) or rest[unit] for unit in units])


def frequent_lengths(
    documents: DataFrame, path: str, text: str = "text", rows: int = SAMPLE_ROWS
) -> dict[str, int]:
    """Lengths of the words seen most in about ``rows`` documents.

    At most ``FREQUENT`` words of at most ``LONGEST_FREQUENT`` characters, so a few
    megabytes whatever the table holds. The sample decides only which words are
    looked up here rather than in a worker's cache, never a count.
    """
    total = documents.count()
    if not total:
        return {}
    words = (
        documents.sample(fraction=min(1.0, rows / total), seed=7)
        .select(F.explode(F.split(F.col(text), " ")).alias("word"))
        .where(F.length("word").between(1, LONGEST_FREQUENT))
    )
    top = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(FREQUENT)
    lengths = UnitLengths(path)
    units = (" " + row.word.replace("▁", " ") for row in top.select("word").collect())
    return {unit: lengths[unit] for unit in units if UNIT.fullmatch(unit)}


def token_counts(
    documents: DataFrame,
    path: str,
    max_tokens: int = 4096,
    text: str = "text",
) -> DataFrame:
    """The columns of ``documents`` plus n_bytes, n_tokens and over_limit.

    Counts are those of the sentencepiece model at ``path``, which every executor can
    read, over whole texts and without special tokens. Lengths of frequent pre-tokens
    come from a broadcast table of bounded size, others are encoded once per worker
    and cached; no pre-token is shuffled.

    NULL and empty texts have no bytes and no tokens. Rows are neither joined nor
    grouped, so repeated rows and NULL ids keep their place. An empty table gives an
    empty result. Columns named as a result column are replaced.
    """
    spark = documents.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_lengths(documents, path, text))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, rest = frequent.value, kept(("unit lengths", path), lambda: UnitLengths(path))
        for texts in batches:
            yield pd.Series([n_pieces(t or "", known, rest) for t in texts], dtype="int64")

    whole = F.coalesce(F.col(text), F.lit(""))
    return (
        documents.withColumn("n_bytes", F.octet_length(whole).cast("long"))
        .withColumn("n_tokens", count(whole))
        .withColumn("over_limit", F.col("n_tokens") > max_tokens)
    )
