"""Language model scores from a log-frequency Bloom filter of n-gram counts."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftwell.llm.groups import groups, joined, slices
from shiftwell.llm.tables import written

BASE = math.sqrt(2)
MIN_PAIR = 1
DISCOUNT = 0.75
PROBES = 6
BLOCK_BITS = 1 << 19
BROADCAST_BLOCKS = 1 << 10
SHARD_BLOCKS = 1 << 6
SHARD_TOKENS = 1 << 21
LEAST_SHARDS = 1 << 5
MOST_PARTITIONS = 50_000
FREQUENT = 1 << 18
CHUNK_CHARS = 1 << 22
CHUNKS_A_TASK = 1 << 4
HELD_PAIRS = 1 << 21
HELD_WORDS = 1 << 19
LEAST_LEFT = 0.02

# What a word is; marks of text end and start, which no word can be.
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
END = b"\n"
START = b" "
# Their names among words that are joined by spaces: no text in UTF-8 has these bytes.
END_NAME, START_NAME = b"\xfe", b"\xff"
WORD_BITS = 28
KIND_WORD, KIND_PAIR, KIND_MASS = 1, 2, 3


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A to Z made small."""
    return WORDS.findall((text or "").encode().lower())


def mix(x: np.ndarray) -> np.ndarray:
    """Numbers scattered over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Pairs as 64 bits: 36 of the context's hash, 28 of the word's."""
    low = np.uint64((1 << WORD_BITS) - 1)
    return (context >> np.uint64(WORD_BITS) << np.uint64(WORD_BITS)) | (word & low)


def context_keys(context: np.ndarray) -> np.ndarray:
    """The part of a pair's key that its context gives."""
    return context >> np.uint64(WORD_BITS)


def entry_keys(kind: int, keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.uint64) + np.uint64(kind * 0x9E3779B97F4A7C15 % (1 << 64)))


def levels_of(count: np.ndarray, least: float) -> np.ndarray:
    """The quantised count: 1 for the least one kept, one more for each factor of BASE."""
    return 1 + np.floor(np.log(np.maximum(count, least) / least) / math.log(BASE) + 1e-9).astype(int)


def count_of(level: np.ndarray, least: float) -> np.ndarray:
    """The count a level stands for, 0 for level 0: the middle of what it holds."""
    lower = np.ceil(least * BASE ** (level - 1.0) - 1e-6)
    upper = np.maximum(np.ceil(least * BASE**level - 1e-6) - 1, lower)
    return np.where(level > 0, np.sqrt(lower * upper), 0.0)


@dataclass
class Filter:
    """A blocked Bloom filter in which an entry of level q is put with 1, 2, .. q.

    ``bits`` are those of the blocks from ``first`` on.
    """

    blocks: int
    bits: np.ndarray
    first: int = 0

    def holds(self, keys: np.ndarray, levels: int | np.ndarray) -> np.ndarray:
        """Whether each entry is in with the level, by all of its probes."""
        found = np.zeros(len(keys), dtype=bool)
        start = (block_of(keys, self.blocks).astype(np.int64) - self.first) * (BLOCK_BITS // 8)
        first, step = probe_steps(keys, levels)
        alive = np.arange(len(keys))
        for probe in range(PROBES):
            at = probe_bit(first, step, probe)
            hit = (self.bits[start + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 == 1
            if not hit.all():
                alive, start, first, step = alive[hit], start[hit], first[hit], step[hit]
            if not len(alive):
                return found
        found[alive] = True
        return found

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each entry.

        An entry is in with every level up to its own, so probes go up in doubling
        steps until one misses, and then halve the gap that is left.
        """
        low = np.zeros(len(keys), dtype=np.int64)
        high = np.zeros(len(keys), dtype=np.int64)
        alive, level = np.arange(len(keys)), 1
        while len(alive):
            hit = self.holds(keys[alive], level)
            high[alive[~hit]] = level
            alive = alive[hit]
            low[alive] = level
            level *= 2
        open_ = np.flatnonzero(high - low > 1)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            hit = self.holds(keys[open_], middle)
            low[open_[hit]] = middle[hit]
            high[open_[~hit]] = middle[~hit]
            open_ = open_[high[open_] - low[open_] > 1]
        return low


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return (keys >> np.uint64(32)) % np.uint64(blocks)


def probe_steps(keys: np.ndarray, level: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and step of an entry's probes at a level."""
    mixed = mix(keys + np.atleast_1d(level).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    return mixed & np.uint64(0xFFFFFFFF), mixed >> np.uint64(32) | np.uint64(1)


def probe_bit(first: np.ndarray, step: np.ndarray, probe: int) -> np.ndarray:
    return ((first + np.uint64(probe) * step) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)


def set_bits(block: np.ndarray, keys: np.ndarray, levels: np.ndarray) -> None:
    """Put entries of one block into it, each with all levels up to its own."""
    every = np.repeat(keys, levels)
    starts = np.cumsum(levels) - levels
    level = np.arange(len(every)) - np.repeat(starts, levels) + 1
    first, step = probe_steps(every, level)
    for probe in range(PROBES):
        at = probe_bit(first, step, probe)
        np.bitwise_or.at(block, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))


def filter_of(keys: np.ndarray, levels: np.ndarray) -> Filter:
    """A filter as large as its entries ask for at ``PROBES`` probes."""
    blocks = max(1, math.ceil(int(levels.sum()) * PROBES / math.log(2) / BLOCK_BITS))
    flags = np.zeros(blocks * BLOCK_BITS, dtype=bool)
    every = np.repeat(keys, levels)
    start = block_of(every, blocks).astype(np.int64) * BLOCK_BITS
    level = np.arange(len(every)) - np.repeat(np.cumsum(levels) - levels, levels) + 1
    first, step = probe_steps(every, level)
    for probe in range(PROBES):
        flags[start + probe_bit(first, step, probe)] = True
    return Filter(blocks, np.packbits(flags, bitorder="little"))


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded length; a longer text is a range of its own."""
    start = size = 0
    for end, text in enumerate(texts):
        length = len(text or "")
        if size and size + length > CHUNK_CHARS:
            yield start, end
            start, size = end, 0
        size += length
    if start < len(texts):
        yield start, len(texts)


@dataclass
class Coded:
    """Texts as numbers of their distinct words: one end after each text."""

    words: list[bytes]
    hashes: np.ndarray
    codes: np.ndarray
    contexts: np.ndarray
    lengths: np.ndarray


class Numbers(dict):
    """Numbers things in the order in which they are first asked for."""

    def __missing__(self, thing: bytes) -> int:
        self[thing] = number = len(self)
        return number


def tokenized(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of texts, the tokens as their numbers, and each text's length."""
    numbers = Numbers({END: 0, START: 1})
    flat: list[int] = []
    lengths = []
    for text in texts:
        words = words_of(text)
        flat.extend(map(numbers.__getitem__, words))
        flat.append(0)
        lengths.append(len(words) + 1)
    return list(numbers), np.array(flat, dtype=np.int64), np.array(lengths)


def hashes_of(words: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64)


def contexts_of(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The token before each; that of a text's first token is the start mark."""
    contexts = np.empty_like(codes)
    contexts[1:] = codes[:-1]
    contexts[np.cumsum(lengths) - lengths] = 1
    return contexts


def coded(texts: list[str | None]) -> Coded:
    """Tokens of texts; the context of a text's first token is the start mark."""
    words, codes, lengths = tokenized(texts)
    return Coded(words, hashes_of(words), codes, contexts_of(codes, lengths), lengths)


def planes(numbers: np.ndarray, size: int = 4) -> bytes:
    """Whole numbers, first all their lowest bytes: small ones leave runs of zeros."""
    numbers = numbers.astype(f"<u{size}")
    return numbers.view(np.uint8).reshape(-1, size).T.tobytes()


def from_planes(data: bytes, size: int = 4) -> np.ndarray:
    numbers = np.frombuffer(data, dtype=np.uint8).reshape(size, -1).T
    return np.ascontiguousarray(numbers).view(f"<u{size}").ravel().astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """word and n over all rows; counted in tasks before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            words = pa.array(list(held), type=pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()))], ["word", "n"])

        for batch in slices(batches):
            values = batch[0].to_pylist()
            for start, end in _chunks(values):
                for value in values[start:end]:
                    held.update(words_of(value))
                    held[END] += 1
                if len(held) >= HELD_WORDS:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    counted = texts.select(text).mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def pair_counts(texts: DataFrame, text: str, least: int) -> DataFrame:
    """pair and n of the pairs of tokens seen ``least`` times or more, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.empty(0, dtype=np.uint64)
        counts = np.empty(0, dtype=np.int64)
        waiting: list[np.ndarray] = []

        def merge() -> tuple[np.ndarray, np.ndarray]:
            # Two sorted runs: the stable sort of both is a merge.
            fresh = np.sort(np.concatenate([keys[:0], *waiting]))
            waiting.clear()
            both = np.concatenate([keys, fresh])
            weight = np.concatenate([counts, np.ones(len(fresh), dtype=np.int64)])
            return _summed(both, weight) if len(both) else (both, weight)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(counts)], ["pair", "n"]
            )

        for batch in slices(batches):
            values = batch[0].to_pylist()
            for start, end in _chunks(values):
                c = coded(values[start:end])
                waiting.append(pair_keys(c.hashes[c.contexts], c.hashes[c.codes]))
                if sum(map(len, waiting)) >= HELD_PAIRS:
                    keys, counts = merge()
                    if len(keys) >= HELD_PAIRS:
                        yield rows()
                        keys, counts = keys[:0], counts[:0]
        keys, counts = merge()
        if len(keys):
            yield rows()

    counted = texts.select(text).mapInArrow(count, "pair bigint, n bigint")
    return counted.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _level(n: Column, least: float) -> Column:
    steps = F.log(F.greatest(n, F.lit(least)) / F.lit(least)) / F.lit(math.log(BASE))
    return (F.floor(steps + F.lit(1e-9)) + 1).cast("int")


@dataclass
class Model:
    """The filter and what is needed besides it to turn its levels into probabilities."""

    filter: Filter | None
    tokens: int
    distinct: int
    texts: int
    least_pair: int
    least_word: int

    def log10(self, c: Coded) -> np.ndarray:
        """log10 of each token's probability after the one before it."""
        words = self.filter.levels(entry_keys(KIND_WORD, c.hashes))
        masses = self.filter.levels(entry_keys(KIND_MASS, context_keys(c.hashes)))
        # Pairs after a context of which none is kept need no probe.
        ask = np.flatnonzero(masses[c.contexts])
        keys = pair_keys(c.hashes[c.contexts[ask]], c.hashes[c.codes[ask]])
        keys, which = np.unique(keys, return_inverse=True)
        pairs = np.zeros(len(c.codes), dtype=np.int64)
        pairs[ask] = self.filter.levels(entry_keys(KIND_PAIR, keys))[which]
        return self.log10_of(c.contexts, c.codes, words, masses, pairs)

    def log10_of(
        self,
        contexts: np.ndarray,
        codes: np.ndarray,
        words: np.ndarray,
        masses: np.ndarray,
        pairs: np.ndarray,
    ) -> np.ndarray:
        """The same from the levels of words and masses, by code, and those of the pairs.

        Counts of pairs, discounted, over the count of the context; what the discount
        and the pairs not kept leave of a context is shared by the words' own
        probabilities, add-one smoothed. Counts are what the filter's levels stand for.
        """
        every = np.arange(256)
        words = count_of(every, self.least_word)[words]
        own = (words + 1) / (self.tokens + self.distinct + 1)
        seen = words.copy()
        seen[1] = self.texts
        mass = count_of(every, 1.0)[masses] * (1 - DISCOUNT)
        # A context's count is at least what its kept pairs add up to.
        seen = np.maximum(seen, mass)
        left = np.clip(1 - mass / np.maximum(seen, 1), LEAST_LEFT, 1)
        left[mass == 0] = 1
        counts = np.maximum(count_of(every, self.least_pair) - DISCOUNT, 0)[pairs]
        known = counts / np.maximum(seen, 1)[contexts]
        rest = left[contexts]
        return np.log10(np.minimum(np.minimum(known, 1 - rest) + rest * own[codes], 1))


def train(
    texts: DataFrame, words: DataFrame, text: str, most_blocks: int | None = None
) -> Model:
    """The model of the texts, whose word counts (word, n) are given, with its whole filter."""
    filled, blocks, numbers = filter_blocks(texts, words, text, most_blocks)
    return Model(Filter(blocks, filter_bits(filled, blocks)), *numbers)


def filter_bits(filled: DataFrame, blocks: int) -> np.ndarray:
    """The bits of all blocks, on the driver."""
    bits = np.zeros(blocks * (BLOCK_BITS // 8), dtype=np.uint8)
    for row in filled.toLocalIterator():
        start = row.block * (BLOCK_BITS // 8)
        bits[start : start + BLOCK_BITS // 8] = np.frombuffer(row.bits, dtype=np.uint8)
    return bits


def filter_blocks(
    texts: DataFrame, words: DataFrame, text: str, most_blocks: int | None = None
) -> tuple[DataFrame, int, tuple[int, int, int, int, int]]:
    """The filter's blocks as rows (block, bits), their number, and the model's numbers.

    Pairs are counted over all texts; those seen less than ``MIN_PAIR`` times are not
    kept. The filter is as large as its entries ask for at ``PROBES`` probes and grows
    with the texts. Only where ``most_blocks`` is given, the least count kept, of pairs
    and then of words, is raised to the first at which they fit. All numbers come from
    the whole table, and words left out keep their add-one share.
    """
    spark = texts.sparkSession
    totals = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    of_end = words.where(F.col("word") == END.decode()).first()
    tokens, distinct = totals[0] or 0, totals[1]
    pairs = written(pair_counts(texts, text, MIN_PAIR), "pairs")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [xxhash.xxh64_intdigest(word) for word in batch["word"].cast("binary").to_pylist()]
            keys = pa.array(np.array(keys, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([keys, batch["n"]], ["word", "n"])

    keyed = words.select("word", "n").mapInArrow(hashed, "word bigint, n bigint")
    keyed = written(keyed, "word-keys")

    # How many levels there are to put in, by the doubling of the count: few numbers.
    def spread(frame: DataFrame, least: int) -> dict[int, int]:
        doubling = F.floor(F.log2(F.col("n") / least) + 1e-9).cast("int")
        rows = frame.groupBy(doubling.alias("d")).agg(F.sum(_level(F.col("n"), least)).alias("e"))
        return dict(rows.collect())

    def entries(by_doubling: dict[int, int], cut: int) -> int:
        lost = 2 * cut
        return sum(e * (2 * d - lost + 2) // (2 * d + 2) for d, e in by_doubling.items() if d >= cut)

    room = math.inf if most_blocks is None else int(most_blocks * BLOCK_BITS * math.log(2) / PROBES)
    of_pairs, of_words = spread(pairs, MIN_PAIR), spread(keyed, 1)
    cut_pairs = cut_words = 0
    # Masses are kept for contexts, no more than there are pairs or words.
    while True:
        masses = min(entries(of_pairs, cut_pairs), entries(of_words, 0)) if most_blocks else 0
        needed = entries(of_pairs, cut_pairs) + entries(of_words, cut_words) + masses
        if needed <= room or (not of_pairs and not of_words) or max(cut_pairs, cut_words) > 62:
            break
        if entries(of_pairs, cut_pairs) + masses >= entries(of_words, cut_words):
            cut_pairs += 1
        else:
            cut_words += 1
    least_pair, least_word = MIN_PAIR << cut_pairs, 1 << cut_words

    pairs = pairs.where(F.col("n") >= least_pair)
    # In units of what the discount leaves of one: whole numbers.
    masses = pairs.groupBy(F.shiftrightunsigned("pair", WORD_BITS).alias("key")).agg(
        F.sum((F.col("n") - DISCOUNT) / (1 - DISCOUNT)).alias("n")
    )
    masses = written(masses, "masses")
    needed = entries(of_pairs, cut_pairs) + entries(of_words, cut_words)
    needed += entries(spread(masses, 1), 0)
    blocks = max(1, -(-int(needed * PROBES / math.log(2)) // BLOCK_BITS))
    blocks = blocks if most_blocks is None else min(most_blocks, blocks)

    every = (
        pairs.select(
            F.lit(KIND_PAIR).alias("kind"),
            F.col("pair").alias("key"),
            _level(F.col("n"), least_pair).alias("level"),
        )
        .unionAll(masses.select(F.lit(KIND_MASS), "key", _level(F.col("n"), 1)))
        .unionAll(
            keyed.where(F.col("n") >= least_word).select(
                F.lit(KIND_WORD), "word", _level(F.col("n"), least_word)
            )
        )
    )

    def keyed_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch["kind"].to_numpy()
            raw = batch["key"].to_numpy().view(np.uint64)
            keys = np.empty(len(raw), dtype=np.uint64)
            for kind in np.unique(kinds):
                keys[kinds == kind] = entry_keys(int(kind), raw[kinds == kind])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block_of(keys, blocks).astype(np.int32)),
                    pa.array(keys.view(np.int64)),
                    batch["level"],
                ],
                ["block", "key", "level"],
            )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch["block"].to_numpy()
            keys = batch["key"].to_numpy().view(np.uint64)
            levels = batch["level"].to_numpy().astype(np.int64)
            for block in np.unique(place).tolist():
                bits = held.setdefault(block, np.zeros(BLOCK_BITS // 8, dtype=np.uint8))
                here = place == block
                set_bits(bits, keys[here], levels[here])
        for block, bits in held.items():
            place = pa.array([block], type=pa.int32())
            yield pa.RecordBatch.from_pydict({"block": place, "bits": [bits.tobytes()]})

    parts = max(4 * spark.sparkContext.defaultParallelism, blocks // SHARD_BLOCKS)
    filled = written(
        every.mapInArrow(keyed_entries, "block int, key bigint, level int")
        .repartition(min(blocks, parts, MOST_PARTITIONS), "block")
        .mapInArrow(fill, "block int, bits binary"),
        "filter",
    )
    numbers = (tokens, distinct, of_end.n if of_end else 0, least_pair, least_word)
    return filled, blocks, numbers


def in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows together whose texts are of bounded length; a longer text is a chunk of its own."""
    held, size = [], 0
    for batch in slices(batches):
        start = 0
        for end, length in enumerate(pc.utf8_length(batch["text"]).to_pylist()):
            if size and size + length + 1 > CHUNK_CHARS:
                if end > start:
                    held.append(batch.slice(start, end - start))
                yield joined(held)
                held, size, start = [], 0, end
            size += length + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield joined(held)


def coded_chunks(rows: DataFrame) -> DataFrame:
    """Rows (id, held_out, text) as chunks, one row each, whose texts are tokens.

    tokens counts all, taught and texts the tokens and texts that teach.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_chunks(batches):
            words, codes, lengths = tokenized(batch["text"].to_pylist())
            learned = ~batch["held_out"].to_numpy(zero_copy_only=False)
            edges = pa.array([0, len(lengths)], type=pa.int32())
            yield pa.RecordBatch.from_pydict(
                {
                    "tokens": [len(codes)],
                    "taught": [int(lengths[learned].sum())],
                    "texts": [int(learned.sum())],
                    "ids": pa.ListArray.from_arrays(edges, batch["id"]),
                    "held_out": pa.ListArray.from_arrays(edges, batch["held_out"]),
                    "lengths": pa.ListArray.from_arrays(edges, pa.array(lengths)),
                    "words": [zstandard.compress(b" ".join(words[2:]))],
                    "codes": [zstandard.compress(planes(codes))],
                }
            )

    chunks = rows.mapInArrow(
        code,
        f"tokens bigint, taught bigint, texts bigint, ids array<{kind}>, "
        "held_out array<boolean>, lengths array<bigint>, words binary, codes binary",
    )
    return chunks.withColumn("chunk", F.monotonically_increasing_id())


def unpacked(batch: pa.RecordBatch, row: int) -> tuple[Coded, np.ndarray]:
    """The tokens of a chunk, and which texts are held out."""
    words = [END, START, *zstandard.decompress(batch["words"][row].as_py()).split()]
    codes = from_planes(zstandard.decompress(batch["codes"][row].as_py()))
    lengths = batch["lengths"][row].values.to_numpy()
    held_out = batch["held_out"][row].values.to_numpy(zero_copy_only=False)
    return Coded(words, hashes_of(words), codes, contexts_of(codes, lengths), lengths), held_out


@dataclass
class Split:
    """Contexts too frequent for one shard: sorted hashes, and the shards each is dealt to."""

    hashes: np.ndarray
    pieces: np.ndarray

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash is among those split, -1 for all others."""
        place = np.searchsorted(self.hashes, hashes)
        found = place < len(self.hashes)
        found[found] = self.hashes[place[found]] == hashes[found]
        return np.where(found, place, -1)


def split_contexts(chunks: DataFrame, tokens: int, most: int) -> Split:
    """The contexts of more than a quarter of a shard's tokens, ``most`` at most.

    Such a context has at least half that share of some chunk's tokens; the chunks where
    it has less make up half of its count at most. So few counts are sent and none is missed.
    """
    limit = SHARD_TOKENS // 4
    if tokens <= limit:
        return Split(np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words = [END, START, *zstandard.decompress(batch["words"][row].as_py()).split()]
                codes = from_planes(zstandard.decompress(batch["codes"][row].as_py()))
                counts = np.bincount(codes, minlength=len(words))
                # Every token but the last is a context; a first one's is the start.
                counts[:2] = 0, len(batch["lengths"][row])
                frequent = np.flatnonzero(counts * 2 * (tokens / limit) >= len(codes))
                hashes = hashes_of(words[code] for code in frequent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(counts[frequent])], ["hash", "n"]
                )

    counted = chunks.select("words", "codes", "lengths").mapInArrow(often, "hash bigint, n bigint")
    counted = counted.groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= limit // 2)
    found = counted.orderBy(F.desc("n"), "hash").limit(most).collect()
    hashes = np.array([row.hash for row in found], dtype=np.int64).view(np.uint64)
    pieces = np.array([-(-row.n // (limit // 2)) for row in found], dtype=np.int64)
    order = np.argsort(hashes)
    return Split(hashes[order], pieces[order])


@dataclass
class Dealt:
    """A chunk's words and distinct pairs, by the shards that count them.

    Entries are shard * (number of words) + code, sorted; ``home`` is the entry of each
    word. ``pairs`` are context * (number of words) + code in the order in which they
    are sent, by entry; ``follow`` is their number in each, ``which`` that of each token.
    """

    entries: np.ndarray
    home: np.ndarray
    pairs: np.ndarray
    follow: np.ndarray
    which: np.ndarray

    def edges(self, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The shards asked, and where their entries and their pairs begin."""
        shards, first = np.unique(self.entries // words, return_index=True)
        before = np.concatenate(([0], np.cumsum(self.follow)))
        return shards, first, before[first]


def dealt(c: Coded, shards: int, split: Split) -> Dealt:
    """A context's pairs go with it to the shard of its hash; those of a split one to several."""
    size = len(c.words)
    pairs, which = np.unique(c.contexts * size + c.codes, return_inverse=True)
    contexts = pairs // size
    home = (c.hashes >> np.uint64(32)).astype(np.int64) % shards
    to = home[contexts]
    place = split.places(c.hashes)
    spread = np.flatnonzero(place[contexts] >= 0)
    piece = mix(c.hashes[pairs[spread] % size]) >> np.uint64(32)
    piece = piece.astype(np.int64) % split.pieces[place[contexts[spread]]]
    to[spread] = (to[spread] + piece) % shards
    own = home * size + np.arange(size)
    asked = to * size + contexts
    entries = np.union1d(own, asked[spread])
    entry = np.searchsorted(entries, asked)
    order = np.argsort(entry, kind="stable")
    at = np.empty_like(order)
    at[order] = np.arange(len(order))
    follow = np.bincount(entry, minlength=len(entries))
    return Dealt(entries, np.searchsorted(entries, own), pairs[order], follow, at[which])


def counted_in_shards(chunks: DataFrame, shards: int, split: Split) -> DataFrame:
    """What each chunk is to know of its words and pairs: exact counts and filter levels.

    A chunk's distinct words and pairs go to shards once, with how often they teach. A
    shard adds them up over all chunks, puts the sums into its part of the filter, probes
    it for all that it was sent and answers each chunk. All of a context is in one shard;
    only of split contexts, the masses come back as sums (split, n) to be added up. Rows
    with neither chunk nor split have the shards' distinct words as n.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield questions(batch, row)

    def questions(batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
        c, held_out = unpacked(batch, row)
        d = dealt(c, shards, split)
        size = len(c.words)
        learned = np.repeat(~held_out, c.lengths)
        codes = d.entries % size
        counts = np.zeros(len(codes), dtype=np.int64)
        counts[d.home] = np.bincount(c.codes[learned], minlength=size)
        taught = np.bincount(d.which[learned], minlength=len(d.pairs))
        words = (c.hashes[d.pairs % size] & np.uint64((1 << WORD_BITS) - 1)).astype(np.uint32)
        names = np.array([END_NAME, START_NAME, *c.words[2:]], dtype=object)[codes]
        asked, first, before = d.edges(size)
        sent: dict[str, list] = {name: [] for name in ("names", "counts", "follow", "pairs", "taught")}
        for a, b, p, q in zip(first, [*first[1:], len(codes)], before, [*before[1:], len(words)]):
            sent["names"].append(b" ".join(names[a:b]))
            sent["counts"].append(planes(counts[a:b]))
            sent["follow"].append(planes(d.follow[a:b]))
            sent["pairs"].append(words[p:q].tobytes())
            sent["taught"].append(planes(taught[p:q]))
        return pa.RecordBatch.from_pydict(
            {
                "shard": pa.array(asked.astype(np.int32)),
                "chunk": pa.array([batch["chunk"][row].as_py()] * len(asked), type=pa.int64()),
                **{name: pa.array(data, type=pa.binary()) for name, data in sent.items()},
            }
        )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, "shard"):
            yield answers(batch)

    def answers(batch: pa.RecordBatch) -> pa.RecordBatch:
        def numbers(name: str) -> list[np.ndarray]:
            return [from_planes(data) for data in batch[name].to_pylist()]

        parts = numbers("follow")
        edges = np.cumsum([len(part) for part in parts])
        follow = np.concatenate(parts)
        pair_edges = np.cumsum([int(part.sum()) for part in parts])
        names = [name for data in batch["names"].to_pylist() for name in data.split()]
        named = pa.array(names, type=pa.binary()).dictionary_encode()
        del names
        marks = {END_NAME: END, START_NAME: START}
        code = named.indices.to_numpy()
        hashes = hashes_of(marks.get(name, name) for name in named.dictionary.to_pylist())
        counts = np.zeros(len(hashes), dtype=np.int64)
        np.add.at(counts, code, np.concatenate(numbers("counts")))
        words = np.frombuffer(b"".join(batch["pairs"].to_pylist()), dtype=np.uint32)
        keys = pair_keys(np.repeat(hashes[code], follow), words.astype(np.uint64))
        pairs, which = np.unique(keys, return_inverse=True)
        taught = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(taught, which, np.concatenate(numbers("taught")))

        kept, known = taught > 0, counts > 0
        # In units of what the discount leaves of one: whole numbers.
        contexts, of_pair = np.unique(context_keys(pairs[kept]), return_inverse=True)
        left = (taught[kept] - DISCOUNT) / (1 - DISCOUNT)
        masses = np.bincount(of_pair, weights=left, minlength=len(contexts))
        held = filter_of(
            np.concatenate(
                [
                    entry_keys(KIND_WORD, hashes[known]),
                    entry_keys(KIND_MASS, contexts),
                    entry_keys(KIND_PAIR, pairs[kept]),
                ]
            ),
            np.concatenate([levels_of(n, 1) for n in (counts[known], masses, taught[kept])]),
        )
        of_words = held.levels(entry_keys(KIND_WORD, hashes)).astype(np.uint8)[code]
        of_masses = held.levels(entry_keys(KIND_MASS, context_keys(hashes))).astype(np.uint8)[code]
        of_pairs = held.levels(entry_keys(KIND_PAIR, pairs)).astype(np.uint8)[which]
        counts = counts[code]
        given, levels = [], []
        for a, b, p, q in zip([0, *edges[:-1]], edges, [0, *pair_edges[:-1]], pair_edges):
            given.append(zstandard.compress(planes(counts[a:b], 8)))
            found = (of_words[a:b], of_masses[a:b], of_pairs[p:q])
            levels.append(zstandard.compress(np.concatenate(found).tobytes()))
        # Sums: of distinct words, and of the masses of split contexts.
        here = hashes[split.places(hashes) >= 0]
        here = here[np.isin(context_keys(here), contexts)]
        at = np.searchsorted(contexts, context_keys(here))
        sums = [float(known.sum()), *masses[at].tolist()]
        more = len(sums)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(batch["chunk"].to_pylist() + [None] * more, type=pa.int64()),
                pa.array(batch["shard"].to_pylist() + [None] * more, type=pa.int32()),
                pa.array(given + [None] * more, type=pa.binary()),
                pa.array(levels + [None] * more, type=pa.binary()),
                pa.array([None] * (len(given) + 1) + here.view(np.int64).tolist(), type=pa.int64()),
                pa.array([None] * len(given) + sums, type=pa.float64()),
            ],
            ["chunk", "shard", "counts", "levels", "split", "n"],
        )

    asked = chunks.select("chunk", "held_out", "lengths", "words", "codes").mapInArrow(
        deal,
        "shard int, chunk bigint, names binary, counts binary, follow binary, pairs binary, "
        "taught binary",
    )
    # A shard is a task, so tasks are alike: hashes of so few numbers would fall together.
    return (
        asked.repartitionById(min(shards, MOST_PARTITIONS), "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(
            answer,
            "chunk bigint, shard int, counts binary, levels binary, split bigint, n double",
        )
    )


def scored(
    documents: DataFrame,
    training: Column,
    key: str = "doc_id",
    text: str = "text",
    broadcast_blocks: int = BROADCAST_BLOCKS,
    frequent_words: int = FREQUENT,
) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Rows for which ``training`` holds teach the model, all are scored whole. Texts are
    tokenized once, to chunks in scratch. Their distinct words and pairs are shuffled once,
    to shards that count them, hold the filter in parts as large as their entries ask for
    and send levels and counts back (``counted_in_shards``). The number of shards grows
    with the tokens. Contexts too frequent for one shard are dealt to several, at most the
    ``frequent_words`` most frequent ones, whose list is broadcast. ``base_score``, the
    add-one score of single words, is exact. No filter is broadcast at any size:
    ``broadcast_blocks`` is accepted from callers and changes nothing.

    NULL and empty texts are one end token. A NULL key keeps its row; where that makes
    ``training`` NULL the row teaches nothing and counts as held out. Repeated rows
    count and are scored each. Without training rows every probability is 1. An empty
    table gives no rows. Further columns are not read.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (~F.coalesce(training, F.lit(False))).alias("held_out"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    chunks = written(coded_chunks(rows), "chunks")
    sums = (F.coalesce(F.sum(name), F.lit(0)) for name in ("tokens", "taught", "texts"))
    every, tokens, texts, number = chunks.agg(*sums, F.count(F.lit(1))).first()
    shards = max(LEAST_SHARDS, -(-every // SHARD_TOKENS))
    split = split_contexts(chunks, every, frequent_words)
    given = written(counted_in_shards(chunks, shards, split), "levels")
    found = given.where("chunk IS NULL").groupBy("split").agg(F.sum("n").alias("n")).collect()
    sums = {row.split: row.n for row in found}
    distinct = int(sums.pop(None, 0))
    masses = np.array([sums.get(h, 0.0) for h in split.hashes.view(np.int64).tolist()])
    masses = np.where(masses > 0, levels_of(masses, 1), 0)
    total = float(np.log10(tokens + distinct + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(None, tokens, distinct, texts, 1, 1)
        for batch in groups(batches, "chunk"):
            yield results(batch, model)

    def results(batch: pa.RecordBatch, model: Model) -> pa.RecordBatch:
        last = batch.num_rows - 1
        c, held_out = unpacked(batch, last)
        d = dealt(c, shards, split)
        counts, of_words, of_masses, of_pairs = [], [], [], []
        for row in range(last):
            counts.append(from_planes(zstandard.decompress(batch["counts"][row].as_py()), 8))
            levels = zstandard.decompress(batch["levels"][row].as_py())
            size = len(counts[-1])
            cut = np.split(np.frombuffer(levels, dtype=np.uint8), [size, 2 * size])
            for held, part in zip((of_words, of_masses, of_pairs), cut):
                held.append(part)
        counts, of_words, of_masses = (np.concatenate(x) for x in (counts, of_words, of_masses))
        of_pairs = np.concatenate(of_pairs)
        if len(counts) != len(d.entries) or len(of_pairs) != len(d.pairs):
            raise ValueError("a chunk's answers are not those to its questions")
        counts, of_words, of_masses = counts[d.home], of_words[d.home], of_masses[d.home]
        place = split.places(c.hashes)
        of_masses = of_masses.astype(np.int64)
        of_masses[place >= 0] = masses[place[place >= 0]]
        logs = model.log10_of(c.contexts, c.codes, of_words, of_masses, of_pairs[d.which])
        edges = np.cumsum(c.lengths) - c.lengths
        base = np.add.reduceat(np.log10(counts + 1.0)[c.codes], edges) - c.lengths * total
        known = np.add.reduceat((counts > 0).astype(np.int64)[c.codes], edges)
        return pa.RecordBatch.from_pydict(
            {
                key: batch["ids"][last].values,
                "held_out": pa.array(held_out),
                "n_tokens": pa.array(c.lengths),
                "n_known": pa.array(known),
                "train_tokens": pa.array([tokens] * len(known), type=pa.int64()),
                "base_score": pa.array(base),
                "score": pa.array(np.add.reduceat(logs, edges)),
            }
        )

    asked = ["ids", "held_out", "lengths", "words", "codes"]
    answers = given.where("chunk IS NOT NULL").select(
        "chunk",
        F.col("shard"),
        "counts",
        "levels",
        *(F.lit(None).cast(chunks.schema[name].dataType).alias(name) for name in asked),
    )
    asking = chunks.select("chunk", F.lit(None), F.lit(None), F.lit(None), *asked)
    # A chunk comes after the answers to it. Chunks are of one size, but for long texts.
    together, parts = answers.unionAll(asking), min(number // CHUNKS_A_TASK, MOST_PARTITIONS)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        together = together.repartition(parts, "chunk")
    else:
        together = together.repartition("chunk")
    return together.sortWithinPartitions("chunk", F.col("shard").asc_nulls_last()).mapInArrow(
        score,
        f"`{key}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double",
    )
