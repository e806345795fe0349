"""Packing token sequences by lexical retrieval: neighbours of a seed fill its window."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwell.llm.groups import slices
from shiftwell.llm.tables import written
from shiftwell.llm.workers import kept

WINDOW = 4096
END_ID = 2
SHARD_DOCUMENTS = 1 << 16
SHARD_TOKENS = 1 << 23
PARTITION_TOKENS = 1 << 22
MOST_PARTITIONS = 50_000
K1 = 1.2
B = 0.75
WORKER_ENTRIES = 400_000
# So many characters, of so many texts, are split into words at once.
BATCH_CHARS = 1 << 23
TEXTS = 1 << 12

# Letters that have one form and one small letter each, then signs that end the word
# for the tokenizer; an apostrophe may begin an ending and is not among them.
WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@[-`{-~]*)")
# Texts of these signs alone have the same normal form when they are made small first.
SIMPLE = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
# Where letters end and signs begin, as in WORD.
WORD_END = "([A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\\[-`{-~])"
# Fixed value: how special tokens begin; the tokenizer finds them anywhere in a text.
SPECIAL = "<|"


class ChunkIds(dict):
    """Ids of the parts of texts between spaces, as bytes; unknown ones are encoded.

    The tokenizer drops white space and no token reaches over it, so a text's ids are
    those of its parts in turn. Nor does one reach from letters to signs. Ids fit two
    bytes.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # How the tokenizer writes the bytes of the letters that WORD knows.
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        latin = (chr(code) for code in range(0xDF, 0x100))
        self.written = {ord(c): level.pre_tokenize_str(c)[0][0] for c in latin}
        self[""] = b""

    def encode(self, chunk: str, is_word: bool) -> bytes:
        if not is_word:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        else:
            # The chunk is its own normal form and one word: only merges are left.
            letters = chunk if chunk.isascii() else chunk.translate(self.written)
            ids = [token.id for token in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}H", *ids)

    def __missing__(self, chunk: str) -> bytes:
        parts = WORD.fullmatch(chunk)
        if parts is not None and (parts[2] or not parts[1].islower()):
            # Not kept: its parts are.
            return self[parts[1].lower()] + self[parts[2]]
        ids = self.encode(chunk, parts is not None)
        if len(self) >= WORKER_ENTRIES:
            self.clear()
            self[""] = b""
        self[chunk] = ids
        return ids


def text_ids(text: str, chunks: ChunkIds) -> bytes:
    """The ids of a whole text, two bytes each."""
    return texts_ids([text], chunks)[0]


def texts_ids(texts: list[str], chunks: ChunkIds) -> list[bytes]:
    """The ids of whole texts; each distinct word of all of them is looked up once."""
    found: list[bytes] = []
    start = size = 0
    for end, text in enumerate(texts):
        if size and size + len(text) > BATCH_CHARS:
            found += _looked_up(texts[start:end], chunks)
            start, size = end, 0
        size += len(text)
    return found + _looked_up(texts[start:], chunks)


def _looked_up(texts: list[str], chunks: ChunkIds) -> list[bytes]:
    plain = []
    for text in texts:
        text = "" if SPECIAL in text else text
        plain.append((text.lower() if SIMPLE.fullmatch(text) else text).replace("\n", " "))
    apart = pc.replace_substring_regex(pa.array(plain, type=pa.string()), WORD_END, r"\1 \2")
    split = pc.split_pattern(apart, " ")
    words = split.flatten().dictionary_encode()
    ids = pa.array([chunks[word] for word in words.dictionary.to_pylist()], type=pa.binary())
    # The words' ids lie one after another, so a text's are one range of the bytes.
    in_turn = ids.take(words.indices)
    edges = np.frombuffer(in_turn.buffers()[1], dtype=np.int32)[split.offsets.to_numpy()].tolist()
    data = in_turn.buffers()[2]
    data = b"" if data is None else data.to_pybytes()
    found = [data[start:end] for start, end in zip(edges, edges[1:])]
    for place, text in enumerate(texts):
        if SPECIAL in text:
            whole = chunks.tokenizer.encode(text, add_special_tokens=False).ids
            found[place] = np.array(whole, dtype="<u2").tobytes()
    return found


def tokenized(
    documents: DataFrame, path: str, end_id: int = END_ID, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, ``ids`` and ``lexical``: each text's ids, two bytes each, and the end id."""
    end = np.array([end_id], dtype="<u2").tobytes()
    kind = documents.schema[key].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = kept(("chunk ids", path), lambda: ChunkIds(path))
        for rows in slices(batches, TEXTS):
            ids = [one + end for one in texts_ids(rows["text"].to_pylist(), chunks)]
            lexical = pa.array([lexical_key(one) for one in ids], type=pa.int64())
            columns = [rows["key"], pa.array(ids, type=pa.binary()), lexical]
            yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "lexical"])

    whole = F.coalesce(F.col(text), F.lit("")).alias("text")
    rows = documents.select(F.col(key).alias("key"), whole)
    rows = rows.mapInArrow(encode, f"key {kind}, ids binary, lexical bigint")
    return rows.withColumnRenamed("key", key)


class Bm25:
    """An inverted index over the documents of one shard, terms being token ids."""

    def __init__(self, documents: list[np.ndarray]) -> None:
        lengths = np.array([len(ids) for ids in documents])
        owner = np.repeat(np.arange(len(documents), dtype=np.uint32), lengths)
        pairs = np.sort(owner << np.uint32(16) | np.concatenate(documents))
        first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
        counts = np.diff(np.append(first, len(pairs)))
        pairs = pairs[first].astype(np.int64)
        terms, owner = pairs & 0xFFFF, pairs >> 16
        # Forward: a document's distinct terms lie together.
        self.forward = np.searchsorted(owner, np.arange(len(documents) + 1))
        self.terms = terms
        order = np.argsort(terms, kind="stable")
        self.posted = owner[order]
        held, starts, found = np.unique(terms[order], return_index=True, return_counts=True)
        self.start = np.zeros(1 << 16, dtype=np.int64)
        self.found = np.zeros(1 << 16, dtype=np.int64)
        self.start[held], self.found[held] = starts, found
        n = len(documents)
        idf = np.log1p((n - self.found + 0.5) / (self.found + 0.5))
        frequency = counts[order].astype(np.float64)
        norm = K1 * (1 - B + B * lengths[self.posted] / max(lengths.mean(), 1))
        self.weight = idf[terms[order]] * frequency * (K1 + 1) / (frequency + norm)
        self.idf = idf
        self.n = n
        self.posted_terms = terms[order]

    def forget(self, gone: np.ndarray) -> None:
        """Leave documents out of later answers; weights of the others stay."""
        stay = ~gone[self.posted]
        self.posted, self.weight = self.posted[stay], self.weight[stay]
        self.posted_terms = self.posted_terms[stay]
        self.found = np.bincount(self.posted_terms, minlength=1 << 16)
        self.start = np.cumsum(self.found) - self.found

    def neighbours(self, document: int) -> np.ndarray:
        """Documents that share a term with one, best first, ties by place.

        The query is all of the document's terms that others have too.
        """
        terms = self.terms[self.forward[document] : self.forward[document + 1]]
        terms = terms[self.found[terms] > 0]
        starts, ends = self.start[terms], self.start[terms] + self.found[terms]
        spans = [slice(*span) for span in zip(starts.tolist(), ends.tolist())]
        if not spans:
            return np.empty(0, dtype=np.int64)
        scores = np.bincount(
            np.concatenate([self.posted[span] for span in spans]),
            np.concatenate([self.weight[span] for span in spans]),
            self.n,
        )
        scores[document] = 0
        hit = np.nonzero(scores)[0]
        return hit[np.lexsort((hit, -scores[hit]))]


def pack_order(documents: list[np.ndarray], room: int, window: int = WINDOW) -> list[int]:
    """The order in which a shard's documents fill windows, ``room`` being left in the first.

    The first unused document is a seed. Its unused neighbours follow it, best first,
    until the window is full; the one that crosses its end goes on in the next window
    and is the seed there. Where neighbours run out the next unused document is a seed.
    """
    index = Bm25(documents)
    used = np.zeros(len(documents), dtype=bool)
    order: list[int] = []
    first_unused = forgotten = 0
    seed = None

    def take(document: int) -> bool:
        """Put a document in; whether it ends the window."""
        nonlocal room
        used[document] = True
        order.append(document)
        room -= len(documents[document])
        return room <= 0

    def carried(document: int) -> int | None:
        """Open the next window; the document, if it goes on there."""
        nonlocal room
        over = -room % window
        room = window - over
        return document if over else None

    while len(order) < len(documents):
        if seed is None:
            while used[first_unused]:
                first_unused += 1
            seed = first_unused
            if take(seed):
                seed = carried(seed)
                continue
        # Used documents are no neighbours; they go when they are a fifth of the index.
        if 5 * (len(order) - forgotten) > len(documents) - forgotten:
            index.forget(used)
            forgotten = len(order)
        following = None
        for near in index.neighbours(seed).tolist():
            if not used[near] and take(near):
                following = carried(near)
                break
        seed = following
    return order


PIECE_FIELDS = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def packed(
    documents: DataFrame,
    path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of ``window`` tokens, a row per piece.

    Columns: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids. A
    document is the ids of the tokenizer at ``path``, which every executor can read,
    and the end id. Sequences are full but for the last of each partition.

    Documents are sorted by a lexical key, the smallest hash of their token pairs, so
    that those with common passages lie together, and dealt by ranges of it into
    partitions of about ``PARTITION_TOKENS`` tokens; equal keys are parted by a hash
    of the row, so a large group of copies is spread over as many partitions as it
    fills. A partition has one BM25 index, more only where it holds over ``SHARD_TOKENS``
    tokens or ``SHARD_DOCUMENTS`` documents, from which a seed's unused neighbours by
    all of its terms fill the window. Neighbours in other partitions are not found.
    Nothing is left out: documents longer than a window go on in the next.

    A NULL or empty text is the end id alone. NULL keys and repeated rows are packed
    like others. An empty table gives no rows. Further columns are not read.
    """
    spark = documents.sparkSession
    kind = documents.schema[key].dataType.simpleString()
    rows = written(tokenized(documents, path, end_id, key, text), "token-ids")
    tokens = rows.agg(F.sum(F.expr("length(ids) div 2")).alias("tokens")).first().tokens or 0
    parts = min(max(1, -(-tokens // PARTITION_TOKENS)), MOST_PARTITIONS)
    turn = F.xxhash64(key, "ids")
    dealt = (
        rows.withColumn("turn", turn)
        .repartitionByRange(parts, "lexical", "turn")
        .sortWithinPartitions("lexical", "turn", key)
    )

    fields = [key, *(field.split()[0] for field in PIECE_FIELDS.split(", ")), "ids"]
    key_type = pa.int64() if kind == "bigint" else None

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        for batch in slices(batches):
            for rows in packer.add(batch[key].to_pylist(), batch["ids"].to_pylist()):
                yield as_batch(rows)
        for rows in packer.finish():
            yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        keys, *rest = zip(*rows)
        arrays = [pa.array(keys, type=key_type), *map(pa.array, rest)]
        return pa.RecordBatch.from_arrays(arrays, fields)

    schema = f"`{key}` {kind}, {PIECE_FIELDS}, ids binary"
    return dealt.select(key, "ids").mapInArrow(pieces, schema)


def lexical_key(ids: bytes) -> int:
    """The smallest hash of the pairs of neighbouring ids; of one id alone, its hash."""
    tokens = np.frombuffer(ids, dtype="<u2").astype(np.uint32)
    pairs = tokens if len(tokens) < 2 else tokens[:-1] << np.uint32(16) | tokens[1:]
    mixed = pairs * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    return int((mixed * np.uint32(0x85EBCA77)).min())


class Packer:
    """Packs documents as they come, a shard at a time, into windows one after another."""

    def __init__(self, window: int, first_sequence: int) -> None:
        self.window = window
        self.sequence = first_sequence
        self.offset = 0
        self.keys: list = []
        self.ids: list[bytes] = []
        self.tokens = 0

    def add(self, keys: list, ids: list[bytes]) -> Iterator[list[tuple]]:
        for key, one in zip(keys, ids):
            self.keys.append(key)
            self.ids.append(one)
            self.tokens += len(one) // 2
            if len(self.ids) >= SHARD_DOCUMENTS or self.tokens >= SHARD_TOKENS:
                yield from self.finish()

    def finish(self) -> Iterator[list[tuple]]:
        if not self.ids:
            return
        documents = [np.frombuffer(one, dtype="<u2") for one in self.ids]
        pieces = []
        for place in pack_order(documents, self.window - self.offset, self.window):
            whole, start = documents[place], 0
            while start < len(whole):
                length = min(self.window - self.offset, len(whole) - start)
                part = whole[start : start + length]
                crc = zlib.crc32(part.astype("<u4").tobytes())
                where = (self.sequence, self.offset)
                pieces.append(
                    (self.keys[place], start, length, crc, len(whole), *where, part.tobytes())
                )
                start += length
                self.offset += length
                if self.offset == self.window:
                    self.sequence, self.offset = self.sequence + 1, 0
        self.keys, self.ids, self.tokens = [], [], 0
        yield pieces
