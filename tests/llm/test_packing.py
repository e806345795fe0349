import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shiftwell.llm import packing
from shiftwell.llm.packing import (
    Bm25,
    ChunkIds,
    Packer,
    lexical_key,
    pack_order,
    packed,
    text_ids,
    texts_ids,
)

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [" ", "  ", "\n", "a", "The", "é", "é", "́", "\t", "'s", "'", "don't", "<|endoftext|>"]
ODD += ["<|ENDOFTEXT|>", "<|", "\x1c", "\x85", "　", "\xa0", "你", "\x00", "İ", "Σ", "ﬁ", ".", ","]
ODD += ["7", "²", "½", "_", "😀", "Word,", "end.", "É", "ß", "ÿ", "×", "A.", "x'll", "%%%", "!!"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_odd_texts_get_the_librarys_ids(library):
    draw, chunks = random.Random(5), ChunkIds(PATH)
    for _ in range(4000):
        text = "".join(draw.choice(ODD) for _ in range(draw.randint(0, 8)))
        found = np.frombuffer(text_ids(text, chunks), "<u2").tolist()
        assert found == ids_of(library, text), repr(text)


def test_cache_stays_within_its_bound(library, monkeypatch):
    monkeypatch.setattr(packing, "WORKER_ENTRIES", 20)
    chunks = ChunkIds(PATH)
    for n in range(200):
        text = f"word{n} Word{n}, ünd{n}!! over"
        assert np.frombuffer(text_ids(text, chunks), "<u2").tolist() == ids_of(library, text)
        assert len(chunks) <= 24


def check(rows, found, library, window=4096):
    """Every id of every row in exactly one piece, sequences gapless and within the window."""
    expected = sorted(
        ((key, ids_of(library, text) + [2]) for key, text in rows), key=repr
    )
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u2")
        assert len(ids) == r.length and zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.doc_tokens, ids.tolist()))
        sequences[r.sequence_id].append((r.offset, r.length))
    if len({key for key, _ in rows}) == len(rows):
        joined = [
            (key, [i for _, _, ids in sorted(parts) for i in ids]) for key, parts in pieces.items()
        ]
        assert sorted(joined, key=repr) == expected
        assert all(n == sum(len(p[2]) for p in parts) for parts in pieces.values() for _, n, _ in parts)
    assert sum(r.length for r in found) == sum(len(ids) for _, ids in expected)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return sequences


def test_table(documents, library):
    draw = random.Random(1)
    words = [f"w{n}" for n in range(400)]
    rows = [(i, " ".join(draw.choices(words, k=draw.randint(0, 400)))) for i in range(150)]
    rows += [(1000, "long " * 15_000), (1001, ""), (1002, None), (None, "no id")]
    frame = documents(*rows).withColumn("ids", F.lit(1)).withColumn("length", F.lit("x"))
    found = packed(frame, PATH).collect()
    sequences = check(rows, found, library)
    short = [s for s, parts in sequences.items() if sum(n for _, n in parts) < 4096]
    assert len(short) <= 1


def test_repeated_rows_and_empty_table(documents, library):
    rows = [(1, "same text"), (1, "same text"), (2, "same text")]
    found = packed(documents(*rows), PATH).collect()
    check(rows, found, library)
    assert [r.length for r in found] == [3, 3, 3] and len({r.sequence_id for r in found}) == 1
    assert packed(documents(), PATH).collect() == []


def test_neighbours_are_ranked_by_bm25():
    texts = [[1, 2, 3, 4], [1, 2, 9, 9], [5, 6, 7], [1, 8, 8, 8], [1, 2, 3, 9]]
    documents = [np.array(t, dtype="<u2") for t in texts]
    n, mean = len(texts), np.mean([len(t) for t in texts])

    def score(query, text):
        total = 0.0
        for term in set(query):
            f = text.count(term)
            df = sum(term in t for t in texts)
            idf = np.log1p((n - df + 0.5) / (df + 0.5))
            total += idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(text) / mean))
        return total

    scores = [score(texts[0], t) if k else 0 for k, t in enumerate(texts)]
    expected = sorted((k for k in range(n) if scores[k] > 0), key=lambda k: (-scores[k], k))
    assert Bm25(documents).neighbours(0).tolist() == expected == [4, 1, 3]


def test_window_is_filled_by_the_seeds_neighbours():
    documents = [np.array(t, dtype="<u2") for t in ([1, 2], [7, 8], [1, 2], [7, 8], [1, 9])]
    assert pack_order(documents, room=6, window=6) == [0, 2, 4, 1, 3]
    # The document that crosses the end of a window is the seed of the next.
    documents = [np.array(t, dtype="<u2") for t in ([1, 1], [5, 5], [1, 6, 6], [6, 6], [5, 4])]
    assert pack_order(documents, room=4, window=4) == [0, 2, 3, 1, 4]


@pytest.mark.parametrize("seed", range(20))
def test_packer_puts_each_id_once(seed):
    draw = random.Random(seed)
    documents = [
        np.array([draw.randint(1, 30) for _ in range(draw.choice([1, 3, 16, 40]))], "<u2").tobytes()
        for _ in range(draw.randint(1, 60))
    ]
    packer = Packer(16, 0)
    pieces = [p for batch in packer.add(list(range(len(documents))), documents) for p in batch]
    pieces += [p for batch in packer.finish() for p in batch]
    whole = defaultdict(bytes)
    for key, start, *_, ids in sorted(pieces):
        assert start == len(whole[key]) // 2
        whole[key] += ids
    assert [whole[k] for k in range(len(documents))] == documents
    lengths = defaultdict(int)
    for _, _, length, _, _, sequence, offset, _ in pieces:
        assert offset == lengths[sequence]
        lengths[sequence] += length
    assert sorted(lengths) == list(range(len(lengths)))
    assert all(lengths[s] == 16 for s in sorted(lengths)[:-1])


def test_documents_with_a_common_passage_often_share_their_key():
    draw = random.Random(2)
    same = 0
    for _ in range(200):
        passage = [draw.randint(0, 49_000) for _ in range(300)]
        a, b = (passage + [draw.randint(0, 49_000) for _ in range(60)] for _ in range(2))
        keys = {lexical_key(np.array(x, "<u2").tobytes()) for x in (a, b)}
        same += len(keys) == 1
    assert same > 100


def test_a_seed_asks_with_all_of_its_terms():
    seed = list(range(1, 200))
    # Terms 1 to 40 are the rarest; of the last document the seed shares common ones only.
    texts = [seed, list(range(1, 41)), *[list(range(100, 200))] * 3, [100]]
    found = Bm25([np.array(t, dtype="<u2") for t in texts]).neighbours(0)
    assert sorted(found.tolist()) == [1, 2, 3, 4, 5]


def test_neighbours_are_found_across_a_partition():
    passage = np.arange(1000, 1300, dtype="<u2")
    far = [np.array([n], dtype="<u2").tobytes() for n in range(2, 902)]
    ids = [passage.tobytes(), *far, passage.tobytes()]
    packer = Packer(600, 0)
    pieces = [p for batch in packer.add(list(range(len(ids))), ids) for p in batch]
    pieces += [p for batch in packer.finish() for p in batch]
    where = {key: sequence for key, _, _, _, _, sequence, _, _ in pieces}
    assert where[0] == where[len(ids) - 1]


def test_a_batch_looks_each_word_up_once():
    asked = []

    class Noted(ChunkIds):
        def __getitem__(self, chunk):
            asked.append(chunk)
            return super().__getitem__(chunk)

    library = Tokenizer.from_file(PATH)
    texts = ["One, two. Two! it's\n(one)"] * 50 + ["", "é Ñandú, one", "a <|endoftext|> b", "H\u0331 A."]
    found = [np.frombuffer(ids, "<u2").tolist() for ids in texts_ids(texts, Noted(PATH))]
    assert found == [ids_of(library, text) for text in texts]
    assert asked.count("one") == asked.count("two") == 1
    assert "two." not in asked
