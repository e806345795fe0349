import random

import public_tokenizers
import pytest
import sentencepiece

from llm_fixtures import documents  # noqa: F401
from shiftwell.llm.token_counts import UnitLengths, frequent_lengths, n_pieces, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [" ", "  ", "▁", "a", "the", "é", "\n", "\t", "<s>", "</s>", "<unk>", "<0x0A>", "　"]
ODD += ["\xa0", "你", "\x00", "İ", "ﬁ", "é", ".", "7", "😀", "Word"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_odd_texts_count_as_the_library_counts_them(library):
    draw, lengths = random.Random(3), UnitLengths(PATH)
    for _ in range(3000):
        text = "".join(draw.choice(ODD) for _ in range(draw.randint(0, 9)))
        assert n_pieces(text, {" the": lengths[" the"]}, lengths) == len(library.encode(text)), text


def test_table_is_counted_whole(documents, library):
    long = "a long text with words of all kinds, " * 5000
    rows = [(1, "one text"), (1, "one text"), (2, None), (None, "no id"), (3, ""), (4, long)]
    frame = documents(*rows).withColumnRenamed("lang", "n_tokens")
    found = token_counts(frame, PATH).collect()
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found] == [
        (key, len((text or "").encode()), n := len(library.encode(text or "")), n > 4096)
        for key, text in rows
    ]


def test_empty_table(documents):
    assert token_counts(documents(), PATH).collect() == []


def test_frequent_words_are_bounded_by_length(documents):
    lengths = frequent_lengths(documents((1, "to be or " + "x" * 99), (2, None)), PATH)
    assert set(lengths) == {" to", " be", " or"}
