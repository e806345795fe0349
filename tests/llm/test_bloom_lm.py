import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from shiftwell.llm import bloom_lm
from shiftwell.llm.bloom_lm import (
    BLOCK_BITS, Filter, block_of, coded, count_of, levels_of, pair_counts, scored, set_bits,
    train, word_counts, written,
)
from shiftwell.session import scratch_root


def test_levels_stand_for_their_counts():
    counts = np.arange(1, 5000)
    for least in (1, 2, 8):
        kept = counts[counts >= least]
        back = count_of(levels_of(kept, least), least)
        assert (np.abs(np.log(back / kept)) <= math.log(bloom_lm.BASE)).all()
        assert (np.diff(levels_of(kept, least)) >= 0).all() and levels_of(kept, least)[0] == 1
    assert count_of(np.array([0]), 1.0)[0] == 0


def test_filter_gives_back_levels_and_few_false_ones():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 63, 60_000, dtype=np.uint64)
    levels = rng.geometric(0.6, len(keys))
    blocks = 2
    bits = np.zeros((blocks, BLOCK_BITS // 8), dtype=np.uint8)
    for block in range(blocks):
        here = block_of(keys, blocks) == block
        set_bits(bits[block], keys[here], levels[here])
    held = Filter(blocks, bits.ravel())
    found = held.levels(keys)
    assert (found >= levels).all() and (found == levels).mean() > 0.97
    strange = rng.integers(1 << 63, 1 << 64, 20_000, dtype=np.uint64)
    assert (held.levels(strange) > 0).mean() < 0.03


def tokens(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def learns(key):
    return zlib.crc32(str(key).encode()) % 7 != 2


TRAINING = "crc32(cast(cast(doc_id AS string) AS binary)) % 7 <> 2"


def check(rows, found):
    counts = Counter(t for key, text in rows if key is not None and learns(key) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for key, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        held = key is None or not learns(key)
        expected.append((repr(key), held, len(own), sum(t in counts for t in own), total, round(base, 6)))
    assert sorted(expected) == sorted(
        (repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in found
    )


@pytest.mark.parametrize("frequent", [1, 1000])
def test_counts_and_base_score_are_exact(documents, frequent, monkeypatch):
    monkeypatch.setattr(bloom_lm, "CHUNK_CHARS", 50)
    monkeypatch.setattr(bloom_lm, "HELD_PAIRS", 10)
    monkeypatch.setattr(bloom_lm, "HELD_WORDS", 5)
    rows = [(i, f"The cat {'SAT' if i % 2 else 'ran'} é\tw{i}\x0bx{i % 5}") for i in range(60)]
    rows += [(None, "no id"), (100, None), (101, ""), (101, ""), (102, "long cat " * 5000)]
    frame = documents(*rows).withColumn("score", F.lit("mine"))
    found = scored(frame, F.expr(TRAINING), frequent_words=frequent).collect()
    check(rows, found)
    assert all(r.score <= 0 for r in found)


def test_empty_table_and_no_training_rows(documents):
    assert scored(documents(), F.expr(TRAINING)).collect() == []
    found = scored(documents((1, "a b"), (2, None)), F.lit(False)).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found} == {
        (3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)
    }


def test_pairs_are_counted_over_all_texts(documents):
    frame = documents((1, "a b a b"), (2, "A B"), (3, "b a"))
    found = sorted(r.n for r in pair_counts(frame, "text", 1).collect())
    # start-a 2, a-b 3, b-a 2, b-end 2, start-b 1, a-end 1
    assert found == [1, 1, 2, 2, 2, 3]
    assert sorted(r.n for r in pair_counts(frame, "text", 2).collect()) == [2, 2, 2, 3]


def model_of(frame, **settings):
    words = written(word_counts(frame, "text"), "words")
    return train(frame, words, "text", **settings)


def test_probabilities_after_a_word_add_up(documents):
    rows = [(i, " ".join(f"w{(i * k) % 17}" for k in range(40))) for i in range(80)]
    model = model_of(documents(*rows))
    vocabulary = sorted({w for _, text in rows for w in text.split()})
    for context in vocabulary[:6]:
        total = 0.0
        for word in vocabulary:
            c = coded([f"{context} {word}"])
            total += 10 ** model.log10(c)[1]
        c = coded([context])
        total += 10 ** model.log10(c)[1]
        assert 0.6 < total < 1.4


def test_model_is_better_than_single_words_on_held_out_text(documents):
    rows = [(i, " ".join(f"w{(i + 3 * k) % 50}" for k in range(60))) for i in range(200)]
    found = [r for r in scored(documents(*rows), F.expr(TRAINING)).collect() if r.held_out]
    assert found and all(r.score > r.base_score for r in found)


def test_small_filter_keeps_the_frequent_counts(documents):
    words = [f"v{k}" for k in range(90_000)]
    rows = [(0, " ".join(words)), *[(i, "often seen words") for i in range(1, 200)]]
    model = model_of(documents(*rows), most_blocks=1)
    assert model.filter.blocks == 1 and (model.least_word > 1 or model.least_pair > 2)
    common = model.log10(coded(["often seen words"]))
    assert (10**common[1:3] > 0.5).all()


def test_filter_grows_with_its_entries_and_keeps_pairs_seen_once(documents):
    rows = [(i, " ".join(f"v{i * 3000 + k}" for k in range(3000))) for i in range(30)]
    model = model_of(documents(*rows))
    assert model.least_pair == model.least_word == 1 and model.filter.blocks > 1
    seen = coded(["v1 v2", "v2 v1"])
    log = model.log10(seen)
    assert log[1] > log[4] + 1


@pytest.mark.parametrize("shard_blocks", [1, 64])
def test_shards_give_the_scores_of_the_broadcast_filter(documents, shard_blocks, monkeypatch):
    monkeypatch.setattr(bloom_lm, "SHARD_BLOCKS", shard_blocks)
    monkeypatch.setattr(bloom_lm, "CHUNK_CHARS", 20_000)
    rows = [(i, " ".join(f"v{(i * 2500 + k * k) % 70_000}" for k in range(3000))) for i in range(30)]
    rows += [(None, "v1 v2"), (100, None), (101, ""), (101, ""), (102, "v1 v4 " * 9000)]
    frame = documents(*rows)

    def of(**settings):
        found = scored(frame, F.expr(TRAINING), **settings).collect()
        return sorted((repr(r.doc_id), *r[1:5], round(r.base_score, 6), round(r.score, 6)) for r in found)

    assert of(broadcast_blocks=0) == of()


def brute_scores(rows):
    """key and score by exact dictionaries of the quantised counts, without a filter."""

    def level(n):
        return float(count_of(levels_of(np.array([n]), 1), 1)[0]) if n else 0.0

    words, pairs, masses, texts = Counter(), Counter(), Counter(), 0
    for key, text in rows:
        if key is not None and learns(key):
            texts += 1
            words.update(tokens(text))
            pairs.update(zip(["start", *tokens(text)], tokens(text)))
    for (context, _), n in pairs.items():
        masses[context] += 4 * n - 3
    total = sum(words.values()) + len(words) + 1
    for key, text in rows:
        score = 0.0
        for context, word in zip(["start", *tokens(text)], tokens(text)):
            mass = level(masses[context]) / 4
            seen = max(texts if context == "start" else level(words[context]), mass)
            rest = min(max(1 - mass / max(seen, 1), bloom_lm.LEAST_LEFT), 1) if mass else 1
            known = min(max(level(pairs[context, word]) - 0.75, 0) / max(seen, 1), 1 - rest)
            score += math.log10(min(known + rest * (level(words[word]) + 1) / total, 1))
        yield repr(key), round(score, 6)


@pytest.mark.parametrize("shard_tokens", [1 << 21, 2000])
def test_scores_are_those_of_exact_dictionaries(documents, shard_tokens, monkeypatch):
    monkeypatch.setattr(bloom_lm, "SHARD_TOKENS", shard_tokens)
    monkeypatch.setattr(bloom_lm, "CHUNK_CHARS", 3_000)
    rows = [(i, " ".join(f"The w{(i * 7 + k * k) % 90} \xff\xfe" for k in range(30))) for i in range(80)]
    rows += [(None, "the w1"), (100, None), (101, ""), (101, ""), (102, "the THE " * 4000)]
    rows += [(103, "a\0 \0 \x1cb \x85c \u2028d \t\x0b\r\na\0"), (104, "\xa0 the a\0 \x1cb \ud7ff")]
    chunks = bloom_lm.coded_chunks(
        documents(*rows).selectExpr("doc_id AS id", "coalesce(text, '') AS text", "false AS held_out")
    )
    split = bloom_lm.split_contexts(chunks, chunks.agg(F.sum("tokens")).first()[0], 100)
    the = bloom_lm.hashes_of([b"the"])
    # "the" is before over half of all tokens; no shard is to hold them all.
    assert (split.places(the)[0] >= 0) == (shard_tokens == 2000)
    found = scored(documents(*rows), F.expr(TRAINING)).collect()
    assert sorted((repr(r.doc_id), round(r.score, 6)) for r in found) == sorted(brute_scores(rows))
    check(rows, found)


def test_disk_stays_near_the_size_of_the_texts(spark, documents):
    """Pairs are shuffled once, and no table of pairs is written."""
    numbers = np.random.default_rng(0).zipf(1.3, (300, 3000)) % 70_000
    rows = [(i, " ".join(f"word{n}" for n in row)) for i, row in enumerate(numbers.tolist())]
    frame = documents(*rows).localCheckpoint()
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    folders = [str(folder) for folder in folders.diskBlockManager().localDirsString()]
    folders.append(scratch_root(spark))

    def files():
        paths = [Path(f.removeprefix("file:")) for f in folders]
        return {p: p.stat().st_size for f in paths for p in f.rglob("*") if p.is_file()}

    before = files()
    assert scored(frame, F.expr(TRAINING), broadcast_blocks=0).count() == 300
    taken = sum(size for path, size in files().items() if path not in before)
    # Once 1.97 bytes for each of the texts, with the filter in shards.
    assert taken < sum(len(text) for _, text in rows)
