"""The pipeline on a small corpus, each stage against what it should leave."""

import numpy as np
import public_tokenizers
import pytest
from test_cotrain import LABELS, junk, prose
from test_simhash import brute
from tokenizers import Tokenizer

import corpus_pipeline
from shiftwell.llm.mixing import n_words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import random

    draw = random.Random(4)
    rows, labels = [], []
    for key in range(300):
        good = key % 4 > 0
        text = rows[key - 9][1] if key % 10 == 9 and rows[key - 9][0] % 4 else None
        text = text or (prose(draw) + " " + prose(draw) if good else junk(draw))
        rows.append((key, text, ["en", "de"][key % 2], f"src{key % 3}", len(text)))
        labels.append((key, int("!!" not in text and "|" not in text and len(set(text.split())) > 3), 0))
    path = tmp_path_factory.mktemp("corpus")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"file://{path}/documents.parquet")
    spark.createDataFrame(labels[:200], LABELS).write.parquet(f"file://{path}/labels.parquet")
    return f"file://{path}", rows, {key: good for key, good, _ in labels}


def test_stages_take_effect_and_lose_nothing(spark, folder):
    path, rows, good = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "mixing", "packing"]

    kept = stages["quality"](spark, docs, path)
    kept_rows = [tuple(r) for r in kept.collect()]
    assert kept.columns == docs.columns
    assert {r[0] for r in kept_rows} == {key for key, is_good in good.items() if is_good}

    kept = spark.createDataFrame(kept_rows, docs.schema)
    single = stages["near_dedup"](spark, kept, path)
    single_rows = [tuple(r) for r in single.collect()]
    pairs = [(r[0], r[1]) for r in kept_rows]
    assert single.columns == docs.columns
    assert {r[0] for r in single_rows} == set(brute(pairs)[2])
    assert len(single_rows) < len(kept_rows)

    single = spark.createDataFrame(single_rows, docs.schema)
    mix = stages["mixing"](spark, single, path)
    assert mix.columns == docs.columns
    assert _words(mix) == _words(single)

    mixed_rows = [tuple(r) for r in mix.collect()]
    pieces = stages["packing"](spark, spark.createDataFrame(mixed_rows, docs.schema), path).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = sum(len(library.encode(r[1], add_special_tokens=False).ids) + 1 for r in mixed_rows)
    assert sum(p.length for p in pieces) == lengths
    assert all(np.frombuffer(bytes(p.ids), "<u2").size == p.length for p in pieces)


def _words(frame):
    return sum(r[0] for r in frame.select(n_words("text")).collect())


def test_run_applies_all_stages(spark, folder):
    pieces = corpus_pipeline.run(spark, folder[0])
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                              "offset", "ids"]
    assert pieces.count() > 0
