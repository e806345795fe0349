import hashlib
import random
import re

import pytest
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from shiftwell.llm import infilling
from shiftwell.llm.infilling import (
    cut,
    framed,
    fill_in_middle,
    n_lines,
    output_texts,
    plain,
    split_after,
    store_frames,
    transformed,
)


def brute(key, text, rate=100, spm=50, seed=7):
    """The contract on plain strings."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    name = "" if key is None else key
    hexed = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    one, two, three, four = (int(hexed[i : i + 8], 16) for i in range(0, 32, 8))
    low, high = sorted((one % (n + 1), two % (n + 1)))
    if not text or re.search("<[PSM]>", text) or three % 100 >= rate:
        return (key, n, "plain", None, None, text)
    prefix, middle, suffix = (
        "".join(part) for part in (units[:low], units[low:high], units[high:])
    )
    if four % 100 < spm:
        return (key, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (key, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def found(frame):
    rows = output_texts(frame).collect()
    for row in rows:
        assert row.output_sha256 == sha(row.output_text)
    return sorted(
        (
            (r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_text, r.restored_sha256)
            for r in rows
        ),
        key=repr,
    )


def expected(rows, **options):
    return sorted(((*brute(k, t, **options), sha(t)) for k, t in rows), key=repr)


def texts(n, seed):
    draw = random.Random(seed)
    pieces = ["a", "é", "漢", "\n", "\n", "🙂", "<", "P", ">", "<P", "S>", " ", "\r\n", "\u2028"]
    return ["".join(draw.choices(pieces, k=draw.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1 << 18])
def test_equals_plain_strings_at_any_frame_size(documents, size):
    rows = list(enumerate(texts(300, size)))
    assert found(transformed(documents(*rows), size=size)) == expected(rows)


def test_edge_cases(documents):
    rows = [
        (1, None),
        (2, ""),
        (3, "\n"),
        (4, "no end"),
        (5, "a\n\n\n"),
        (6, "has <M> inside\nline"),
        (7, "<P"),
        (8, "same\ntext\nthrice"),
        (8, "same\ntext\nthrice"),
        (None, "no\nid\n"),
        (-9, "negative\nid"),
        (10, "x" * 300_000 + "\n" + "é" * 300_000 + "\n" + "tail\n" * 50_000),
    ]
    assert found(transformed(documents(*rows))) == expected(rows)


def test_rate_share_and_seed(documents):
    rows = [(i, f"line {i}\nand {i}\nmore\n") for i in range(200)]
    options = {"rate": 40, "spm": 90, "seed": 11}
    assert found(transformed(documents(*rows), **options)) == expected(rows, **options)


def test_empty_table_and_clashing_columns(documents):
    assert transformed(documents()).collect() == []
    frame = documents((1, "a\nb\n")).selectExpr("*", "9 AS key", "'x' AS frames", "'y' AS form")
    assert found(transformed(frame)) == expected([(1, "a\nb\n")])


def test_only_cut_frames_are_made_anew():
    text = "".join(f"line {i}\n" for i in range(1000)).encode()
    frames = cut(text, 100)
    before, behind, chars = split_after(frames, 500)
    assert b"".join(map(plain, before + behind)) == text
    assert chars == len("".join(f"line {i}\n" for i in range(500)))
    own = {id(frame) for frame in frames}
    assert sum(id(frame) not in own for frame in before + behind) <= 2
    assert n_lines(frames) == 1000 == before[-1].lines + behind[-1].lines - before[-1].lines


def test_selection_reads_the_frame_of_the_cut_alone(monkeypatch):
    frames = cut("".join(f"line {i}\n" for i in range(1000)).encode(), 100)
    reads = []
    monkeypatch.setattr(infilling, "plain", lambda frame: reads.append(frame) or plain(frame))
    split_after(frames, 321)
    assert len(reads) == 1


def test_frames_are_a_table(documents, spark, tmp_path):
    rows = [(i, f"{i}\nb\nc") for i in range(20)]
    path = f"file://{tmp_path}/frames"
    stored = store_frames(framed(documents(*rows), size=3), path)
    assert found(fill_in_middle(stored)) == expected(rows)
    sizes = stored.select("doc_id", F.size("frames").alias("n")).collect()
    assert all(row.n == -(-len(f"{row.doc_id}\nb\nc") // 3) for row in sizes)


def test_nothing_is_shuffled(documents):
    frame = transformed(documents((1, "a")))
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
