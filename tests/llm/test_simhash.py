import random
import re

import numpy as np
import pytest
import xxhash
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from shiftwell.llm import simhash
from shiftwell.llm.components import components, forest
from shiftwell.llm.simhash import deduplicated, fingerprint, near_duplicates, tile_links


def plain_fingerprint(text):
    """The definition, bit by bit."""
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", small) if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)]
    shingles = shingles or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(
    "text",
    [None, "", " \t\n", "One", "one two", "ONE two\tthree", "a b c d", "a b c d e a b c d e",
     "É è Ü\xa0x y z w", "x " * 9, "\x1cA b\x0bC d\x85e f", "word " * 70_000 + "end"],
)
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def flipped(print_, bits):
    for bit in bits:
        print_ ^= 1 << bit
    return print_


@pytest.mark.parametrize("same", [True, False])
def test_tiles_are_compared_exactly(same):
    rng, draw = np.random.default_rng(7), random.Random(7)
    seeds = [int(x) for x in rng.integers(0, 1 << 63, 120, dtype=np.uint64)]
    prints = {flipped(s, draw.sample(range(64), draw.randint(0, 5))) for s in seeds for _ in range(6)}
    by_count = {}
    for p in prints:
        by_count.setdefault(p.bit_count(), []).append(p)
    counts = sorted(by_count, key=lambda c: -len(by_count[c]))[:4]
    for a in counts:
        for b in counts:
            if same != (a == b):
                continue
            left, right = (np.array(by_count[c], dtype=np.uint64) for c in (a, b))
            links = tile_links(left, right, 4, same)
            assert len(links) < len(left) + len(right)
            nodes = sorted({*by_count[a], *by_count[b]})
            place = {p: i for i, p in enumerate(nodes)}

            def joined(pairs):
                pairs = [(place[int(x)], place[int(y)]) for x, y in pairs]
                ends = np.array(pairs, dtype=int).reshape(-1, 2)
                return forest(ends[:, 0], ends[:, 1], len(nodes)).tolist()

            pairs = [(x, y) for x in by_count[a] for y in by_count[b] if (x ^ y).bit_count() <= 4]
            assert joined(links) == joined(pairs)


def brute(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    ends = np.array(
        [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    ).reshape(-1, 2)
    root = forest(ends[:, 0], ends[:, 1], len(rows)).tolist()
    least = {}
    for (key, _), r in zip(rows, root):
        if key is not None:
            least[r] = min(least.get(r, key), key)
    return prints, root, [least.get(r) for r in root]


def texts(n, seed=0):
    """Texts of which many are copies, or differ in a word or two."""
    draw = random.Random(seed)
    base = [[f"w{draw.randint(0, 3000)}" for _ in range(150)] for _ in range(n // 5)]
    rows = []
    for key in range(n):
        words = list(draw.choice(base))
        for _ in range(draw.choice([0, 0, 1, 2, 30])):
            words[draw.randrange(150)] = f"x{draw.randint(0, 10**6)}"
        rows.append((key, " ".join(words)))
    return rows


def test_table_against_brute_force(documents, monkeypatch):
    monkeypatch.setattr(simhash, "STRIP", 3)
    rows = texts(200) + [(None, "no key"), (None, "no key"), (7000, None), (6999, ""), (5, "dup")]
    rows += [(5, "dup")]
    frame = documents(*rows).withColumn("component_id", F.lit("mine"))
    found = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(frame).collect()), key=repr)
    prints, _, least = brute(rows)
    assert found == sorted(
        ((key, f"{p:016x}", low) for (key, _), p, low in zip(rows, prints, least)), key=repr
    )
    assert len({low for _, _, low in found}) < 150


def test_one_row_of_each_component_stays(documents):
    rows = texts(120, seed=2) + [(None, "no key"), (None, "no key"), (3, "again"), (3, "again")]
    rows += [(-5, None), (-4, "")]
    kept = deduplicated(documents(*rows).withColumn("print", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "print"]
    _, root, least = brute(rows)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        {r: low for r, low in zip(root, least)}.values(), key=repr
    )


def test_empty_table(documents):
    assert near_duplicates(documents()).collect() == []
    assert deduplicated(documents()).collect() == []


def test_components_of_chains_stars_and_nothing(spark):
    draw = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, 500 + i) for i in range(1, 60)]
    loose = [(draw.randint(1000, 1200), draw.randint(1000, 1200)) for _ in range(90)]
    links = chain + star + loose + [(3, 3), (None, 4), (8, 7), (7, 8)]
    draw.shuffle(links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    nodes = sorted({x for link in real for x in link})
    place = {x: i for i, x in enumerate(nodes)}
    ends = np.array([(place[a], place[b]) for a, b in real])
    root = forest(ends[:, 0], ends[:, 1], len(nodes))
    assert found == {x: nodes[root[i]] for i, x in enumerate(nodes)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
