import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from shiftwell.llm import divergence
from shiftwell.llm.divergence import audit, band, pair_distances, skyband, words

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, least=10, top=10):
    times, holders, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        times[lang, source].update(found)
        holders[lang].update(set(found))
    kept = {lang: {t for t, n in holders[lang].items() if n >= least} for lang, _ in groups}

    def p(count, total, lang):
        return 1 + 1000000000 * (count + 2) // (total + 2 * len(kept[lang]))

    def f(a, b):
        return (a - b) * (a - b) // (a + b)

    result = []
    for lang, source in groups:
        terms = kept[lang]
        own = times[lang, source]
        everywhere = Counter()
        for other in groups:
            if other[0] == lang:
                everywhere.update(times[other])
        total = sum(own[t] for t in terms)
        lang_total = sum(everywhere[t] for t in terms)
        pairs, tells = [], []
        for _, other in (g for g in groups if g[0] == lang and g[1] != source):
            theirs = times[lang, other]
            their_total = sum(theirs[t] for t in terms)
            value = sum(
                f(p(own[t], total, lang), p(theirs[t], their_total, lang)) for t in terms
            )
            pairs.append((-value, other.encode(), other))
        for t in terms:
            a, b = p(own[t], total, lang), p(everywhere[t], lang_total, lang)
            if own[t] and a > b:
                tells.append((-f(a, b), t.encode(), t))
        for part, items in (("pair", sorted(pairs)), ("term", sorted(tells)[:top])):
            result += [
                (lang, source, part, item, -value, rank)
                for rank, (value, _, item) in enumerate(items, 1)
            ]
    return sorted(result)


def made(documents, rows):
    return documents(*((i, t, lang, source, 0) for i, (t, lang, source) in enumerate(rows)))


def found(frame):
    return sorted(tuple(row) for row in frame.select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(n, seed):
    draw = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdeé漢Z" for b in "xyzÄ"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = []
    for _ in range(n):
        source = f"s{min(draw.randrange(9), draw.randrange(9))}"
        shuffled = weights if source < "s4" else weights[::-1]
        text = " ".join(draw.choices(vocabulary, shuffled, k=draw.randrange(20)))
        rows.append((text, draw.choice(["en", "de", None]), source))
    return rows


def test_equals_brute_force(documents):
    rows = corpus(600, 1)
    assert found(audit(made(documents, rows))) == brute(rows)


def test_equals_brute_force_with_small_limits(documents):
    rows = corpus(300, 2)
    assert found(audit(made(documents, rows), least=3, top=2)) == brute(rows, 3, 2)


def test_counts_are_emptied_within_a_task(documents, monkeypatch):
    rows = corpus(200, 3)
    monkeypatch.setattr(divergence, "HELD_TERMS", 5)
    assert found(audit(made(documents, rows).coalesce(1))) == brute(rows)


def test_edge_cases(documents):
    rows = [("ABC abc ÄB, a1b\x00c", "en", "x")] * 12
    rows += [(None, "en", "y"), ("", "en", None), ("1 2 3", "en", "z"), ("rare", "de", "x")]
    rows += [(None, None, None), ("word " * 300_000, "en", "y"), ("K\u212a ſ", "fr", "one")]
    assert found(audit(made(documents, rows))) == brute(rows)
    found_rows = found(audit(made(documents, rows)))
    assert ("en", "", "pair", "z") in {row[:4] for row in found_rows}
    assert not [row for row in found_rows if row[0] == "fr"]


def test_ties_follow_utf8(documents):
    rows = [("b a é 漢 z", "en", "x"), ("other", "en", "y")] * 10
    terms = [row[3] for row in found(audit(made(documents, rows))) if row[1:3] == ("x", "term")]
    ranks = {row[3]: row[5] for row in found(audit(made(documents, rows)))}
    assert sorted(terms, key=ranks.get) == ["a", "b", "z", "é", "漢"]


def test_empty_table_and_clashing_columns(documents):
    assert audit(documents()).collect() == []
    rows = corpus(100, 4)
    frame = made(documents, rows).withColumn("term", F.lit("x")).withColumn("times", F.lit(1))
    assert found(audit(frame)) == brute(rows)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_band_is_what_fewer_than_k_dominate(k):
    draw = np.random.default_rng(k)
    for n in (0, 1, 50, 700):
        times, low = draw.integers(1, 12, n), draw.integers(1, 30, n)
        terms = [f"{x:05}".encode() for x in draw.permutation(n)]
        expected = [
            i
            for i in range(n)
            if sum(
                times[j] >= times[i] and low[j] <= low[i] and terms[j] < terms[i] for j in range(n)
            )
            < k
        ]
        assert sorted(band(times, low, terms, k).tolist()) == expected


def test_skyband_does_not_depend_on_partitions(spark):
    draw = random.Random(5)
    rows = [("en", f"s{i % 2}", f"t{i}", draw.randrange(1, 9), draw.randrange(9, 30)) for i in range(900)]
    terms = spark.createDataFrame(
        rows, "lang string, source string, term string, times bigint, lang_times bigint"
    )
    one, many = (
        {tuple(row) for row in skyband(terms.repartition(n), 3).collect()} for n in (1, 13)
    )
    assert one == many and len(one) < 200


@pytest.mark.parametrize("tile,cells", [(2, 4), (3, 1 << 20), (256, 8)])
def test_pairs_in_tiles_and_blocks(spark, tile, cells):
    draw = random.Random(tile)
    shares = {f"s{i}": {f"t{j}": draw.randrange(1, 500) for j in draw.sample(range(20), 9)} for i in range(7)}
    none = {source: 1 + 2000000000 // (sum(own.values()) + 50) for source, own in shares.items()}
    groups = spark.createDataFrame(
        [("en", s, sum(own.values()), 25) for s, own in shares.items()] + [("de", "a", 0, 0), ("de", "b", 0, 0)],
        "lang string, source string, total bigint, kept bigint",
    )
    terms = spark.createDataFrame(
        [("en", s, t, p) for s, own in shares.items() for t, p in own.items()],
        "lang string, source string, term string, p bigint",
    )
    result = {
        frozenset((r.a, r.b)): r.value
        for r in pair_distances(groups, terms, tile, cells).collect()
    }
    expected = {frozenset("ab"): 0}
    for a, left in shares.items():
        for b, right in shares.items():
            if a < b:
                ps = [(left.get(f"t{j}", none[a]), right.get(f"t{j}", none[b])) for j in range(25)]
                expected[frozenset((a, b))] = sum((p - q) ** 2 // (p + q) for p, q in ps)
    assert result == expected


def test_long_texts_are_read_in_slices():
    text = b" ".join(b"w%d" % (i % 7) for i in range(1000))
    sliced = [word for part in words(text, 16) for word in part]
    assert sliced == [word for part in words(text) for word in part]
    assert len(list(words(text, 16))) > 50
