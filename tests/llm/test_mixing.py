import hashlib
import re

import pytest
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from shiftwell.llm.mixing import cut_to_taken, leaf_budgets, mixed

LEVELS = {"kind": "source", "language": "lang"}


def budgets(spark, leaves, weights, total, epochs):
    frame = spark.createDataFrame(leaves, "kind string, language string, tokens bigint")
    found = leaf_budgets(frame, ["kind", "language"], weights, total, epochs)
    return {(r.kind, r.language): r.budget for r in found.collect()}


def test_shortage_goes_to_siblings_before_other_branches(spark):
    leaves = [("a", "en", 10), ("a", "de", 1000), ("b", "en", 1000), ("b", "de", 1000)]
    found = budgets(spark, leaves, {}, 400, 1)
    # The 90 that a/en lacks are made up by a/de; b keeps its half.
    assert found == {("a", "en"): 10, ("a", "de"): 190, ("b", "en"): 100, ("b", "de"): 100}


def test_branch_that_runs_out_leaves_the_rest_to_the_other(spark):
    leaves = [("a", "en", 10), ("a", "de", 20), ("b", "en", 1000), ("b", "de", 1000)]
    found = budgets(spark, leaves, {}, 400, 2)
    assert found == {("a", "en"): 20, ("a", "de"): 40, ("b", "en"): 170, ("b", "de"): 170}


def test_weights_odd_tokens_and_zero_weight(spark):
    leaves = [("a", "en", 100), ("a", "de", 100), ("a", "fr", 100), ("b", "en", 100)]
    found = budgets(spark, leaves, {("a", "fr"): 0, ("a",): 2, ("*", "en"): 2}, 100, 1)
    assert found[("a", "fr")] == 0 and sum(found.values()) == 100
    assert found[("b", "en")] == 33 and found[("a", "en")] == 45 and found[("a", "de")] == 22


@pytest.mark.parametrize("total", [0, 1, 7, 299, 10_000])
def test_budgets_add_up(spark, total):
    leaves = [("a", "en", 0), ("a", "de", 7), ("b", "en", 50), ("c", "de", 90)]
    found = budgets(spark, leaves, {("c",): 5}, total, 2)
    assert sum(found.values()) == min(total, 2 * 147)


def brute(rows, budget_of, seed=42):
    """Whole epochs and a prefix of the next, each in the order of seed, epoch and key."""
    out = []
    for (kind, language), budget in budget_of.items():
        leaf = [r for r in rows if (r[3] or "(none)", r[2] or "(none)") == (kind, language)]
        epoch = 0
        while budget > 0:
            def place(r):
                key = r[1] or "" if r[0] is None else str(r[0])
                return hashlib.md5(f"{seed}/{epoch}/{key}".encode()).hexdigest()

            for row in sorted(leaf, key=lambda r: (place(r), words(r[1]))):
                if budget > 0:
                    out.append((row[0], epoch, min(words(row[1]), budget)))
                    budget -= words(row[1])
            epoch += 1
    return sorted(out, key=repr)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix_against_brute_force(documents, spark):
    rows = [(i, "w " * (1 + i * 13 % 29), "en" if i % 3 else "de", "ab"[i % 2], 0) for i in range(300)]
    rows += [(None, "no id here", "en", None, 0), (1000, "x y z", None, "a", 0)]
    mix = mixed(documents(*rows), LEVELS, {("a",): 3}, total_tokens=3000)
    found = sorted(((r.doc_id, r.epoch, r.taken) for r in mix.collect()), key=repr)
    leaves = {}
    for r in rows:
        leaf = (r[3] or "(none)", r[2] or "(none)")
        leaves[leaf] = leaves.get(leaf, 0) + words(r[1])
    shares = budgets(spark, [(*leaf, n) for leaf, n in leaves.items()], {("a",): 3}, 3000, 2)
    assert found == brute(rows, shares)
    assert sum(taken for _, _, taken in found) == 3000


def test_texts_are_cut_at_the_end_of_a_budget(documents):
    mix = cut_to_taken(mixed(documents((1, " a  b\tc\nd ")), LEVELS, total_tokens=3))
    assert [(r.text, r.taken) for r in mix.collect()] == [(" a  b\tc", 3)]


def test_nulls_repeats_and_clashing_names(documents):
    rows = [(None, None), (1, ""), (2, "a b"), (2, "a b"), (3, "long " * 20_000)]
    frame = documents(*rows).withColumn("tokens", F.lit("mine")).withColumn("kind", F.lit(1))
    mix = mixed(frame, LEVELS, max_epochs=1)
    assert sorted((r.doc_id or 0, r.taken) for r in mix.collect()) == [
        (0, 0), (1, 0), (2, 2), (2, 2), (3, 20_000)
    ]
    assert mix.columns == ["doc_id", "text", "lang", "source", "n_chars", "kind", "language",
                           "tokens", "epoch", "taken"]


def test_empty_table(documents):
    assert mixed(documents(), LEVELS).collect() == []
    assert mixed(documents((1, None)), LEVELS, total_tokens=5).collect() == []


def test_plan_has_no_python_and_no_row_level_sort_of_a_leaf(documents):
    mix = mixed(documents((1, "a")), LEVELS)
    plan = mix._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
