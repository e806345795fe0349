import numpy as np
import pytest
from llm_fixtures import vectors  # noqa: F401
from pyspark.sql import functions as F

from shiftwell.llm import permutation, pstable
from shiftwell.llm.permutation import footrule_scores, nearest
from shiftwell.llm.pstable import buckets, near_vectors

ODD = [
    (900, None, 1),
    (901, [0.0, 0.0, 0.0, 0.0], 1),
    (902, [1.0, None, 0.0, 0.0], 1),
    (903, [float("nan"), 1.0, 0.0, 0.0], 1),
    (904, [float("inf"), 1.0, 0.0, 0.0], 1),
    (905, [], 1),
]


def clouds(n, dim=16, labels=3, copies=20, seed=0):
    """Random vectors, among them groups close around and across the threshold."""
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, dim))
    for k in range(copies):
        rows[n - 1 - k] = rows[k % 4] + rng.standard_normal(dim) * 0.05 * (k % 5)
    return [(i, [float(np.float32(x)) for x in row], i % labels) for i, row in enumerate(rows)]


def cosines(rows):
    x = np.array([row[1] for row in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def brute_links(rows, threshold):
    """n_links, component_id by key; rows that take no part link with nothing."""
    near = cosines(rows) >= threshold
    labels = [row[2] for row in rows]
    n = len(rows)
    links = [
        {j for j in range(n) if j != i and near[i, j] and labels[i] == labels[j] and labels[i] is not None}
        for i in range(n)
    ]
    found = {}
    for i in range(n):
        reached, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - reached:
                reached.add(j)
                todo.append(j)
        found[rows[i][0]] = (len(links[i]), min(rows[j][0] for j in reached))
    return found


@pytest.mark.parametrize("tile", [8, 1024])
def test_near_vectors_against_brute_force(vectors, tile):
    rows = clouds(200) + [(500 + k, [1.0] + [0.0] * 15, 2) for k in range(30)]
    rows += [(600, [1.0] + [0.0] * 15, 1), (601, [2.0] + [0.0] * 15, None)]
    found = near_vectors(vectors(*rows, *ODD), tile=tile).collect()
    result = {r.vec_id: (r.n_links, r.component_id) for r in found}
    expected = brute_links(rows, 0.98) | {row[0]: (0, row[0]) for row in ODD}
    assert result == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_near_vectors_of_repeated_and_unnamed_rows(vectors):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (2, [0.0, 1.0], 0)]
    frame = vectors(*rows, (3, [1.0, 0.0, 0.0], 0)).withColumn("n_links", F.lit(5))
    found = sorted(map(tuple, near_vectors(frame).collect()), key=repr)
    assert found == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (2, 0, 2, True), (3, 0, 3, True)],
        key=repr,
    )


def test_empty_tables(vectors):
    assert near_vectors(vectors()).collect() == []
    assert near_vectors(vectors(*ODD[:2])).count() == 2
    assert nearest(vectors(), F.lit(True)).collect() == []
    assert nearest(vectors(*ODD), F.lit(True)).collect() == []


def test_close_vectors_share_a_bucket():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((500, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = 0.98 * a + np.sqrt(1 - 0.98**2) * b
    keys = [buckets(x, pstable.TABLES, pstable.PROJECTIONS, pstable.WIDTH, 1) for x in (a, b, c)]
    assert (keys[0] == keys[2]).any(axis=1).mean() > 0.99
    assert (keys[0] == keys[1]).mean() < 0.01


def test_nearest_on_a_small_table_is_exact(vectors):
    rows = clouds(60, labels=1)
    found = nearest(vectors(*rows, *ODD), F.col("vec_id") % 20 == 0, k=5).collect()
    scores = cosines(rows)
    expected = []
    for i in range(0, 60, 20):
        order = sorted((j for j in range(60) if j != i), key=lambda j: (-scores[i, j], j))[:5]
        expected += [(i, rank, j) for rank, j in enumerate(order, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == expected
    assert all(abs(r.score - scores[r.query_id, r.vec_id]) < 1e-12 for r in found)


def test_nearest_of_ties_repeats_and_few_candidates(vectors):
    rows = [(3, [1.0, 0.0], 0), (3, [1.0, 0.0], 0), (1, [2.0, 0.0], 0), (None, [1.0, 0.0], 0)]
    found = nearest(vectors(*rows, (9, [1.0], 0)), F.col("vec_id") == 3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found if r["rank"] == 1) == [(3, 1, 1)] * 2
    assert sorted(r["rank"] for r in found) == [1, 1, 2, 2, 3, 3]


def test_recall_over_several_blocks(vectors, monkeypatch):
    monkeypatch.setattr(permutation, "ROW_BLOCK", 300)
    monkeypatch.setattr(permutation, "QUERY_BLOCK", 10)
    rows = clouds(1200, dim=32, labels=1, seed=4)
    found = nearest(vectors(*rows), F.col("vec_id") % 20 == 0, k=5).collect()
    scores = cosines(rows)
    np.fill_diagonal(scores, -2)
    hits = sum(r.vec_id in np.argsort(-scores[r.query_id])[:5] for r in found)
    assert len(found) == 300 and hits / 300 >= 0.9


def test_scores_are_footrule_distances():
    rng = np.random.default_rng(3)
    perms = np.array([rng.permutation(12)[:5] for _ in range(20)], dtype=np.int16)

    def distance(a, b):
        place = lambda p, x: list(p).index(x) if x in p else 5
        return sum(abs(place(a, x) - place(b, x)) for x in set(a) | set(b))

    scores = footrule_scores(perms[:4], perms, 12)
    for i in range(4):
        for j in range(20):
            assert distance(perms[i], perms[j]) == 5 * 6 - 2 * scores[i, j]


def test_each_length_is_searched_among_its_own(vectors):
    rows = [(k, [1.0, k / 10, 0.0], 0) for k in range(6)]
    rows += [(10, [1.0, 0.0], 0), (11, [1.0, 0.1], 0), (12, [0.0, 1.0], 0), (20, [1.0], 0)]
    found = nearest(vectors(*rows, *ODD), F.col("vec_id").isin(0, 10, 20), k=2).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == [
        (0, 1, 1), (0, 2, 2), (10, 1, 11), (10, 2, 12)
    ]


def test_equal_vectors_go_by_their_keys(spark):
    """A third of all rows are one vector; ids that a double cannot hold."""
    rng = np.random.default_rng(3)
    rows, base = rng.standard_normal((900, 24)), 1 << 60
    rows[::3] = rows[0]
    data = [(base + i, [float(v) for v in row]) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    query = F.col("vec_id") == base + 6
    found = nearest(frame.repartition(5), query, share=1.0).orderBy("rank").collect()
    assert [r.vec_id - base for r in found] == [0, 3, 9, 12, 15]
    assert len({r.score for r in found}) == 1


def test_scores_near_the_ends_of_doubles(spark):
    data = [(1, [1e300, 0.0]), (2, [1e300, 1e300]), (3, [1e-300, 1e-300])]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    found = {r.vec_id: r.score for r in nearest(frame, F.col("vec_id") == 1).collect()}
    assert found[2] == found[3] == pytest.approx(0.5**0.5, abs=1e-15)


def test_pivots_are_a_bounded_sample_at_any_number_of_tasks(spark):
    rows = spark.range(20000).select(
        F.col("id").alias("row"), F.array(*(F.rand(i) for i in range(4))).alias("vector")
    )
    rows = rows.checkpoint()
    few, many = (permutation.choose_pivots(rows.repartition(n), 16, 300) for n in (2, 64))
    assert few.shape == (16, 4) and np.array_equal(few, many)
