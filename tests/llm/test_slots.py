import zlib
from collections import defaultdict

from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from shiftwell.llm.slots import (
    assigned, even_map, first_map, load_map, rebalanced, slot_bytes, store_map,
)


def check(found, documents, shards):
    """Sizes and sums of the rows, gapless places, and the bytes of each shard."""
    places, load = defaultdict(list), defaultdict(int)
    for row in found:
        places[row.shard].append(row.slot)
        load[row.shard] += row["size"]
    assert all(sorted(slots) == list(range(len(slots))) for slots in places.values())
    expected = sorted(
        (key is None, key or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
        for key, t in documents
    )
    assert expected == sorted(
        (r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in found
    )
    assert set(places) <= set(range(shards))
    return [load[shard] for shard in range(shards)]


def test_shards_are_near_equal(documents):
    rows = [(i, "ä" * (i * 7 % 90)) for i in range(900)]
    rows += [(None, "no id"), (None, None), (5, None), (5, None), (7, "é" * 300)]
    load = check(assigned(documents(*rows), 16).collect(), rows, 16)
    assert max(load) - min(load) <= 100


def test_rows_of_one_key_are_spread(documents):
    """A repeated id, equal rows and equal texts without an id, each with many bytes."""
    rows = [(i, "x" * (i % 50)) for i in range(600)]
    rows += [(-1, f"{i} " + "y" * 90) for i in range(400)]
    rows += [(-2, "z" * 99)] * 300 + [(None, "w" * 99)] * 300
    found = assigned(documents(*rows), 16).collect()
    load = check(found, rows, 16)
    assert max(load) - min(load) <= 110
    assert all(len({r.virtual_slot for r in found if r.doc_id == k}) > 200 for k in (-1, -2, None))


def test_one_long_row_stays_in_the_slot_of_its_key(documents):
    rows = [(i, "x") for i in range(50)]
    slots = [
        {r.doc_id: r.virtual_slot for r in assigned(documents(*rows, (50, text)), 4).collect()}
        for text in ("x", "long " * 10_000)
    ]
    assert slots[0] == slots[1]


def test_even_map_is_edited_for_the_bytes(documents, spark, tmp_path):
    path = f"file://{tmp_path}/map"
    store_map(even_map(spark, 4, 64), path)
    rows = [(i, "x" * (i % 7) ** 3) for i in range(900)]
    found = assigned(documents(*rows), 4, slots=64, map_path=path).collect()
    load = check(found, rows, 4)
    assert {r.version for r in found} == {2} and max(load) <= 1.02 * sum(load) / 4
    one = {r.virtual_slot: r.shard for r in load_map(spark, path, 1).collect()}
    two = {r.virtual_slot: r.shard for r in load_map(spark, path).collect()}
    assert len(one) == len(two) == 64 and 0 < sum(one[s] != two[s] for s in one) < 32


def test_place_depends_on_the_row_alone(documents):
    rows = [(i, "x" * i) for i in range(50)]
    first = {r.doc_id: r.virtual_slot for r in assigned(documents(*rows), 4).collect()}
    second = {r.doc_id: r.virtual_slot for r in assigned(documents(*rows[::-1][:20]), 8).collect()}
    assert all(first[key] == slot for key, slot in second.items())


def test_empty_table_and_clashing_columns(documents):
    assert assigned(documents(), 16).collect() == []
    frame = documents((1, "a")).withColumn("slot", F.lit(9)).withColumn("shard", F.lit("x"))
    assert [(r.doc_id, r.slot) for r in assigned(frame, 16).collect()] == [(1, 0)]


def test_map_is_stored_in_versions_and_edited(documents, tmp_path, spark):
    path = f"file://{tmp_path}/map"
    rows = [(i, "x" * (i % 40)) for i in range(600)]
    before = assigned(documents(*rows), 4, slots=64, map_path=path).collect()
    more = rows + [(i, "y" * 30) for i in range(600, 900)]
    after = assigned(documents(*more), 5, slots=64, map_path=path).collect()
    assert {r.version for r in before} == {1} and {r.version for r in after} == {2}
    load = check(after, more, 5)
    assert max(load) <= 1.2 * sum(load) / 5
    old, new = (
        {r.virtual_slot: r.shard for r in load_map(spark, path, v).collect()} for v in (1, 2)
    )
    assert len(old) == len(new) == 64
    assert sum(old[slot] != new[slot] for slot in old) < 64 * 0.4
    assert load_map(spark, path).agg(F.max("version")).first()[0] == 2


def test_rebalancing_an_even_map_moves_nothing(spark):
    rows = spark.range(64).select(F.col("id").cast("int").alias("virtual_slot"), F.lit(5).alias("size"))
    sizes = slot_bytes(rows, 64)
    one = first_map(sizes, 8)
    two = rebalanced(one, sizes, 8)
    assert {(r.virtual_slot, r.shard) for r in one.collect()} == {
        (r.virtual_slot, r.shard) for r in two.collect()
    }


def test_heaviest_slot_goes_to_the_lightest_shard(spark):
    rows = spark.createDataFrame([(0, 9), (1, 5), (2, 4), (3, 1)], "virtual_slot int, size bigint")
    found = {r.virtual_slot: r.shard for r in first_map(slot_bytes(rows, 4), 2).collect()}
    assert found == {0: 0, 1: 1, 2: 1, 3: 0}


def test_store_map_keeps_versions(spark, tmp_path):
    sizes = slot_bytes(spark.createDataFrame([(0, 1)], "virtual_slot int, size bigint"), 2)
    path = f"file://{tmp_path}/kept"
    store_map(first_map(sizes, 1), path)
    assert load_map(spark, path, 1).count() == 2
