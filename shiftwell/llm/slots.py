"""Shards by fixed virtual slots and a versioned map from slots to shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shiftwell import files
from shiftwell.llm.tables import written

SLOTS = 4096
PARTS = 16
MAP_SCHEMA = "version int, virtual_slot int, bytes bigint, shard int"


def key_hash(key: str, text: str) -> Column:
    """The hash of a row's id, or of its text where the id is NULL."""
    return F.xxhash64(F.coalesce(F.col(key).cast("string"), F.col(text)))


def slot_of(hashed: Column, salt: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a row by the hash of its key and, if it has one, by its salt."""
    spread = F.when(salt.isNotNull(), F.xxhash64(hashed, salt)).otherwise(hashed)
    return F.pmod(spread, F.lit(slots)).cast("int")


def heavy_keys(rows: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """The ``hash`` of keys of several rows that hold over an eighth of a shard's bytes.

    There are 8 x ``shards`` of them at most. Only the rows of slots that hold as much
    are grouped by key, so where no slot stands out nothing is shuffled but slots.
    """
    slot = F.pmod("hash", F.lit(slots))
    sums = rows.groupBy(slot.alias("slot")).agg(F.sum("size").alias("bytes"))
    share = F.sum("bytes").over(W.partitionBy(F.lit(0))) / (8 * shards)
    full = sums.withColumn("share", share).where(F.col("bytes") > F.col("share"))
    # One row a slot at most, a fixed number.
    inside = rows.withColumn("slot", slot).join(F.broadcast(full.drop("bytes")), "slot")
    keys = inside.groupBy("hash").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.first("share").alias("share")
    )
    return keys.where((F.col("rows") > 1) & (F.col("bytes") > F.col("share"))).select("hash")


def slot_bytes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """virtual_slot and bytes, one row for each of the slots, used or not."""
    used = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(used, "virtual_slot", "left").select(
        "virtual_slot", F.coalesce("bytes", F.lit(0)).alias("bytes")
    )


def _lightest(loads):
    """The place, from 0, of the first of the smallest numbers of an array."""
    return (F.array_position(loads, F.array_min(loads)) - 1).cast("int")


def first_map(sizes: DataFrame, shards: int) -> DataFrame:
    """Version 1: slots from the heaviest down, each to the shard lightest so far.

    The fold runs over one array of all slots, whose number is fixed.
    """
    heaviest = F.array_sort(
        F.collect_list(
            F.struct((-F.col("bytes")).alias("minus"), F.col("virtual_slot").alias("slot"))
        )
    )
    start = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), shards).alias("loads"),
        F.array().cast("array<int>").alias("shards"),
    )

    def place(state, slot):
        at = _lightest(state["loads"])
        return F.struct(
            F.transform(
                state["loads"], lambda load, i: F.when(i == at, load - slot["minus"]).otherwise(load)
            ).alias("loads"),
            F.concat(state["shards"], F.array(at)).alias("shards"),
        )

    placed = sizes.agg(heaviest.alias("slots")).select(
        "slots", F.aggregate("slots", start, place).getField("shards").alias("shards")
    )
    zipped = placed.select(F.explode(F.arrays_zip("slots", "shards")).alias("z"))
    return zipped.select(
        F.lit(1).alias("version"),
        F.col("z.slots.slot").alias("virtual_slot"),
        (-F.col("z.slots.minus")).alias("bytes"),
        F.col("z.shards").alias("shard"),
    )


def rebalanced(current: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, edited for new sizes and a new number of shards.

    Slots stay where they are, but for those that do not fit: each shard keeps its
    slots from the heaviest down as long as their sum stays within an equal share of
    all bytes, and the slots left over (and those of shards that are gone) go,
    heaviest first, to the shard lightest by then.
    """
    fresh = current.select("version", "virtual_slot", "shard").join(sizes, "virtual_slot")
    share = F.ceil(F.sum("bytes").over(W.partitionBy("version")) / shards)
    by_weight = W.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    held = F.sum("bytes").over(by_weight.rowsBetween(W.unboundedPreceding, 0))
    marked = fresh.withColumn("share", share).withColumn(
        "stays", (F.col("shard") < shards) & (held <= F.col("share"))
    )
    # Slots that stay come first and are only counted; the others are dealt out.
    order = F.array_sort(
        F.collect_list(
            F.struct(
                F.when(F.col("stays"), 0).otherwise(1).alias("turn"),
                (-F.col("bytes")).alias("minus"),
                F.col("virtual_slot").alias("slot"),
                F.col("shard"),
            )
        )
    )
    start = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), shards).alias("loads"),
        F.array().cast("array<int>").alias("shards"),
    )

    def place(state, slot):
        at = F.when(slot["turn"] == 0, slot["shard"]).otherwise(_lightest(state["loads"]))
        return F.struct(
            F.transform(
                state["loads"], lambda load, i: F.when(i == at, load - slot["minus"]).otherwise(load)
            ).alias("loads"),
            F.concat(state["shards"], F.array(at)).alias("shards"),
        )

    placed = marked.agg(F.max("version").alias("old"), order.alias("slots")).select(
        "old", "slots", F.aggregate("slots", start, place).getField("shards").alias("shards")
    )
    return placed.select("old", F.explode(F.arrays_zip("slots", "shards")).alias("z")).select(
        (F.col("old") + 1).alias("version"),
        F.col("z.slots.slot").alias("virtual_slot"),
        (-F.col("z.slots.minus")).alias("bytes"),
        F.col("z.shards").alias("shard"),
    )


def even_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1 before any bytes are known: slots dealt to the shards in turn."""
    slot = F.col("id").cast("int")
    return spark.range(slots).select(
        F.lit(1).alias("version"),
        slot.alias("virtual_slot"),
        F.lit(0).cast("bigint").alias("bytes"),
        F.pmod(slot, F.lit(shards)).alias("shard"),
    )


def store_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the map's table; versions before it stay readable."""
    slot_map.write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of a stored map, the newest unless one is named."""
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == version)


def assigned(
    documents: DataFrame,
    shards: int = 16,
    slots: int = SLOTS,
    map_path: str | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every row with its shard: key, size, text_crc32, virtual_slot, version, shard, slot.

    Rows are hashed into ``slots`` virtual slots, bytes are added up per slot, and the
    map from slots to shards makes the shards' bytes near equal. With ``map_path`` the
    newest version stored there is edited for the bytes as they are now, stored as the
    next version and used; the first call stores version 1. ``slot`` is the row's place
    in its shard, gapless from 0: places of a shard run through its virtual slots and,
    in these, through a fixed order of rows. No window holds more than a part of a
    virtual slot, so a hot source, text or id length meets no single task.

    A row's virtual slot comes from its key alone. Where many rows repeat one key, or one
    text without a key, and hold over an eighth of a shard together, each of them is
    hashed with its place in the written table, so that they spread over all slots.

    size is the text's UTF-8 bytes plus 1. A NULL text counts as empty, a NULL key is
    hashed by its text and stays NULL. Equal rows take places of their own. An empty
    table gives no rows and a map with all slots of no bytes. Of further columns none
    is read.
    """
    spark = documents.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        documents.select(
            F.col(key),
            (F.octet_length(whole).cast("long") + 1).alias("size"),
            F.crc32(whole.cast("binary")).alias("text_crc32"),
            key_hash(key, text).alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sharded-rows",
    )
    heavy = written(heavy_keys(rows, shards, slots), "heavy-keys").withColumn("heavy", F.lit(True))
    salt = F.when(F.col("heavy"), F.col("row"))
    rows = rows.join(F.broadcast(heavy), "hash", "left").select(
        key,
        "size",
        "text_crc32",
        slot_of(F.col("hash"), salt, slots).alias("virtual_slot"),
        F.pmod(F.xxhash64(F.lit(1), "hash", salt), F.lit(PARTS)).alias("part"),
    )
    parts = written(
        rows.groupBy("virtual_slot", "part").agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")
        ),
        "slot-parts",
    )
    sizes = slot_bytes(parts, slots)
    if map_path is None:
        slot_map = written(first_map(sizes, shards), "slot-map")
    else:
        old = load_map(spark, map_path) if files.exists(spark, map_path) else None
        new = first_map(sizes, shards) if old is None else rebalanced(old, sizes, shards)
        store_map(new, map_path)
        slot_map = load_map(spark, map_path)
    # slots x parts rows at most, a fixed number: small enough to send to every task.
    before = (
        W.partitionBy("shard")
        .orderBy("virtual_slot", "part")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    places = parts.join(F.broadcast(slot_map.drop("bytes")), "virtual_slot").select(
        "virtual_slot",
        "part",
        "version",
        "shard",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"),
    )
    within = W.partitionBy("virtual_slot", "part").orderBy(key, "text_crc32", "size")
    ranked = rows.withColumn("place", F.row_number().over(within) - 1)
    return ranked.join(F.broadcast(places), ["virtual_slot", "part"]).select(
        key,
        "size",
        "text_crc32",
        "virtual_slot",
        "version",
        "shard",
        (F.col("base") + F.col("place")).alias("slot"),
    )
