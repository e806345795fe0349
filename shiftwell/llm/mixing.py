"""Mixing sources to target weights: budgets down a tree, seeded token prefixes of leaves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shiftwell.llm.tables import written

# The white space that parts words, and the buckets of three hex digits.
WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 3

MISSING = "(none)"
FEW_LEAVES = 20_000


def n_words(text: str) -> Column:
    """Words of a text, its tokens here."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def _weight(path: Sequence[str], weights: Mapping[tuple[str, ...], int]) -> Column:
    """The weight of the node named by the columns of ``path``, 1 unless given."""
    given = [(p, w) for p, w in weights.items() if len(p) == len(path)]
    weight = F.lit(1)
    for names, value in given:
        here = F.lit(True)
        for column, name in zip(path, names):
            here = here & (F.col(column) == name) if name != "*" else here
        weight = F.when(here, value).otherwise(weight)
    return weight.cast("bigint")


def _shared_out(nodes: DataFrame, parent: Sequence[str], path: Sequence[str]) -> DataFrame:
    """Nodes with ``share``: their part of the parent's ``budget``.

    In the order of capacity per weight, nodes that cannot use their part take what
    they hold; what they leave is shared by weight among the siblings after them.
    Whole tokens, the odd ones to the largest remainders. Numbers are exact.
    """
    nodes = nodes.withColumn("ratio", F.col("capacity").cast("double") / F.col("weight"))
    family = W.partitionBy(*parent)
    order = family.orderBy("ratio", *path)
    # Decimals: tokens times weights pass the range of a long.
    nodes = (
        nodes.withColumn(
            "before",
            F.coalesce(
                F.sum("capacity").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .withColumn(
            "weight_left", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
        )
        .withColumn(
            "fits",
            F.expr(
                "CASE WHEN CAST(capacity AS DECIMAL(20,0)) * CAST(weight_left AS DECIMAL(18,0))"
                " <= CAST(budget - before AS DECIMAL(20,0)) * CAST(weight AS DECIMAL(18,0))"
                " THEN 1 ELSE 0 END"
            ),
        )
        .withColumn("full", F.min("fits").over(order.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn(
            "left_over", F.col("budget") - F.sum(F.col("capacity") * F.col("full")).over(family)
        )
        .withColumn("open_weight", F.sum(F.col("weight") * (1 - F.col("full"))).over(family))
        .withColumn(
            "product", F.expr("CAST(left_over AS DECIMAL(20,0)) * CAST(weight AS DECIMAL(18,0))")
        )
        .withColumn(
            "part",
            F.when(F.col("full") == 1, F.col("capacity")).otherwise(
                F.expr("CAST(product div greatest(open_weight, 1) AS BIGINT)")
            ),
        )
        .withColumn(
            "rest",
            F.when(F.col("full") == 1, F.lit(-1)).otherwise(
                F.expr("CAST(product % greatest(open_weight, 1) AS BIGINT)")
            ),
        )
        .withColumn("odd", F.col("budget") - F.sum("part").over(family))
    )
    turn = F.row_number().over(family.orderBy(F.desc("rest"), *path))
    return nodes.withColumn(
        "share",
        F.col("part")
        + F.when((F.col("full") == 0) & (turn <= F.col("odd")), F.lit(1)).otherwise(F.lit(0)),
    )


def leaf_budgets(
    leaves: DataFrame,
    levels: Sequence[str],
    weights: Mapping[tuple[str, ...], int],
    total_tokens: int | None,
    max_epochs: int,
) -> DataFrame:
    """Leaves (``levels``, tokens) with ``budget``: the tokens each gives to the mix.

    Budgets go down the tree level by level. A subtree never gets more than its leaves
    hold over ``max_epochs``, so a shortage is first made up by the siblings of the
    leaf, and reaches other branches only when all of these are used up. The frame has
    a row per leaf, not per document.
    """
    capacity = F.col("tokens") * max_epochs
    for depth in range(1, len(levels) + 1):
        capacity = F.when(_weight(levels[:depth], weights) > 0, capacity).otherwise(F.lit(0))
    leaves = leaves.withColumn("capacity", capacity)
    held, given = leaves.agg(F.sum("capacity"), F.sum("tokens")).first()
    budget = min(held or 0, (given or 0) if total_tokens is None else total_tokens)
    level = None
    for depth in range(1, len(levels) + 1):
        path = list(levels[:depth])
        nodes = (
            leaves.groupBy(*path)
            .agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
            .withColumn("weight", F.greatest(_weight(path, weights), F.lit(1)))
        )
        if level is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("bigint"))
        else:
            nodes = nodes.join(level, path[:-1])
        level = _shared_out(nodes, path[:-1], path).select(
            *path, F.col("share").alias("budget"), *(["tokens"] if depth == len(levels) else [])
        )
    return level


def mixed(
    documents: DataFrame,
    levels: Mapping[str, str],
    weights: Mapping[tuple[str, ...], int] | None = None,
    total_tokens: int | None = None,
    max_epochs: int = 2,
    seed: int = 42,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Documents of the mix: all columns, the ``levels``, tokens, epoch and taken.

    ``levels`` names the tree's levels from the root down, each with the SQL expression
    it is read by; ``weights`` gives integer weights of nodes by path (1 unless given, ``*`` for
    any name of a level, 0 to leave a subtree out). The mix has ``total_tokens`` words,
    as many as the table unless given, or as many as ``max_epochs`` passes over the
    leaves can give. A leaf's budget is taken from its documents in an order made of
    seed, epoch and key, epoch after epoch: a row per document and epoch, the last one
    with fewer tokens ``taken`` than it has.

    The order inside a leaf is cut into buckets whose token sums, few numbers, tell
    which bucket holds the end of the prefix. Only that bucket is ordered row by row,
    so a leaf with a third of all rows is never in one task.

    NULL names of a level form a node of their own, shown as ``(none)``. NULL and empty
    texts have no tokens; they go with the whole epochs and with prefixes they stand
    in. Rows without a key are ordered by their text. Equal rows are taken as often as
    they occur. An empty table gives an empty mix. Columns of documents named as a
    result column or level are replaced.
    """
    weights = weights or {}
    names = list(levels)
    added = ["tokens", "epoch", "taken", *names]
    own = [c for c in documents.columns if c not in added]
    level_columns = [
        F.coalesce(F.expr(e).cast("string"), F.lit(MISSING)).alias(n) for n, e in levels.items()
    ]
    rows = documents.select(*own, *level_columns)

    def ordered(epoch: Column) -> Column:
        by = F.coalesce(F.col(key).cast("string"), F.col(text), F.lit(""))
        return F.md5(F.concat_ws("/", F.lit(seed).cast("string"), epoch.cast("string"), by))

    def bucket(epoch: Column) -> Column:
        return F.substring(ordered(epoch), 1, BUCKET_DIGITS)

    slim = written(
        rows.select(
            *names, n_words(text).alias("tokens"), *[bucket(F.lit(e)).alias(f"bucket{e}") for e in range(max_epochs)]
        ),
        "mix-rows",
    )
    leaves = slim.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, names, weights, total_tokens, max_epochs)
    plan = written(
        budgets.select(
            *names,
            F.expr("CASE WHEN tokens > 0 THEN budget div tokens ELSE 0 END").alias("epochs"),
            F.expr("CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END").alias("prefix"),
        ),
        "mix-plan",
    )
    few = plan.count() <= FEW_LEAVES
    plan = F.broadcast(plan) if few else plan
    last = F.element_at(
        F.array(*[F.col(f"bucket{e}") for e in range(max_epochs)]),
        (F.least(F.col("epochs"), F.lit(max_epochs - 1)) + 1).cast("int"),
    )
    # A leaf has as many rows here as there are buckets, at most.
    sums = (
        slim.join(plan, names)
        .where("prefix > 0")
        .groupBy(*names, "prefix", last.alias("end_bucket"))
        .agg(F.sum("tokens").alias("tokens"))
    )
    up_to = F.sum("tokens").over(W.partitionBy(*names).orderBy("end_bucket"))
    ends = written(
        sums.withColumn("up_to", up_to)
        .withColumn("base", F.col("up_to") - F.col("tokens"))
        .where("base < prefix AND up_to >= prefix")
        .select(*names, "end_bucket", "base"),
        "mix-ends",
    )
    ends = F.broadcast(ends) if few else ends
    placed = rows.join(plan, names).join(ends, names, "left")
    placed = placed.withColumn("in_bucket", bucket(F.col("epochs")))

    passes = F.col("epochs") + F.expr("int(prefix > 0 AND in_bucket < end_bucket)")
    whole = (
        placed.withColumn("passes", passes)
        .where("passes > 0")
        .withColumn("tokens", n_words(text))
        .withColumn("epoch", F.explode(F.expr("sequence(0, int(passes) - 1)")))
        .withColumn("taken", F.col("tokens"))
    )
    order = W.partitionBy(*names).orderBy(ordered(F.col("epochs")), "tokens", text)
    so_far = F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, 0))
    at_end = (
        placed.where("prefix > 0 AND in_bucket = end_bucket")
        .withColumn("tokens", n_words(text))
        .withColumn("before", F.col("base") + so_far - F.col("tokens"))
        .where("before < prefix")
        .withColumn("epoch", F.col("epochs").cast("int"))
        .withColumn("taken", F.least(F.col("tokens"), F.col("prefix") - F.col("before")))
    )
    result = [*own, *names, "tokens", "epoch", "taken"]
    return whole.select(result).unionByName(at_end.select(result))


def cut_to_taken(mix: DataFrame, text: str = "text") -> DataFrame:
    """The mix with each text cut to the words taken of it, white space before them kept."""
    words = F.split(F.col(text), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    part = F.array_join(F.slice(words, 1, F.col("taken").cast("int")), "")
    return mix.withColumn(
        text, F.when(F.col("taken") < F.col("tokens"), part).otherwise(F.col(text))
    )
