"""URL verdicts by rules and, where none fits, by a tree of path templates per host."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftwell.llm.tables import written

DEPTH = 4
LEAST_PAGES = 5
LEAST_SHARE = 50
ALPHA = 0.05
WEIGHT = 2.0
REJECT_ABOVE = 0.5
SENT_BYTES = 8 * 1024 * 1024

# The letters that are lower-cased, no others.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    """A verdict for a host with all its subdomains, below a path."""

    verdict: str
    host: str
    path: str


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def matching(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest rule that fits, NULL where none does.

    Two rules that fit one url have hosts and paths of which one continues the other,
    so the longer is the narrower one; of equal lengths that with the longer host wins.
    """
    longest = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.host, r.path))
    found = None
    for rule in longest:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = (F if found is None else found).when(fits, value(rule))
    return F.lit(None).cast("string") if found is None else found


def _segments(path: Column, depth: int) -> Column:
    """The path's segments; those beyond the last level are one segment."""
    named = F.filter(F.split(path, "/"), lambda s: s != "")
    rest = F.concat_ws("/", F.slice(named, depth, F.greatest(F.size(named), F.lit(1))))
    return F.when(F.size(named) <= depth, named).otherwise(
        F.concat(F.slice(named, 1, depth - 1), F.array(rest))
    )


def _alike(a: Column, b: Column, part: str, of: str) -> Column:
    """Hoeffding's test: whether two shares may come from one."""
    share = F.abs(a[part].cast("double") / a[of] - b[part].cast("double") / b[of])
    room = F.lit(math.sqrt(0.5 * math.log(2 / ALPHA))) * (
        F.lit(1.0) / F.sqrt(a[of]) + F.lit(1.0) / F.sqrt(b[of])
    )
    return share < room


def _similar(a: Column, b: Column) -> Column:
    """Whether two branches look alike in labels and in what comes below them.

    Branches without labelled pages are like others without, never like labelled ones.
    """
    labels = F.when((a["labelled"] > 0) & (b["labelled"] > 0), _alike(a, b, "blocked", "labelled"))
    return (
        F.coalesce(labels, (a["labelled"] == 0) & (b["labelled"] == 0))
        & _alike(a, b, "ends", "pages")
        & _alike(a, b, "numbers", "pages")
    )


COUNTS = ("pages", "labelled", "blocked", "ends", "numbers")


def _merged(branches: Column) -> Column:
    """Sorted branches folded into groups: each joins the group before it if alike."""
    first = F.array().cast(
        "array<struct<members array<string>, "
        + ", ".join(f"{name} bigint" for name in COUNTS)
        + ">>"
    )

    def step(groups: Column, branch: Column) -> Column:
        def group(members: Column, counts) -> Column:
            return F.array(
                F.struct(
                    members.alias("members"), *(counts(name).alias(name) for name in COUNTS)
                )
            )

        last = F.try_element_at(groups, F.lit(-1))
        own = F.array(branch["segment"])
        pooled = group(F.concat(last["members"], own), lambda n: last[n] + branch[n])
        alone = group(own, lambda n: branch[n])
        joins = (F.size(groups) > 0) & F.coalesce(_similar(last, branch), F.lit(False))
        return F.when(
            joins, F.concat(F.slice(groups, 1, F.size(groups) - 1), pooled)
        ).otherwise(F.concat(groups, alone))

    return F.aggregate(branches, first, step)


def _label(members: Column) -> Column:
    """Members of a group as text; signs of the template's own are escaped."""
    plain = F.transform(
        F.array_sort(members), lambda s: F.replace(F.replace(s, F.lit("*"), F.lit("%2A")), F.lit("|"), F.lit("%7C"))
    )
    return F.concat_ws("|", plain)


def _nodes(rows: DataFrame, level: int) -> DataFrame:
    """host, node, ended counts and the groups of branches below, of one level.

    A segment is a branch of its own if it has at least ``LEAST_PAGES`` pages and one
    in ``LEAST_SHARE`` of its node's; so a node has at most ``LEAST_SHARE`` of them.
    """
    following = F.try_element_at("segments", F.lit(level + 1))
    ends = F.size("segments") < level
    children = (
        rows.select(
            "host",
            "node",
            F.when(~ends, F.try_element_at("segments", F.lit(level))).alias("segment"),
            "pages",
            F.col("labelled").cast("int").alias("is_labelled"),
            F.col("is_blocked").cast("int").alias("is_blocked"),
            following.isNull().cast("int").alias("at_end"),
            F.coalesce(following.rlike("^[0-9]"), F.lit(False)).cast("int").alias("at_number"),
        )
        .groupBy("host", "node", "segment")
        .agg(
            F.max("pages").alias("through"),
            F.count(F.lit(1)).alias("pages"),
            F.sum("is_labelled").alias("labelled"),
            F.sum("is_blocked").alias("blocked"),
            F.sum("at_end").alias("ends"),
            F.sum("at_number").alias("numbers"),
        )
    )
    lasting = (F.col("pages") >= LEAST_PAGES) & (
        F.col("pages") * LEAST_SHARE >= F.col("through")
    )
    branch = F.struct(
        (F.col("labelled") > 0).alias("has_labels"),
        F.when(F.col("ends") * 2 >= F.col("pages"), 0)
        .when(F.col("numbers") * 2 >= F.col("pages"), 1)
        .otherwise(2)
        .alias("kind"),
        F.coalesce(
            F.try_divide(F.col("blocked").cast("double"), F.col("labelled")), F.lit(0.0)
        ).alias("share"),
        "segment",
        *COUNTS,
    )
    kept = children.where(F.col("segment").isNull() | lasting)
    return kept.groupBy("host", "node").agg(
        _merged(
            F.array_sort(F.collect_list(F.when(F.col("segment").isNotNull(), branch)))
        ).alias("groups"),
        *(F.sum(name).alias(f"kept_{name}") for name in COUNTS[:3]),
    )


def _sized(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written; sent to every task where they measure little.

    Urls of one host or node then stay where they are. Larger tables are joined by sort
    and merge, with the urls as the side that adaptive execution splits.
    """
    stored = written(rows, label)
    measured = stored.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
    return stored.hint("broadcast" if measured <= SENT_BYTES else "merge")


def _smoothed(blocked: Column, labelled: Column, above: Column) -> Column:
    return (blocked + F.lit(WEIGHT) * above) / (labelled + F.lit(WEIGHT))


def _descended(rows: DataFrame, level: int) -> DataFrame:
    """The rows one level further down, with the counts and the purity of their node."""
    nodes = _sized(_nodes(rows, level), "url-nodes")
    segment = F.try_element_at("segments", F.lit(level))
    met = F.filter("groups", lambda g: F.array_contains(g["members"], segment))
    joined = rows.join(
        nodes.withColumnsRenamed({"host": "n_host", "node": "n_node"}),
        (F.col("host") == F.col("n_host")) & (F.col("node") == F.col("n_node")),
        "left",
    ).withColumn("met", F.try_element_at(met, F.lit(1)))
    named = F.col("met").isNotNull()

    def count(name: str, of: str) -> Column:
        other = F.col(of) - F.coalesce(f"kept_{name}", F.lit(0))
        return F.when(named, F.col("met")[name]).otherwise(other)

    moved = {
        "node": F.concat(
            "node", F.lit("/"), F.when(named, _label(F.col("met.members"))).otherwise("*")
        ),
        "pages": count("pages", "pages"),
        "node_labelled": count("labelled", "node_labelled"),
        "node_blocked": count("blocked", "node_blocked"),
    }
    stays = F.size("segments") < level
    columns = [c for c in rows.columns if c not in moved]
    return joined.select(
        *columns, *(F.when(stays, F.col(k)).otherwise(v).alias(k) for k, v in moved.items())
    ).withColumn(
        "purity",
        F.when(stays, F.col("purity")).otherwise(
            _smoothed(F.col("node_blocked"), F.col("node_labelled"), F.col("purity"))
        ),
    )


def url_verdicts(
    pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", depth: int = DEPTH
) -> DataFrame:
    """Every row with its verdict: key, host, path, rule, verdict, template, purity.

    A rule fits its host and all subdomains where the path starts with its own; the
    longest wins. The rows that rules judge are the labelled ones. From them a tree of
    templates is learned for each host, level by level: a segment that few of its node's
    pages share becomes the wildcard ``*``, branches that do not differ in labels and in
    what follows are merged (``de|fr``), and the share of blocked pages of a template is
    smoothed by that of the template above it, the host's by that of all labelled rows.
    Rows without a rule are blocked where that share is above ``REJECT_ABOVE``.

    Levels beyond ``depth`` count as one. A level is one aggregation by (host, node,
    segment), reduced in the map stage, one by (host, node) over branches that last, at
    most ``LEAST_SHARE`` a node, and a join with these, sent to all tasks while they measure
    ``SENT_BYTES`` at most. Levels are written, so a lost executor costs one at most. Rules become one
    expression and are meant to be few.

    NULL urls and urls without ``://`` have an empty host and path and are one host's
    pages, with nothing below. Repeated rows and NULL keys keep their place and count
    each. Without labelled rows, and in an empty table, every share is a half and
    nothing is rejected. Further columns are not read.
    """
    host, path = F.col("host"), F.col("path")
    parsed = pages.select(
        F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    judged = parsed.select(
        key,
        "host",
        "path",
        matching(rules, host, path, lambda r: F.lit(r.host + r.path)).alias("rule"),
        matching(rules, host, path, lambda r: F.lit(r.verdict)).alias("said"),
        _segments(path, depth).alias("segments"),
    )
    judged = written(
        judged.withColumn("labelled", F.col("said").isNotNull()).withColumn(
            "is_blocked", F.coalesce(F.col("said") == "block", F.lit(False))
        ),
        "urls",
    )
    hosts = _sized(
        judged.groupBy("host").agg(
            F.count(F.lit(1)).alias("pages"),
            F.sum(F.col("labelled").cast("int")).alias("node_labelled"),
            F.sum(F.col("is_blocked").cast("int")).alias("node_blocked"),
            F.max(F.size("segments")).alias("levels"),
        ),
        "url-hosts",
    )
    labelled, blocked, levels = hosts.agg(
        F.coalesce(F.sum("node_labelled"), F.lit(0)),
        F.coalesce(F.sum("node_blocked"), F.lit(0)),
        F.coalesce(F.max("levels"), F.lit(0)),
    ).first()
    overall = F.lit((blocked + 1.0) / (labelled + 2.0))
    rows = judged.join(hosts.drop("levels"), "host").select(
        *judged.columns,
        F.lit("").alias("node"),
        "pages",
        "node_labelled",
        "node_blocked",
        _smoothed(F.col("node_blocked"), F.col("node_labelled"), overall).alias("purity"),
    )
    for level in range(1, levels + 1):
        rows = written(_descended(written(rows, "url-rows") if level == 1 else rows, level), "url-rows")
    learned = F.when(F.col("purity") > REJECT_ABOVE, "block").otherwise("allow")
    return rows.select(
        key,
        "host",
        "path",
        "rule",
        F.coalesce("said", learned).alias("verdict"),
        F.concat("host", F.when(F.col("node") == "", "/").otherwise(F.col("node"))).alias("template"),
        "purity",
    )
