"""Merkle dataset manifest: a content-addressed DAG of digests, and proofs by descent.

Leaves are ordered inside their group (a language, say). Every ``fan_out`` consecutive nodes
become one record, digest -> children, whose digest is the hash of the children's, until one
node is left: the group's subroot. The subroots, ordered by group, are the leaves of one more
such tree, whose last node is the root. Records are written once, by height above the leaves.

A proof is found from the root downwards. A leaf is asked for by its rank; the digits of the
rank in base ``fan_out`` say which child to take at each height. Requests with the same leading
digits are one row, which looks its digest up among the records of its height, fans out to the
children asked for, and takes the digests of the others along as a path segment. Reversed, the
segments lead from the leaf to the root.

Ranks come from a range partitioning by (group, order): each task numbers its own sorted rows,
and offsets are sums over one row per (partition, group). No group is ever in one task, and
the heights of the trees are the only thing the driver loops over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinemetrics.llm.common import settle
from cinemetrics.operators.broadcast import broadcast_if_bounded

FAN_OUT = 8
_ROW_BITS = 33  # of monotonically_increasing_id: the row's number in its partition


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the fields of a row, one after the other."""
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def fold(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` leads to along the segments of a proof."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_text(path: Column) -> Column:
    """The digests of a proof one after the other, from the leaf to the root, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & a[c].eqNullSafe(b[c])
    return on


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (settled) with _i, the rank inside _group by ``order``, and _n, the group's rows."""
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in ["_group", *order, "_tie"]]
    placed = tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    placed = settle(placed.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", _ROW_BITS))
    parts = placed.groupBy("_group", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy("_group")
    before = F.sum("_rows").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select(
        F.col("_group").alias("_g"), F.col("_part").alias("_p"),
        (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(group).alias("_n"),
    )
    known = placed.join(
        broadcast_if_bounded(offsets), placed["_group"].eqNullSafe(offsets["_g"]) & (placed["_part"] == offsets["_p"])
    )
    return known.withColumn("_i", F.col("_at") + F.col("_shift")).drop("_g", "_p", "_shift", "_at", "_part")


def _parents(nodes: DataFrame, fan_out: int, *extra: str) -> DataFrame:
    """One record (_group, _i, _n, digest, children, ...) for every ``fan_out`` consecutive nodes."""
    members = F.array_sort(F.collect_list(F.struct("_i", "digest", *extra)))
    runs = nodes.groupBy("_group", F.expr(f"_i div {fan_out}").alias("_i"), F.expr(f"(_n - 1) div {fan_out} + 1").alias("_n"))
    found = runs.agg(members.alias("members")).withColumn("children", F.col("members.digest"))
    return found.withColumn("digest", F.sha2(F.array_join("children", ""), 256))


@dataclass(frozen=True)
class Tree:
    """The records of all groups: ``heights[h]`` has those h + 1 above the leaves; ``tops`` has
    (_group, height, digest) of the last node of every group; ``members`` the leaves by parent."""

    heights: list[DataFrame]
    tops: DataFrame
    members: DataFrame


def _grow(leaves: DataFrame, fan_out: int, *extra: str) -> Tree:
    """``leaves``: _group, _i, _n, digest and the ``extra`` columns."""
    members = settle(_parents(leaves, fan_out, *extra))
    lone = F.size("children") == 1
    only = (F.col("_n") == 1) & lone
    tops = members.where(only).select("_group", F.lit(0).alias("height"), F.element_at("children", 1).alias("digest"))
    # a group of one leaf has no record: the leaf is its last node
    level = members.where(~only).select("_group", "_i", "_n", "digest", "children")
    heights: list[DataFrame] = []
    while not level.isEmpty():
        heights.append(level)
        done = level.where(F.col("_n") == 1)
        tops = tops.unionByName(done.select("_group", F.lit(len(heights)).alias("height"), "digest"))
        level = settle(_parents(level.where(F.col("_n") > 1), fan_out).drop("members"))
    return Tree(heights, tops, members)


_PATH = "array<struct<left:string,right:string>>"


def _fan(children: Column) -> Column:
    """A row for each child: its place, and the digests before and after it."""
    place = F.sequence(F.lit(1), F.size(children))
    each = F.transform(
        place,
        lambda k: F.struct(
            (k - 1).alias("_digit"),
            F.element_at(children, k).alias("_child"),
            F.struct(
                F.array_join(F.slice(children, F.lit(1), k - 1), "").alias("left"),
                F.array_join(F.slice(children, k + 1, F.size(children)), "").alias("right"),
            ).alias("_segment"),
        ),
    )
    return F.inline(each)


def _descend(tree: Tree, starts: DataFrame, fan_out: int, wanted: DataFrame | None = None) -> DataFrame:
    """From the last node of every group to the parents of the leaves (height 1; 0 for a lone leaf).

    ``starts``: _group, height, digest, path (segments from the root on) and columns to carry.
    """
    carried = [c for c in starts.columns if c not in ("height", "digest", "path", "_group")]
    here = starts.withColumn("_i", F.lit(0).cast("long"))
    arrived = here.where(F.col("height") <= 1)
    above = here.where(F.col("height") > 1).limit(0)
    for h in range(len(tree.heights), 1, -1):
        asking = above.unionByName(here.where(F.col("height") == h))
        store = tree.heights[h - 1].select(F.col("digest").alias("_key"), "children").dropDuplicates(["_key"])
        found = asking.join(store, asking["digest"] == store["_key"])
        fan = found.select("_group", *carried, F.col("_i").alias("_up"), "path", _fan(F.col("children")))
        above = fan.select(
            "_group", *carried, F.lit(h - 1).alias("height"), F.col("_child").alias("digest"),
            F.concat("path", F.array("_segment")).alias("path"), (F.col("_up") * fan_out + F.col("_digit")).alias("_i"),
        )
        if wanted is not None:
            lead = wanted.select("_group", F.expr(f"_rank div {fan_out ** (h - 1)}").alias("_i")).distinct()
            above = above.join(lead, _same(above, lead, ["_group", "_i"]), "left_semi")
    return arrived.unionByName(above)


@dataclass(frozen=True)
class Manifest:
    """The written records of a data set. ``root`` is null for an empty one."""

    leaves: Tree
    groups: Tree
    root: str | None
    fan_out: int

    def records(self) -> DataFrame:
        """(digest, children): every record once, whatever its height."""
        tables = [t.select("digest", "children") for t in self.leaves.heights + self.groups.heights]
        out = self.leaves.members.select("digest", "children").limit(0)
        for t in tables:
            out = out.unionByName(t)
        return out.dropDuplicates(["digest"])


def build_manifest(
    rows: DataFrame, group: str, order: str, digest: str, carry: tuple[str, ...] = (), fan_out: int = FAN_OUT
) -> Manifest:
    """The manifest over ``rows`` with leaf digests in column ``digest``.

    Leaves are ordered by ``order`` inside ``group`` (nulls first, text by its UTF-8 bytes); rows
    with the same order value by digest, equal rows are leaves of their own. ``carry``: columns
    that ``proofs`` returns beside each leaf. Other columns are not read.
    """
    if fan_out < 2:
        raise ValueError("a record has two children at least")
    named = [F.col(f"`{c}`").alias(f"_carry{n}") for n, c in enumerate(carry)]
    plain = rows.select(
        F.col(f"`{group}`").alias("_group"), F.col(f"`{order}`").alias("_order"), F.col(f"`{digest}`").alias("digest"), *named
    )
    extra = [f"_carry{n}" for n in range(len(carry))]
    leaves = _ranked(settle(plain), ["_order", "digest"]).select("_group", "_i", "_n", "digest", *extra)
    tree = _grow(leaves, fan_out, *extra)
    tops = settle(tree.tops.select(F.lit(0).alias("_group"), F.col("_group").alias("_name"), "height", "digest"))
    top = _grow(_ranked(tops, ["_name"]).select("_group", "_i", "_n", "digest", "_name", "height"), fan_out, "_name", "height")
    last = top.tops.first()
    return Manifest(tree, top, last["digest"] if last else None, fan_out)


def _to_leaves(tree: Tree, arrived: DataFrame) -> DataFrame:
    """The members below the parents arrived at, with the last segment of their path."""
    keys = tree.members.select(
        F.col("_group").alias("_g"), F.col("_i").alias("_up"), F.col("digest").alias("_key"), "members", "children"
    )
    whole = F.when(F.col("height") == 0, F.col("children")[0]).otherwise(F.col("_key"))
    on = arrived["_group"].eqNullSafe(keys["_g"]) & (arrived["_i"] == keys["_up"])
    found = arrived.join(keys, on).where(F.col("digest") == whole)
    fan = found.select(*[c for c in arrived.columns if c not in ("_i", "digest")], "members", _fan(F.col("children")))
    path = F.when(F.col("height") == 0, F.col("path")).otherwise(F.concat("path", F.array("_segment")))
    return fan.withColumn("path", path).withColumn("_member", F.element_at("members", F.col("_digit") + 1))


def proofs(manifest: Manifest, carry: tuple[str, ...] = (), wanted: DataFrame | None = None) -> DataFrame:
    """(group, rank, leaf, subroot, root, path, ...carry): one row for every leaf asked for.

    ``path`` has one (left, right) pair of concatenated sibling digests for every record from
    the leaf's own to the root's; both are empty where a record has one child. ``carry`` as given
    to ``build_manifest``. ``wanted`` (group, rank): the leaves asked for, each once; without it all.
    """
    if wanted is not None:
        wanted = wanted.select(F.col("group").alias("_group"), F.col("rank").alias("_rank"))
    starts = manifest.groups.tops.select("_group", "height", "digest", F.array().cast(_PATH).alias("path"))
    named = _to_leaves(manifest.groups, _descend(manifest.groups, starts, manifest.fan_out))
    subroots = named.select(
        F.col("_member._name").alias("_group"), F.col("_member.height").alias("height"),
        F.col("_member.digest").alias("digest"), F.col("_member.digest").alias("subroot"), "path",
    )
    arrived = _descend(manifest.leaves, subroots, manifest.fan_out, wanted)
    at_leaves = _to_leaves(manifest.leaves, arrived)
    out = at_leaves.select(
        F.col("_group").alias("group"), F.col("_member._i").alias("rank"), F.col("_member.digest").alias("leaf"), "subroot",
        F.lit(manifest.root).alias("root"), F.reverse("path").alias("path"),
        *[F.col(f"_member._carry{n}").alias(c) for n, c in enumerate(carry)],
    )
    if wanted is None:
        return out
    asked = wanted.distinct().select(F.col("_group").alias("group"), F.col("_rank").alias("rank"))
    return out.join(asked, _same(out, asked, ["group", "rank"]), "left_semi")
