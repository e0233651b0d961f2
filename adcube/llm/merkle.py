"""A Merkle manifest of a table, with few levels kept and proofs recomputed from them.

Every row is a leaf; the leaves of a group (``lang``), in order, are the bottom of
a binary tree whose root is the group's; the roots of the groups, in order, are the
bottom of one more tree.  H(x) is the lowercase hex sha256 of x; a node is the H of
its two children's digests, or of its one child where a level ends with an odd one.

*Checkpoint*: of the levels of a tree only every EVERY-th is written, as one row
for each aligned subtree ("block") of 2^EVERY nodes: at most 1 + 1/255 digests a row
are kept instead of 2.  *Recompute*: a proof needs the levels between.  Each block
builds them again from its stored nodes, hands out the siblings on the way from
each of its nodes to its own top, and forgets them; the block above, read first,
gives the rest of the way.  A block is a row, so no task holds more than one
subtree, however large a group is.

Ranks come from one range sort and a count for each range, so a group that holds
most of the rows is numbered by many tasks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

EVERY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = T.StructType().add("side", "string").add("digest", "string")
PATH = T.ArrayType(STEP)


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The digest of one row."""
    return F.sha2(F.concat(*map(field_text, values)), 256)


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, each row's rank in its group (from 0, nulls first), and ``size``,
    the number of the group's rows.  ``rows`` must be a written table: it is read twice.

    Equal rows get neighbouring ranks; which of them gets which one is settled when the
    sorted rows are written.
    """
    by = [*group, *order, "_tie"]  # the tie cuts many equal rows into ranges too
    spread = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stored(spread.drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    runs = placed.groupBy(*group, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))  # a row for each range and group
    all_of = Window.partitionBy(*group)
    before = F.sum("_n").over(all_of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = stored(runs.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_part").alias("_range"), (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_offset"), F.sum("_n").over(all_of).alias("size")))
    return placed.join(runs, _same([(part, "_range"), *((g, f"_{g}") for g in group)])).select(*rows.columns, (F.col("_at") + F.col("_offset")).alias("pos"), "size")


def _same(pairs) -> Column:
    found = F.lit(True)
    for a, b in pairs:
        found &= (F.col(a) if isinstance(a, str) else a).eqNullSafe(F.col(b))
    return found


# --------------------------------------------------------------------- subtrees

def _levels(nodes: list[str], rise: int) -> list[list[str]]:
    """The nodes and ``rise`` levels above them."""
    out = [nodes]
    for _ in range(rise):
        row = out[-1]
        out.append([hashlib.sha256("".join(row[i : i + 2]).encode()).hexdigest() for i in range(0, len(row), 2)])
    return out


def _rise(size: int, level: int, every: int) -> int:
    """Levels from ``level`` to the next one kept, or to the root of a tree of ``size`` leaves."""
    return max(0, min(every, (size - 1).bit_length() - level))


@dataclass
class Tree:
    """The kept levels of the trees of all groups, as blocks (``levels[0]`` has the leaves), and the groups' roots."""

    group: list[str]
    every: int
    levels: list[DataFrame]  # group, size, block, nodes
    roots: DataFrame  # group, digest


def tree(rows: DataFrame, group: list[str], order: list[str], carry: list[str], every: int = EVERY) -> Tree:
    """Trees over ``rows`` (written; with ``digest``), one for each group; leaves keep ``carry``."""
    nodes = stored(numbered(rows, group, order))
    height = max((nodes.agg(F.max("size")).first()[0] or 0) - 1, 0).bit_length()
    levels, roots = [], None
    for level in range(0, max(height, 1), every):
        row = F.struct("pos", "digest", *(carry if level == 0 else []))
        blocks = nodes.groupBy(*group, "size", F.shiftright("pos", every).alias("block")).agg(F.sort_array(F.collect_list(row)).alias("nodes"))
        levels.append(stored(blocks))
        tops = _tops(levels[-1], group, level, every)
        done = F.col("size") <= F.lit(1 << (level + every))
        ended, nodes = tops.where(done).select(*group, "digest"), tops.where(~done)
        roots = ended if roots is None else roots.unionByName(ended)
    return Tree(group, every, levels, stored(roots))


def _tops(blocks: DataFrame, group: list[str], level: int, every: int) -> DataFrame:
    """The top node of every block: a node of the next level kept."""

    def run(batches):
        for batch in batches:
            nodes, size = batch.column("nodes").to_pylist(), batch.column("size").to_pylist()
            top = [_levels(row, _rise(s, level, every))[-1][0] for row, s in zip(nodes, size)]
            yield pa.RecordBatch.from_arrays([*[batch.column(g) for g in group], batch.column("size"), batch.column("block"), pa.array(top, pa.string())], [*group, "size", "pos", "digest"])

    schema = T.StructType([blocks.schema[g] for g in group]).add("size", "long").add("pos", "long").add("digest", "string")
    return blocks.select(*group, "size", "block", F.col("nodes.digest").alias("nodes")).mapInArrow(run, schema)


def paths(t: Tree, above: DataFrame) -> DataFrame:
    """Each leaf with its ``path``: from the leaf up, the side its sibling is on (``left``,
    ``right``, ``none``) and the sibling's digest.

    ``above`` holds, for each group, the ``path`` from its root on and columns that its
    leaves shall get.  Interior nodes live only while their block is worked on.
    """
    given = [c for c in above.columns if c not in (*t.group, "path")]
    ends = above.withColumn("pos", F.lit(0).cast("long"))
    down = None  # paths of the nodes of the level above
    for k in reversed(range(len(t.levels))):
        level, blocks = k * t.every, t.levels[k]
        tall = F.col("size") > F.lit(1 << (level + t.every))
        joined = _with_path(blocks.where(~tall), ends, t.group)
        if down is not None:
            joined = joined.unionByName(_with_path(blocks.where(tall), down, t.group))
        node = blocks.schema["nodes"].dataType.elementType
        schema = T.StructType([blocks.schema[g] for g in t.group] + node.fields).add("path", PATH)
        for c in given:
            schema = schema.add(above.schema[c])
        rows = joined.mapInArrow(_siblings(t.group, node.names, given, level, t.every), schema)
        down = rows if k == 0 else stored(rows.select(*t.group, "pos", "path", *given))
    return down


def _with_path(blocks: DataFrame, tops: DataFrame, group: list[str]) -> DataFrame:
    keys = [*group, "pos"]
    right = tops.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in tops.columns])
    return blocks.join(right, _same([("block", "_pos"), *((g, f"_{g}") for g in group)])).drop(*[f"_{c}" for c in keys])


def _siblings(group: list[str], names: list[str], given: list[str], level: int, every: int):
    """Blocks to one row for each of their nodes, with its path."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # a block at a time
                block = {n: batch.column(n)[i] for n in batch.schema.names}
                nodes = block["nodes"].values
                rows = _levels(nodes.field("digest").to_pylist(), _rise(block["size"].as_py(), level, every))
                rest = block["path"].as_py()
                rest_sides, rest_digests = [s["side"] for s in rest], [s["digest"] for s in rest]
                n, sides, digests = len(nodes), [], []
                for at in range(n):
                    for row in rows[:-1]:
                        other = at ^ 1
                        there = other < len(row)
                        sides.append(("left" if other < at else "right") if there else "none")
                        digests.append(row[other] if there else None)
                        at >>= 1
                    sides += rest_sides
                    digests += rest_digests
                step = pa.StructArray.from_arrays([pa.array(sides, pa.string()), pa.array(digests, pa.string())], ["side", "digest"])
                width = len(rows) - 1 + len(rest)
                path = pa.ListArray.from_arrays(pa.array(range(0, (n + 1) * width, width) if width else [0] * (n + 1), pa.int32()), step)
                same = [pa.repeat(block[c], n) for c in (*group, *given)]
                columns = [*same[: len(group)], *(nodes.field(c) for c in names), path, *same[len(group) :]]
                yield pa.RecordBatch.from_arrays(columns, [*group, *names, "path", *given])

    return run


# --------------------------------------------------------------------- manifest

@dataclass
class Manifest:
    """The trees of the groups, the tree over their roots, and the ``root`` of all (one row; none for an empty table)."""

    groups: Tree
    top: Tree
    root: DataFrame


def manifest(leaves: DataFrame, group: str = "lang", order: str = "doc_id", every: int = EVERY) -> Manifest:
    """The manifest of ``leaves``: ``digest``, the group, the order and whatever proofs shall carry.

    Null groups and ids come first; rows of one id go by their digest, and equal rows are
    leaves of their own.  Columns may have any names.
    """
    leaves = stored(leaves.select(F.col(group).alias("key"), F.col(order).alias("id"), "digest", F.struct(*leaves.columns).alias("row")))
    groups = tree(leaves, ["key"], ["id", "digest"], ["row"], every)
    top = tree(groups.roots, [], ["key"], ["key"], every)
    return Manifest(groups, top, top.roots.select(F.col("digest").alias("root")))


def proofs(m: Manifest) -> DataFrame:
    """``key`` (the group), ``pos``, ``digest``, ``row`` (the leaf's columns), ``path``, ``subroot``, ``root`` of every leaf."""
    end = m.root.select(F.array().cast(PATH).alias("path"), "root")
    above = paths(m.top, end).select("key", "path", F.col("digest").alias("subroot"), "root")
    return paths(m.groups, stored(above))


def folded(digest: Column, path: Column | str) -> Column:
    """The root that follows from a leaf's digest and the siblings on its path."""
    both = lambda acc, s: F.when(s["side"] == "left", F.concat(s["digest"], acc)).when(s["side"] == "right", F.concat(acc, s["digest"])).otherwise(acc)
    return F.aggregate(path, digest, lambda acc, s: F.sha2(both(acc, s), 256))


def siblings(path: Column | str) -> Column:
    """Digests of the siblings, from the leaf's to the root's."""
    return F.transform(F.filter(path, lambda s: s["digest"].isNotNull()), lambda s: s["digest"])
