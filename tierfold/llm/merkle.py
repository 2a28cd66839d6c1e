"""Merkle manifest of a dataset as a persistent tree: a change copies only its ancestors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from tierfold.llm.common import shuffle_partitions, written

HEIGHT = 12  # levels of an aligned block; a block has at most 4,096 nodes at its foot
TOP = ""  # key of the tree over the subroots; keys of the others are not empty
_ROW_MASK = (1 << 33) - 1  # of a row number within its task
_NODES = "tree string, level int, position long, digest string"
_PATHS = "tree string, position long, block long, path array<string>, up string"
_PROVEN = (
    "doc_id long, tree string, position long, leaf string, subroot string, root string,"
    " proof_sha256 string, folded_root string, verified boolean, copied array<string>"
)


def digest_of(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def height_of(nodes: int, height: int = HEIGHT) -> int:
    """Levels until one of ``nodes`` nodes remains, but no more than a block has."""
    return min(height, (nodes - 1).bit_length())


def levels_of(digests: list[str], height: int) -> list[list[str]]:
    """The digests and ``height`` levels above them; every two make one, a last one alone too."""
    levels = [digests]
    for _ in range(height):
        now = levels[-1]
        levels.append([digest_of("".join(now[k : k + 2])) for k in range(0, len(now), 2)])
    return levels


def path_of(levels: list[list[str]], at: int) -> list[str]:
    """The sibling of a node and of each ancestor below the top level.

    Each is its digest behind ``<`` if it stands left and ``>`` if right; an only child has "".
    """
    path = []
    for level in levels[:-1]:
        if at & 1:
            path.append("<" + level[at - 1])
        else:
            path.append(">" + level[at + 1] if at + 1 < len(level) else "")
        at >>= 1
    return path


def folded(digest: str, path: Sequence[str]) -> list[str]:
    """New digests of all ancestors on ``path`` of a node that now has ``digest``."""
    copied = []
    for sibling in path:
        left, right = (sibling[1:], "") if sibling[:1] == "<" else ("", sibling[1:])
        digest = digest_of(left + digest + right)
        copied.append(digest)
    return copied


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the columns: ``-`` for null, else length in bytes, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*(F.coalesce(s, F.lit("-")) for s in sized)), 256)


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``position`` (from 0 within ``tree``, without gaps) and ``n`` (rows of it).

    ``tree`` must not be null. Rows are dealt into ranges of (tree, order, row number), so
    neither a tree that has most rows nor a row that is repeated often is in one task. Each
    range is numbered as it is written; what is summed over ranges is a row for each range
    and tree.
    """
    parts = shuffle_partitions(rows.sparkSession)
    given = written(rows.withColumn("__row", F.monotonically_increasing_id()), "merkle-rows")
    keys = [tree, *order, "__row"]
    ranges = written(
        given.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .select(
            *rows.columns,
            F.spark_partition_id().alias("__range"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK)).alias("__at"),
        ),
        "merkle-ranges",
    )
    whole = Window.partitionBy(tree)
    before = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranges.groupBy("__range", tree).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first")
    )
    starts = counts.select(
        "__range",
        tree,
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__before"),
        F.sum("__n").over(whole).alias("n"),
    )
    placed = ranges.join(starts, ["__range", tree])
    position = (F.col("__before") + F.col("__at")).alias("position")
    return placed.select(*rows.columns, position, "n")


def _blocks(nodes: DataFrame, height: int) -> GroupedData:
    return nodes.groupBy("tree", F.shiftright("position", height))


def _levels(table: pa.Table, height: int) -> tuple[pa.Table, list[list[str]], int]:
    """Nodes of one block in order, the levels over them, and the size of their tree."""
    table = table.sort_by("position")
    n = table.column("n")[0].as_py()
    return table, levels_of(table.column("digest").to_pylist(), height_of(n, height)), n


def _block_root(height: int) -> Callable[[pa.Table], pa.Table]:
    def found(table: pa.Table) -> pa.Table:
        table, levels, n = _levels(table, height)
        return pa.table(
            {
                "tree": table.column("tree").slice(0, 1),
                "position": pa.array([table.column("position")[0].as_py() >> height], pa.int64()),
                "digest": pa.array([levels[-1][0]]),
                "n": pa.array([-(-n >> height)], pa.int64()),
            }
        )

    return found


def _block_paths(height: int) -> Callable[[pa.Table], pa.Table]:
    def found(table: pa.Table) -> pa.Table:
        table, levels, _ = _levels(table, height)
        places = table.column("position").to_pylist()
        paths = [path_of(levels, k) for k in range(len(places))]
        return pa.table(
            {
                "tree": table.column("tree"),
                "position": table.column("position"),
                "block": pa.array([x >> height for x in places], pa.int64()),
                "path": pa.array(paths, pa.list_(pa.string())),
                "up": pa.array([levels[-1][0]] * len(places)),
            }
        )

    return found


def _upper(nodes: DataFrame, height: int) -> DataFrame:
    """The nodes above the blocks of ``nodes`` (tree, position, digest, n)."""
    narrow = nodes.select("tree", "position", "digest", "n")
    schema = "tree string, position long, digest string, n long"
    return written(_blocks(narrow, height).applyInArrow(_block_root(height), schema), "merkle-upper")


def _one_block(nodes: DataFrame, height: int) -> bool:
    """Whether no tree has more nodes than a block."""
    return (nodes.agg(F.max("n")).first()[0] or 0) <= 1 << height


def _paths(nodes: DataFrame, height: int) -> DataFrame:
    """tree, position, ``path`` from there to the root of its tree, and that ``root``.

    One stratum of blocks after the other, upwards as long as a tree has more than one block;
    then the upper paths are put behind the lower ones, one row of them for each block.
    """
    own = written(
        _blocks(nodes, height).applyInArrow(_block_paths(height), _PATHS), "merkle-paths"
    )
    if _one_block(nodes, height):
        return own.select("tree", "position", "path", F.col("up").alias("root"))
    above = _paths(_upper(nodes, height), height).select(
        "tree", F.col("position").alias("block"), F.col("path").alias("rest"), "root"
    )
    return own.join(above, ["tree", "block"]).select(
        "tree", "position", F.concat("path", "rest").alias("path"), "root"
    )


def _proven(height: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def found(leaves: pa.Table, above: pa.Table) -> pa.Table:
        """Proofs and versions of a block of leaves; ``above`` is its row of the upper tree."""
        leaves, levels, _ = _levels(leaves, height)
        subroot, root = (above.column(c)[0].as_py() for c in ("subroot", "root"))
        upper = above.column("path")[0].as_py()
        upper_digests = "".join(s[1:] for s in upper)
        unchanged = folded(levels[-1][0], upper)  # the ancestors above the block
        proofs, roots, copies = [], [], []
        for k, new in enumerate(leaves.column("changed").to_pylist()):
            path = path_of(levels, k)
            proofs.append(digest_of("".join(s[1:] for s in path) + upper_digests))
            way = [levels[0][k] if new is None else new]
            way += folded(way[0], path)
            way += unchanged if way[-1] == levels[-1][0] else folded(way[-1], upper)
            roots.append(way[-1])
            copies.append(None if new is None else way[1:])
        rows = leaves.num_rows
        return pa.table(
            {
                "doc_id": leaves.column("doc_id"),
                "tree": leaves.column("tree"),
                "position": leaves.column("position"),
                "leaf": leaves.column("digest"),
                "subroot": pa.array([subroot] * rows),
                "root": pa.array([root] * rows),
                "proof_sha256": pa.array(proofs),
                "folded_root": pa.array(roots),
                "verified": pa.array([r == root for r in roots]),
                "copied": pa.array(copies, pa.list_(pa.string())),
            }
        )

    return found


def _nodes_of(base: int, height: int) -> Callable[[pa.Table], pa.Table]:
    def found(table: pa.Table) -> pa.Table:
        table, levels, _ = _levels(table, height)
        first, tree = table.column("position")[0].as_py(), table.column("tree")[0].as_py()
        nodes = [
            (tree, base + k, (first >> k) + j, digest)
            for k, level in enumerate(levels)
            for j, digest in enumerate(level)
            if k or not (base or tree == TOP)  # those at the foot are listed below it
        ]
        schema = pa.schema(
            [("tree", pa.string()), ("level", pa.int32()), ("position", pa.int64()), ("digest", pa.string())]
        )
        columns = zip(*nodes, strict=True) if nodes else [[]] * len(schema)
        return pa.table(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    return found


@dataclass(frozen=True)
class Manifest:
    """A tree over leaves, and a version of it for every changed leaf.

    ``leaves`` has tree, position, digest, n and changed; ``trees`` the key, root (as digest)
    and place of every tree in the tree over them, whose key is ``TOP``; ``proofs`` a row for
    each leaf (see ``manifest``).
    """

    leaves: DataFrame
    trees: DataFrame
    proofs: DataFrame
    height: int = HEIGHT

    def nodes(self) -> DataFrame:
        """tree, level (0: leaves), position and digest of all nodes without any change.

        A subroot is the highest node of its own tree; the tree over them begins at level 1.
        """
        found = []
        for nodes in (self.leaves, self.trees):
            nodes, base = nodes.select("tree", "position", "digest", "n"), 0
            while True:
                own = _nodes_of(base, self.height)
                found.append(_blocks(nodes, self.height).applyInArrow(own, _NODES))
                if _one_block(nodes, self.height):
                    break
                nodes, base = _upper(nodes, self.height), base + self.height
        every = found[0]
        for more in found[1:]:
            every = every.union(more)
        return every

    def copies(self) -> DataFrame:
        """The nodes each version has of its own, the changed leaf among them.

        version_tree and version_position name the changed leaf; tree, level, position and
        digest the node. All other nodes of a version are those of ``nodes``.
        """
        own = ["version_tree", "version_position", "tree", "level", "position", "digest"]
        sizes = self.leaves.groupBy("tree").agg(F.first("n").alias("n"))
        depth = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
        places = sizes.select("tree", depth.alias("depth")).join(
            self.trees.select("tree_key", F.col("position").alias("tree_at")),
            F.col("tree") == F.col("tree_key"),
        ).drop("tree_key")
        changed = self.proofs.filter("copied is not null").select(
            "tree", "position", F.posexplode("copied").alias("k", "digest")
        )
        level = F.col("k") + 1
        above = level > F.col("depth")
        inner = changed.join(places, "tree").select(
            F.col("tree").alias("version_tree"), F.col("position").alias("version_position"),
            F.when(above, TOP).otherwise(F.col("tree")).alias("tree"),
            F.when(above, level - F.col("depth")).otherwise(level).cast("int").alias("level"),
            F.when(above, F.expr("shiftright(tree_at, int(k + 1 - depth))"))
            .otherwise(F.expr("shiftright(position, int(k + 1))")).alias("position"),
            "digest",
        )
        leaves = self.leaves.filter("changed is not null").select(
            F.col("tree").alias("version_tree"), F.col("position").alias("version_position"),
            "tree", F.lit(0).alias("level"), "position", F.col("changed").alias("digest"),
        )
        return inner.select(*own).union(leaves.select(*own))


def manifest(
    docs: DataFrame,
    columns: Sequence[str],
    where: Column,
    changes: dict[str, Column],
    group: str = "lang",
    height: int = HEIGHT,
) -> Manifest:
    """A Merkle tree over the rows of ``docs``, and a version for each row that is changed.

    A row is a leaf, the digest of its ``columns``. Rows of one ``group`` make a tree in the
    order of doc_id; its root is the subroot, and the subroots in the order of the group make
    the tree whose root is that of the dataset. Every two nodes in order make one, a last one
    alone too, until one remains.

    Trees are persistent. Where ``where`` holds, a row with the ``changes`` put in place of its
    columns begins a version of its own: it has new nodes on the way to the root alone and
    shares all others.

    1. Leaves, and changed leaves, are hashed where rows are read; texts go no further. They
       are numbered within their trees over ranges (see ``numbered``).
    2. An aligned block of 2 ** ``height`` leaves (4,096) is a unit of work. Block roots are the leaves of the
       next stratum, until each tree has one block; a block has one row of siblings above it.
    3. That row meets the block again, which copies the ancestors of each version within the
       block and continues above it. No unit of work grows with the table, and the versions of
       a stratum are never gathered.

    ``proofs`` has a row for each row: doc_id, tree (null group: ``0``, else ``1`` and the group),
    position, leaf, subroot, root and proof_sha256 (SHA-256 of the siblings' digests from leaf
    to root) of the unchanged trees; folded_root (root of the row's version, or the root folded
    from its leaf if it has none), verified (whether that is ``root``) and copied (digests of
    the copied ancestors from the lowest up; null without a version).

    Nulls: a null in ``columns`` is ``-`` and differs from the empty text; null groups come first
    and are a tree; null ids come first in their tree; a null ``where`` is false. Rows of one id
    follow the order of their digests, so equal rows are leaves side by side. A row whose changes
    alter nothing begins a version with the old digests, which is verified. A tree of one
    leaf has it as subroot, a dataset of one tree its subroot as root. An empty table gives no
    rows. Other columns are not looked at.
    """
    given = [docs[c] for c in columns]
    new = [changes.get(c, docs[c]) for c in columns]
    key = F.coalesce(F.concat(F.lit("1"), docs[group].cast("string")), F.lit("0"))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        key.alias("tree"),
        leaf_digest(given).alias("digest"),
        F.when(where, leaf_digest(new)).alias("changed"),
    )
    leaves = written(numbered(rows, "tree", ["doc_id", "digest", "changed"]), "merkle-leaves")

    blocks = _upper(leaves, height)
    below = _paths(blocks, height)  # a row for each block of leaves
    subroots = below.filter("position = 0").select(
        F.col("tree").alias("tree_key"), F.lit(TOP).alias("tree"), F.col("root").alias("digest")
    )
    trees = written(numbered(subroots, "tree", ["tree_key"]), "merkle-trees")
    top = _paths(trees, height).select("position", F.col("path").alias("rest"), F.col("root"))
    over = trees.select("tree_key", "position").join(top, "position")
    above = written(
        below.withColumnRenamed("root", "subroot")
        .withColumnRenamed("position", "block")
        .join(over.drop("position"), F.col("tree") == F.col("tree_key"))
        .select(
            F.col("tree").alias("of_tree"), "block", F.concat("path", "rest").alias("path"),
            "subroot", "root",
        ),
        "merkle-above",
    )
    proofs = (
        _blocks(leaves, height)
        .cogroup(above.groupBy("of_tree", "block"))
        .applyInArrow(_proven(height), _PROVEN)
    )
    return Manifest(leaves, trees, proofs, height)
