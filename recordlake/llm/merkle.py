"""A Merkle manifest of a dataset, and what tampered leaves make of it."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.llm.frames import written

FAN = 3
LEVELS = 7  # an aligned block holds FAN ** LEVELS nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ALL = "="  # the one group of the tree over subroots


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class PersistentTree:
    """A tree whose nodes are never changed: a new leaf copies its ancestors only.

    Nodes are numbered in the order they are made; ``children`` holds each
    node's (none of a leaf). ``replace`` returns the root of a new version that
    shares every node but the copied ones.
    """

    def __init__(self, leaves: list[str], fan: int, levels: int | None):
        """``levels``: how many levels a block has; None ends at a single node."""
        self.fan = fan
        self.digests = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        nodes, self.height = list(range(len(leaves))), 0
        while len(nodes) > 1 if levels is None else self.height < levels:
            nodes = [self.node(nodes[at : at + fan]) for at in range(0, len(nodes), fan)]
            self.height += 1
        (self.root,) = nodes

    def node(self, children) -> int:
        self.children.append(tuple(children))
        self.digests.append(digest(*[self.digests[c] for c in children]))
        return len(self.digests) - 1

    def slots(self, leaf: int) -> list[int]:
        """The child to take at each node from the root down to a leaf."""
        return [leaf // self.fan**level % self.fan for level in reversed(range(self.height))]

    def path(self, leaf: int) -> list[tuple[list[str], list[str]]]:
        """Level by level from the leaf up: digests of the siblings before it and after it."""
        at, found = self.root, []
        for slot in self.slots(leaf):
            held = [self.digests[c] for c in self.children[at]]
            found.append((held[:slot], held[slot + 1 :]))
            at = self.children[at][slot]
        return found[::-1]

    def replace(self, leaf: int, value: str) -> int:
        """A version with another leaf: the number of its root."""
        way, at = [], self.root
        for slot in self.slots(leaf):
            way.append((self.children[at], slot))
            at = self.children[at][slot]
        self.digests.append(value)
        self.children.append(())
        new = len(self.digests) - 1
        for held, slot in reversed(way):
            new = self.node([*held[:slot], new, *held[slot + 1 :]])
        return new

    def forget(self, since: int) -> None:
        """Drop the nodes of versions no longer asked for."""
        del self.digests[since:], self.children[since:]


def written_path(path: list[tuple[list[str], list[str]]]) -> str:
    """Levels joined by `;`, each the siblings before and after, with `|` between."""
    return ";".join("".join(left) + "|" + "".join(right) for left, right in path)


def joined(lower: str, upper: str) -> str:
    return f"{lower};{upper}" if lower and upper else lower or upper


def climb(value: str, path: str) -> list[str]:
    """The digests of the ancestors a version copies along a written path."""
    copies = []
    for level in path.split(";") if path else ():
        left, _, right = level.partition("|")
        value = digest(left, value, right)
        copies.append(value)
    return copies


def leaf_digest(fields: list[Column]) -> Column:
    """H of the fields, each `-` if null, else its UTF-8 length, `:` and itself."""
    parts = []
    for field in fields:
        text = field.cast("string")
        spelt = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(spelt, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Stored ``rows`` with ``pos``, their place in their ``grp``, and ``n``, its size.

    Rows are range-partitioned by group and ``order``, so a group of any size is
    spread over tasks; each task numbers its own rows, and what the tasks
    before it hold of the group is added from one row per task and group.
    """
    spread = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    stored = written(
        spread.withColumn("task", F.spark_partition_id()).withColumn(
            "at", F.monotonically_increasing_id()
        ),
        label,
    )
    held = stored.groupBy("grp", "task").agg(F.min("at").alias("first"), F.count("*").alias("k"))
    before = Window.partitionBy("grp").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        "grp",
        "task",
        (F.coalesce(F.sum("k").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("k").over(Window.partitionBy("grp")).alias("n"),
    )
    placed = stored.join(held, ["grp", "task"]).withColumn("pos", F.col("at") + F.col("shift"))
    return placed.drop("task", "at", "shift")


def by_block(rows: DataFrame, size: int, *order: str) -> DataFrame:
    """Rows dealt out by aligned block and sorted within it."""
    block = rows.withColumn("block", F.floor(F.col("pos") / size))
    return block.repartition("grp", "block").sortWithinPartitions("grp", "block", *order)


def runs(batches: Iterator[pa.RecordBatch]):
    """(group, block), rows of each run of sorted rows; rows start with group and block."""

    def rows():
        for batch in batches:
            yield from zip(*[column.to_pylist() for column in batch.columns])

    return groupby(rows(), key=lambda row: row[:2])


def batch_of(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=t) for c, t in zip(columns, types)], names=names
    )


def block_paths(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """(grp, pos, n, block, path, top): each node's path to the top of its block.

    ``nodes`` is (grp, pos, n, digest). A group that fits in one block ends at
    its single node; all blocks of a larger one have all ``levels``.
    """
    size = fan**levels
    names = ["grp", "block", "pos", "n", "path", "top"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        for (grp, block), rows in runs(batches):
            held = list(rows)
            n = held[0][3]
            tree = PersistentTree([r[4] for r in held], fan, levels if n > size else None)
            top = tree.digests[tree.root]
            out = [
                (grp, block, r[2], n, written_path(tree.path(i)), top) for i, r in enumerate(held)
            ]
            yield batch_of(out, names, types)

    dealt = by_block(nodes, size, "pos").select("grp", "block", "pos", "n", "digest")
    return dealt.mapInArrow(run, "grp string, block bigint, pos bigint, n bigint, path string, top string")


def full_paths(nodes: DataFrame, fan: int, levels: int, label: str) -> DataFrame:
    """(grp, pos, path, root) of nodes (grp, pos, n, digest): their paths to their group's root.

    Blocks become the nodes of the next tier until every group is one block.
    Each tier is smaller by the size of a block and stored.
    """
    size = fan**levels
    paths = written(block_paths(nodes, fan, levels), label)
    if not paths.where(F.col("n") > size).take(1):
        return paths.select("grp", "pos", "path", F.col("top").alias("root"))
    tops = paths.groupBy("grp", "block").agg(F.min("n").alias("n"), F.min("top").alias("digest"))
    upper = full_paths(
        tops.select("grp", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), "digest"),
        fan,
        levels,
        label,
    ).select("grp", F.col("pos").alias("block"), F.col("path").alias("upper"), "root")
    return _extended(paths.join(upper, ["grp", "block"]), "root")


def _extended(rows: DataFrame, root: str) -> DataFrame:
    path = F.concat_ws(
        ";", *[F.when(F.col(c) != "", F.col(c)) for c in ("path", "upper")]
    )
    return rows.select("grp", "pos", path.alias("path"), F.col(root).alias("root"))


def manifest(
    df: DataFrame,
    *,
    fields: tuple[str, ...] = FIELDS,
    id_column: str = "doc_id",
    group: str = "source",
    tampered: dict[str, Column] | None = None,
    touched: Column | None = None,
    fan: int = FAN,
    levels: int = LEVELS,
) -> DataFrame:
    """A Merkle tree over all rows, a proof for each, and its version with that row tampered.

    A row's leaf is the hash of its ``fields``. Leaves ascend by ``id_column``
    in each ``group``; every ``fan`` consecutive nodes (the last run may be
    shorter, even one) become their hash until one node is left, the subroot.
    Subroots, ordered by group (null first, then bytes), give the root alike.

    Where ``touched``, the columns ``tampered`` replace their namesakes, and
    the tampered leaf makes a version of the tree: a persistent tree copies its
    ancestors within the leaf's aligned block of ``fan ** levels`` leaves and
    shares all other nodes; the copies go on through the upper tiers along the
    stored path of the block. A row not touched folds its own leaf.

    Returns the id column and ``leaf``, ``position`` (in the group),
    ``subroot``, ``root``, ``proof`` (siblings' digests from the leaf up,
    joined), ``copied`` (the ancestors the version copied, from the leaf's
    parent to the root, comma-joined; for a row not touched those of the tree),
    ``folded_root`` and ``verified``. Other columns are not carried, so none
    can clash.

    Nulls are hashed as `-`. A null id comes first in its group and is touched
    only if ``touched`` says so (null counts as no); rows of one id are ordered
    by their leaves, and repeated rows stay, each a leaf. A group of one row is
    its own subroot, and where there is one group its subroot is the root. An
    empty table gives no rows.

    Texts are read once; from then on rows of a few hashes move. A group of any
    size is spread over tasks, and no task holds more than a block at once.
    """
    tampered, size = tampered or {}, fan**levels
    own = [F.col(f"`{c}`") for c in fields]
    other = [tampered.get(c, F.col(f"`{c}`")) for c in fields]
    touch = F.coalesce(touched, F.lit(False)) if touched is not None else F.lit(False)
    name = F.col(f"`{group}`").cast("string")
    leaves = written(
        df.select(
            F.coalesce(F.concat(F.lit(ALL), name), F.lit("")).alias("grp"),
            F.col(f"`{id_column}`").alias("id"),
            leaf_digest(own).alias("leaf"),
            F.when(touch, leaf_digest(other)).alias("tampered"),
        ),
        "leaves",
    )
    # stored rows have a number of their own, which spreads rows alike in all else
    stored = leaves.select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    ordered = written(
        numbered(stored, ["id", "leaf", "file", "row"], "ordered").drop("file", "row"), "placed"
    )

    blocks = written(_tops(ordered, fan, levels), "tops")
    nodes = blocks.select(
        "grp", F.col("block").alias("pos"), F.ceil(F.col("n") / size).alias("n"), "digest"
    )
    above = full_paths(nodes, fan, levels, "tiers")
    subroots = above.groupBy("grp").agg(F.min("root").alias("digest"))
    ranked = numbered(
        subroots.select(F.lit(ALL).alias("grp"), F.col("grp").alias("name"), "digest"),
        ["name"],
        "subroots",
    )
    ranked = written(ranked, "subroots")
    last = full_paths(ranked.select("grp", "pos", "n", "digest"), fan, levels, "root")
    last = ranked.select("pos", F.col("name").alias("grp"), F.col("digest").alias("subroot")).join(
        last.select("pos", F.col("path").alias("upper"), F.col("root").alias("whole")), "pos"
    )
    whole = above.drop("root").join(last.drop("pos"), "grp")
    path = F.concat_ws(";", *[F.when(F.col(c) != "", F.col(c)) for c in ("path", "upper")])
    routes = written(
        whole.select("grp", F.col("pos").alias("block"), path.alias("path"), "subroot", "whole"),
        "routes",
    )
    return _versions(ordered, routes, id_column, fan, levels)


def _tops(ordered: DataFrame, fan: int, levels: int) -> DataFrame:
    """(grp, block, n, digest): the top of every aligned block of leaves."""
    size = fan**levels
    names = ["grp", "block", "n", "digest"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        out = []
        for (grp, block), rows in runs(batches):
            held = list(rows)
            n = held[0][2]
            tree = PersistentTree([r[3] for r in held], fan, levels if n > size else None)
            out.append((grp, block, n, tree.digests[tree.root]))
            if len(out) == 4096:
                yield batch_of(out, names, types)
                out = []
        yield batch_of(out, names, types)

    dealt = by_block(ordered, size, "pos").select("grp", "block", "n", "leaf")
    return dealt.mapInArrow(run, "grp string, block bigint, n bigint, digest string")


def _versions(
    ordered: DataFrame, routes: DataFrame, id_column: str, fan: int, levels: int
) -> DataFrame:
    """The result's rows: each block's rows meet the route of the block, which sorts first."""
    size = fan**levels
    kind = ordered.schema["id"].dataType
    none = F.lit(None).cast("string")
    rows = ordered.select(
        "grp", "pos", "n", "id", "leaf", "tampered", none.alias("a"), none.alias("b"), none.alias("c")
    )
    heads = routes.select(
        "grp",
        (F.col("block") * size).alias("pos"),
        F.lit(-1).cast("bigint").alias("n"),
        F.lit(None).cast(kind).alias("id"),
        none.alias("leaf"),
        none.alias("tampered"),
        F.col("path").alias("a"),
        F.col("subroot").alias("b"),
        F.col("whole").alias("c"),
    )
    dealt = by_block(rows.unionByName(heads), size, "pos", "n").select(
        "grp", "block", "n", "leaf", "tampered", "a", "b", "c", "id", "pos"
    )
    names = [
        "id", "position", "leaf", "subroot", "root", "proof", "copied", "folded_root", "verified",
    ]

    def run(batches):
        kinds = [pa.int64(), *[pa.string()] * 6, pa.bool_()]
        for (grp, block), found in runs(batches):
            head, *held = found
            upper, subroot, root = head[5:8]
            n = held[0][2]
            tree = PersistentTree([r[3] for r in held], fan, levels if n > size else None)
            base, out = len(tree.digests), []
            for i, row in enumerate(held):
                path = joined(written_path(tree.path(i)), upper)
                new = tree.replace(i, row[3] if row[4] is None else row[4])
                within = tree.digests[len(tree.digests) - tree.height :] if tree.height else []
                copied = [*within, *climb(tree.digests[new], upper)]
                folded = copied[-1] if copied else tree.digests[new]
                tree.forget(base)
                proof = path.replace("|", "").replace(";", "")
                out.append(
                    (row[9], row[3], subroot, root, proof, ",".join(copied), folded, folded == root)
                )
            body = batch_of(out, names[1:], kinds)
            ids = pa.array([r[8] for r in held], type=id_type)
            yield pa.RecordBatch.from_arrays([ids, *body.columns], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(kind)
    schema = (
        f"id {kind.simpleString()}, position bigint, leaf string, subroot string, root string, "
        "proof string, copied string, folded_root string, verified boolean"
    )
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id_column)
