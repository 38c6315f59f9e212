"""Merkle manifest of a table, with a proof for every row.

A row is a leaf: the digest of its named fields. The leaves of each tree (rows of one value of a
column) are ordered, and while several nodes remain, each run of eight neighbours becomes their digest.
What remains of each tree is in turn a leaf of the tree on top, whose last node is the root.

Digests are merged as an associative sparse-forest monoid. An element is a set of nodes keyed by tree,
level and index. Two elements are put together as the union of their nodes; whenever all siblings of a
run are there, which the known size of the tree tells, they give way to their parent, and so on up. The
order and grouping of merges don't matter. Leaves are dealt to blocks of neighbours, so a block's
element is some nodes at its two ends, a few for each level. Blocks are merged by a tree reduction whose
rounds are written out, `FAN` neighbours at a time, until the root alone is left: no task and no driver
ever sees more than that.

Each merge also tells for its nodes what siblings they have met on their way up and at which node they
still wait. Proofs are these ways put together, from the last round down to the leaves.

Cases: a null field is `-`, so a null text and an empty one are different leaves; a null tree value is a
tree of its own and the first; null ids come first in their tree; equal ids are ordered by their leaf
digests, and repeated rows are leaves as often as they occur, each with its own proof; very long texts
are hashed whole; an empty table has no row and no root; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm._common import column_rows, record_batch, small_side
from helixframe.operators.workqueue import numbered
from helixframe.storage import release, scratch

ARITY = 8
#: Leaves of a block, and elements that are merged at once.
BLOCK_ROWS, FAN = 50_000, 32
#: The tree whose leaves are the subroots of the others.
TOP = -1
_DIGEST = 64  # characters of a digest

Key = tuple[int, int, int]  # tree, level, index


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def level_size(size: int, level: int) -> int:
    """Nodes of a level of a tree of so many leaves."""
    for _ in range(level):
        size = -(-size // ARITY)
    return size


def run_of(size: int, key: Key) -> tuple[int, int]:
    """The first index of a node's run, and the number of nodes in it."""
    start = key[2] // ARITY * ARITY
    return start, min(ARITY, level_size(size, key[1]) - start)


def placed(size: int, key: Key) -> Key:
    """Where a node stands: the last of a tree is a leaf of the tree on top, at the tree's number."""
    return (TOP, 0, key[0]) if key[0] != TOP and level_size(size, key[1]) == 1 else key


class Element:
    """Unresolved nodes, and the way up of those that were put in."""

    def __init__(self, trees: int):
        self.sizes, self.nodes = {TOP: trees}, {}
        self.parent: dict[Key, tuple[str, Key]] = {}  # siblings of a resolved node, and its parent

    def add(self, nodes: dict[Key, str], sizes: dict[int, int]) -> list[Key]:
        """The monoid's operation: takes nodes in and resolves every run that is now whole. Returns
        the nodes as they are placed."""
        self.sizes |= sizes
        put = {placed(self.sizes[k[0]], k): d for k, d in nodes.items()}
        self.nodes |= put
        touched = {(t, level, i // ARITY) for t, level, i in put}
        while touched:
            after = set()
            for tree, level, run in touched:
                size = self.sizes[tree]
                start, many = run_of(size, (tree, level, run * ARITY))
                keys = [(tree, level, i) for i in range(start, start + many)]
                if level_size(size, level) == 1 or any(k not in self.nodes for k in keys):
                    continue
                digests = [self.nodes.pop(k) for k in keys]
                above = placed(size, (tree, level + 1, run))
                for n, k in enumerate(keys):
                    self.parent[k] = "".join(digests[:n] + digests[n + 1 :]), above
                self.nodes[above] = digest_of("".join(digests))
                after.add((above[0], above[1], above[2] // ARITY))
            touched = after
        return list(put)

    def way(self, key: Key, known: dict[Key, tuple[str, Key]]) -> tuple[str, Key]:
        """Siblings from a node up, and the unresolved node where its way ends."""
        if key not in self.parent:
            return "", key
        if key not in known:
            own, above = self.parent[key]
            more, end = self.way(above, known)
            known[key] = own + more, end
        return known[key]


def fold(digest: str, path: str, size: int, tree: int, index: int, trees: int) -> tuple[str, str]:
    """(subroot, root) of a leaf and the siblings on its way, level by level from left to right."""
    key, at, subroot = placed(size, (tree, 0, index)), 0, None
    while True:
        if key[0] == TOP and subroot is None:
            subroot, size = digest, trees
        if key[0] == TOP and level_size(size, key[1]) == 1:
            return subroot, digest
        start, many = run_of(size, key)
        cut, end = at + (key[2] - start) * _DIGEST, at + (many - 1) * _DIGEST
        digest, at = digest_of(path[at:cut] + digest + path[cut:end]), end
        key = placed(size, (key[0], key[1] + 1, key[2] // ARITY))


def encoded(field: Column) -> Column:
    """`-` for null, else the bytes of the value's text, a colon and the text."""
    text = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, fields)), 256)


_LEAF = pa.struct([("id", pa.int64()), ("leaf", pa.string()), ("other", pa.string())])
_NODE = [("tree", pa.int64()), ("level", pa.int32()), ("index", pa.int64()), ("size", pa.int64())]
_WAY = [("above", pa.string()), ("end_tree", pa.int64()), ("end_level", pa.int32()), ("end_index", pa.int64())]
_FOLDED = pa.schema([("block", pa.int64()), *_NODE, ("digest", pa.string()), ("leaves", pa.list_(_LEAF)), ("whole", pa.bool_()), *_WAY])
_FOLDED_DDL = "block long, tree long, level int, index long, size long, digest string, leaves array<struct<id: long, leaf: string, other: string>>, whole boolean, above string, end_tree long, end_level int, end_index long"
_MERGED = pa.schema([("block", pa.int64()), *_NODE, ("digest", pa.string()), *_WAY])
_MERGED_DDL = "block long, tree long, level int, index long, size long, digest string, above string, end_tree long, end_level int, end_index long"
_END = ["end_tree", "end_level", "end_index"]


def _left(element: Element, block: int, width: int) -> list[tuple]:
    """Rows of the nodes that are still unresolved."""
    return [(block, *key, element.sizes[key[0]], digest, *[None] * width) for key, digest in element.nodes.items()]


def _blocks(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Rows by their first column, whose values lie together."""
    block, held = None, []
    for batch in batches:
        for row in column_rows(batch, names):
            if row[0] != block:
                if held:
                    yield block, held
                block, held = row[0], []
            held.append(row)
    if held:
        yield block, held


def _fold_leaves(trees: int):
    """Of each block, rows of its leaves run by run with their way up, and of its unresolved nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(["block", "tree", "first", "size", "id", "leaf", "other"], batches):
            element, nodes, sizes, at, tree = Element(trees), {}, {}, 0, None
            leaves = []
            for _, now, first, size, id_, leaf, other in rows:
                at, tree = (at + 1 if now == tree else first), now
                nodes[now, 0, at], sizes[now] = leaf, size
                leaves.append((now, at, size, {"id": id_, "leaf": leaf, "other": other}))
            element.add(nodes, sizes)
            out, known, k = [], {}, 0
            while k < len(leaves):
                tree, at, size, _ = leaves[k]
                key = placed(size, (tree, 0, at))
                many = run_of(size, key)[1] if key[0] == tree and key in element.parent else 1
                whole = key[0] == tree and key in element.parent
                above, end = element.way(element.parent[key][1] if whole else key, known)
                out.append((block, tree, 0, at, size, None, [x[3] for x in leaves[k : k + many]], whole, above, *end))
                k += many
            for low in range(0, len(out), 1000):
                yield record_batch(out[low : low + 1000], _FOLDED)
            yield record_batch(_left(element, block, 6), _FOLDED)

    return run


def _merge(trees: int):
    """Elements of a group of blocks as one: the way up of each node, and what is left unresolved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _blocks(["block", "tree", "level", "index", "size", "digest"], batches):
            element = Element(trees)
            put = element.add({tuple(r[1:4]): r[5] for r in rows}, {r[1]: r[4] for r in rows})
            known: dict = {}
            ways = [(block, *key, element.sizes[key[0]], None, *(w := element.way(key, known))[:1], *w[1]) for key in put]
            yield record_batch(ways + _left(element, block, 4), _MERGED)

    return run


def _prove(trees: int, root: str):
    schema = pa.schema([("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof", pa.string()), ("tree", pa.int64()), ("index", pa.int64()), ("size", pa.int64()), ("folded_root", pa.string()), ("verified", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tree, index, size, leaves, whole, above, more in column_rows(batch, ["tree", "index", "size", "leaves", "whole", "above", "more"]):
                for n, one in enumerate(leaves):
                    own = "".join(x["leaf"] for x in leaves[:n] + leaves[n + 1 :]) if whole else ""
                    path = own + above + more
                    subroot, folded = fold(one["leaf"], path, size, tree, index + n, trees)
                    if one["other"] is not None:
                        _, folded = fold(one["other"], path, size, tree, index + n, trees)
                    out.append((one["id"], one["leaf"], subroot, root, path, tree, index + n, size, folded, folded == root))
                if len(out) >= 1000:
                    yield record_batch(out, schema)
                    out = []
            yield record_batch(out, schema)

    return run


def manifest(docs: DataFrame, fields: list[str], tree_col: str, id_col: str, other_leaf: Column | None = None, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """(id, leaf, subroot, root, proof, tree, index, size, folded_root, verified), one row for each row:
    its leaf, the last nodes of its tree and of all, the siblings on its way up as one text, and its
    place: the number of its tree, its index there and the tree's size.

    other_leaf is what a row's leaf is now, if that is not null: folded_root is then computed from it
    and the proof, else from the leaf itself, and a row is verified if that gives the root."""
    spark = docs.sparkSession
    own = [F.col(f"`{f}`") for f in fields]
    leaves = docs.select(
        F.col(f"`{tree_col}`").cast("string").alias("value"), F.col(f"`{id_col}`").cast("long").alias("id"), leaf_of(*own).alias("leaf"),
        (F.lit(None).cast("string") if other_leaf is None else other_leaf).alias("other"), F.monotonically_increasing_id().alias("row"),
    )
    leaves = scratch(leaves, "merkle-leaves")
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-leaves.count() // block_rows))
    order = ["value", "id", "leaf", "row"]  # the last splits even a third of all rows that are equal
    ranged = scratch(leaves.repartitionByRange(blocks, *order).withColumn("block", F.spark_partition_id().cast("long")), "merkle-ranged")
    release(leaves)
    counts = ranged.groupBy("value", "block").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy("value")
    spans = counts.withColumns({"first": F.coalesce(F.sum("n").over(w.orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)), "size": F.sum("n").over(w)})
    spans = scratch(spans.drop("n"), "merkle-spans")
    ranked = scratch(numbered(spans.select("value").distinct(), "value").select(F.col("value").alias("v"), F.col("nth").cast("long").alias("tree")), "merkle-trees")
    trees = ranked.count()
    placed_ = scratch(spans.join(small_side(ranked), F.col("value").eqNullSafe(F.col("v"))).select("v", F.col("block").alias("b"), "first", "size", "tree"), "merkle-places")
    # By block, which is narrow rows again; blocks are ranges of equal size, whatever the trees are.
    known = ranged.join(small_side(placed_), (F.col("block") == F.col("b")) & F.col("value").eqNullSafe(F.col("v")))
    sorted_ = known.select("block", "tree", "first", "size", "id", "leaf", "other").repartition("block").sortWithinPartitions("block", "tree", F.asc_nulls_first("id"), "leaf")
    folded = scratch(sorted_.mapInArrow(_fold_leaves(trees), _FOLDED_DDL), "merkle-folded")
    release(ranged)

    # The tree reduction: neighbouring elements become one, round by round.
    nodes, ways, groups = folded.filter("digest IS NOT NULL"), [], blocks
    while True:
        groups = -(-groups // fan)
        group = nodes.select(F.floor(F.col("block") / fan).cast("long").alias("block"), "tree", "level", "index", "size", "digest")
        merged = scratch(group.repartition("block").sortWithinPartitions("block").mapInArrow(_merge(trees), _MERGED_DDL), "merkle-merged")
        ways.append(merged.filter("digest IS NULL").select("tree", "level", "index", "above", *_END))
        nodes = merged.filter("digest IS NOT NULL")
        if groups == 1:
            break
    last = nodes.select("digest").collect()  # the root, or nothing
    root = last[0].digest if last else None

    # Ways of the last round end at the root; those of the rounds before go on where they end.
    more = ways.pop().select(*[F.col(n).alias(e) for n, e in zip(("tree", "level", "index"), _END, strict=True)], F.col("above").alias("more"))
    while ways:
        longer = ways.pop().join(small_side(more), _END).select("tree", "level", "index", F.concat("above", "more").alias("more"))
        more = scratch(longer.select(*[F.col(n).alias(e) for n, e in zip(("tree", "level", "index"), _END, strict=True)], "more"), "merkle-ways")
    runs = folded.filter("digest IS NULL").select("tree", "index", "size", "leaves", "whole", "above", *_END).join(small_side(more), _END)
    return runs.mapInArrow(_prove(trees, root), "id long, leaf string, subroot string, root string, proof string, tree long, index long, size long, folded_root string, verified boolean")
