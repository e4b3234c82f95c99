"""A Merkle manifest of a data set: one tree per source, and one over the sources' roots.

Trees have three children a node and are cut into aligned subtrees of six levels above their leaves, the blocks. A block is a row: all its digests
in van Emde Boas order, addressed by arithmetic, both when it is built and when siblings are looked up.
The roots of a tree's blocks are the leaves of the next blocks above, until one is left. Every step is a shuffle by tree and block, so a source with a third of all rows is many blocks.

Building goes up, block by block; proofs come down: each block hands what lies above it to the blocks below, and the last
ones give each leaf its siblings, from its own run up to the root.

A digest H is the lowercase hex SHA-256 of its inputs, one after the other; digests go in as hex text. What remains of the
last run of a level, even a single node, becomes its H while the level has several nodes; a tree of one leaf is that leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.bpe import portions
from rollcall.llm.shared import keep, placed, scratch
from rollcall.llm.van_emde_boas import addresses, size

FAN, HEIGHT = 3, 6
BLOCK = FAN**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

BLOCKS = "tree string, block long, n int, root string, nodes binary, ids array<long>, others binary"
PROOFS = "tree string, pos long, id long, digest string, other string, path array<string>, subroot string"
Finish = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def sha(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def digest(*values: Column) -> Column:
    """H of a row's values: `-` for null, else the number of UTF-8 bytes, a colon, and the value."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """tree (the source), id, digest, and `other`: the digest of the row with its text tampered with, where that is done."""
    given = docs.select(*FIELDS).withColumns({"id": F.col("doc_id").cast("long"), "tree": F.col("source").cast("string")})
    digits = F.col("id").cast("string")
    fields = [digits, *(F.col(name) for name in FIELDS[1:])]
    changed = [*fields[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit(""))]
    touched = F.coalesce((F.crc32(digits.cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n")), F.lit(False))
    made = given.select("tree", "id", digest(*fields).alias("digest"), F.when(touched, digest(*changed)).alias("other"))
    return made.withColumn("other", F.coalesce("other", "digest"))


def levels_of(leaves: list[bytes], height: int) -> list[list[bytes]]:
    """The levels of a subtree from its leaves up."""
    made = [leaves]
    for _ in range(height):
        below = made[-1]
        made.append([sha(b"".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return made


def height_of(block: int, n: int) -> int:
    """A tree's only block ends where one node is left; all others are full subtrees."""
    if block or n == BLOCK:
        return HEIGHT
    return next(h for h in range(HEIGHT + 1) if FAN**h >= n)


def stored(levels: list[list[bytes]]) -> bytes:
    """A subtree's digests in van Emde Boas order, 32 bytes each."""
    count, height = len(levels), len(levels) - 1
    nodes = np.zeros((size(count, FAN), 32), np.uint8)
    for above_leaves, level in enumerate(levels):
        at = addresses(count, height - above_leaves, np.arange(len(level)), FAN)
        nodes[at] = np.frombuffer(bytes.fromhex(b"".join(level).decode()), np.uint8).reshape(-1, 32)
    return nodes.tobytes()


def loaded(nodes: bytes, n: int, height: int) -> list[list[bytes]]:
    """The digests of each level, from the leaves up."""
    table = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    levels = []
    for up in range(height + 1):
        there = -(-n // FAN**up)
        text = table[addresses(height + 1, height - up, np.arange(there), FAN)].tobytes().hex().encode()
        levels.append([text[i : i + 64] for i in range(0, len(text), 64)])
    return levels


def blocks(rows: DataFrame, folder: str) -> DataFrame:
    """Rows (tree, pos, id, digest, other) to blocks, one row each."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None
        out: list[tuple] = []

        def close() -> None:
            made = levels_of([row[0].encode() for row in held], height_of(key[1], len(held)))
            others = bytes.fromhex("".join(row[2] for row in held))
            out.append((*key, len(held), made[-1][0].decode() if len(made[-1]) == 1 else None, stored(made), [row[1] for row in held], others))

        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("tree", "block", "digest", "id", "other")]
            for tree, block, *row in zip(*columns, strict=True):
                if (tree, block) != key:
                    if held:
                        close()
                        held = []
                        if len(out) >= 100:
                            yield as_blocks(out)
                            out.clear()
                    key = tree, block
                held.append(tuple(row))
        if held:
            close()
        if out:
            yield as_blocks(out)

    dealt = rows.withColumn("block", F.expr(f"pos div {BLOCK}")).repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    return keep(dealt.select("tree", "block", "digest", "id", "other").mapInArrow(build, BLOCKS), folder)


def as_blocks(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.binary()]
    columns = [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["tree", "block", "n", "root", "nodes", "ids", "others"])


def build(rows: DataFrame, folder: str) -> tuple[list[DataFrame], DataFrame]:
    """All blocks of all trees over leaves (tree, pos, id, digest, other), lowest first, and each tree's root (tree, root)."""
    made: list[DataFrame] = []
    done: list[DataFrame] = []
    while True:
        level = blocks(rows, f"{folder}/blocks-{len(made)}")
        made.append(level)
        heads = level.groupBy("tree").agg(F.max("block").alias("_last"), F.max_by("root", -F.col("block")).alias("root"))
        heads = keep(heads, f"{folder}/heads-{len(made)}")
        done.append(heads.where("_last = 0").select("tree", "root"))
        taller = heads.where("_last > 0").select(F.col("tree").alias("_tree"))
        if taller.isEmpty():
            roots = done[0]
            for more in done[1:]:
                roots = roots.unionByName(more)
            return made, roots
        near = level.select("tree", "block", "root").join(taller, F.col("tree").eqNullSafe(F.col("_tree")), "left_semi")
        rows = near.select("tree", F.col("block").alias("pos"), F.col("block").alias("id"), F.col("root").alias("digest"), F.col("root").alias("other"))


def proofs(made: list[DataFrame], tops: DataFrame, folder: str, finish: Finish | None = None, schema: str = PROOFS) -> DataFrame:
    """Per leaf of the trees that `build` made: PROOFS. path holds, from the leaf up, the digests to the left and those to
    the right of each node, in turn; tops (tree, path, subroot) holds what lies above each tree's root. finish goes over
    the last rows in the tasks that make them."""

    def hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "nodes"):
            for row in batch.to_pylist():
                yield one(row)

    def one(row: dict) -> pa.RecordBatch:
        n, block = row["n"], row["block"]
        height = height_of(block, n)
        levels = loaded(row["nodes"], n, height)
        paths = [list(map(str.encode, row["path"]))]
        for level in reversed(levels[:-1]):  # from below the block's root down to its leaves
            lower = []
            for i in range(len(level)):
                start = i - i % FAN
                lower.append([b"".join(level[start:i]), b"".join(level[i + 1 : start + FAN]), *paths[i // FAN]])
            paths = lower
        others = row["others"].hex()
        columns = [
            pa.array([row["tree"]] * n, pa.string()), pa.array([block * BLOCK + i for i in range(n)], pa.int64()), pa.array(row["ids"], pa.int64()),
            pa.array([x.decode() for x in levels[0]], pa.string()), pa.array([others[i : i + 64] for i in range(0, 64 * n, 64)], pa.string()),
            pa.array([[x.decode() for x in path] for path in paths], pa.list_(pa.string())), pa.array([row["subroot"]] * n, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["tree", "pos", "id", "digest", "other", "path", "subroot"])

    above: DataFrame | None = None
    ends = tops.select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot")
    for number, level in reversed(list(enumerate(made))):
        # the only block of a tree lies below the top, all others below blocks of the level above
        single = level if above is None else level.join(above.select(F.col("tree").alias("_tree")).distinct(), F.col("tree").eqNullSafe(F.col("_tree")), "left_anti")
        parts = [joined(single, ends)]
        if above is not None:
            parts.append(joined(level, above))
        found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if number:
            found = keep(found.mapInArrow(hand, PROOFS), f"{folder}/proofs-{number}")
            above = found.select("tree", F.col("id").alias("block"), "path", "subroot")
    return found.mapInArrow((lambda batches: finish(hand(batches))) if finish else hand, schema)


def joined(level: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with what lies above them."""
    named = above.withColumnsRenamed({"tree": "_tree", "block": "_block"})
    both = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))
    return level.join(named, both).select("tree", "block", "n", "nodes", "ids", "others", "path", "subroot")


def manifest(docs: DataFrame, folder: str | None = None, finish: Callable[[str], Finish] | None = None, schema: str = PROOFS) -> DataFrame:
    """Per row of documents its PROOFS; finish(root), if given, makes rows of another schema of them.

    Any of the fields may be null; a null source is a source, a null id comes first in its source, and rows with equal ids
    stand in the order of their digests, repeated rows each for themselves. Without rows there is no root.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "merkle")
    # written before they are dealt by range, which reads its rows twice
    lowest = placed(keep(leaves(docs), f"{folder}/digests"), ["tree"], ["id", "digest", "other"], f"{folder}/leaves")
    made, roots = build(lowest, f"{folder}/sources")
    subroots = keep(placed(roots, [], ["tree"], f"{folder}/roots"), f"{folder}/subroots")
    top_rows = subroots.select(F.lit(None).cast("string").alias("tree"), "pos", F.col("pos").alias("id"), F.col("root").alias("digest"), F.col("root").alias("other"))
    top, summit = build(top_rows, f"{folder}/top")
    root = summit.first()
    if root is None:
        return spark.createDataFrame([], schema)
    start = spark.createDataFrame([(None, [], root.root)], "tree string, path array<string>, subroot string")
    paths = proofs(top, start, f"{folder}/top").select(F.col("id").alias("pos"), "path")
    tops = keep(subroots.join(paths, "pos").select("tree", "path", F.col("root").alias("subroot")), f"{folder}/tops")
    return proofs(made, tops, f"{folder}/sources", finish(root.root) if finish else None, schema)


def folded(leaf: bytes, path: list[str]) -> bytes:
    """The root that a leaf and its path lead to."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        leaf = sha(left.encode() + leaf + right.encode())
    return leaf


def auditing(root: str) -> Finish:
    """Rows of PROOFS to rows of RESULT."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, others = batch.column("path").to_pylist(), batch.column("other").to_pylist()
            proof = [sha("".join(path).encode()).decode() for path in paths]
            ends = [folded(other.encode(), path).decode() for other, path in zip(others, paths, strict=True)]
            count = batch.num_rows
            columns = [
                batch.column("id"), batch.column("digest"), batch.column("subroot"), pa.array([root] * count, pa.string()),
                pa.array(proof, pa.string()), pa.array(ends, pa.string()), pa.array([end == root for end in ends], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in RESULT.split(", ")])

    return check


def audited(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Per document its leaf, the roots, the digest of its proof, and what a tampered copy's leaf leads to."""
    return manifest(docs, folder, auditing, RESULT)
