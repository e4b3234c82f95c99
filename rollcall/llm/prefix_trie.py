"""The prefix trie of conversations, by adaptive radix trees over sequences of turn ids.

A turn's id is a 128-bit digest of role and text; a conversation's key is the ids of its turns, one after the other, as
big-endian bytes of fixed width. A radix tree over keys branches at any byte, but only depths at the end of a turn are
nodes of the trie; where a path holds several turns, each is one.

1. Turns are gathered per conversation as ids and word counts; texts are not shuffled.
2. Conversations with equal keys fold into one, with their number, the least id and the digest of their ids. The ids of a
   key are hashed in order: they are sorted by range, so a key with a third of all conversations spans many tasks, and
   its ids reach the last hash as long pieces of text, read one after the other.
3. Distinct keys are sorted by range. A task builds one tree after the other, of a bounded number of neighbouring keys.
4. Keys below one node are neighbours, so a node lies in one tree unless it is part of what the last key before a tree
   and its first key share (or its last key and the next). Such a node has a copy in each tree it spans. The tree in which
   it comes first counts it, so that all figures add up over copies: only copies are shuffled, a path per tree.

A conversation is one row: its turns, 36 bytes each, must fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.radix_tree import Node, RadixTree, common
from rollcall.llm.shared import keep, scratch, sized

WIDTH = 16
#: Keys of one tree, ids of one piece of a long list.
KEYS, IDS = 20_000, 4_000
#: The query's rule: conversations share the head of one in twenty, up to three turns.
SHARED, HEADS = 20, 4

NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, node binary, up binary"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def gathered(turns: DataFrame) -> DataFrame:
    """conv_id, turns: each conversation's turns in order (null first), as digests and numbers of words.

    Null role or text counts as empty. Turns of equal number stand in the order of their digests, repeated rows each count.
    Rows without a conversation are no part of any.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("id"), words.alias("words"))
    listed = F.sort_array(F.collect_list(F.struct("turn", "id", "words")))
    return rows.groupBy("conv_id").agg(F.transform(listed, lambda x: F.struct(x["id"].alias("id"), x["words"].alias("words"))).alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """conv_id, turns: the first h turns of conversation c - c % 20, then c's own after its first h; h = crc32(c) % 4."""
    head = convs.where(f"conv_id % {SHARED} = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    asked = convs.withColumn("base", F.expr(f"conv_id - conv_id % {SHARED}")).withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int"))
    first = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return asked.join(head, "base", "left").select("conv_id", F.concat(first, own).alias("turns"))


def keyed(convs: DataFrame) -> DataFrame:
    """conv_id, seq (a digest of the key), key, words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column("turns")
            flat = turns.flatten()
            ids = b"".join(flat.field("id").to_pylist())
            ends = (turns.offsets.to_numpy() - turns.offsets[0].as_py()).tolist()
            keys = [ids[a * WIDTH : b * WIDTH] for a, b in zip(ends, ends[1:], strict=False)]
            words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat.field("words").cast(pa.int32()))
            seqs = [hashlib.blake2b(key, digest_size=16).digest() for key in keys]
            columns = [batch.column("conv_id"), pa.array(seqs, pa.binary()), pa.array(keys, pa.binary()), words]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "seq", "key", "words"])

    return convs.mapInArrow(run, "conv_id long, seq binary, key binary, words array<int>")


def ends(convs: DataFrame, folder: str) -> DataFrame:
    """seq, n, least, ends: per key the number of its conversations, the least id, and the digest of all, ascending."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keys inside a task are hashed there; those at its edges may go on in the next one and leave as pieces."""
        part, seq, whole, held, number = TaskContext.get().partitionId(), None, False, [], 0
        out: dict[str, list] = {name: [] for name in ("seq", "n", "least", "ends", "part", "number", "ids")}

        def leave(done: bool) -> None:
            text = ",".join(map(str, held))
            inside = done and whole and not number
            row = (seq, len(held), held[0], hashlib.sha256(text.encode()).hexdigest() if inside else None, part, number, None if inside else text)
            for values, value in zip(out.values(), row, strict=True):
                values.append(value)

        def rows() -> pa.RecordBatch:
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))
            for values in out.values():
                values.clear()
            return batch

        for batch in batches:
            seqs, ids = batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist()
            for this, conv in zip(seqs, ids, strict=True):
                if this != seq:
                    if held:
                        leave(True)
                    whole, seq, number = seq is not None, this, 0
                    held.clear()
                elif len(held) == IDS:
                    leave(False)
                    number += 1
                    held.clear()
                held.append(conv)
            yield rows()
        if held:
            leave(False)
            yield rows()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, digest, n, least = None, None, 0, 0
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["seq"] != seq:
                    if seq is not None:
                        done.append((seq, n, least, digest.hexdigest()))
                    seq, digest, n, least = row["seq"], hashlib.sha256(), 0, row["least"]
                digest.update((("," if n else "") + row["ids"]).encode())
                n += row["n"]
            yield as_rows(done)
        if seq is not None:
            yield as_rows([(seq, n, least, digest.hexdigest())])

    def as_rows(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done, strict=True) if done else ((), (), (), ())
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(columns, kinds, strict=True)], names=["seq", "n", "least", "ends"])

    ordered = convs.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    runs = keep(ordered.mapInArrow(pieces, "seq binary, n long, least long, ends string, part int, number int, ids string"), f"{folder}/runs")
    open_ = runs.where("ends is null").repartition("seq").sortWithinPartitions("seq", "part", "number")
    return runs.where("ends is not null").select("seq", "n", "least", "ends").unionByName(open_.select("seq", "n", "least", "ids").mapInArrow(joined, "seq binary, n long, least long, ends string"))


def ranged(keys: DataFrame, folder: str) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """The distinct keys, dealt by range into numbered parts; and for each part the turns that its first key shares with
    the key before it, and its last key with the one after it: -1 where there is none. As many as there are parts."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, part, np.int32)), *batch.columns], names=["part", *batch.schema.names])

    dealt = keys.repartitionByRange("key").mapInArrow(numbered, "part int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys.schema))
    dealt = keep(dealt, f"{folder}/parts")
    edges = dealt.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    in_order = Window.orderBy("part")  # one row per part
    pairs = edges.select("part", F.lag("last").over(in_order).alias("before"), "first")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [-1 if r["before"] is None else common(r["before"], r["first"]) // WIDTH for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(found, pa.int32())], names=["part", "shared"])

    rows = sorted((r.part, r.shared) for r in pairs.mapInArrow(shared, "part int, shared int").collect())
    after = [shared for _, shared in rows[1:]] + [-1]
    return dealt, {part: (before, next_) for (part, before), next_ in zip(rows, after, strict=False)}


class Edge:
    """A node of a radix tree, with the depths of the trie's nodes on the path that leads to it."""

    __slots__ = ("node", "above", "low", "high", "end", "first", "last", "n", "least", "leaves", "saved", "tops", "found")

    def __init__(self, node: Node, above: Edge | None, start: int, first: bool, last: bool):
        self.node, self.above, self.first, self.last = node, above, first, last
        self.end = start + len(node.path)
        self.low = 0 if above is None else (start - 1) // WIDTH + 1
        self.high = self.end // WIDTH
        self.n = self.leaves = self.saved = self.tops = 0
        self.least: int | None = None
        self.found: list[tuple[int, int, int]] = []


def summed(rows: list[tuple], before: int, after: int) -> Iterator[tuple]:
    """The trie nodes of one tree over sorted rows (key, words, n, least, ends), as rows of `NODES`.

    The first key shares `before` turns with the key before it, the last one `after` turns with the one after it.
    """
    tree = RadixTree()
    for row in rows:
        tree.insert(row[0], row)
    path_ids = {side: digests(rows[at][0], turns) for side, at, turns in (("first", 0, before), ("last", -1, after))}
    order = [Edge(tree.root, None, 0, True, True)]
    for edge in order:  # grows as it goes: every edge stands behind the one above it
        kids = list(edge.node.children())
        for i, kid in enumerate(kids):
            order.append(Edge(kid, edge, edge.end + 1, edge.first and i == 0 and edge.node.value is None, edge.last and i == len(kids) - 1))
    for edge in reversed(order):
        node = edge.node
        words, children = node.sample[1], edge.tops
        if node.value is not None:
            _, _, n, least, _ = node.value
            edge.n += n
            edge.least = least if edge.least is None else min(edge.least, least)
            if node.kids is None and not (edge.last and after == edge.high):
                edge.leaves = 1
        ours = 0
        for depth in range(edge.high, edge.low - 1, -1):
            ours = 0 if edge.first and depth <= before else 1
            if depth:
                edge.saved += (edge.n - ours) * words[depth - 1]
            edge.found.append((depth, children, edge.saved))
            children = ours
        if edge.found:
            edge.tops = ours
        if above := edge.above:
            above.n += edge.n
            above.least = edge.least if above.least is None else min(above.least, edge.least)
            above.leaves += edge.leaves
            above.saved += edge.saved
            above.tops += edge.tops
    for edge in order:
        parent = edge.above
        while parent is not None and not parent.found:
            parent = parent.above
        for depth, children, saved in reversed(edge.found):
            holder = edge if depth > edge.low else parent
            up = spans(holder, depth - 1, before, after, path_ids) if depth else None
            ended = edge.node.value is not None and depth * WIDTH == edge.end
            over = None if not depth or up is not None else holder.least
            yield (edge.least, depth, over, edge.n, children, edge.leaves, saved, edge.node.value[4] if ended else None, spans(edge, depth, before, after, path_ids), up)


def spans(edge: Edge, depth: int, before: int, after: int, path_ids: dict[str, list[bytes]]) -> bytes | None:
    """The name of a node that other trees may hold as well, or nothing."""
    if edge.first and depth <= before:
        return path_ids["first"][depth]
    if edge.last and depth <= after:
        return path_ids["last"][depth]
    return None


def digests(key: bytes, turns: int) -> list[bytes]:
    """The names of the key's first nodes, from the root on."""
    running, found = hashlib.blake2b(digest_size=16), []
    for depth in range(turns + 1):
        found.append(running.copy().digest())
        running.update(key[depth * WIDTH : (depth + 1) * WIDTH])
    return found


def nodes(convs: DataFrame, folder: str | None = None, keys: int = KEYS) -> DataFrame:
    """The trie's nodes over rows (conv_id, turns) as `gathered` gives them.

    conv_id (the least member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens
    (over the subtree, words of repeated turns) and ends_sha256 (of the ids of the conversations that end there). Without
    conversations there is no node; conversations without turns end at the root.
    """
    spark = convs.sparkSession
    folder = folder or scratch(spark, "prefix-trie")
    made = keep(keyed(convs), f"{folder}/keys")
    distinct = made.select("seq", "key", "words").dropDuplicates(["seq"])
    folded = distinct.join(ends(made, folder), "seq").select("key", "words", "n", "least", "ends")
    dealt, edges = ranged(folded, folder)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        part, before, after = None, -1, -1
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("part", "key", "words", "n", "least", "ends")]
            for of, *row in zip(*columns, strict=True):
                if of != part:
                    if held:
                        yield from as_nodes(summed(held, before, after))
                        held = []
                    part, (before, after) = of, edges[of]
                elif len(held) == keys:
                    shared = common(held[-1][0], row[0]) // WIDTH
                    yield from as_nodes(summed(held, before, shared))
                    held, before = [], shared
                held.append(tuple(row))
        if held:
            yield from as_nodes(summed(held, before, after))

    found = keep(dealt.repartition("part").sortWithinPartitions("part", "key").mapInArrow(grow, NODES), f"{folder}/nodes")
    totals = [F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    copies = found.where("node is not null").groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), *totals, F.max("ends_sha256").alias("ends_sha256"), F.first("up").alias("up"))
    copies = keep(copies, f"{folder}/copies")  # a path per tree at most
    names = sized(copies.select(F.col("node").alias("up"), F.col("conv_id").alias("_above")))
    every = found.where("node is null").drop("node").unionByName(copies.drop("node").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return every.join(names, "up", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def as_nodes(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = [*[pa.int64()] * 7, pa.string(), pa.binary(), pa.binary()]
    names = [field.split()[0] for field in NODES.split(", ")]
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*block, strict=True), kinds, strict=True)], names=names)
            block = []
    if block:
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*block, strict=True), kinds, strict=True)], names=names)


def trie(turns: DataFrame) -> DataFrame:
    """The nodes over conversations rebuilt with shared heads; other columns of the rows are not used."""
    folder = scratch(turns.sparkSession, "prefix-trie")
    convs = keep(gathered(turns.select("conv_id", "turn", "role", "text")), f"{folder}/turns")
    return nodes(rebuilt(convs), folder)
