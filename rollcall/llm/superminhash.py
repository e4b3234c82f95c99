"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find (Ertl 2017).

1. Each distinct shingle walks through the places of the signature in a random order of its own; at its j-th step it
   offers j plus a random fraction to the place it is at, and each place keeps the least offer. Ranks within a signature
   are thus correlated, which lowers the variance; and as a later step never beats an earlier one, a document is done
   at the first step after which all its places are taken. A step is done for all shingles of a batch at once.
2. Documents with equal sets are one from here on; the least id stands for them.
3. Banding: four places make a band, thirty bands a signature. Documents that agree on a band meet in its bucket. Two
   documents with similarity 0.8 miss each other in all bands once in seven million times.
4. Every bucket has a centre, the document that meets most others over all its buckets; each document is compared with
   the centres it meets most often: as many pairs as documents, however large a group of copies is. Links join groups.
5. What is left is documents that share a bucket but no group. Of each bucket the largest group is compared with the
   others, and these with each other; equal groups never are. Where that would be many pairs, as in a crowd of copies
   that are just not similar enough, the bucket's documents are compared exactly instead, by the rarest of their
   shingles: of two sets that link, the first shingle they share stands early in both.
6. A pair is a candidate if sizes allow it and not too many bits of the signatures differ, and a link only after both
   full sets were compared. Links are united in trees of pointers, within tasks first, then between them.

Identity is a 64-bit hash of a shingle, and a 128-bit hash of a set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.bpe import portions
from rollcall.llm.components import labels
from rollcall.llm.perfect_hash import mixed
from rollcall.llm.shared import keep, scratch, sized
from rollcall.llm.words import distinct, shingles

SIZE, PERCENT = 4, 80
BANDS, ROWS = 30, 4
PLACES = BANDS * ROWS
#: Places whose lowest bits may differ: 12 of 120 do at similarity 0.8; more than 36 with a chance of one in 10^8.
DIFFER = 36
#: Centres a document is compared with, and pairs of a bucket beyond which its documents meet by rare shingles.
CENTRES, PAIRS = 2, 300
#: Buckets in which shingles are counted for the order by rarity, and chunks in which tasks send the counts.
COUNTS, CHUNKS = 1 << 18, 64
#: Bytes of text worked on at a time, and nodes of a task's union-find forest.
AT_ONCE, FOREST = 1 << 20, 500_000
EMPTY = np.uint64(2**64 - 1)


def signatures(elements: np.ndarray, counts: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Per set a row of `places` ranks: the step in the upper bits, a random fraction in the lower 32.

    elements holds the distinct 64-bit elements of all sets, one set after the other; an empty set has ranks EMPTY.
    """
    found = np.full(len(counts) * places, EMPTY)
    owner = np.repeat(np.arange(len(counts)), counts)
    walking, order = elements, None
    for step in range(places):
        if not len(walking):
            break
        random = mixed(walking, 31 + step)
        target = step + (((random >> np.uint64(32)) * np.uint64(places - step)) >> np.uint64(32)).astype(np.int64)
        if order is None:
            place = target
        else:  # the next of a random permutation, by one swap
            rows = np.arange(len(walking))
            place = order[rows, target].astype(np.int64)
            order[rows, target] = order[:, step]
        np.minimum.at(found, owner * places + place, (np.uint64(step) << np.uint64(32)) | (random & np.uint64(0xFFFFFFFF)))
        still = (found.reshape(-1, places) == EMPTY).any(axis=1)[owner]
        if order is None:
            if not still.any():
                break
            order = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.uint16), (int(still.sum()), 1))
            order[np.arange(len(order)), target[still]] = 0
        else:
            order = order[still]
        walking, owner = walking[still], owner[still]
    return found.reshape(-1, places)


def bands(ranks: np.ndarray) -> np.ndarray:
    """A hash per band; the band's number is part of it."""
    parts = ranks.reshape(len(ranks), -1, ROWS)
    made = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64), parts.shape[:2])
    for row in range(ROWS):
        made = mixed(made ^ parts[:, :, row], 3 + row)
    return made


def low_bits(ranks: np.ndarray) -> np.ndarray:
    """The ranks' lowest bits, in two numbers of 60 bits."""
    bits = (ranks & np.uint64(1)).reshape(len(ranks), 2, -1)
    return (bits << np.arange(bits.shape[2], dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


def measured(docs: DataFrame, folder: str) -> DataFrame:
    """Per row: doc, n (distinct shingles), set (its hash), part (half of that), low and high (bits), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text", AT_ONCE):
            elements, sizes = distinct(*shingles(batch.column("text"), SIZE))
            ends = np.cumsum(sizes)
            sets = [xxhash.xxh3_128_digest(elements[a:b].tobytes()) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
            ranks = signatures(elements, sizes)
            bits, made = low_bits(ranks).view(np.int64), bands(ranks)
            there = sizes > 0
            offsets = np.concatenate([[0], np.cumsum(there) * BANDS]).astype(np.int32)
            parts = np.frombuffer(b"".join(digest[:8] for digest in sets), "<i8")
            columns = [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(sets, pa.binary()), pa.array(parts), pa.array(bits[:, 0]), pa.array(bits[:, 1])]
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(made[there].ravel().view(np.int64))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "set", "part", "low", "high", "bands"])

    return keep(docs.mapInArrow(run, "doc long, n long, set binary, part long, low long, high long, bands array<long>"), f"{folder}/sets")


def equal_sets(made: DataFrame, folder: str) -> DataFrame:
    """doc, set, label: documents whose set a smaller id has too, that set, and the least of these ids."""
    there = made.where("doc is not null and n > 0")
    least = there.groupBy("set").agg(F.min("doc").alias("label"), F.max("doc").alias("last")).where("label < last").drop("last")
    least = sized(keep(least, f"{folder}/least"))  # a set that a third of all documents have is not shuffled by its hash
    return keep(there.select("doc", "set").join(least, "set").where("doc <> label").select("doc", "set", "label").distinct(), f"{folder}/copies")


def buckets(made: DataFrame, copies: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Places in buckets that several documents share (bucket, doc, part), and of each of these documents what pairs are
    chosen by: score (how many it meets), n, low, high."""
    alone = made.where("doc is not null and n > 0").join(sized(copies.select("doc", "set")), ["doc", "set"], "left_anti")
    rows = alone.select("doc", "part", F.explode("bands").alias("bucket"))
    several = rows.groupBy("bucket").agg(F.count("*").alias("met")).where("met > 1")
    met = keep(rows.join(several, "bucket"), f"{folder}/buckets")
    scores = met.groupBy("doc", "part").agg(F.sum("met").alias("score"))
    facts = alone.select("doc", "part", "n", "low", "high").dropDuplicates(["doc", "part"])
    return met.drop("met"), keep(scores.join(facts, ["doc", "part"]), f"{folder}/facts")


WHO = ("doc", "part", "n", "low", "high")


def may_link(x: str, y: str) -> Column:
    """Whether sizes and signatures of two documents leave a link possible."""
    small, large = F.least(f"{x}.n", f"{y}.n"), F.greatest(f"{x}.n", f"{y}.n")
    differ = sum(F.bit_count(F.col(f"{x}.{half}").bitwiseXOR(F.col(f"{y}.{half}"))) for half in ("low", "high"))
    return (100 * small >= PERCENT * large) & (differ <= DIFFER)


def ordered(x: str, y: str) -> list[Column]:
    """The columns of a pair, the smaller id first: a, part_a, b, part_b."""
    less = F.col(f"{x}.doc") < F.col(f"{y}.doc")
    pick = lambda one, other, field, name: F.when(less, F.col(f"{one}.{field}")).otherwise(F.col(f"{other}.{field}")).alias(name)
    return [pick(x, y, "doc", "a"), pick(x, y, "part", "part_a"), pick(y, x, "doc", "b"), pick(y, x, "part", "part_b")]


def centred(met: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs (a, part_a, b, part_b) of documents with the centres they meet most often."""
    rows = met.join(facts, ["doc", "part"]).select("bucket", "score", F.struct(*WHO).alias("x"))
    centre = rows.groupBy("bucket").agg(F.max(F.struct("score", (-F.col("x.doc")).alias("last"), "x")).alias("best")).select("bucket", F.col("best.x").alias("y"))
    pairs = rows.join(centre, "bucket").where(F.col("x.doc") != F.col("y.doc")).where(may_link("x", "y"))
    counted = pairs.groupBy("x.doc", "x.part", *ordered("x", "y")).agg(F.count("*").alias("times"))
    best = Window.partitionBy("doc", "part").orderBy(F.desc("times"), "a", "part_a", "b", "part_b")  # one row per band at most
    return counted.withColumn("place", F.row_number().over(best)).where(F.col("place") <= CENTRES).select("a", "part_a", "b", "part_b").distinct()


def apart(rows: DataFrame, folder: str) -> DataFrame:
    """Places (bucket, label, x) in buckets that hold several groups, with the bucket's pairs and whether the place's
    group is its largest."""
    sizes = rows.groupBy("bucket", "label").agg(F.count("*").alias("docs"))
    held = sizes.groupBy("bucket").agg(F.max(F.struct("docs", "label")).alias("most"), F.sum("docs").alias("all"), F.count("*").alias("groups")).where("groups > 1")
    open_ = held.select("bucket", F.col("most.label").alias("largest"), (F.col("all") * (F.col("all") - F.col("most.docs"))).alias("pairs"))
    return keep(rows.join(open_, "bucket").withColumn("main", F.col("label") == F.col("largest")).drop("largest"), folder)


def crossed(rows: DataFrame) -> DataFrame:
    """All pairs of different groups in a bucket that may link."""
    side = lambda df, name: df.select("bucket", F.col("label").alias(f"label_{name}"), F.col("x").alias(name))
    differ = (F.col("label_x") != F.col("label_y")) & may_link("x", "y")
    others = rows.where("not main")
    mixed_ = side(others, "x").join(side(rows.where("main"), "y"), "bucket").where(differ)
    among = side(others, "x").join(side(others, "y"), "bucket").where(differ & (F.col("x.doc") < F.col("y.doc")))
    return mixed_.select(*ordered("x", "y")).unionByName(among.select(*ordered("x", "y")))


def remaining(docs: DataFrame, met: DataFrame, facts: DataFrame, known: DataFrame, folder: str) -> DataFrame:
    """Pairs of documents in different groups that share a bucket."""
    grouped = facts.join(known.select(F.col("node").alias("doc"), "label"), "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    of_doc = grouped.select("doc", "part", "label", F.struct(*WHO).alias("x"))
    places = apart(met.join(of_doc, ["doc", "part"]).select("bucket", "label", "x"), f"{folder}/apart")
    crowded = places.where(F.col("pairs") > PAIRS).select("x.doc", "x.part", "label", "x").dropDuplicates(["doc", "part"])
    return crossed(places.where(F.col("pairs") <= PAIRS)).unionByName(rare(docs, keep(crowded, f"{folder}/crowded"), folder)).distinct()


def needed(n: Column, m: Column) -> Column:
    """Shingles that sets of n and m must share to link."""
    return F.ceil(F.lit(PERCENT) * (n + m) / (100 + PERCENT))


def rare(docs: DataFrame, crowded: DataFrame, folder: str) -> DataFrame:
    """All pairs of different groups among these documents that may link, by their rarest shingles.

    If the first shingle that two sets share stands at places i and j in the order, they share at most what the shorter
    rest holds. So it stands within the first fifth of each, and within the first ninth of the smaller one.
    """
    sets = keep(whole_sets(docs, crowded.select("doc", "part"), f"{folder}/rare"), f"{folder}/rare/sets")
    order = docs.sparkSession.sparkContext.broadcast(np.argsort(np.argsort(counts(sets, f"{folder}/rare"), kind="stable"), kind="stable").astype(np.uint32))  # 1 MB

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "set", AT_ONCE):
            out: dict[str, list] = {"doc": [], "part": [], "at": [], "shingle": []}
            for doc, part, held in zip(batch.column("doc").to_pylist(), batch.column("part").to_pylist(), batch.column("set"), strict=True):
                elements = np.frombuffer(held.as_buffer(), np.uint64)
                ranks = order.value[(elements % np.uint64(COUNTS)).astype(np.int64)]
                early = np.lexsort((elements, ranks))[: len(elements) - -(-PERCENT * len(elements) // 100) + 1]
                for values, value in zip(out.values(), (np.full(len(early), doc), np.full(len(early), part), np.arange(len(early)), elements[early].view(np.int64)), strict=True):
                    values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).astype(np.int64)) for v in out.values()], names=list(out))

    rows = sets.mapInArrow(first, "doc long, part long, at long, shingle long").join(crowded, ["doc", "part"]).select("shingle", "at", "label", "x")
    sizes = rows.groupBy("shingle", "label").agg(F.count("*").alias("docs"))
    open_ = sizes.groupBy("shingle").agg(F.max(F.struct("docs", "label")).alias("most"), F.count("*").alias("groups")).where("groups > 1")
    rows = keep(rows.join(open_.select("shingle", F.col("most.label").alias("largest")), "shingle").withColumn("main", F.col("label") == F.col("largest")), f"{folder}/rare/places")
    early = rows.where(F.col("x.n") - F.col("at") >= needed(F.col("x.n"), F.col("x.n")))
    side = lambda df, name: df.select("shingle", F.col("label").alias(f"label_{name}"), F.col("at").alias(f"at_{name}"), F.col("x").alias(name))
    fits = F.expr("label_x <> label_y and (x.n < y.n or x.n = y.n and x.doc < y.doc)") & may_link("x", "y")
    fits &= F.least(F.col("x.n") - F.col("at_x"), F.col("y.n") - F.col("at_y")) >= needed(F.col("x.n"), F.col("y.n"))
    outside = side(early.where("not main"), "x").join(side(rows, "y"), "shingle").where(fits)
    inside = side(early.where("main"), "x").join(side(rows.where("not main"), "y"), "shingle").where(fits)
    return outside.select(*ordered("x", "y")).unionByName(inside.select(*ordered("x", "y")))


def counts(sets: DataFrame, folder: str) -> np.ndarray:
    """Shingles of all sets per bucket by hash: a table of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTS, np.int64)
        for batch in batches:
            for held in batch.column("set"):
                total += np.bincount((np.frombuffer(held.as_buffer(), np.uint64) % np.uint64(COUNTS)).astype(np.int64), minlength=COUNTS)
        yield sent(enumerate(total.reshape(CHUNKS, -1)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                total[row["chunk"]] = total.get(row["chunk"], 0) + np.frombuffer(row["counts"], np.int64)
        yield sent(total.items())

    def sent(chunks) -> pa.RecordBatch:
        numbers, arrays = zip(*chunks, strict=True) if (chunks := list(chunks)) else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array([x.tobytes() for x in arrays], pa.binary())], names=["chunk", "counts"])

    schema = "chunk int, counts binary"
    found = keep(sets.select("set").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema), f"{folder}/counts")
    chunks = {row.chunk: np.frombuffer(bytes(row.counts), np.int64) for row in found.collect()}  # 2 MB in all
    return np.concatenate([chunks.get(i, np.zeros(COUNTS // CHUNKS, np.int64)) for i in range(CHUNKS)])


def whole_sets(docs: DataFrame, wanted: DataFrame, folder: str) -> DataFrame:
    """doc, part, set (the distinct shingles, in order) of the wanted documents (doc, part), once each."""
    ids = sized(keep(wanted.select(F.col("doc").alias("doc_id")).distinct(), f"{folder}/ids"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text", AT_ONCE):
            elements, sizes = distinct(*shingles(batch.column("text"), SIZE))
            ends = np.cumsum(sizes)
            held = [elements[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
            parts = np.frombuffer(b"".join(xxhash.xxh3_128_digest(each)[:8] for each in held), "<i8")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(parts), pa.array(held, pa.binary())], names=["doc", "part", "set"])

    # an id may be repeated, with the same text or others
    found = docs.join(ids, "doc_id", "left_semi").mapInArrow(sets, "doc long, part long, set binary")
    return found.groupBy("doc", "part").agg(F.any_value("set").alias("set"))


def links(docs: DataFrame, pairs: DataFrame, folder: str) -> DataFrame:
    """The pairs (a, b) whose full sets link."""
    pairs = keep(pairs, f"{folder}/pairs")
    ends = [pairs.select(F.col(end).alias("doc"), F.col(f"part_{end}").alias("part")) for end in ("a", "b")]
    whole = whole_sets(docs, ends[0].unionByName(ends[1]).distinct(), folder)
    side = lambda end: whole.select(F.col("doc").alias(end), F.col("part").alias(f"part_{end}"), F.col("set").alias(f"set_{end}"))
    both = pairs.join(side("b"), ["b", "part_b"]).join(side("a"), ["a", "part_a"]).select("a", "b", "set_a", "set_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "set_a", AT_ONCE):
            same = []
            for left, right in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (left, right))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                same.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    return keep(both.mapInArrow(compare, "a long, b long").distinct(), f"{folder}/links")


def united(edges: DataFrame) -> DataFrame:
    """Each task's edges (a, b) as trees of depth one: every node with the least of its tree, by union-find."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(node: int) -> int:
            while (up := above.setdefault(node, node)) != node:
                above[node] = above[up]  # halve the path
                node = up
            return node

        def trees() -> pa.RecordBatch:
            nodes = [node for node, up in above.items() if node != up]
            rows = [pa.array(nodes, pa.int64()), pa.array([root(node) for node in nodes], pa.int64())]
            above.clear()
            return pa.RecordBatch.from_arrays(rows, names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = root(a), root(b)
                above[max(a, b)] = min(a, b)
            if len(above) > FOREST:
                yield trees()
        yield trees()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Per row of doc_id and text: doc_id, n_shingles, component_id, kept.

    Null and empty texts, and texts without a word, have no shingles and link with nothing. Rows that repeat an id are
    one document, which links if any of its texts does. Rows without an id link with nothing, their component is null, and they are kept.
    """
    folder = folder or scratch(docs.sparkSession, "superminhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = measured(docs, folder)
    copies = equal_sets(made, folder)
    met, facts = buckets(made, copies, folder)
    first = links(docs, centred(met, facts), f"{folder}/centres")
    known = keep(labels(united(first), f"{folder}/centres/groups"), f"{folder}/centres/labels")
    last = links(docs, remaining(docs, met, facts, known, folder), f"{folder}/remaining")
    # what is known already is a star around each label, and so are equal sets
    stars = [df.select(F.col(x).alias("a"), F.col(y).alias("b")) for df, x, y in ((known.where("node <> label"), "node", "label"), (copies, "doc", "label"))]
    final = labels(united(last.unionByName(stars[0]).unionByName(stars[1])), f"{folder}/groups")
    named = made.select("doc", "n").join(final.select(F.col("node").alias("doc"), "label"), "doc", "left")
    component = F.coalesce("label", "doc")
    return named.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"))


def representatives(docs: DataFrame) -> DataFrame:
    """The documents that are their group's least id, with their columns; rows without an id stay, repeated rows as well."""
    found = components(docs).where("not kept").select(F.col("doc_id").alias("_copy")).distinct()
    copies = sized(keep(found, scratch(docs.sparkSession, "copies")))
    return docs.join(copies, docs["doc_id"] == copies["_copy"], "left_anti")
