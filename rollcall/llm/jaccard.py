"""Near-duplicate documents by an n-gram Jaccard join with vertical partitioning.

All shingles have one global order, rare ones first. The order is cut into fragments; documents meet over the rarest of
their shingles, and the overlap of two documents is counted fragment by fragment and summed.

1. Count shingles in a fixed number of buckets by hash, over the whole corpus. A shingle's place in the order is that of
   its bucket, by count, then its hash. So passages that many documents share come last, without a table of shingles.
2. Documents with equal sets are one from here on; the least id stands for them.
3. Two sets with Jaccard similarity t share a shingle among the first n - ceil(t n) + 1 of each. These are the
   documents' postings; shingles that only one document has there are dropped.
4. Stars: among a shingle's documents, those whose postings are shared most are hubs. Each document proposes itself with
   two hubs and one neighbour per shingle, and its three most proposed pairs are compared: as many pairs as documents,
   however large a group is. Links found join documents to components.
5. All others: pairs of different components that share a posting early enough. If a pair's first common shingle stands
   at places i and j, they have at most 1 + min(rest after i, rest after j) in common; so the smaller set must have it
   within its first seventh. Postings that two documents share, all counted, bound their overlap once more.

A pair is compared where one of the two, the one with fewer pairs, is sent its partners' shingles, cut at the fragments.
Links inside a component change nothing and are not sought. Shingles are compared by 64-bit hashes, sets of equal
documents by 128-bit ones.
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
from rollcall.llm.shared import keep, scratch, sized
from rollcall.llm.words import distinct, shingles

SIZE, PERCENT = 5, 75
#: Buckets of the order, chunks in which tasks send their counts, and fragments of the order.
BUCKET_BITS, CHUNKS, FRAGMENTS = 20, 64, 4
BUCKETS = 1 << BUCKET_BITS
#: Pairs a document asks for in the round of stars. What it doesn't ask for there is left to the last round.
ASKED = 3


def least_overlap(n: Column) -> Column:
    """Shingles that a set of n must share with any set it links with."""
    return F.ceil(F.lit(PERCENT) * n / 100)


def needed(n: Column, m: Column) -> Column:
    """Shingles that sets of n and m must share to link."""
    return F.ceil(F.lit(PERCENT) * (n + m) / (100 + PERCENT))


def bucket_counts(docs: DataFrame, folder: str) -> np.ndarray:
    """Shingles per bucket over the whole corpus: a table of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in portions(batches, "text"):
            made, _ = shingles(batch.column("text"), SIZE)
            total += np.bincount((made % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        kind = np.min_scalar_type(int(total.max()))
        counts = pa.array([part.astype(kind).tobytes() for part in total.reshape(CHUNKS, -1)], pa.binary())
        columns = [pa.array(range(CHUNKS), pa.int32()), pa.array([kind.itemsize] * CHUNKS, pa.int32()), counts]
        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "width", "counts"])

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in rows:
            for row in batch.to_pylist():
                total[row["chunk"]] = total.get(row["chunk"], 0) + np.frombuffer(row["counts"], f"u{row['width']}").astype(np.int64)
        columns = [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "counts"])

    sent = docs.select("text").mapInArrow(count, "chunk int, width int, counts binary")
    found = keep(sent.repartition("chunk").mapInArrow(add, "chunk int, counts binary"), f"{folder}/buckets")
    chunks = {row.chunk: np.frombuffer(bytes(row.counts), np.int64) for row in found.collect()}  # 8 MB in all
    return np.concatenate([chunks.get(i, np.zeros(BUCKETS // CHUNKS, np.int64)) for i in range(CHUNKS)])


class Order:
    """The global order: places of buckets, and where fragments end."""

    def __init__(self, counts: np.ndarray):
        by_count = np.argsort(counts, kind="stable")
        self.place = np.empty(BUCKETS, np.uint32)
        self.place[by_count] = np.arange(BUCKETS, dtype=np.uint32)
        held = np.cumsum(counts[by_count])
        self.cuts = np.searchsorted(held, held[-1] * np.arange(1, FRAGMENTS) / FRAGMENTS).astype(np.uint64)

    def sets(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each text's distinct shingles, renamed so that they sort in the global order, and their number. The new name
        is the bucket's place, then the hash's other bits: as unique as the hash."""
        made, counts = shingles(texts, SIZE)
        bucket = self.place[(made % np.uint64(BUCKETS)).astype(np.int64)].astype(np.uint64)
        return distinct((bucket << np.uint64(64 - BUCKET_BITS)) | (made >> np.uint64(BUCKET_BITS)), counts)

    def fragments(self, tokens: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, tokens >> np.uint64(64 - BUCKET_BITS), side="right")


def measured(docs: DataFrame, order, folder: str) -> DataFrame:
    """Per row: doc, n (distinct shingles), set (its hash), tokens (its first ones in the global order)."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            tokens, sizes = order.value.sets(batch.column("text"))
            ends = np.cumsum(sizes)
            starts = ends - sizes
            hashes = [xxhash.xxh3_128_digest(tokens[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            prefix = np.where(sizes > 0, sizes - -(-PERCENT * sizes // 100) + 1, 0)
            at = np.repeat(starts - (np.cumsum(prefix) - prefix), prefix) + np.arange(int(prefix.sum()))
            offsets = pa.array(np.concatenate([[0], np.cumsum(prefix)]).astype(np.int32))
            columns = [batch.column("doc_id"), pa.array(sizes.astype(np.int32)), pa.array(hashes, pa.binary())]
            columns.append(pa.ListArray.from_arrays(offsets, pa.array(tokens[at].view(np.int64))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "set", "tokens"])

    return keep(docs.mapInArrow(first, "doc long, n int, set binary, tokens array<long>"), f"{folder}/sets")


def equal_sets(made: DataFrame, folder: str) -> DataFrame:
    """doc, set, label: documents whose set a smaller id has too, that set, and the least of these ids."""
    there = made.where("doc is not null and n > 0")
    least = there.groupBy("set").agg(F.min("doc").alias("label"), F.max("doc").alias("last")).where("label < last").drop("last")
    pairs = there.select("doc", "set").join(least, "set").where("doc <> label").select("doc", "set", "label").distinct()
    return keep(pairs, f"{folder}/copies")


def parted(made: DataFrame, folder: str) -> DataFrame:
    """Adds part, which tells the sets of a repeated id apart: 0 for ids with one set."""
    name = F.xxhash64("set")
    several = made.where("doc is not null and n > 0").groupBy("doc").agg(F.min(name).alias("low"), F.max(name).alias("high"))
    several = keep(several.where("low < high").select(F.col("doc").alias("_several")), f"{folder}/several")
    return made.join(sized(several), F.col("doc") == F.col("_several"), "left").withColumn("part", F.when(F.col("_several").isNotNull(), name).otherwise(0)).drop("_several")


def postings(made: DataFrame, copies: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Postings that two or more documents share (token, doc, part, n, at, met), and per set of a document its tokens
    among them and how often these are shared."""
    rows = made.where("doc is not null and n > 0").join(sized(copies.select("doc", "set")), ["doc", "set"], "left_anti")
    rows = parted(rows, folder).select("doc", "part", "n", F.posexplode("tokens").alias("at", "token"))
    met = rows.withColumn("met", F.count("*").over(Window.partitionBy("token"))).where("met > 1")
    met = keep(met, f"{folder}/postings")
    of_doc = met.groupBy("doc", "part").agg(F.max("n").alias("n"), F.sum("met").alias("score"), F.collect_set("token").alias("tokens"))
    return met, keep(of_doc, f"{folder}/shared")


def ordered(doc: str, part: str, other: str, other_part: str) -> list[Column]:
    """The columns of a pair, the smaller id first: a, part_a, b, part_b."""
    low = F.col(doc) < F.col(other)
    pick = lambda x, y, name: F.when(low, F.col(x)).otherwise(F.col(y)).alias(name)
    return [pick(doc, other, "a"), pick(part, other_part, "part_a"), pick(other, doc, "b"), pick(other_part, part, "part_b")]


def stars(met: DataFrame, of_doc: DataFrame) -> DataFrame:
    """The pairs (a, part_a, b, part_b) that documents ask for first."""
    rows = met.select("token", "doc", "part", "n").join(of_doc.select("doc", "part", "score"), ["doc", "part"])
    ranked = Window.partitionBy("token").orderBy(F.desc("score"), "doc", "part")
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one = F.struct("doc", "part", "n")
    near = [F.first(one).over(whole), F.nth_value(one, 2).over(whole), F.lag(one).over(ranked)]
    asked = rows.select("doc", "part", "n", F.array(*near).alias("near")).select("doc", "part", "n", F.explode("near").alias("other"))
    asked = asked.where("other.doc <> doc").where(F.least("n", "other.n") >= least_overlap(F.greatest("n", "other.n")))
    pairs = asked.groupBy(*ordered("doc", "part", "other.doc", "other.part")).agg(F.count("*").alias("times"))
    best = Window.partitionBy("doc", "part").orderBy(F.desc("times"), "a", "b", "part_a", "part_b")
    ends = F.array(*[F.struct(F.col(end).alias("doc"), F.col(f"part_{end}").alias("part")) for end in ("a", "b")])
    each = pairs.select("*", F.inline(ends))
    return each.withColumn("place", F.row_number().over(best)).where(F.col("place") <= ASKED).select("a", "part_a", "b", "part_b").distinct()


def others(met: DataFrame, known: DataFrame, folder: str) -> DataFrame:
    """All pairs (a, part_a, b, part_b) of different components that a common posting allows to link."""
    found = met.join(known.select(F.col("node").alias("doc"), "label"), "doc", "left").withColumn("label", F.coalesce("label", "doc"))
    around = Window.partitionBy("token")
    several = found.withColumn("low", F.min("label").over(around)).withColumn("high", F.max("label").over(around))
    several = keep(several.where("low < high").select("token", "doc", "part", "n", "at", "label"), f"{folder}/open")
    sizes = several.groupBy("token", "label").agg(F.count("*").alias("docs"))
    largest = sizes.groupBy("token").agg(F.max_by("label", F.struct("docs", "label")).alias("largest"))
    rows = several.join(largest, "token").withColumn("main", F.col("label") == F.col("largest"))
    early = rows.where(F.col("n") - F.col("at") >= needed(F.col("n"), F.col("n")))
    side = lambda df, end: df.select("token", *[F.col(c).alias(f"{c}_{end}") for c in ("doc", "part", "n", "at", "label")])
    fits = F.expr("label_x <> label_y and (n_x < n_y or n_x = n_y and doc_x < doc_y)")
    fits &= F.col("n_x") >= least_overlap(F.col("n_y"))
    fits &= F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y")) >= needed(F.col("n_x"), F.col("n_y"))
    outside = side(early.where("not main"), "x").join(side(rows, "y"), "token").where(fits)
    inside = side(early.where("main"), "x").join(side(rows.where("not main"), "y"), "token").where(fits)
    pairs = [p.select(*ordered("doc_x", "part_x", "doc_y", "part_y")) for p in (outside, inside)]
    return pairs[0].unionByName(pairs[1]).distinct()


def possible(pairs: DataFrame, of_doc: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shared postings leave room for enough overlap.

    All that two sets share up to the end of the postings that end first is shared postings; after it, at most what
    that document has left.
    """
    side = lambda end: of_doc.select(F.col("doc").alias(end), F.col("part").alias(f"part_{end}"), F.col("n").alias(f"n_{end}"), F.col("tokens").alias(f"tokens_{end}"))
    both = pairs.join(side("a"), ["a", "part_a"]).join(side("b"), ["b", "part_b"])
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    rest = F.greatest(least_overlap(F.col("n_a")), least_overlap(F.col("n_b"))) - 1
    return both.where(shared + rest >= needed(F.col("n_a"), F.col("n_b"))).select("a", "b")


def links(docs: DataFrame, pairs: DataFrame, order, folder: str) -> DataFrame:
    """The pairs (a, b) that link: partial overlaps per fragment, summed per pair."""
    pairs = keep(pairs, f"{folder}/pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc")).groupBy("doc").agg(F.count("*").alias("pairs"))
    degree = lambda end: ends.select(F.col("doc").alias(end), F.col("pairs").alias(f"pairs_{end}"))
    hosted = pairs.join(degree("a"), "a").join(degree("b"), "b")
    host = F.when(F.col("pairs_a") <= F.col("pairs_b"), F.col("a")).otherwise(F.col("b"))
    sent = hosted.select(host.alias("host"), F.explode(F.array("a", "b")).alias("doc"))
    targets = keep(sent.groupBy("doc").agg(F.collect_set("host").alias("hosts")), f"{folder}/targets")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            tokens, sizes = order.value.sets(batch.column("text"))
            ends, ids, hosts = np.cumsum(sizes), batch.column("doc_id").to_pylist(), batch.column("hosts").to_pylist()
            out: dict[str, list] = {name: [] for name in ("host", "fragment", "doc", "set", "n", "tokens")}
            for doc, targets, start, end in zip(ids, hosts, (ends - sizes).tolist(), ends.tolist(), strict=True):
                mine = tokens[start:end]
                name, parts = xxhash.xxh3_64_intdigest(mine.tobytes()) >> 1, order.value.fragments(mine)
                for fragment in np.unique(parts).tolist():
                    part = mine[parts == fragment].view(np.int64)
                    for target in targets:
                        for key, value in zip(out, (target, fragment, doc, name, end - start, part), strict=True):
                            out[key].append(value)
                    if sum(map(len, out["tokens"][-len(targets) :])) > 1_000_000:
                        yield rows(out)
            yield rows(out)

    def rows(out: dict[str, list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())]
        batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))
        for values in out.values():
            values.clear()
        return batch

    met = docs.join(sized(targets), docs["doc_id"] == targets["doc"]).select("doc_id", "text", "hosts")
    parts = met.mapInArrow(cut, "host long, fragment int, doc long, set long, n int, tokens array<long>")
    # rows that repeat an id are told apart by their sets, and equal ones fold
    groups = parts.groupBy("host", "fragment").agg(F.collect_set(F.struct("doc", "set", "n", "tokens")).alias("all"))
    own = F.filter("all", lambda x: x["doc"] == F.col("host"))
    guests = F.filter("all", lambda x: x["doc"] != F.col("host"))

    def against(mine: Column) -> Column:
        return F.transform(
            guests,
            lambda x: F.struct(
                x["doc"].alias("doc"), mine["set"].alias("set"), x["set"].alias("other"), (mine["n"] + x["n"]).alias("sum"),
                F.size(F.array_intersect(mine["tokens"], x["tokens"])).alias("overlap"),
            ),
        )

    partial = groups.select("host", F.inline(F.flatten(F.transform(own, against))))
    summed = partial.groupBy("host", "doc", "set", "other", "sum").agg(F.sum("overlap").alias("overlap"))
    linked = summed.where(F.expr(f"100 * overlap >= {PERCENT} * (sum - overlap)"))
    return keep(linked.select(F.least("host", "doc").alias("a"), F.greatest("host", "doc").alias("b")).distinct(), f"{folder}/links")


def components(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Per row of doc_id and text: doc_id, n_shingles, component_id.

    Null and empty texts, and texts without a word, have no shingles and link with nothing. Rows that repeat an id are
    one document, which links if any of its texts does. Rows without an id link with nothing; their component is null.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = spark.sparkContext.broadcast(Order(bucket_counts(docs, folder)))  # 4 MB
    made = measured(docs, order, folder)
    copies = equal_sets(made, folder)
    met, of_doc = postings(made, copies, folder)
    first = links(docs, possible(stars(met, of_doc), of_doc), order, f"{folder}/stars")
    known = keep(labels(first, f"{folder}/stars/components"), f"{folder}/stars/labels")
    last = links(docs, possible(others(met, known, folder), of_doc), order, f"{folder}/others")
    # what is known already is a star around each label, and so are equal sets
    edges = [last, *[df.select(F.col(x).alias("a"), F.col(y).alias("b")) for df, x, y in ((known.where("node <> label"), "node", "label"), (copies, "doc", "label"))]]
    final = labels(edges[0].unionByName(edges[1]).unionByName(edges[2]), f"{folder}/components")
    named = made.select("doc", "n").join(final.select(F.col("node").alias("doc"), "label"), "doc", "left")
    return named.select(F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.coalesce("label", "doc").alias("component_id"))


def representatives(docs: DataFrame) -> DataFrame:
    """The documents that are their component's smallest id, with their columns; of rows that repeat an id and its text, one.

    Rows without an id stay, all of them. Which of two such rows stays, where other columns differ, is not defined.
    """
    folder = scratch(docs.sparkSession, "copies")
    found = components(docs).where("component_id <> doc_id").select(F.col("doc_id").alias("_copy")).distinct()
    copies = sized(keep(found, f"{folder}/copies"))
    kept = docs.join(copies, docs["doc_id"] == copies["_copy"], "left_anti")
    # ids are counted before the shuffle; where none is repeated, that is all
    repeated = keep(docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select(F.col("doc_id").alias("_again")), f"{folder}/repeated")
    if repeated.isEmpty():
        return kept
    ids, same = sized(repeated), kept["doc_id"] == repeated["_again"]
    once = kept.join(ids, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(ids, same, "left_anti").unionByName(once)
