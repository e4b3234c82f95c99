"""Token ids in binary shards with keyed access in constant time.

A store is a folder:

  shards/*.ids      the ids of many documents one after the other, little-endian, 2 bytes each if the vocabulary allows
  index/*.mph       per bucket of keys: a minimal perfect hash, then a slot for each key: fingerprint, shard, first id in
                    the shard, number of ids, first id in the store
  shards.parquet    number, file and first id of every shard
  buckets.parquet   number, file and number of keys of every bucket

A lookup hashes the key to a bucket and, by the bucket's function, to a slot; if the slot's fingerprint differs, the key
is not in the store. Keys themselves are not stored.

Documents are dealt to shards by range of key and sorted inside, so ids lie in ascending order of key over all shards; the
rows of a key that has very many lie in several.
A task writes its shard under a name of its own and only files named in the committed tables count, so a task that is
run again, or twice, changes nothing.
"""

from __future__ import annotations

import json
import posixpath
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.bpe import RARE, portions
from rollcall.llm.perfect_hash import PerfectHash, mixed
from rollcall.llm.shared import byte_texts, carried, files, keep, placed, read_file, scratch, single, text_of, write_file

#: Keys in a bucket of the index, on average: what one task builds and one lookup task holds, some MB.
BUCKET_KEYS = 100_000
#: Words remembered per worker in each of two generations; bytes of text worked on at a time.
REMEMBERED, AT_ONCE = 600_000, 8 << 20
#: Records read at a time, and ids of neighbours that come along.
READ_ROWS, READ_IDS = 1_000, 4_000_000
SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("ids", "<u8"), ("start", "<u8")])


class Pool:
    """Ids of strings, one after the other in one array, and where each string's lie."""

    def __init__(self, kind: np.dtype):
        self.known: dict[bytes, int] = {}
        self.ids, self.used = np.empty(1 << 16, kind), 0
        self.ends = np.zeros(1 << 14, np.int64)  # after a leading 0, the end of each string's ids

    def add(self, strings: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        count = len(self.known)
        while len(self.ids) < self.used + len(ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while len(self.ends) < count + len(strings) + 1:
            self.ends = np.concatenate([self.ends, np.empty_like(self.ends)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.ends[count + 1 : count + 1 + len(strings)] = self.used + np.cumsum(sizes)
        self.known.update(zip(strings, range(count, count + len(strings)), strict=True))
        self.used += len(ids)

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of strings by their numbers, one after the other, and how many each has."""
        starts = self.ends[places]
        sizes = self.ends[places + 1] - starts
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)], sizes


class Encoder:
    """The tokenizers library behind a table of the words met before.

    Texts are cut where a pre-token must begin, as in `bpe`; a full stop or comma after a letter, and a newline before a
    word, are pre-tokens of their own. Each distinct word of a batch is looked up once. New words go to the library many
    at a time, as lines of one text: the newline between them stays one id. Texts with unusual white space go there whole.
    """

    def __init__(self, source: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = np.dtype(f"<u{width}")
        added = [t["content"].encode() for t in json.loads(source)["added_tokens"]]
        self.newline, self.stop, self.comma = [self.tokenizer.encode(text, add_special_tokens=False).ids[0] for text in ("\n", ".", ",")]
        self.rare = "|".join([RARE, *(re.escape(token.decode()) for token in added)])
        self.pool, self.older = Pool(self.kind), Pool(self.kind)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers in the pool."""
        if len(self.pool.known) + len(words) > REMEMBERED:
            self.pool, self.older = Pool(self.kind), self.pool
        known = self.pool.known
        places = np.array([known.get(word, -1) for word in words], np.int64)
        missing = np.flatnonzero(places < 0).tolist()
        if not missing:
            return places
        new = [words[i] for i in missing]
        if self.older.known:
            before = np.array([self.older.known.get(word, -1) for word in new], np.int64)
            if (again := before >= 0).any():
                self.pool.add([word for word, there in zip(new, again.tolist(), strict=True) if there], *self.older.of(before[again]))
                new = [word for word, there in zip(new, again.tolist(), strict=True) if not there]
        if new:
            found = np.asarray(self.tokenizer.encode_batch_fast([b"\n".join(new).decode()], add_special_tokens=False)[0].ids, self.kind)
            lines = np.flatnonzero(found == self.newline)
            sizes = np.diff(np.concatenate([[-1], lines, [len(found)]])) - 1
            self.pool.add(new, np.delete(found, lines), sizes)
        places[missing] = [known[words[i]] for i in missing]
        return places

    def encode(self, column: pa.Array) -> list[bytes]:
        """The ids of each text; none for null and empty ones."""
        texts = pc.fill_null(column, "")
        rare = pc.match_substring_regex(texts, self.rare).to_numpy(zero_copy_only=False)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        for i in np.flatnonzero(rare & ~empty).tolist():
            out[i] = np.asarray(self.tokenizer.encode_batch_fast([texts[i].as_py()], add_special_tokens=False)[0].ids, self.kind).tobytes()
        usual = np.flatnonzero(~rare & ~empty)
        if len(usual):
            for i, ids in zip(usual.tolist(), self.gathered(texts.take(pa.array(usual))), strict=True):
                out[i] = ids
        return out

    def gathered(self, texts: pa.Array) -> Iterator[bytes]:
        # every piece follows a space or newline; the newline before a text is taken off again below
        lined = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        parts = pc.split_pattern(lined, " ")
        coded = parts.flatten().dictionary_encode()
        pieces, which = coded.dictionary, coded.indices.to_numpy()
        line = pc.starts_with(pieces, "\n")
        words = pc.if_else(line, pc.utf8_slice_codeunits(pieces, 1), pc.binary_join_element_wise(" ", pieces, ""))
        stop = pc.match_substring_regex(pieces, r"[A-Za-z][.,]\z")
        last = pc.if_else(pc.ends_with(pieces, "."), self.stop, self.comma).to_numpy(zero_copy_only=False)
        stems = pc.if_else(stop, pc.utf8_slice_codeunits(words, 0, -1), words).dictionary_encode()
        line, stop = (flag.to_numpy(zero_copy_only=False) for flag in (line, stop))
        places = self.find(byte_texts(stems.dictionary))
        ids, held = self.pool.of(places[stems.indices.to_numpy()])
        # the ids of each distinct piece: a newline, the word's, a stop
        sizes = held + line + stop
        ends = np.cumsum(sizes)
        starts = ends - sizes
        every = np.empty(int(ends[-1]), self.kind)
        inner = np.repeat(starts + line - (np.cumsum(held) - held), held) + np.arange(len(ids))
        every[inner] = ids
        every[starts[line]] = self.newline
        every[ends[stop] - 1] = last[stop]
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        payload = every[np.repeat(starts[which] - (ends - lengths), lengths) + np.arange(int(ends[-1]))].tobytes()
        offsets = parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()
        width = self.kind.itemsize
        bounds = np.concatenate([[0], ends])[offsets] * width
        for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
            yield payload[a + width : b]


_encoders: dict[tuple[int, int], Encoder] = {}


def encoder(source: str, width: int) -> Encoder:
    key = hash(source), width
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(source, width)
    return _encoders[key]


def id_width(source: str) -> int:
    given = json.loads(source)
    largest = max([*given["model"]["vocab"].values(), *(t["id"] for t in given["added_tokens"])])
    return 2 if largest < 2**16 else 4


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 977) >> np.uint64(32)).astype(np.uint32)


def write(docs: DataFrame, folder: str, tokenizer: str, end: int | None = None, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append the id `end`, and write shards and index under the folder.

    Null and empty texts are records of the end id alone. Rows with a null key are stored after all others. Rows that
    repeat a key are all stored, each under the key and a copy number. Other columns are not stored.
    """
    source_text = text_of(tokenizer)
    source = docs.sparkSession.sparkContext.broadcast(source_text)  # a vocabulary file, some MB
    width = id_width(source_text)
    close = b"" if end is None else np.asarray([end], f"<u{width}").tobytes()

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, name, out = encoder(source.value, width), f"{uuid.uuid4().hex}.ids", None
        number = TaskContext.get().partitionId()
        last, copy, lead, at, row = (), 0, True, 0, 0
        for batch in portions(batches, "text", AT_ONCE):
            if out is None:
                system, path = files(f"{folder}/shards/{name}")
                system.create_dir(posixpath.dirname(path), recursive=True)
                out = system.open_output_stream(path)
            records = [ids + close for ids in known.encode(batch.column("text"))]
            count, sizes = len(records), np.array([len(r) // width for r in records], np.int64)
            out.write(b"".join(records))
            copies, leads = [], []
            for this in batch.column("key").to_pylist():
                if this != last:
                    lead, copy, last = last == (), 0, this
                else:
                    copy += 1
                copies.append(copy)
                leads.append(lead)
            columns = [batch.column("key"), pa.array(copies, pa.int64()), pa.array(leads), pa.array([number] * count, pa.int32()), pa.array([name] * count)]
            columns += [pa.array(np.arange(row, row + count)), pa.array(at + np.cumsum(sizes) - sizes), pa.array(sizes)]
            at, row = at + int(sizes.sum()), row + count
            yield pa.RecordBatch.from_arrays(columns, names=["key", "copy", "lead", "shard", "file", "row", "offset", "ids"])
        if out is not None:
            out.close()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.monotonically_increasing_id().alias("at"), F.col(text).alias("text"))
    # at parts the rows of a key that has many, equal ones too
    by = [F.col("key").asc_nulls_last(), F.col("at")]
    written = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("key", "text").mapInArrow(
        shard, "key long, copy long, lead boolean, shard int, file string, row long, offset long, ids long"
    )
    records = keep(written, f"{folder}/records")

    edge = F.struct("key")
    totals = records.groupBy("shard", "file").agg(
        F.sum("ids").alias("ids"), F.min_by(edge, "row").alias("low"), F.max_by(edge, "row").alias("high"), F.max_by("copy", "row").alias("at")
    )  # one row per shard
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals = keep(totals.withColumn("first", F.coalesce(before, F.lit(0))), f"{folder}/shards.parquet")
    offsets = carried([(r.shard, r.low, r.high, r["at"]) for r in totals.orderBy("shard").collect()])
    shards = totals.select("shard", "first").join(docs.sparkSession.createDataFrame(offsets, "shard int, copies long"), "shard")

    keys = records.count()
    buckets = -(-keys // BUCKET_KEYS) or 1
    starts = records.join(F.broadcast(shards), "shard")  # bounded by the number of partitions
    starts = starts.withColumn("copy", F.col("copy") + F.when(F.col("lead"), F.col("copies")).otherwise(0))
    entries = starts.select("key", "copy", "shard", "offset", "ids", (F.col("first") + F.col("offset")).alias("start"))

    def index(bucket: tuple, entries: pd.DataFrame) -> pd.DataFrame:
        keys = numbered(entries["key"].to_numpy(np.int64), entries["copy"].to_numpy(np.int64), entries["absent"].to_numpy(bool))
        function = PerfectHash.build(keys)
        slots = np.zeros(len(keys), SLOT)
        found = function(keys)
        slots["fingerprint"][found] = fingerprints(keys)
        for field in ("shard", "offset", "ids", "start"):
            slots[field][found] = entries[field].to_numpy()
        name = f"{uuid.uuid4().hex}.mph"
        write_file(f"{folder}/index/{name}", function.dump() + slots.tobytes())
        return pd.DataFrame({"bucket": [bucket[0]], "file": [name], "keys": [len(keys)]})

    dealt = entries.withColumn("bucket", bucket_of(buckets)).withColumns({"absent": F.col("key").isNull(), "key": F.coalesce("key", F.lit(0))})
    keep(dealt.groupBy("bucket").applyInPandas(index, "bucket long, file string, keys long"), f"{folder}/buckets.parquet")
    meta = json.dumps({"width": width, "buckets": buckets, "keys": keys})
    write_file(f"{folder}/meta.json", meta.encode())


def bucket_of(buckets: int):
    return F.pmod(F.xxhash64("key", "copy"), F.lit(buckets))


def numbered(keys: np.ndarray, copies: np.ndarray, absent: np.ndarray) -> np.ndarray:
    """Key and copy number as one number; a first copy's is its key, unless that is absent."""
    plain, turn = keys.view(np.uint64), mixed(copies, 5)
    return np.where(absent, mixed(turn, 13), np.where(copies == 0, plain, mixed(plain ^ turn, 7)))


def locate(spark: SparkSession, folder: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Where each key's record lies: key, shard, offset, ids, start. Keys not in the store have no row. The n-th row that
    asks for a key, or for none, gets its n-th record. A fingerprint of 32 bits lets one unknown key in four billion
    through."""
    meta = json.loads(read_file(f"{folder}/meta.json"))
    named = spark.read.schema("bucket long, file string, keys long").parquet(f"{folder}/buckets.parquet")
    # only numbers of keys are shuffled; a bucket's keys are looked up as they stream by
    asked = keys.select(F.col(key).cast("long").alias("key"), F.monotonically_increasing_id().alias("at"))
    asked = placed(asked, ["key"], ["at"], scratch(spark, "asked")).select("key", F.col("pos").alias("copy"))
    asked = asked.withColumn("bucket", bucket_of(meta["buckets"])).join(named.select("bucket", "file"), "bucket")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, PerfectHash, np.ndarray] | None = None
        for batch in batches:
            names, asked_for = batch.column("file").to_pylist(), batch.column("key")
            absent = asked_for.is_null().to_numpy(zero_copy_only=False)
            wanted = numbered(asked_for.fill_null(0).to_numpy(), batch.column("copy").to_numpy(), absent)
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if opened is None or opened[0] != names[a]:
                    data = read_file(f"{folder}/index/{names[a]}")
                    function, at = PerfectHash.load(data)
                    opened = names[a], function, np.frombuffer(data, SLOT, -1, at)
                slots = opened[2][opened[1](wanted[a:b])]
                there = slots["fingerprint"] == fingerprints(wanted[a:b])
                slots = slots[there]
                columns = [asked_for[a:b].filter(pa.array(there)), pa.array(slots["shard"].astype(np.int32))]
                columns += [pa.array(slots[f].astype(np.int64)) for f in ("offset", "ids", "start")]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "shard", "offset", "ids", "start"])

    near = asked.repartition("bucket").sortWithinPartitions("bucket")
    return near.select("key", "copy", "file").mapInArrow(look, "key long, shard int, offset long, ids long, start long")


def read(spark: SparkSession, folder: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """The ids of each key's record, as little-endian unsigned 32-bit integers: key, start, n_tokens, ids.

    Records of a shard are read in the order they lie, neighbours in one go.
    """
    width = json.loads(read_file(f"{folder}/meta.json"))["width"]
    shards = spark.read.schema("shard int, file string, ids long, first long").parquet(f"{folder}/shards.parquet")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, system = None, None, None
        for batch in single(batches, READ_ROWS):
            rows = batch.to_pydict()
            payloads: list[bytes] = []
            i, held, base = 0, b"", 0
            for i, (file, offset, ids) in enumerate(zip(rows["file"], rows["offset"], rows["ids"], strict=True)):
                if file != name:
                    if source is not None:
                        source.close()
                    system, path = files(f"{folder}/shards/{file}")
                    name, source, held = file, system.open_input_file(path), b""
                a, b = offset * width, (offset + ids) * width
                if not base <= a <= b <= base + len(held):
                    base, upto = a, b
                    for more in range(i + 1, len(rows["file"])):  # neighbours within the reading size come along
                        if rows["file"][more] != file or not a <= rows["offset"][more] * width <= a + READ_IDS * width:
                            break
                        upto = max(upto, (rows["offset"][more] + rows["ids"][more]) * width)
                        if upto - a > READ_IDS * width:
                            break
                    source.seek(a)
                    held = source.read(upto - a)
                payload = held[a - base : b - base]
                payloads.append(payload if width == 4 else np.frombuffer(payload, "<u2").astype("<u4").tobytes())
            columns = [batch.column("key"), batch.column("start"), batch.column("ids"), pa.array(payloads, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "n_tokens", "payload"])
        if source is not None:
            source.close()

    found = locate(spark, folder, keys, key).join(F.broadcast(shards.select("shard", "file")), "shard")
    ordered = found.repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")
    read_back = ordered.select("key", "file", "offset", "ids", "start").mapInArrow(load, "key long, start long, n_tokens long, payload binary")
    return read_back.withColumnsRenamed({"key": key, "payload": "ids"})


def checks(docs: DataFrame, folder: str, tokenizer: str, end: int) -> DataFrame:
    """Write a store of the documents and read every one of them back by its key."""
    write(docs, folder, tokenizer, end)
    stored = read(docs.sparkSession, folder, docs.select("doc_id"))
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


