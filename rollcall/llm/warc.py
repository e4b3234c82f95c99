"""Web archives: WARC records written and read back, and an index of captures merged from sorted runs.

Writing: each task appends records to archives of its own, one gzip member per record. Of captures with equal payloads
the one with the largest id is stored, the others are revisits that refer to it; a table of payloads met twice or more,
made by counting digests, says which.

Reading: each task streams whole archives, checks digests, and sorts what it has read into runs of bounded size. A run
is a file of sorted blocks. Blocks' first keys give the ranges of the global order (URL key, time, id), and one task per
range merges the blocks that reach into it with a tree of losers, holding one block per run. With more runs than one
merge may open, runs are first merged group by group into longer ones. A URL with any share of the captures is cut by
time and id like all others.

Files of a failed or repeated task are never named in a table, so they don't count.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import parse_qsl, quote, urlencode, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.loser_tree import merge
from rollcall.llm.shared import files, keep, scratch, single

#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

#: Bytes of an archive before the next is begun; captures sorted at a time; captures in a block of a run.
ARCHIVE_BYTES, RUN_ROWS, BLOCK_ROWS = 128 << 20, 200_000, 2_000
#: Captures merged by a task, and runs that a merge opens at most.
MERGE_ROWS, FAN_IN = 25_000, 256
LEVEL = 3

CAPTURE = pa.schema(
    [
        ("url_key", pa.string()),
        ("time", pa.int64()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)
CAPTURE_DDL = (
    "url_key string, time long, page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, archive string, offset long, length long"
)
ORDER = ("url_key", "time", "page_id")


def url_key(url: str) -> str:
    """Host labels from the right, then path and sorted query in lower case: captures of a site lie together."""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    port = f":{port}" if port and (parts.scheme, port) not in (("http", 80), ("https", 443)) else ""
    query = urlencode(sorted(parse_qsl(parts.query, keep_blank_values=True)))
    return f"{','.join(reversed(host.split('.')))}{port}){(parts.path or '/').lower()}{'?' + query if query else ''}"


def order_of(capture: dict | tuple) -> tuple:
    """Sort key; nulls first."""
    key, time, page = (capture[c] for c in ORDER) if isinstance(capture, dict) else capture[:3]
    return (key or "", time is not None, time or 0, page is not None, page or 0)


def record_id(page: int | None) -> str:
    return f"<urn:page:{page}>" if page is not None else f"<urn:uuid:{uuid.uuid4()}>"


def page_of(record: str | None) -> int | None:
    name = (record or "").strip("<>")
    return int(name.rpartition(":")[2]) if name.startswith("urn:page:") else None


def record(page: int | None, url: str | None, time: int, payload: bytes, refers_to: int | None) -> bytes:
    """One capture as a WARC record: a response, or a revisit that refers to another page's response."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    # header lines hold no control characters; other characters go as they are
    target = quote(url or "", safe="".join(map(chr, range(33, 127)))) if (url or "").isascii() else "".join(c if c > " " else quote(c) for c in url)
    head = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Date: {datetime.fromtimestamp(time / 1e6, UTC).strftime('%Y-%m-%dT%H:%M:%S.%fZ')}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + END + block + END


def headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def parse(data: bytes, archive: str, offset: int, length: int) -> dict:
    """The capture of one record, its digest checked against the payload where that is stored."""
    if not data.startswith(VERSION):
        raise ValueError(f"{archive} at {offset}: no WARC record")
    head, _, rest = data.partition(END)
    fields = headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(END)
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(headers(http)["content-length"])
    if fields["warc-type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest or len(payload) != size:
            raise ValueError(f"{archive} at {offset}: the payload doesn't match its digest")
    when = datetime.strptime(fields["warc-date"], "%Y-%m-%dT%H:%M:%S.%fZ").replace(tzinfo=UTC)
    micros = round((when - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds() * 1_000_000)
    return {
        "url_key": url_key(fields["warc-target-uri"]),
        "time": micros,
        "page_id": page_of(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "record_type": fields["warc-type"],
        "refers_to": page_of(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": digest,
        "archive": archive,
        "offset": offset,
        "length": length,
    }


def members(archive: str, uri: str) -> Iterator[dict]:
    """The captures of an archive, one gzip member held at a time."""
    system, path = files(uri)
    with system.open_input_stream(path, buffer_size=1 << 20) as source:
        start, waiting = 0, b""
        while waiting or (waiting := source.read(1 << 20)):
            member, parts, used = zlib.decompressobj(wbits=31), [], 0
            while not member.eof:
                if not waiting and not (waiting := source.read(1 << 20)):
                    raise ValueError(f"{archive} at {start}: the record is cut off")
                parts.append(member.decompress(waiting))
                used += len(waiting) - len(member.unused_data)
                waiting = member.unused_data
            yield parse(b"".join(parts), archive, start, used)
            start += used


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write a record per row of page_id, url, time (a timestamp) and html; returns the table of archives.

    Of rows with equal payloads of at least min_bytes, those with the largest page_id are responses and the others revisit
    it. A null html is an empty payload, a null url an empty one, a null time the epoch. Rows without a page_id get an
    id of their own, can't be referred to, and revisit like others. Other columns are not stored.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.unix_micros(F.col("time").cast("timestamp")), F.lit(0)).alias("time"),
        F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"),
    )
    digest = F.sha1("payload").alias("digest")
    met = rows.where(F.octet_length("payload") >= min_bytes).select("page_id", digest).groupBy("digest")
    twice = met.agg(F.count("*").alias("rows"), F.max("page_id").alias("original")).where("rows > 1").drop("rows")
    twice = keep(twice, f"{folder}/twice.parquet")  # its size on disk tells Spark whether to broadcast it
    dealt = rows.withColumn("digest", digest).join(twice, "digest", "left")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = files(f"{folder}/archives")
        name, out, count, size = "", None, 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in single(batches, 256):
            for row in batch.to_pylist():
                if out is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(posixpath.join(base, name))
                original = row["original"] if row["original"] != row["page_id"] else None
                packer = zlib.compressobj(LEVEL, wbits=31)
                packed = packer.compress(record(row["page_id"], row["url"], row["time"], row["payload"], original)) + packer.flush()
                out.write(packed)
                count, size = count + 1, size + len(packed)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    done.append((name, count, size))
        if out is not None:
            out.close()
            done.append((name, count, size))
        names, counts, sizes = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["archive", "records", "bytes"])

    given = dealt.select("page_id", "url", "time", "payload", "original")
    return keep(given.mapInArrow(archive, "archive string, records long, bytes long"), f"{folder}/archives.parquet")


BLOCKS = "run string, block int, rows long, first struct<url_key:string,time:long,page_id:long>, last struct<url_key:string,time:long,page_id:long>, range int"


class RunWriter:
    """A run under writing: sorted captures go in, blocks come out."""

    def __init__(self, folder: str, range_: int = -1):
        self.name, self.range, self.blocks, self.rows = f"{uuid.uuid4().hex}.arrow", range_, [], []
        system, path = files(f"{folder}/runs/{self.name}")
        system.create_dir(posixpath.dirname(path), recursive=True)
        self.file = system.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.file, CAPTURE, options=pa.ipc.IpcWriteOptions(compression="zstd"))

    def add(self, capture: dict) -> None:
        self.rows.append(capture)
        if len(self.rows) == BLOCK_ROWS:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            first, last = ({c: row[c] for c in ORDER} for row in (self.rows[0], self.rows[-1]))
            self.blocks.append((self.name, len(self.blocks), len(self.rows), first, last, self.range))
            self.writer.write_batch(pa.RecordBatch.from_pylist(self.rows, CAPTURE))
            self.rows = []

    def close(self) -> list[tuple]:
        self.flush()
        self.writer.close()
        self.file.close()
        return self.blocks


def block_rows(blocks: list[tuple]) -> pa.RecordBatch:
    place = pa.struct([("url_key", pa.string()), ("time", pa.int64()), ("page_id", pa.int64())])
    kinds = [pa.string(), pa.int32(), pa.int64(), place, place, pa.int32()]
    columns = zip(*blocks, strict=True) if blocks else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["run", "block", "rows", "first", "last", "range"])


def scan(spark: SparkSession, folder: str, archives: DataFrame) -> DataFrame:
    """Read whole archives back into sorted runs; returns the table of their blocks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []

        def run() -> pa.RecordBatch:
            writer = RunWriter(folder)
            for capture in sorted(waiting, key=order_of):
                writer.add(capture)
            waiting.clear()
            return block_rows(writer.close())

        for batch in batches:
            for name in batch.column("archive").to_pylist():
                for capture in members(name, f"{folder}/archives/{name}"):
                    waiting.append(capture)
                    if len(waiting) == RUN_ROWS:
                        yield run()
        if waiting:
            yield run()

    named = archives.select("archive")
    spread = named.repartition(max(1, archives.count()), "archive")
    return keep(spread.mapInArrow(read, BLOCKS), f"{folder}/blocks-0.parquet")


def ranges(blocks: DataFrame, count: int) -> list[tuple]:
    """Where the global order is cut for so many tasks: from a bounded, spread sample of blocks' first keys.
    The sample decides how even the tasks are, not what they return."""
    most, there = 64 * count, blocks.count()
    picked = blocks if there <= most else blocks.where(F.pmod(F.xxhash64("run", "block"), F.lit(-(-there // most))) == 0)
    keys = sorted({order_of((r.first.url_key, r.first.time, r.first.page_id)) for r in picked.select("first").collect()})
    return [keys[len(keys) * i // count] for i in range(1, count)] if keys else []


def captures(folder: str, run: str, numbers: list[int], low: tuple | None, high: tuple | None) -> Iterator[dict]:
    """A run's captures from low up to but without high; one block held at a time."""
    system, path = files(f"{folder}/runs/{run}")
    with system.open_input_file(path) as source:
        reader = pa.ipc.open_file(source)
        for number in sorted(numbers):
            for capture in reader.get_batch(number).to_pylist():
                place = order_of(capture)
                if high is not None and place >= high:
                    return
                if low is None or place >= low:
                    yield capture


def ordered(spark: SparkSession, folder: str, blocks: DataFrame) -> DataFrame:
    """All captures in the global order: the place is (range, row)."""
    rows = blocks.agg(F.sum("rows")).first()[0] or 0
    cuts = sorted(set(ranges(blocks, -(-rows // MERGE_ROWS) or 1)))
    bounds = [None, *cuts, None]  # one key per merge task

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"run": [], "block": [], "range": []}
            for row in batch.to_pylist():
                low, high = (bisect_right(cuts, order_of(row[end])) for end in ("first", "last"))
                for number in range(low, high + 1) if row["range"] < 0 else [row["range"]]:
                    out["run"].append(row["run"])
                    out["block"].append(row["block"])
                    out["range"].append(number)
            yield pa.RecordBatch.from_pydict(out, pa.schema([("run", pa.string()), ("block", pa.int32()), ("range", pa.int32())]))

    def merged(key: int, blocks: pd.DataFrame) -> Iterator[dict]:
        low, high = bounds[key], bounds[key + 1]
        runs = [captures(folder, run, part["block"].tolist(), low, high) for run, part in blocks.groupby("run", sort=True)]
        return merge(runs, order_of)

    def shorten(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        writer = RunWriter(folder, int(key[0]))
        for capture in merged(int(key[0]), blocks):
            writer.add(capture)
        return block_rows(writer.close()).to_pandas()

    def emit(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        rows = pa.Table.from_pylist(list(merged(int(key[0]), blocks)), CAPTURE)
        return rows.append_column("range", pa.array([key[0]] * len(rows), pa.int32())).append_column("row", pa.array(range(len(rows)), pa.int64())).to_pandas(
            types_mapper={pa.int64(): pd.Int64Dtype()}.get
        )

    level = 0
    dealt = blocks.mapInArrow(deal, "run string, block int, range int")
    while dealt.groupBy("range").agg(F.countDistinct("run").alias("runs")).where(F.col("runs") > FAN_IN).limit(1).count():
        level += 1
        groups = -(-dealt.select("run").distinct().count() // FAN_IN)
        grouped = dealt.withColumn("group", F.pmod(F.xxhash64("run"), F.lit(groups))).groupBy("range", "group")
        blocks = keep(grouped.applyInPandas(shorten, BLOCKS), f"{folder}/blocks-{level}.parquet")
        dealt = blocks.select("run", "block", "range")
    return dealt.groupBy("range").applyInPandas(emit, f"{CAPTURE_DDL}, range int, row long")


def history(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write archives of the pages, read them back, and return the captures in global order."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "archives")
    return ordered(spark, folder, scan(spark, folder, write(pages, folder, min_bytes)))
