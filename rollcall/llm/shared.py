"""What several operators need: tables kept in the shared folder, files beside them, and the given tables."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.workspace import new_folder

#: White space that separates words in the contracts: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keep(df: DataFrame, folder: str) -> DataFrame:
    """Write the table and read it back: the lineage ends here, and a lost executor recomputes nothing before it."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Rows of ids that are broadcast at most, some 100 MB as a hash table.
BROADCAST_IDS = 2_000_000


def sized(ids: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast if it is small enough; beyond, Spark shuffles the join."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def scratch(spark: SparkSession, purpose: str) -> str:
    return new_folder(spark, purpose)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by name in either case, so that the columns an operator adds never clash with given ones."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def files(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, for tasks that write files of a format of their own."""
    return fs.FileSystem.from_uri(uri if ":" in uri else posixpath.abspath(uri))


def write_file(uri: str, data: bytes) -> None:
    system, path = files(uri)
    system.create_dir(posixpath.dirname(path), recursive=True)
    with system.open_output_stream(path) as out:
        out.write(data)


def read_file(uri: str) -> bytes:
    system, path = files(uri)
    with system.open_input_stream(path) as source:
        return source.read()


@cache
def text_of(path: str) -> str:
    with open(path, encoding="utf-8") as source:
        return source.read()


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """A text column as UTF-8 bytes, not decoded."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def replaced(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch without columns of these names (in either case), then these columns."""
    taken = {name.lower() for name in columns}
    kept = [i for i, name in enumerate(batch.schema.names) if name.lower() not in taken]
    arrays = [batch.column(i) for i in kept] + list(columns.values())
    return pa.RecordBatch.from_arrays(arrays, names=[batch.schema.names[i] for i in kept] + list(columns))


def single(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most so many rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def carried(parts: list[tuple]) -> list[tuple[int, int]]:
    """For parts of sorted rows (part, first group, last group, last number in that), in order: the part, and the rows of its
    first group that lie in parts before it."""
    offsets, before, held = [], None, 0
    for part, first, last, at in parts:
        offset = held if offsets and first == before else 0
        held = at + 1 + (offset if first == last else 0)
        before = last
        offsets.append((part, offset))
    return offsets


def placed(rows: DataFrame, group: list[str], order: list[str], folder: str) -> DataFrame:
    """Adds pos: each row's number in its group, in the given order, null first.

    Rows are dealt by range and numbered inside their part. Only a part's first group can have begun in an earlier one, so
    one offset per part is all that is added.
    """
    schema = "_part int, _local long, _lead boolean, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, lead, count = TaskContext.get().partitionId(), None, True, 0
        for batch in batches:
            keys = list(zip(*[batch.column(name).to_pylist() for name in group], strict=True)) if group else [()] * batch.num_rows
            local, leads = [], []
            for key in keys:
                if key != last:
                    lead, last, count = last is None, key, 0
                local.append(count)
                leads.append(lead)
                count += 1
            columns = [pa.array([part] * len(keys), pa.int32()), pa.array(local, pa.int64()), pa.array(leads, pa.bool_()), *batch.columns]
            yield pa.RecordBatch.from_arrays(columns, names=["_part", "_local", "_lead", *batch.schema.names])

    by = [F.col(name).asc_nulls_first() for name in [*group, *order]]
    found = keep(rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(number, schema), folder)
    name = F.struct(*group) if group else F.lit(1)
    edges = found.groupBy("_part").agg(F.min(name).alias("first"), F.max(name).alias("last"), F.max_by("_local", F.struct(name, "_local")).alias("at"))
    offsets = carried([tuple(row) for row in edges.orderBy("_part").collect()])  # one row per part
    named = rows.sparkSession.createDataFrame(offsets, "_part int, _offset long")
    pos = F.col("_local") + F.when(F.col("_lead"), F.col("_offset")).otherwise(0)
    return found.join(F.broadcast(named), "_part").select(*rows.columns, pos.alias("pos"))
