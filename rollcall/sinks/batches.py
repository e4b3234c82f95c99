"""Tables that take micro-batches idempotently."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.sinks.log import Log
from rollcall.workspace import exists, folders, remove_folder, size_of

#: Slices of one level that are merged into one of the next.
FAN_IN = 16
#: Versions for which the folders of a slice outlive it, for readers that have begun with an earlier version.
RETAINED = 5
#: Bytes of a file that a merge writes.
FILE_BYTES = 256 << 20


@dataclass(frozen=True)
class Slice:
    """A folder with the rows of the batches from `low` to `batch`."""

    folder: str
    batch: int
    low: int
    level: int = 0


class Slices:
    """Folders that hold batches, named by a log.

    A batch is written into a folder that no version names yet, and one commit to the log makes it the batch's folder. So
    a batch that Spark replays after a crash takes the place of its first run at once: a reader has the one or the other,
    and a crash at any point leaves the version before. Folders of replaced and merged slices are removed some versions
    later. Table and checkpoint belong together: under a new checkpoint the batch numbers start again at 0 and would
    replace older rows, so give it a new table as well.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self.path = path
        self._log = Log(spark, f"{path}/_log")

    def live(self, before: int | None = None) -> list[Slice]:
        """The slices of the newest version, the oldest batch first; only those of batches before one, if given."""
        state = self._log.read() or {"slices": []}
        found = [Slice(**fields) for fields in state["slices"]]
        return [s for s in found if before is None or s.batch < before]

    def place(self, piece: Slice) -> str:
        return f"{self.path}/{piece.folder}"

    def _folder(self, batch: int) -> str:
        # Plain readers of a table find the first run of a batch here, and pass over names that start with an underscore.
        plain = f"batch_id={batch}"
        return f"_{uuid.uuid4().hex}/{plain}" if exists(self._spark, f"{self.path}/{plain}") else plain

    def _commit(self, change: Callable[[list[Slice]], list[Slice] | None]) -> list[Slice]:
        gone: list[str] = []

        def versions(state, number):
            state = state or {"slices": [], "retired": []}
            old = [Slice(**fields) for fields in state["slices"]]
            new = change(old)
            if new is None:
                return None
            new = sorted(new, key=lambda s: s.batch)
            retired = state["retired"] + [[number, s.folder] for s in old if s not in new]
            gone[:] = [folder for at, folder in retired if at <= number - RETAINED]
            return {"slices": [asdict(s) for s in new], "retired": [pair for pair in retired if pair[1] not in gone]}

        state = self._log.commit(versions)
        for folder in gone:
            remove_folder(self._spark, f"{self.path}/{folder.partition('/')[0]}")
        return [Slice(**fields) for fields in (state or {"slices": []})["slices"]]

    def put(self, batch: int, write: Callable[[str], None], drop_before: int | None = None) -> list[Slice]:
        """Write a batch's folder and make it the batch's; slices of batches before `drop_before` leave at the same time."""
        folder = self._folder(batch)
        write(f"{self.path}/{folder}")

        def change(old: list[Slice]) -> list[Slice]:
            # A batch that a merge has taken up can't be told apart in it any more. Spark replays the last batch only.
            if any(s.low <= batch < s.batch or s.low < batch == s.batch for s in old):
                raise ValueError(f"batch {batch} of {self.path} was merged with others")
            kept = [s for s in old if s.batch != batch and not (drop_before is not None and s.batch < drop_before)]
            return [*kept, Slice(folder, batch, batch)]

        return self._commit(change)

    def mergeable(self, fan_in: int = FAN_IN) -> list[Slice]:
        """The oldest slices of a level that has enough of them. The newest batch, which may be replayed, stays apart."""
        settled = self.live()[:-1]
        for level in sorted({s.level for s in settled}):
            same = [s for s in settled if s.level == level]
            if len(same) >= fan_in:
                return same[:fan_in]
        return []

    def merge(self, combine: Callable[[list[str], str], None], fan_in: int = FAN_IN) -> int:
        """Merge slices level by level until no level has enough; the number of merges.

        That may go on beside the stream that writes the table: both commit to one log.
        """
        merges = 0
        while pieces := self.mergeable(fan_in):
            whole = Slice(f"_{uuid.uuid4().hex}/batch_id={pieces[-1].batch}", pieces[-1].batch, pieces[0].low, pieces[0].level + 1)
            combine([self.place(s) for s in pieces], self.place(whole))

            def change(old: list[Slice], pieces=pieces, whole=whole) -> list[Slice] | None:
                return [*(s for s in old if s not in pieces), whole] if set(pieces) <= set(old) else None

            if whole not in self._commit(change):  # another merge was faster
                remove_folder(self._spark, f"{self.path}/{whole.folder.partition('/')[0]}")
            merges += 1
        return merges

    def vacuum(self) -> list[str]:
        """Remove folders that no version names, as crashes leave them. Not while a batch or a merge is being written."""
        state = self._log.read() or {"slices": [], "retired": []}
        named = {s["folder"].partition("/")[0] for s in state["slices"]} | {folder.partition("/")[0] for _, folder in state["retired"]}
        lost = [name for name in folders(self._spark, self.path) if name not in named and name not in ("_log", "batch_id=-1")]
        for name in lost:
            remove_folder(self._spark, f"{self.path}/{name}")
        return lost


class BatchTable:
    """Parquet table that takes each micro-batch once, however often it is written; see `Slices`.

    Read it by this class, `load_users`, or the catalog's table if one is kept (`catalog`): a plain Parquet reader finds all
    rows only until a batch is replayed or merged. With `merge_every`, slices are merged as batches come, so the number of
    files grows with the logarithm of that of batches.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, *, catalog: str | None = None, merge_every: int | None = FAN_IN):
        self._spark = spark
        self.path = path
        empty = spark.createDataFrame([], schema)
        self.schema = empty.schema
        self.slices = Slices(spark, path)
        self._catalog = catalog
        self._merge_every = merge_every
        # Makes the table readable before its first batch; does nothing where it exists.
        empty.write.mode("ignore").parquet(f"{path}/batch_id=-1")

    def replace(self, rows: DataFrame, batch_id: int, drop_before: int | None = None) -> None:
        rows = rows.select(*self.schema.names)
        self.slices.put(batch_id, lambda folder: rows.write.parquet(folder), drop_before)
        if self._merge_every:
            self.compact(self._merge_every)
        self.register()

    def snapshot(self, rows: DataFrame, batch_id: int) -> None:
        """Write a batch that holds the whole state, and drop those before the last one."""
        self.replace(rows, batch_id, drop_before=batch_id - 1)

    def compact(self, fan_in: int = FAN_IN) -> int:
        """Merge the files of many batches; the number of merges."""

        def combine(sources: list[str], target: str) -> None:
            files = max(1, -(-sum(size_of(self._spark, source) for source in sources) // FILE_BYTES))
            self._spark.read.schema(self.schema).parquet(*sources).coalesce(files).write.parquet(target)

        return self.slices.merge(combine, fan_in)

    def _frame(self, pieces: list[Slice]) -> DataFrame:
        batch = F.regexp_extract("_metadata.file_path", r"batch_id=(-?\d+)", 1).cast("long").alias("batch_id")
        if not pieces:
            return self._spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())]))
        return self._spark.read.schema(self.schema).parquet(*map(self.slices.place, pieces)).select(*self.schema.names, batch)

    def read(self) -> DataFrame:
        """The rows with their batch; merged ones have the last of theirs."""
        return self._frame(self.slices.live())

    def rows(self) -> DataFrame:
        return self.read().drop("batch_id")

    def before(self, batch_id: int) -> DataFrame:
        """The rows of earlier batches. A replayed batch must not meet its own rows."""
        return self._frame(self.slices.live(before=batch_id)).drop("batch_id")

    def batch(self, batch_id: int) -> DataFrame:
        """The rows of one batch that isn't merged yet."""
        return self._frame([s for s in self.slices.live() if s.low == s.batch == batch_id]).drop("batch_id")

    def newest(self) -> DataFrame:
        """The rows of the last batch, for sinks that write a full snapshot each time."""
        return self._frame(self.slices.live()[-1:]).drop("batch_id")

    def register(self) -> None:
        """Make the partitions of the catalog's table those of the newest version.

        A replayed batch's partition is pointed to its new folder at once. Merged ones are taken out before the merged
        slice is put in their place, so a query of the catalog's table at that moment may miss rows.
        """
        if not self._catalog:
            return
        wanted = {s.batch: self.slices.place(s) for s in self.slices.live()}
        there = {int(row[0].partition("=")[2]) for row in self._spark.sql(f"SHOW PARTITIONS {self._catalog}").collect()}
        if merged := sorted(there - wanted.keys()):
            gone = ", ".join(f"PARTITION (batch_id = {batch})" for batch in merged)
            self._spark.sql(f"ALTER TABLE {self._catalog} DROP IF EXISTS {gone}")
        for batch, folder in wanted.items():
            if batch in there:
                self._spark.sql(f"ALTER TABLE {self._catalog} PARTITION (batch_id = {batch}) SET LOCATION '{folder}'")
            else:
                self._spark.sql(f"ALTER TABLE {self._catalog} ADD IF NOT EXISTS PARTITION (batch_id = {batch}) LOCATION '{folder}'")
        self._spark.catalog.refreshTable(self._catalog)


class SlotTable:
    """Parquet table of state by slot of time and micro-batch, which forgets old slots."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self._spark = spark
        self.path = path
        self.schema = T.StructType([*(f for f in schema if f.name != "slot"), schema["slot"], T.StructField("batch_id", T.LongType())])

    def _read(self) -> DataFrame:
        if not folders(self._spark, self.path):
            return self._spark.createDataFrame([], self.schema)
        return self._spark.read.schema(self.schema).parquet(self.path)

    def before(self, batch_id: int) -> DataFrame:
        return self._read().filter(F.col("batch_id") < batch_id).drop("batch_id")

    def replace(self, rows: DataFrame, batch_id: int) -> None:
        names = [name for name in self.schema.names if name not in ("slot", "batch_id")]
        placed = rows.select(*names, "slot", F.lit(batch_id).cast("long").alias("batch_id"))
        # Few files per slot, but a slot that holds most of a batch is more than one task's.
        placed = placed.hint("rebalance", "slot")
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot", "batch_id").parquet(self.path)

    def forget(self, slot: int) -> None:
        """Drop the slots before this one."""
        for name in folders(self._spark, self.path):
            number = name.removeprefix("slot=")
            if number.lstrip("-").isdigit() and int(number) < slot:
                remove_folder(self._spark, f"{self.path}/{name}")
