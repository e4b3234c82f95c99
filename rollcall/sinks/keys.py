"""An index of the keys that a table has taken, so that a batch opens only the files its keys may be in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.sinks.batches import FAN_IN, Slices

#: Files of a slice, by hash of the key; and words of a file's filter, 64 bits each.
BUCKETS, WORDS = 64, 1 << 18
#: Bits that a key sets in its word.
BITS = 5
KEYS, FILTER = "side int, key string", "side int, bucket int, word int, bits long"


class KeyIndex:
    """Keys of several columns by batch, in files dealt by hash, each with a Bloom filter.

    A filter is rows of 64-bit words: a key's hash names a word and five bits in it. A batch's keys are joined with the
    words; only files for which some key finds all its bits set are opened, and there the keys themselves are compared. So
    a false hit costs a file, never a wrong answer, and fresh keys open hardly any file, however large the table is. A
    filter holds some four keys a word before false hits become common: 67 million keys a slice and column; give larger
    tables more buckets. Slices are merged by levels.
    """

    def __init__(self, spark: SparkSession, path: str, columns: tuple[str, ...], *, buckets: int = BUCKETS, merge_every: int = FAN_IN):
        self._spark = spark
        self._columns, self._buckets, self._merge_every = columns, buckets, merge_every
        self.slices = Slices(spark, path)

    def _listed(self, rows: DataFrame) -> DataFrame:
        """side, key: the columns' values under each other."""
        pairs = [F.struct(F.lit(side).alias("side"), F.col(name).alias("key")) for side, name in enumerate(self._columns)]
        return rows.select(F.inline(F.array(*pairs))).where("key is not null")

    def _placed(self, listed: DataFrame) -> DataFrame:
        """Adds bucket, word and mask. Each uses bits of the hash of its own."""
        hashed = F.xxhash64("key")

        def bit(number: int) -> Column:
            return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(hashed, 6 * number).bitwiseAND(F.lit(63)).cast("int"))

        mask = bit(0)
        for number in range(1, BITS):
            mask = mask.bitwiseOR(bit(number))
        word = F.pmod(F.shiftright(hashed, 30), F.lit(WORDS)).cast("int")
        bucket = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(self._buckets)).cast("int")
        return listed.withColumns({"bucket": bucket, "word": word, "mask": mask})

    def _write(self, listed: DataFrame, folder: str) -> None:
        placed = self._placed(listed)
        placed.select("side", "key", "bucket").repartition("bucket").sortWithinPartitions("bucket", "side", "key").write.partitionBy("bucket").parquet(f"{folder}/keys")
        written = self._placed(self._spark.read.schema(f"{KEYS}, bucket int").parquet(f"{folder}/keys").drop("bucket"))
        words = written.groupBy("side", "bucket", "word").agg(F.bit_or("mask").alias("bits"))
        words.sortWithinPartitions("bucket", "side", "word").write.parquet(f"{folder}/filter")

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """The keys that a batch has taken."""
        self.slices.put(batch_id, lambda folder: self._write(self._listed(rows), folder))

        def combine(sources: list[str], target: str) -> None:
            self._write(self._spark.read.schema(KEYS).option("recursiveFileLookup", True).parquet(*(f"{source}/keys" for source in sources)), target)

        self.slices.merge(combine, self._merge_every)

    def taken(self, rows: DataFrame, batch_id: int) -> DataFrame | None:
        """The keys of these rows that earlier batches have taken: the index's columns, all but one null in a row. None if
        there are none."""
        pieces = self.slices.live(before=batch_id)
        if not pieces:
            return None
        asked = self._placed(self._listed(rows).distinct())
        filters = self._spark.read.schema(FILTER).parquet(*(f"{self.slices.place(s)}/filter" for s in pieces))
        batch = F.regexp_extract("_metadata.file_path", r"batch_id=(-?\d+)", 1).cast("int").alias("batch")
        words = filters.select("side", "bucket", "word", "bits", batch)
        hits = asked.join(words, ["side", "bucket", "word"]).where("bits & mask = mask").select("batch", "bucket").distinct().collect()
        if not hits:  # at most a row per file
            return None
        places = {s.batch: self.slices.place(s) for s in pieces}
        stored = self._spark.read.schema(KEYS).parquet(*(f"{places[row.batch]}/keys/bucket={row.bucket}" for row in hits))
        found = stored.join(asked.select("side", "key"), ["side", "key"], "left_semi")
        return found.select(*(F.when(F.col("side") == side, F.col("key")).alias(name) for side, name in enumerate(self._columns)))
