"""Benchmark passages in documents, found by spaced seeds and verified around each hit.

A seed is the hash of some words of a window: a fixed mask says which positions count, the others may differ. Seeds of
documents and of benchmark items meet in a join. A hit fixes an offset between document and item; on that offset the
words are compared one by one. An item leaks into a document if some window of 13 of its words has at least 10 equal
ones there (an item with fewer words: the same share, rounded up). The four masks find every such window, and every item
of at least four words with that share, wherever the substitutions are. Of shorter items all words must be equal, so each
is one seed of all its words.

The benchmark's seeds are broadcast while they are few. Beyond, seeds are shuffled, without the texts: those of documents
with a hit are read once more.

Words are runs of letters and digits in lower case. Null and empty texts hold nothing. Rows are told apart by their id:
rows that repeat an id share its result, and a null id is an id like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import keep, scratch, sized

#: The positions that count. A test tries every placement of substitutions.
MASKS = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4))
#: The masks of items that are too short for those, by their number of words.
SHORT = {1: (0,), 2: (0, 1), 3: (0, 1, 2)}
WINDOW, EQUAL = 13, 10
#: Seeds of the benchmark that are broadcast at most: some 40 bytes each, so 80 MB. Beyond, the join is a shuffle join.
BROADCAST_SEEDS = 2_000_000


def words(text: Column) -> Column:
    """The hashes of a text's words."""
    found = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda word: word != "")
    return F.transform(found, lambda word: F.xxhash64(word))


def seeds(hashed: DataFrame, key: str, at: str, masks: list[tuple[int, ...]], *kept: str, items: bool = False) -> DataFrame:
    """One row per word and mask that fits: the kept columns, the words, the seed, the word's place. Items shorter than the
    masks of others have only the one of their length, and others never that."""
    placed = hashed.select(*kept, "words", F.posexplode("words").alias(at, "_word"))
    ends = F.size("words")

    def seed(mask: tuple[int, ...]) -> Column:
        parts = [F.get("words", F.col(at) + offset) for offset in mask]
        fits = F.col(at) + mask[-1] < ends
        if items:
            fits &= ends == len(mask) if mask in SHORT.values() else ends > max(SHORT)
        return F.when(fits, F.xxhash64(F.lit(",".join(map(str, mask))), *parts))

    made = placed.withColumn(key, F.explode(F.array(*map(seed, masks))))
    return made.where(F.col(key).isNotNull()).drop("_word")


def overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc: str = "doc_id", item: str = "item_id", item_text: str = "text", broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """One row per document and item that leaks into it, under the given id names: item_words, equal_words on the best
    offset, and window_words, the equal words of the best window there."""
    given = docs.select(F.col(doc).alias("doc"), words(F.col(text)).alias("words")).withColumn("copy", F.xxhash64("words"))
    items = benchmark.select(F.col(item).alias("item"), words(F.col(item_text)).alias("words")).distinct()
    lengths = {row.n for row in items.select(F.size("words").alias("n")).where(F.col("n").isin(list(SHORT))).distinct().collect()}  # three at most
    masks = [*MASKS, *(mask for n, mask in SHORT.items() if n in lengths)]
    wanted = seeds(items, "seed", "place", masks, "item", items=True).select("seed", "item", "place", F.size("words").alias("length"))
    few = wanted.count() <= broadcast_seeds
    sought = seeds(given, "seed", "at", masks, "doc", "copy")
    if few:
        hits = sought.join(F.broadcast(wanted), "seed")
    else:
        narrow = sought.select("seed", "doc", "copy", "at").join(wanted, "seed")
        met = narrow.select("doc", "copy", "item", "length", (F.col("at") - F.col("place")).alias("offset")).distinct()
        texts = given.withColumnsRenamed({"doc": "_doc", "copy": "_copy"})
        same_text = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("copy") == F.col("_copy"))
        hits = met.withColumns({"at": F.col("offset"), "place": F.lit(0)}).drop("offset").join(texts, same_text)
    hits = hits.withColumn("offset", F.col("at") - F.col("place"))
    # texts of one id stay apart; a passage's hits all name one offset, and lie in one task: they fold into one row before any shuffle
    start = F.greatest(F.col("offset"), F.lit(0))
    there = F.slice("words", start + 1, F.col("offset") + F.col("length") - start)
    found = hits.groupBy("doc", "copy", "item", "offset", "length").agg(F.any_value(there).alias("there"))
    known = items.select(F.col("item").alias("known"), F.col("words").alias("item_words"))
    pairs = found.join(known, F.col("item").eqNullSafe(F.col("known")) & (F.col("length") == F.size("item_words")))
    skipped = F.greatest(-F.col("offset"), F.lit(0))
    same = F.transform("item_words", lambda word, i: F.when(word.eqNullSafe(F.get("there", i - skipped)), 1).otherwise(0))
    total = lambda part: F.aggregate(part, F.lit(0), lambda a, b: a + b)
    width = F.least(F.col("length"), F.lit(WINDOW))
    compared = pairs.withColumn("same", same).select(
        "doc",
        "item",
        F.col("length").alias("item_words"),
        total(F.col("same")).alias("equal_words"),
        F.array_max(F.transform(F.sequence(F.lit(1), F.col("length") - width + 1), lambda i: total(F.slice("same", i, WINDOW)))).alias("window_words"),
    )
    leaks = compared.where(WINDOW * F.col("window_words") >= EQUAL * F.least(F.col("item_words"), F.lit(WINDOW)))
    best = F.max(F.struct("window_words", "equal_words", "item_words")).alias("best")
    rows = leaks.groupBy("doc", "item").agg(best)
    return rows.select(F.col("doc").alias(doc), F.col("item").alias(item), *[F.col(f"best.{c}").cast("long").alias(c) for c in ("item_words", "equal_words", "window_words")])


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """The documents into which no item leaks, with their columns."""
    leaky = overlaps(docs, benchmark, text, doc).select(F.col(doc).alias("_leaky")).distinct()
    leaky = sized(keep(leaky, scratch(docs.sparkSession, "leaks")))
    return docs.join(leaky, docs[doc].eqNullSafe(leaky["_leaky"]), "left_anti")


ORACLE = r"""
with doc_words as (
  select doc_id, unnest(words) as word, unnest(range(len(words))) as pos
  from (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as words from documents)),
items as (select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as words from benchmark),
item_words as (select item_id, len(words) as n, unnest(words) as word, unnest(range(len(words))) as place from items),
same as (select doc_id, item_id, n, pos - place as o, place from doc_words join item_words using (word)),
windows as (
  select *, count(*) over (partition by doc_id, item_id, o order by place range between current row and 12 following) as w,
         count(*) over (partition by doc_id, item_id, o) as e
  from same),
best as (
  select doc_id, item_id, n, max((w, e)) as b from windows where 13 * w >= 10 * least(n, 13) group by all)
select doc_id, item_id, n::bigint as item_words, b[2]::bigint as equal_words, b[1]::bigint as window_words from best
"""
