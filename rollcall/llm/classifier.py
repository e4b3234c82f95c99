"""A quality classifier: gradient-boosted trees over statistics of a document's text.

Statistics are counted in numpy for many texts at once, in the tasks that read them. The trees are fitted on a bounded
sample of labelled documents, whose statistics (not texts) come to the driver, and go to the tasks as flat arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm import trees
from rollcall.llm.bpe import portions
from rollcall.llm.shared import byte_texts, replaced, without
from rollcall.llm.words import STEP, word_hashes

#: Labelled documents the trees are fitted on, about; if there are more, they are chosen by a hash of their ids.
SAMPLE = 20_000
#: Scores from here on are predicted as good.
THRESHOLD = 0.3
FOLDS, WINDOW = 5, 8
#: The characters counted as symbols.
CLASSES = {
    "symbols": b"#*$%&|<>",
    "bangs": b"!?",
    "stops": b".,;:",
    "digits": b"0123456789",
    "capitals": bytes(range(65, 91)),
    "letters": bytes(range(97, 123)),
    "wide": bytes(range(128, 256)),
    "spaces": b" \t\n\x0b\f\r",
    "lines": b"\n",
    "marks": b"()[]{}\"'`=_~^@/\\+-",
    "controls": bytes([*range(9), *range(14, 32), 127]),
}
STATISTICS = [
    "words", "word_bytes", *[f"{name}_share" for name in CLASSES], "symbols_per_word", "capitals_per_letter", "distinct_words",
    "words_twice_in_a_row", "windows_met_before", "lines_met_before", "words_per_line", "common_word",
]


def _per_text(ends: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """How many marked items each text has, given where each text's items end."""
    return np.diff(np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])[np.concatenate([[0], ends])])


def _seen(owner: np.ndarray, values: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the number of distinct values, and how often the commonest occurs."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    most = np.zeros(texts, np.int64)
    np.maximum.at(most, owner[at], np.diff(np.concatenate([at, [len(values)]])))
    return np.bincount(owner[at], minlength=texts), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text; null and empty texts are zeros."""
    texts = pc.fill_null(texts, "")
    count = len(texts)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(byte_texts(texts)), np.uint8)
    ends = np.cumsum(sizes)
    number = {}
    for name, members in CLASSES.items():
        marked = np.zeros(256, bool)
        marked[list(members)] = True
        number[name] = _per_text(ends, marked[data])
    hashes, words = word_hashes(texts)
    owner, last = np.repeat(np.arange(count), words), np.cumsum(words)
    distinct, commonest = _seen(owner, hashes, count)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    mixed = np.zeros(max(0, len(hashes) - WINDOW + 1), np.uint64)
    for k in range(WINDOW):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * STEP + hashes[k : k + len(mixed)]
    inside = owner[: len(mixed)] == owner[WINDOW - 1 :] if len(mixed) else np.zeros(0, bool)
    windows = np.bincount(owner[: len(mixed)][inside], minlength=count)
    fresh, _ = _seen(owner[: len(mixed)][inside], mixed[inside], count)
    lines = pc.split_pattern(texts, "\n")
    of, coded = pc.list_parent_indices(lines).to_numpy(), lines.flatten().dictionary_encode().indices.to_numpy()
    all_lines = np.bincount(of, minlength=count)
    new_lines, _ = _seen(of, coded, count)
    share = lambda a, b: a / np.maximum(b, 1)
    columns = [
        words, share(sizes - number["spaces"], words), *[share(number[name], sizes) for name in CLASSES], share(number["symbols"], words),
        share(number["capitals"], number["capitals"] + number["letters"]), share(distinct, words), share(_per_text(last, again), words),
        share(windows - fresh, windows), share(all_lines - new_lines, all_lines), share(words, all_lines), share(commonest, words),
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1) * (sizes > 0)[:, None]


def fold(doc: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc).cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> trees.Trees:
    """Trees for the label, from about SAMPLE labelled documents outside fold 0.

    Labels that are null or neither 0 nor 1 don't count; a document with several rows or labels counts with each.
    """
    given = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").where(fold() != 0)
    labelled = given.count()
    chosen = given.where(F.pmod(F.xxhash64("doc_id"), F.lit(labelled)) < SAMPLE) if labelled > SAMPLE else given

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text"):
            rows = pa.FixedSizeListArray.from_arrays(pa.array(statistics(batch.column("text")).ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), rows], names=["label", "row"])

    # the sample is bounded, so it may go to every task; its statistics may come to the driver
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text").mapInArrow(measure, "label int, row array<double>")
    rows = found.toPandas()
    table = np.array(rows["row"].tolist(), float).reshape(len(rows), len(STATISTICS))
    order = np.lexsort((*table.T, rows["label"].to_numpy(int)))  # sums, and so trees, don't depend on the order of arrival
    return trees.fit(table[order], rows["label"].to_numpy(float)[order])


def scored(docs: DataFrame, model: trees.Trees, text: str = "text", score: str = "score") -> DataFrame:
    """Adds the chance that a whole text is good; a given column of that name is replaced, all others stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, text):
            yield replaced(batch, {score: pa.array(shared.value.predict(statistics(batch.column(text))))})

    return docs.mapInArrow(run, T.StructType([*without(docs, score).schema.fields, T.StructField(score, T.DoubleType())]))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it is held out of training, its score and the prediction."""
    rows = scored(docs.select("doc_id", "text"), train(docs, labels)).drop("text")
    return rows.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted as good, with their columns; trained on those of them that are labelled."""
    return scored(docs, train(docs, labels), score="_accepted").where(F.col("_accepted") >= THRESHOLD).drop("_accepted")
