"""Byte-pair encoding and decoding by merge ranks.

A pre-token's symbols form a doubly linked list. A priority queue holds the rank of every adjacent pair that merges; the
lowest rank merges first, leftmost among equals. A merge only changes links, so queue entries of pairs that are no longer
there stay behind and are skipped when they come up. A pre-token of n bytes takes O(n log n), however long it is.

Texts are cut where a pre-token must begin (a space before a character that isn't white space; a newline between two
such characters). Each distinct piece of a batch is looked up once, in a table of bounded size of pieces met before, and
the ids of texts are gathered from those of their pieces.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.shared import byte_texts, replaced, text_of, without

#: The pattern that cuts text into pre-tokens before any merge.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A space at which a text may be cut: what follows is no white space (bytes that may start wide white space count as such).
CUT = re.compile(rb" (?=[^\s\x1c-\x1f\xc2\xe1\xe2\xe3])")
#: Texts that need that careful cut: white space other than single spaces and newlines between other characters.
RARE = r"[\x00-\x09\x0b-\x1f\x{85}\x{a0}\x{1000}-\x{3fff}]|[ \n][ \n]|^[ \n]|[ \n]\z"
#: Pieces remembered per worker in each of two generations, some 200 bytes each; bytes of text worked on at a time.
REMEMBERED, AT_ONCE = 300_000, 2 << 20


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary strings: itself if printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def portions(batches: Iterator[pa.RecordBatch], text: str, size: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Batches cut where the column's values reach so many bytes; a longer value stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right"))
            upto = max(upto, at + 1)
            yield batch.slice(at, upto - at)
            at = upto
    pa.default_memory_pool().release_unused()  # a worker waits for its next task without what this one took


class Pieces:
    """Encodes texts from the ids of their pieces.

    learn(pieces, plain) gives the ids of pieces; plain ones are one word after a space or newline. careful(text) gives
    the pieces of a text that can't be cut at every space.
    """

    def __init__(self, learn, careful, newline: bytes, width: int, added: Iterable[bytes], remembered: int = REMEMBERED):
        self.learn, self.careful, self.newline, self.width, self.remembered = learn, careful, newline, width, remembered
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.rare = "|".join([RARE, *(re.escape(token.decode()) for token in added)])

    def ids(self, pieces: list[bytes], plain: bool) -> list[bytes]:
        known = self.known
        found = list(map(known.get, pieces))
        new = list(dict.fromkeys([p for p, ids in zip(pieces, found, strict=True) if ids is None]))
        if not new:
            return found
        made = {p: ids for p in new if (ids := self.older.get(p)) is not None}
        new = [p for p in new if p not in made] if made else new
        made.update(zip(new, self.learn(new, plain), strict=True))
        if len(known) + len(made) > self.remembered:
            self.older, self.known = known, made
        else:
            known.update(made)
        return [made[p] if ids is None else ids for p, ids in zip(pieces, found, strict=True)]

    def encode(self, column: pa.Array) -> list[bytes]:
        """The ids of each text; none for null and empty ones."""
        texts = pc.fill_null(column, "")
        rare = pc.match_substring_regex(texts, self.rare).to_numpy(zero_copy_only=False)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        for i in np.flatnonzero(rare & ~empty).tolist():
            out[i] = b"".join(self.ids(self.careful(texts[i].as_py().encode()), False))
        usual = np.flatnonzero(~rare & ~empty)
        if len(usual):
            for i, ids in zip(usual.tolist(), self.gathered(texts.take(pa.array(usual))), strict=True):
                out[i] = ids
        return out

    def gathered(self, texts: pa.Array) -> Iterator[bytes]:
        # every piece now follows a space or newline; the newline before a text is taken off again below
        lined = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        parts = pc.split_pattern(lined, " ")
        coded = parts.flatten().dictionary_encode()
        pieces = [p if p[:1] == b"\n" else b" " + p for p in byte_texts(coded.dictionary)]
        found = self.ids(pieces, True)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        starts = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        every = np.frombuffer(b"".join(found), f"<u{self.width}")
        payload = every[np.repeat(starts[which] - (ends - lengths), lengths) + np.arange(int(ends[-1]))].tobytes()
        offsets = parts.offsets.to_numpy().astype(np.int64) - parts.offsets[0].as_py()
        bounds = np.concatenate([[0], ends])[offsets] * self.width
        lead = len(self.newline)
        for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False):
            yield payload[a + lead : b]


def has_stop(piece: bytes) -> bool:
    """Whether its last character, a full stop or comma, is a pre-token of its own."""
    return len(piece) > 2 and piece[-1] in b".," and piece[-2:-1].isalpha()


class Vocabulary:
    """Merge ranks and vocabulary strings of a byte-level tokenizer file."""

    def __init__(self, source: str):
        given = json.loads(source)
        letters, ids = byte_letters(), given["model"]["vocab"]
        self.first = [0] * 256
        for letter, byte in letters.items():
            self.first[byte] = ids[letter]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in given["model"]["merges"]]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        self.ranks = {(a, b): rank for rank, (a, b, _) in reversed(list(enumerate(self.merges)))}
        self.added = {token["content"].encode(): token["id"] for token in given["added_tokens"]}
        self.split = re.compile(b"(%s)" % b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.pretokens = regex.compile(PRETOKENS)
        self.stops = {stop: self.merged(stop) for stop in (b".", b",")}
        self.newline = self.merged(b"\n")
        self.table = Pieces(self.learn, self.careful, self.newline, 4, self.added)

    def merged(self, word: bytes) -> bytes:
        """The ids of one pre-token."""
        symbols = [self.first[b] for b in word]
        size, ranks, merges = len(symbols), self.ranks, self.merges
        if size == 1:
            return struct.pack("<I", symbols[0])
        before, after = list(range(-1, size - 1)), [*range(1, size), -1]
        queue = [(ranks[pair], at) for at, pair in enumerate(zip(symbols, symbols[1:], strict=False)) if pair in ranks]
        heapify(queue)
        while queue:
            rank, at = heappop(queue)
            left, right, both = merges[rank]
            other = after[at]
            if other < 0 or symbols[at] != left or symbols[other] != right:
                continue
            symbols[at], symbols[other] = both, -1
            after[at] = beyond = after[other]
            if beyond >= 0:
                before[beyond] = at
                if (rank := ranks.get((both, symbols[beyond]))) is not None:
                    heappush(queue, (rank, at))
            previous = before[at]
            if previous >= 0 and (rank := ranks.get((symbols[previous], both))) is not None:
                heappush(queue, (rank, previous))
        symbols = [s for s in symbols if s >= 0]
        return struct.pack(f"<{len(symbols)}I", *symbols)

    def learn(self, pieces: list[bytes], plain: bool) -> list[bytes]:
        return [self.piece(piece, plain) for piece in pieces]

    def piece(self, piece: bytes, plain: bool) -> bytes:
        """The ids of a piece, one pre-token after the other."""
        if piece in self.added:
            return struct.pack("<I", self.added[piece])
        if plain and has_stop(piece):
            stem = piece[:-1]
            ids = self.table.known.get(stem)
            return (self.piece(stem, True) if ids is None else ids) + self.stops[piece[-1:]]
        return b"".join([self.merged(word.encode()) for word in self.pretokens.findall(piece.decode())])

    def careful(self, text: bytes) -> list[bytes]:
        """The pieces of any text: added tokens, and what stands between them cut where that is safe."""
        pieces = []
        for part in self.split.split(text) if self.split else [text]:
            if part in self.added:
                pieces.append(part)
            elif part:
                first, *others = CUT.split(part)
                pieces += [*([first] if first else []), *(b" " + piece for piece in others)]
        return pieces

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.table.encode(texts)


class Strings:
    """The vocabulary strings of a byte-level tokenizer file as bytes, by id."""

    def __init__(self, source: str):
        given, letters = json.loads(source), byte_letters()
        ids = given["model"]["vocab"].items()
        self.of = {i: bytes(letters[x] for x in string) for string, i in ids if all(x in letters for x in string)}
        self.of |= {token["id"]: token["content"].encode() for token in given["added_tokens"]}

    def decode(self, ids: bytes) -> str:
        of = self.of
        return b"".join([of.get(i, b"") for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")


_loaded: dict[tuple[type, int], Vocabulary | Strings] = {}


def loaded(kind: type, source: str):
    """One table of a kind per worker process, kept for its next tasks."""
    key = kind, hash(source)
    if key not in _loaded:
        for other in [k for k in _loaded if k[0] is kind]:
            del _loaded[other]
        _loaded[key] = kind(source)
    return _loaded[key]


Batches = Iterator[pa.RecordBatch]


def encoding(source, text: str, ids: str) -> Callable[[Batches], Batches]:
    """What a task does to add ids; source is a broadcast tokenizer file, some MB."""

    def run(batches: Batches) -> Batches:
        known = loaded(Vocabulary, source.value)
        for batch in portions(batches, text):
            yield replaced(batch, {ids: pa.array(known.encode(batch.column(text)), pa.binary())})

    return run


def decoding(source, ids: str, text: str) -> Callable[[Batches], Batches]:
    """What a task does to add the text of ids."""

    def run(batches: Batches) -> Batches:
        known = loaded(Strings, source.value)
        for batch in portions(batches, ids):
            rows = batch.column(ids).to_pylist()
            yield replaced(batch, {text: pa.array([known.decode(x) if x else "" for x in rows], pa.string())})

    return run


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the ids of every whole text, as little-endian unsigned 32-bit integers in a binary column.

    tokenizer is the path of a byte-level tokenizer file. A null or empty text has no ids. A given column named as the
    new one is replaced; all others, and repeated rows, stay as they are.
    """
    source = docs.sparkSession.sparkContext.broadcast(text_of(tokenizer))
    schema = T.StructType([*without(docs, ids).schema.fields, T.StructField(ids, T.BinaryType())])
    return docs.mapInArrow(encoding(source, text, ids), schema)


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of every row's ids by concatenating vocabulary strings.

    Bytes that are no UTF-8 become replacement characters, unknown ids nothing; null ids give an empty text. A given
    column named as the new one is replaced.
    """
    source = encoded.sparkSession.sparkContext.broadcast(text_of(tokenizer))
    schema = T.StructType([*without(encoded, text).schema.fields, T.StructField(text, T.StringType())])
    return encoded.mapInArrow(decoding(source, ids, text), schema)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per document: the number of ids, and digests of the ids and of the text they decode to.

    One worker does both, so that no more workers than cores hold vocabularies and tables.
    """
    source = docs.sparkSession.sparkContext.broadcast(text_of(tokenizer))
    to_ids, to_text = encoding(source, "text", "ids"), decoding(source, "ids", "text")
    docs = docs.select("doc_id", "text")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.BinaryType()), T.StructField("text", T.StringType())])
    return docs.mapInArrow(lambda batches: to_text(to_ids(batches)), schema).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
