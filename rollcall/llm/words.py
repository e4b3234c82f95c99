"""Words and shingles of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from rollcall.llm.shared import byte_texts

STEP = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one text after the other, and the number of words of each.

    Words are runs of other characters than space and the control characters 9 to 13; A to Z count as a to z.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    owner = pc.list_parent_indices(parts).to_numpy()
    coded = parts.flatten().dictionary_encode()
    known = byte_texts(coded.dictionary)
    hashes = np.fromiter((xxhash.xxh64_intdigest(word) for word in known), np.uint64, len(known))
    which = coded.indices.to_numpy()
    real = np.fromiter((word != b"" for word in known), bool, len(known))[which] if len(known) else np.zeros(0, bool)
    return hashes[which[real]], np.bincount(owner[real], minlength=len(texts))


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all texts as 64-bit hashes, in order and with repeats, and their number in each text.

    A text with fewer words than `size`, but at least one, has its whole sequence as its only shingle.
    """
    hashes, counts = word_hashes(texts)
    if not len(hashes):
        return hashes, np.zeros(len(counts), np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    left = np.cumsum(counts)[owner] - np.arange(len(hashes))  # words from here to the text's end
    made = np.zeros(len(hashes), np.uint64)
    for k in range(min(size, len(hashes))):
        mixed = (made ^ (made >> np.uint64(29))) * STEP
        mixed[: len(hashes) - k] += hashes[k:] + np.uint64(k + 1)
        made = np.where(left > k, mixed, made)  # a short text's shingle stops at its last word
    made ^= made >> np.uint64(32)
    whole = (left >= size) | ((counts[owner] < size) & (left == counts[owner]))
    return made[whole], np.bincount(owner[whole], minlength=len(counts))


def distinct(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted and without repeats, and their number."""
    values, ends = values.copy(), np.cumsum(counts)
    for start, end in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        values[start:end].sort()
    owner = np.repeat(np.arange(len(counts)), counts)
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.bincount(owner[new], minlength=len(counts))
