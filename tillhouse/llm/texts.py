"""Vectorised text helpers for code that runs inside Spark tasks on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text worked on at once; a longer single text is worked on alone.
SLICE_BYTES = 32 << 20


def whole(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array without nulls: a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "")


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` bytes of text, or one row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64()))
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if len(sizes) > start:
        yield batch.slice(start)


def strings(column: pa.Array) -> list[str]:
    """The texts of an array without nulls as a list."""
    return column.to_numpy(zero_copy_only=False).tolist()


def pieces(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Split at runs of ``[\\x20\\x09-\\x0D]``: pieces per row, a code per piece, and the text of each code.

    A text that begins or ends with white space, or is empty, also gives an empty piece there.
    """
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    return np.diff(np.asarray(lists.offsets)).astype(np.int64), np.asarray(coded.indices), coded.dictionary


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """As ``pieces``, without the empty ones."""
    counts, codes, vocabulary = pieces(texts)
    names = strings(vocabulary)
    if "" in names:
        filled = codes != names.index("")
        counts = row_sums(counts, filled.astype(np.int64))
        codes = codes[filled]
    return counts, codes, names


def row_sums(counts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum ``values``, laid out row after row with ``counts`` values each."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[ends[1:]] - sums[ends[:-1]]


def hashes(words: list[str], seed: int = 0) -> np.ndarray:
    """A stable 64-bit hash of each word."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w.encode("utf-8", "surrogatepass"), seed) for w in words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(counts: np.ndarray, word_hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``width`` words: shingles per row, and the hash of each shingle in order.

    A row with fewer words, but at least one, gives its whole sequence as one shingle.
    """
    n = len(word_hashes)
    ends = np.cumsum(counts)
    starts = ends - counts
    each = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.repeat(starts, each) + (np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each))
    length = np.repeat(np.minimum(counts, width), each)
    total = length.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            at = np.minimum(first + k, max(n - 1, 0))
            word = word_hashes[at] if n else np.zeros(0, np.uint64)
            total = np.where(length > k, mix(total * np.uint64(0x9E3779B97F4A7C15) + word), total)
    return each, total
