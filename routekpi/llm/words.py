"""Vectorised tokenising of Arrow string columns inside Spark tasks.

Texts stay UTF-8 bytes: a word separator is one of the six ASCII bytes
0x20 and 0x09-0x0D, which never occur inside a multi-byte character, so
splitting bytes and splitting characters give the same words.  A word is
known by a 64-bit hash of its bytes, computed for all words of a chunk at
once.  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Odd multiplier of the polynomial byte hash and its inverse mod 2**64.
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1

#: A chunk of texts handled at once holds about this many bytes; arrays over it fit a core's cache.
CHUNK_BYTES = 1 << 18
#: And at most so many texts.
CHUNK_ROWS = 1 << 15

_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, kept per process."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, CHUNK_BYTES + 1)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Bytes:
    """Texts of one chunk as one byte array with document offsets."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.offsets = offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower_ascii(self) -> Bytes:
        upper = (self.data >= 65) & (self.data <= 90)
        return Bytes(self.data + upper.astype(np.uint8) * np.uint8(32), self.offsets)

    def prefix_hashes(self) -> np.ndarray:
        """P with P[j] - P[i] the polynomial hash of bytes i..j-1, times base**i."""
        out = np.zeros(len(self.data) + 1, np.uint64)
        terms = (self.data.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, len(self.data))
        np.cumsum(terms, out=out[1:])
        return out


def texts(column: pa.Array | pa.ChunkedArray) -> Bytes:
    """The UTF-8 bytes of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return Bytes(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Bytes(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` bytes of text; one longer text is one slice."""
    ends = texts(batch.column(batch.schema.get_field_index(text))).offsets
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), at + CHUNK_ROWS, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def is_letter(data: np.ndarray) -> np.ndarray:
    """ASCII letters and every byte of a non-ASCII character."""
    low = data | np.uint8(32)
    return ((low >= 97) & (low <= 122)) | (data >= 128)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that don't cross a document border.

    Returns starts, ends and, per document, the index of its first run
    (one entry more than documents).
    """
    n = len(inside)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | border[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | border[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes anywhere."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    raw = prefix[ends] - prefix[starts]
    return mix64(raw * _power_table(_BASE_INV, len(prefix))[starts])


def word_hashes(b: Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start, end of each white-space separated word; first word of each document."""
    starts, ends, first = runs(~is_space(b.data), b.offsets)
    return span_hashes(b.prefix_hashes(), starts, ends), starts, ends, first


def owners(first: np.ndarray) -> np.ndarray:
    """The document index of each run."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def gram_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words and, per document, the index of its first gram.

    A document of fewer than k words has none.
    """
    lengths = np.diff(first)
    counts = np.maximum(lengths - k + 1, 0)
    at = np.concatenate([[0], np.cumsum(counts)])
    if not at[-1]:
        return np.zeros(0, np.uint64), at
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + words[i : i + n]
    out = mix64(out)
    begin = np.repeat(first[:-1] - at[:-1], counts) + np.arange(at[-1])
    return out[begin], at


def sliding_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of words i..i+k-1 for every i (documents not heeded); cost free of k."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    prefix = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _power_table(_BASE, len(words)), out=prefix[1:])
    raw = prefix[k:] - prefix[:-k]
    return mix64(raw * _power_table(_BASE_INV, len(words))[: len(raw)])
