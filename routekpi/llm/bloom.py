"""Counting Bloom filters of bounded size, built by tasks and merged in Spark.

A filter has two bit planes over the same slots: *seen* (some key has the
slot) and *again* (two keys or more have it).  A key that occurs twice has all
its slots in *again*, so testing that plane never misses a repeated key; a key
that occurs once passes the test only when all of its slots are shared.

The planes never exceed ``max_bytes`` each whatever the number of keys; past
that size more keys look repeated, which costs work and never correctness.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType

from routekpi.llm.words import mix64

#: Slots that a key sets.
SLOTS = 4
#: Bits of a plane per key, up to the bound of the plane's size.
BITS_PER_KEY = 12
#: Most bytes of one plane.
MAX_BYTES = 16 << 20
#: Tasks that build planes: bounds what the merging tasks hold.
BUILDERS = 256
_SEGMENT = 1 << 17  # bits of a plane merged as one row


def slot_count(keys: int, max_bytes: int = MAX_BYTES) -> int:
    """A power of two of slots for so many keys, within the bound."""
    wanted = max(_SEGMENT, keys * BITS_PER_KEY)
    return min(1 << (wanted - 1).bit_length(), max(_SEGMENT, max_bytes * 8))


def key_slots(keys: np.ndarray, n: int) -> np.ndarray:
    """The slots of each key, one column for each of SLOTS."""
    keys = keys.view(np.uint64)
    a, b = mix64(keys), mix64(keys ^ np.uint64(0xA5A5A5A55A5A5A5A)) | np.uint64(1)
    steps = np.arange(SLOTS, dtype=np.uint64)
    return ((a[:, None] + steps * b[:, None]) & np.uint64(n - 1)).astype(np.int64)


def _planes(batches: Iterator[pa.RecordBatch], n: int, repeats: bool) -> tuple[np.ndarray, np.ndarray]:
    seen, again = np.zeros(n, bool), np.zeros(n, bool)
    for batch in batches:
        column = batch.column(0)
        keys = np.asarray(column.drop_null())
        for at in range(0, len(keys), 1 << 16):
            slots = key_slots(keys[at : at + (1 << 16)], n)
            if not repeats:
                seen[slots.ravel()] = True
                continue
            # a key's own slots may coincide: count each slot once per key
            slots.sort(axis=1)
            own = np.ones(slots.shape, bool)
            own[:, 1:] = slots[:, 1:] != slots[:, :-1]
            flat = np.sort(slots[own])
            unique = np.concatenate([[True], flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, bool)
            again[flat[~unique]] = True
            once = flat[unique]
            again[once[seen[once]]] = True
            seen[once] = True
    return np.packbits(seen), np.packbits(again)


def build(keys: DataFrame, column: str, count: int, max_bytes: int = MAX_BYTES, plane: str = "again", repeats: bool = True) -> Broadcast:
    """Broadcast (slots, packed plane) of the keys in ``column``; plane: again or seen.

    Without ``repeats`` the work that only the plane ``again`` needs is left out.
    """
    n = slot_count(count, max_bytes)
    step = _SEGMENT // 8

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = _planes(batches, n, repeats)
        for k in range(0, len(seen), step):
            s, a = seen[k : k + step], again[k : k + step]
            if s.any():
                yield pa.RecordBatch.from_pydict(
                    {"segment": pa.array([k // step], pa.int32()), "seen": pa.array([zlib.compress(s.tobytes(), 1)], pa.binary()),
                     "again": pa.array([zlib.compress(a.tobytes(), 1)], pa.binary())})

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        seen, again = np.zeros(step, np.uint8), np.zeros(step, np.uint8)
        for s, a in zip(rows["seen"], rows["again"]):
            s = np.frombuffer(zlib.decompress(s), np.uint8)
            again |= np.frombuffer(zlib.decompress(a), np.uint8) | (seen & s)
            seen |= s
        return pd.DataFrame({"segment": [key[0]], "bits": [zlib.compress((seen if plane == "seen" else again).tobytes(), 1)]})

    planes = keys.select(column).coalesce(BUILDERS).mapInArrow(local, "segment int, seen binary, again binary")
    merged = planes.groupBy("segment").applyInPandas(merge, "segment int, bits binary")
    out = np.zeros(n // 8, np.uint8)
    for row in merged.collect():  # at most max_bytes in all
        out[row.segment * step : (row.segment + 1) * step] = np.frombuffer(zlib.decompress(row.bits), np.uint8)
    return keys.sparkSession.sparkContext.broadcast((n, out))


def holds(value: tuple[int, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """True where a key may be in the plane of a filter's broadcast value."""
    n, plane = value
    slots = key_slots(keys, n)
    return ((plane[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1).all(axis=1)


def may_hold(filt: Broadcast, column):
    """True where a key may be in the plane (so it may be repeated, or may be among the keys); null keys are false."""

    @F.pandas_udf(BooleanType())
    def test(keys: pd.Series) -> pd.Series:
        known = keys.notna().to_numpy()
        out = np.zeros(len(keys), bool)
        out[known] = holds(filt.value, keys[known].to_numpy(np.int64))
        return pd.Series(out)

    return test(column)
