"""Fixed-size filters: which hashes occur often enough to matter.

Shuffling every key only to find that most occur once is the dear part of finding
what keys share. Here tasks send a key's 40-bit *slot* in five or six bytes, packed in sorted
arrays; ranges of slots are summed apart; the slots that reach a count become bits of a
bitmap of a fixed size, which the tasks get. A clash of slots or bits lets a lone
key through and never holds a shared one back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SLOTS = "chunk int, offsets binary, times binary"
#: Keys packed at once, and (about) in one range of slots.
KEYS = 1 << 20


def slots_of(hashes: np.ndarray) -> np.ndarray:
    """The upper 40 of 64 well-mixed bits."""
    return hashes >> np.uint64(24)


def chunks_for(keys: int) -> int:
    """Ranges of slots for so many keys; 256 at least, so that a place in a range has 32 bits."""
    return max(256, keys // KEYS)


def _kind(least: int) -> np.dtype:
    return np.dtype("u1" if least < 256 else "<u4")


def packed(slots: np.ndarray, chunks: int, least: int, times: np.ndarray | None = None) -> pa.RecordBatch:
    """Slots and how often each occurs (repeats counted, up to ``least``), one row for each range."""
    n = np.uint64(chunks)
    place = slots % n << np.uint64(32) | slots // n
    if times is None:
        place, times = np.unique(place, return_counts=True)
    else:
        order = np.argsort(place, kind="stable")
        place, times = place[order], times[order]
    times = np.minimum(times, least).astype(_kind(least))
    offset = place.astype("<u4")  # the low half
    cuts = np.searchsorted(place >> np.uint64(32), np.arange(chunks + 1, dtype=np.uint64)).tolist()
    own = [c for c in range(chunks) if cuts[c] < cuts[c + 1]]
    return pa.RecordBatch.from_arrays(
        [pa.array(own, pa.int32()),
         pa.array([offset[cuts[c]:cuts[c + 1]].tobytes() for c in own], pa.binary()),
         pa.array([times[cuts[c]:cuts[c + 1]].tobytes() for c in own], pa.binary())],
        ["chunk", "offsets", "times"])


def frequent(rows: DataFrame, chunks: int, least: int, bits: int) -> DataFrame:
    """Bits (s) of the slots whose counts in ``rows`` (of :func:`packed`) reach ``least``."""
    kind = _kind(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if parts:
                place, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(where, weights=np.concatenate([p[1] for p in parts]))
                slot = place[n >= least].astype(np.int64) * chunks + current
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(slot % bits), pa.int64())], ["s"])

        for b in batches:
            for chunk, offsets, times in zip(*(b.column(c).to_pylist() for c in ("chunk", "offsets", "times"))):
                if chunk != current:
                    yield from out()
                    current, parts = chunk, []
                parts.append((np.frombuffer(offsets, "<u4"), np.frombuffer(times, kind)))
        yield from out()

    return rows.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, "s long")


def bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """Bytes of a bitmap with the bits ``s`` set; at most ``bits / 64`` numbers reach the driver."""
    words = places.selectExpr("shiftright(s, 6) AS at", "shiftleft(1L, cast(s & 63 AS int)) AS bit")
    got = words.groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits // 64, dtype="<i8")
    out[got.column("at").to_numpy()] = got.column("bit").to_numpy()
    return out.view(np.uint8)


def has(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which of the bits (int64, or uint64) are set."""
    places = places.astype(np.int64)
    return (bitmap[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)
