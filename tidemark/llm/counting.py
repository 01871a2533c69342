"""Counts of hashed things over a whole corpus in a table of fixed size.

Each task counts its rows into an array of ``cells`` counters and sends the cells it has used,
packed block by block; blocks are summed by key. What is sent grows with the corpus, what is
kept is bounded by ``cells``.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

BLOCK = 1 << 14


def _pack(counts: np.ndarray) -> bytes:
    """Used cells as distances, and their counts."""
    at = np.flatnonzero(counts)
    gaps = np.diff(at, prepend=0).astype(np.uint16)
    body = gaps.tobytes() + counts[at].astype(np.uint64).tobytes()
    return struct.pack("<I", len(at)) + zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(blob: bytes, into: np.ndarray) -> None:
    n = struct.unpack_from("<I", blob)[0]
    body = zstandard.ZstdDecompressor().decompress(blob[4:])
    at = np.cumsum(np.frombuffer(body, np.uint16, n))
    into[at] += np.frombuffer(body, np.uint64, n, 2 * n)


def count_cells(
    df: DataFrame, cells_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], cells: int
) -> np.ndarray:
    """How often each cell number comes out of ``cells_of`` over all batches of ``df``."""

    def local(batches):
        counts = np.zeros(cells, dtype=np.uint64)
        for batch in batches:
            for got in cells_of(batch):
                if len(got) * 8 < cells:
                    at, n = np.unique(got, return_counts=True)
                    counts[at] += n.astype(np.uint64)
                else:
                    counts += np.bincount(got, minlength=cells).astype(np.uint64)
        used = [b for b in range(0, cells, BLOCK) if counts[b : b + BLOCK].any()]
        for i in range(0, len(used), 64):
            part = used[i : i + 64]
            yield pa.record_batch(
                [pa.array([b // BLOCK for b in part], pa.int32()), pa.array([_pack(counts[b : b + BLOCK]) for b in part], pa.binary())],
                ["block", "packed"],
            )

    def total(frames: Iterator[pd.DataFrame]):
        # a task's share of blocks: whole arrays of them stay small, BLOCK counters each
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for block, blob in zip(frame["block"], frame["packed"]):
                _unpack(blob, sums.setdefault(block, np.zeros(BLOCK, dtype=np.uint64)))
        yield pd.DataFrame({"block": list(sums), "packed": [_pack(x) for x in sums.values()]})

    sent = df.mapInArrow(local, "block int, packed binary")
    summed = sent.repartition(max(1, min(cells // BLOCK, 64)), "block").mapInPandas(total, "block int, packed binary")
    out = np.zeros(-(-cells // BLOCK) * BLOCK, dtype=np.uint64)
    for row in summed.toLocalIterator():  # at most cells / BLOCK rows
        _unpack(bytes(row["packed"]), out[row["block"] * BLOCK : (row["block"] + 1) * BLOCK])
    return out[:cells]
