"""Packing: bounded-space online best fit, leftovers merged at the end.

Each partition keeps at most ``n_open`` open windows. A document's ids (with
one end id) are cut at the window length; every full piece is a window of its
own and the remainder goes to the open window it fills best. If none has room
and all places are taken, the fullest window is emitted for a new one. The
windows left open by groups of partitions are merged by first fit on
decreasing size; whole windows move, so only their sequence and offset change.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoder
from .common import column, lean, narrow, store, text_chunks

N_OPEN = 128
MERGED_PARTITIONS = 64
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, window long, offset long, "
    "left_used long"
)


class OpenWindows:
    """Best fit over at most ``n_open`` windows, by bisection on the free room."""

    def __init__(self, size: int, n_open: int):
        self.size, self.n_open, self.next = size, n_open, 0
        self.free: list[tuple[int, int]] = []  # (free room, window), sorted

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, length: int) -> tuple[int, int]:
        """(window, offset) for a piece of 1 to ``size`` ids."""
        if length == self.size:
            return self.new(), 0
        k = bisect.bisect_left(self.free, (length, -1))
        if k < len(self.free):
            room, window = self.free.pop(k)
        else:
            if len(self.free) == self.n_open:
                self.free.pop(0)  # the fullest is emitted as it is
            room, window = self.size, self.new()
        if room > length:
            bisect.insort(self.free, (room - length, window))
        return window, self.size - room


def _pack_partition(path: str, size: int, n_open: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        bpe, windows = encoder(path), OpenWindows(size, n_open)
        schema = pa.schema([(c.split()[0], pa.int64()) for c in _PIECES.split(", ")])
        for batch in batches:
            docs, texts = column(batch, "doc_id", pa.int64()).to_pylist(), column(batch, "text", pa.string())
            for lo, hi in text_chunks(texts, 4 << 20):
                ids, offsets = bpe.encode(texts.slice(lo, hi - lo))
                rows = []
                for k in range(hi - lo):
                    own = np.append(ids[offsets[k] : offsets[k + 1]], end_id).astype("<u4")
                    total = len(own)
                    for start in range(0, total, size):
                        piece = own[start : start + size]
                        window, offset = windows.place(len(piece))
                        rows.append((docs[lo + k], start, len(piece), zlib.crc32(piece), total, part, window, offset, None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema
                )
        left = [(None, None, None, None, None, part, w, None, size - room) for room, w in windows.free]
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*left, strict=True)], schema=schema)

    return run


def _merge(size: int):
    def run(left: pd.DataFrame) -> pd.DataFrame:
        """First fit decreasing of left-over windows into shared sequences."""
        left = left.sort_values(["left_used", "part", "window"], ascending=[False, True, True])
        free: list[tuple[int, int, int, int]] = []  # (room, part, window, used), sorted by room
        out = []
        for part, window, used in left[["part", "window", "left_used"]].itertuples(index=False):
            k = bisect.bisect_left(free, (used,))
            room, to_part, to_window, base = free.pop(k) if k < len(free) else (size, part, window, 0)
            out.append((part, window, to_part, to_window, base))
            if room > used:
                bisect.insort(free, (room - used, to_part, to_window, base + used))
        return pd.DataFrame(out, columns=["part", "window", "to_part", "to_window", "base"])

    return run


def pack(
    docs: DataFrame, tokenizer_path: str, size: int = 1024, end_id: int = 0, n_open: int = N_OPEN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone. A document of any length is cut
    at multiples of ``size``. Null and repeated ids are packed row by row.
    An empty table gives no rows; extra columns are not read.
    """
    pieces = store(narrow(docs, id_col, text_col).mapInArrow(lean(_pack_partition(tokenizer_path, size, n_open, end_id)), _PIECES))
    left = pieces.filter("left_used is not null").select(
        "part", "window", "left_used", F.expr(f"part div {MERGED_PARTITIONS}").alias("team")
    )
    moved = left.groupBy("team").applyInPandas(
        _merge(size), "part long, window long, to_part long, to_window long, base long"
    )
    return (
        pieces.filter("left_used is null").join(moved, ["part", "window"], "left")
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.shiftleft(F.coalesce("to_part", "part"), 40) + F.coalesce("to_window", "window")).alias("sequence_id"),
            (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
        )
    )
