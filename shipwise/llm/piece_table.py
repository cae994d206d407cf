"""Ids of many distinct strings, kept between batches of a task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash


class PieceTable:
    """Ragged rows of ids found by a 128-bit hash in sorted arrays, some 60 bytes a string.

    Past ``cache_size`` strings the table starts anew, which bounds its memory.
    """

    def __init__(self, cache_size: int = 1_800_000):
        self.cache_size = cache_size
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # first half of the hash, sorted
        self.checks = np.zeros(0, np.uint64)
        self.rows = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int32)

    def append(self, flat: np.ndarray, lengths: np.ndarray) -> int:
        """Add rows without a key; returns the first one's number."""
        first = len(self.starts)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.ids = np.concatenate([self.ids, flat.astype(np.uint32)])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
        return first

    def cut(self, n_rows: int, n_ids: int) -> None:
        self.ids, self.starts, self.lengths = self.ids[:n_ids], self.starts[:n_rows], self.lengths[:n_rows]

    def rows_of(
        self, pieces: list[bytes], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], wanted: np.ndarray | None = None
    ) -> np.ndarray:
        """The row of each (wanted) piece; new ones are encoded and kept. Others are -1 if not kept."""
        if len(self.keys) > self.cache_size:
            self.clear()
        if not pieces:
            return np.zeros(0, np.int64)
        codes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, pieces)), "<u8").reshape(-1, 2)
        rows = np.full(len(pieces), -1, np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, codes[:, 0]), len(self.keys) - 1)
            same = (self.keys[at] == codes[:, 0]) & (self.checks[at] == codes[:, 1])
            rows[same] = self.rows[at[same]]
        new = np.flatnonzero(rows < 0 if wanted is None else (rows < 0) & wanted)
        if len(new):
            rows[new] = self.append(*encode([pieces[i].decode() for i in new])) + np.arange(len(new))
            new = new[np.argsort(codes[new, 0], kind="stable")]
            at = np.searchsorted(self.keys, codes[new, 0])
            self.keys = np.insert(self.keys, at, codes[new, 0])
            self.checks = np.insert(self.checks, at, codes[new, 1])
            self.rows = np.insert(self.rows, at, rows[new].astype(np.int32))
        return rows

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in order, length of each)."""
        size = self.lengths[rows].astype(np.int64)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[rows] - (ends - size), size) + np.arange(total)], size
