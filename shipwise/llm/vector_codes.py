"""Compact codes of vectors: product quantisation by dual-tree Lloyd rounds.

Vectors become integers, are cut into equal parts, and each part position gets
a codebook. Blocks of vectors are stored once with a tree over the parts of
each position: halves by the widest dimension, every node with its integer
bounding box and the cached sum of its parts. A round walks these trees level by
level against a tree over the codebook's entries: box-to-box distances prune
node pairs, box-to-entry distances and bisecting planes prune entries, and a
node with one entry left is assigned whole by its cached sum. Leaves that stay
uncertain compare integer distances. All bounds are integers, so the result is
that of plain Lloyd rounds.

A round is one job: tasks add up counts and sums, Spark adds those of all tasks,
and the driver gets one number per codebook cell.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, lean, scalar_row, store

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
LEAF, BLOCK_ROWS, BLOCK_CELLS = 16, 4096, 1 << 20
# Totals of so many labels at most go to all tasks, more are joined by shuffle.
BROADCAST_LABELS = 100_000


# ---------------------------------------------------------------- trees


@dataclass
class PartTree:
    """Points in tree order; node j of level l holds the points of ``bounds(l)[j:j + 2]``."""

    order: np.ndarray  # original row of each point
    points: np.ndarray  # (n, width) in tree order
    low: list[np.ndarray]  # per level (nodes, width)
    high: list[np.ndarray]
    total: list[np.ndarray]

    def bounds(self, level: int) -> np.ndarray:
        return (len(self.points) * np.arange((1 << level) + 1)) >> level

    @property
    def levels(self) -> int:
        return len(self.low)


def n_levels(n: int) -> int:
    return max(1, (n // LEAF).bit_length())


def tree_order(points: np.ndarray) -> np.ndarray:
    """Rows ordered so that every node is a run, halved along its widest dimension."""
    n = len(points)
    order = np.arange(n)
    for level in range(n_levels(n) - 1):
        cut = (n * np.arange((1 << level) + 1)) >> level
        held = points[order]
        wide = (np.maximum.reduceat(held, cut[:-1]) - np.minimum.reduceat(held, cut[:-1])).argmax(1)
        node = np.repeat(np.arange(1 << level), np.diff(cut))
        order = order[np.lexsort((held[np.arange(n), wide[node]], node))]
    return order


def part_tree(points: np.ndarray, order: np.ndarray | None = None) -> PartTree:
    order = tree_order(points) if order is None else order
    held = points[order].astype(np.int64)
    n, levels = len(held), n_levels(len(held))
    cut = (n * np.arange(1 << (levels - 1))) >> (levels - 1)
    low, high = [np.minimum.reduceat(held, cut)], [np.maximum.reduceat(held, cut)]
    total = [np.add.reduceat(held, cut)]
    for _ in range(levels - 1):
        low.append(np.minimum(low[-1][::2], low[-1][1::2]))
        high.append(np.maximum(high[-1][::2], high[-1][1::2]))
        total.append(total[-1][::2] + total[-1][1::2])
    return PartTree(order, held, low[::-1], high[::-1], total[::-1])


def entry_tree(entries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of (members, low, high): halves of the entries by the widest dimension, down to pairs."""
    groups, out = [np.arange(len(entries))], []
    while max(map(len, groups)) > 1:
        split = []
        for own in groups:
            if len(own) == 1:
                split.append(own)
                continue
            held = entries[own]
            own = own[np.argsort(held[:, np.ptp(held, axis=0).argmax()], kind="stable")]
            split += [own[: len(own) // 2], own[len(own) // 2 :]]
        groups = split
        members = np.zeros((len(groups), len(entries)), bool)
        for k, own in enumerate(groups):
            members[k, own] = True
        out.append((members, np.array([entries[g].min(0) for g in groups]), np.array([entries[g].max(0) for g in groups])))
    return out[:-1]  # single entries have closer bounds of their own


def box_distances(low, high, other_low, other_high) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) squared distances of all box pairs, (a, b) each."""
    low, high = low[:, None], high[:, None]
    gap = np.maximum(np.maximum(low - other_high, other_low - high), 0)
    span = np.maximum(high - other_low, other_high - low)
    return (gap * gap).sum(2), (span * span).sum(2)


_FAR = np.iinfo(np.int64).max


def prune(low: np.ndarray, high: np.ndarray, may: np.ndarray, entries: np.ndarray, tree) -> np.ndarray:
    """Of the entries each node may have (nodes, entries), those that some point of its box may be nearest to."""
    for members, entry_low, entry_high in tree:
        near, far = box_distances(low, high, entry_low, entry_high)
        live = (may[:, None] & members).any(2)
        limit = np.where(live, far, _FAR).min(1)
        may = may & ((near <= limit[:, None]) @ members)
    near, far = box_distances(low, high, entries, entries)
    best = np.where(may, far, _FAR).argmin(1)
    limit = far[np.arange(len(best)), best][:, None]
    after = np.arange(len(entries)) > best[:, None]
    may = may & ((near < limit) | ((near == limit) & ~after))
    # The plane between best and entry: the box's corner that favours the entry most.
    toward = entries - entries[best][:, None]
    square = (entries * entries).sum(1)
    corner = np.where(toward > 0, high[:, None], low[:, None])
    gain = 2 * (corner * toward).sum(2) - (square - square[best][:, None])
    return may & ((gain > 0) | ((gain == 0) & ~after))


def nearest_entries(tree: PartTree, entries: np.ndarray):
    """(whole nodes, leaf points): (level, nodes, entry of each) lists, and (point rows, entry of each).

    Ties go to the lower entry.
    """
    whole, rows, codes = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    by_entry = entry_tree(entries)
    nodes, may = np.zeros(1, np.int64), np.ones((1, len(entries)), bool)
    square = (entries * entries).sum(1)
    for level in range(tree.levels):
        may = prune(tree.low[level][nodes], tree.high[level][nodes], may, entries, by_entry)
        one = may.sum(1) == 1
        whole.append((level, nodes[one], may[one].argmax(1)))
        nodes, may = nodes[~one], may[~one]
        if not len(nodes):
            break
        if level + 1 < tree.levels:
            nodes, may = (nodes[:, None] * 2 + np.arange(2)).ravel(), np.repeat(may, 2, axis=0)
            continue
        cut = tree.bounds(level)
        sizes = cut[nodes + 1] - cut[nodes]
        at = np.repeat(cut[nodes] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        distance = square - 2 * (tree.points[at] @ entries.T)
        rows.append(at)
        codes.append(np.where(np.repeat(may, sizes, axis=0), distance, _FAR).argmin(1))
    return whole, np.concatenate(rows), np.concatenate(codes)


def round_sums(tree: PartTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts, sums) of the points nearest to each entry."""
    whole, rows, codes = nearest_entries(tree, entries)
    counts, sums = np.bincount(codes, minlength=len(entries)), np.zeros(entries.shape, np.int64)
    np.add.at(sums, codes, tree.points[rows])
    for level, nodes, own in whole:
        np.add.at(counts, own, np.diff(tree.bounds(level))[nodes])
        np.add.at(sums, own, tree.total[level][nodes])
    return counts, sums


def point_codes(tree: PartTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every point, in the original row order."""
    whole, rows, codes = nearest_entries(tree, entries)
    out = np.zeros(len(tree.points), np.int64)
    out[rows] = codes
    for level, nodes, own in whole:
        cut = tree.bounds(level)
        for node, code in zip(nodes, own, strict=True):
            out[cut[node] : cut[node + 1]] = code
    gap = tree.points - entries[out]
    back = np.empty(len(out), np.int64)
    back[tree.order] = np.arange(len(out))
    return out[back], (gap * gap).sum(1)[back]


# ---------------------------------------------------------------- Spark


def _width(longest: int) -> int:
    """Components of a part: vectors are padded with zeros to a multiple of PARTS."""
    return max(1, -(-longest // PARTS))


def integers(values: np.ndarray, width: int) -> np.ndarray:
    """floor(SCALE * x), clamped so that squared distances of a part stay in 64 bits."""
    limit = float(1 << int((62 - np.log2(width)) / 2 - 1))
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(SCALE))
    return np.clip(scaled, -limit, limit).astype(np.int64)


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _blocks(width: int):
    """Batches of (vec_id, label, vector) to rows (ids, labels, points, order) with a tree per part position."""
    size = max(4 * LEAF, min(BLOCK_ROWS, BLOCK_CELLS // (width * PARTS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = column(batch, "vector", pa.list_(pa.float64()))
            sizes = np.diff(vectors.offsets.to_numpy())
            x = np.zeros((len(batch), width * PARTS))
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            x[np.repeat(np.arange(len(batch)), sizes), at] = vectors.flatten().to_numpy(zero_copy_only=False)
            ints = integers(x, width)
            ids, labels = column(batch, "vec_id", pa.int64()), column(batch, "label", pa.string())
            for lo in range(0, len(batch), size):
                own = ints[lo : lo + size]
                orders = [tree_order(own[:, p * width : (p + 1) * width]) for p in range(PARTS)]
                yield pa.RecordBatch.from_arrays(
                    [
                        _one_list(ids.slice(lo, size)),
                        _one_list(labels.slice(lo, size)),
                        pa.array([own.astype(np.int32).tobytes()], pa.binary()),
                        pa.array([np.concatenate(orders).astype(np.int32).tobytes()], pa.binary()),
                    ],
                    names=["ids", "labels", "points", "orders"],
                )

    return run


def _trees(batch: pa.RecordBatch, row: int, width: int) -> list[PartTree]:
    points = np.frombuffer(batch.column("points")[row].as_py(), np.int32).reshape(-1, PARTS * width)
    orders = np.frombuffer(batch.column("orders")[row].as_py(), np.int32).reshape(PARTS, -1)
    return [part_tree(points[:, p * width : (p + 1) * width], orders[p]) for p in range(PARTS)]


def _add_up(books: np.ndarray):
    """Blocks to (cell, value): counts and sums of all blocks of the task, by codebook cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        for batch in batches:
            for row in range(len(batch)):
                for p, tree in enumerate(_trees(batch, row, books.shape[2])):
                    counts, sums = round_sums(tree, books[p])
                    cells[p, :, 0] += counts
                    cells[p, :, 1:] += sums
        flat = cells.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["cell", "value"])

    return run


def _encode(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                found = [point_codes(t, books[p]) for p, t in enumerate(_trees(batch, row, books.shape[2]))]
                codes = np.stack([c for c, _ in found], 1).astype(np.uint8)
                text = codes.tobytes().hex()
                step = 2 * PARTS
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[row].values, batch.column("labels")[row].values,
                        pa.array([text[k : k + step] for k in range(0, len(text), step)], pa.string()),
                        pa.array(sum(e for _, e in found), pa.int64()),
                    ],
                    names=["vec_id", "label", "code", "error"],
                )

    return run


def next_books(books: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Entries as floors of their parts' means; unused ones stay."""
    counts = cells[:, :, :1]
    return np.where(counts > 0, cells[:, :, 1:] // np.maximum(counts, 1), books)


def fit_codebooks(blocks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd rounds over stored blocks. Per round the driver gets one number per codebook cell."""
    for _ in range(rounds):
        sums = blocks.select("points", "orders").mapInArrow(lean(_add_up(books)), "cell long, value long").groupBy("cell").agg(F.sum("value").alias("value"))
        cells = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        for r in sums.collect():
            cells.reshape(-1)[r.cell] = r.value
        books = next_books(books, cells)
    return books


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


OUT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def vector_codes(embeddings: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that is whole.

    Rows whose vector is null or holds a null or non-finite component are left
    out. Vectors shorter than the longest one, or whose length 8 doesn't divide,
    are padded with zeros. Scaled components are clamped where a squared distance
    could pass 64 bits (from 2^28 on at 8 components a part). The first entries
    are the rows of the smallest vec_ids, null ids last and equal ids by vector;
    with fewer rows there are fewer entries. Repeated rows count each. A sum of
    errors past 64 bits is null. An empty table gives no rows; other columns are
    not read.
    """
    spark = embeddings.sparkSession
    vectors = embeddings.select(
        F.col("`vec_id`").cast("long").alias("vec_id"), F.col("`label`").cast("string").alias("label"),
        F.col("`embedding`").cast("array<double>").alias("vector"),
    ).filter(
        F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    longest = scalar_row(vectors, n=F.max(F.size("vector")))["n"]
    if longest is None:
        return spark.createDataFrame([], OUT)
    width = _width(longest)
    # bounded: ENTRIES rows
    first = vectors.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).collect()
    start = np.zeros((len(first), width * PARTS))
    for k, r in enumerate(first):
        start[k, : len(r.vector)] = r.vector
    books = integers(start, width).reshape(len(first), PARTS, width).transpose(1, 0, 2)
    blocks = store(
        vectors.mapInArrow(lean(_blocks(width)), "ids array<long>, labels array<string>, points binary, orders binary"), "vectors"
    )
    books = fit_codebooks(blocks, np.ascontiguousarray(books), rounds)
    rows = store(blocks.mapInArrow(lean(_encode(books)), "vec_id long, label string, code string, error long"), "codes")
    totals = store(rows.groupBy("label").agg(F.try_sum("error").alias("label_error")), "codes").withColumnRenamed("label", "of")
    if totals.count() <= BROADCAST_LABELS:
        totals = F.broadcast(totals)
    return rows.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")
    )
