"""SimHash near-duplicates by BK-trees.

Fingerprints within ``radius`` bits agree on some choice of blocks (pigeonhole),
so distinct fingerprints are dealt by every choice of block values. The
fingerprints of one deal form BK-trees: children are keyed by their integer
Hamming distance to the parent, and a search follows only the edges whose key
is within the radius of its own distance. A deal of many fingerprints becomes
several trees of bounded size (shards); each tree then goes out to the rows of
the deal's later shards as well, so no pair is lost. A tree reports a spanning
forest of its links, never all pairs, and components follow from these.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, lean, narrow, scalar_row, store, text_chunks
from .components import components

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
TREE_SIZE = 2048
_BLOCK_ROWS = 1 << 16
_BUFFER_ROWS = 60_000
_FRONTIER = 1 << 21


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(text: bytes, n_words: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every run of ``n_words`` words (of the whole sequence if shorter)."""
    words = text.lower().split()  # bytes: A-Z only, and the contract's separators
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > n_words:
        starts, ends = starts[: len(words) - n_words + 1], ends[n_words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts)
    )


def fingerprint_of(hashes: list[np.ndarray]) -> np.ndarray:
    """One 64-bit fingerprint per hash array; a bit is 1 if set in over half."""
    sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
    flat = np.concatenate(hashes) if len(hashes) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(hashes)), sizes)
    counts = np.zeros((len(hashes), 64), np.int64)
    for k in range(0, len(flat), _BLOCK_ROWS):
        block = flat[k : k + _BLOCK_ROWS].astype("<u8")
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[k : k + _BLOCK_ROWS]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        counts[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    on = counts * 2 > sizes[:, None]
    return np.packbits(on, axis=1, bitorder="little").view("<u8").ravel()


def _fingerprints(n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text", pa.string()).fill_null("").cast(pa.binary())
            prints = [np.zeros(0, np.uint64)]
            for lo, hi in text_chunks(texts.cast(pa.string()), 1 << 20):
                prints.append(fingerprint_of([shingle_hashes(t, n_words) for t in texts.slice(lo, hi - lo).to_pylist()]))
            fps = np.concatenate(prints).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id", pa.int64()), pa.array(fps)], names=["doc_id", "fp"]
            )

    return run


def fingerprints(
    docs: DataFrame, n_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp) per row; null and empty texts have fingerprint zero."""
    return narrow(docs, id_col, text_col).mapInArrow(lean(_fingerprints(n_words)), "doc_id long, fp long")


# -------------------------------------------------------------------- BK-trees


class BkForest:
    """BK-trees of several groups, built and searched level by level as arrays.

    ``fps`` holds the members group by group (distinct within a group);
    ``roots`` is each group's first member. Edges are sorted by
    (parent, distance), so the children of a node within a range of distances
    are one slice.
    """

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        self.fps = fps
        self.roots = np.flatnonzero(np.diff(group, prepend=-1))
        node = np.setdiff1d(np.arange(len(fps)), self.roots)
        parent = self.roots[np.searchsorted(self.roots, node, side="right") - 1]
        keys, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(node):
            key = parent * 65 + np.bitwise_count(fps[node] ^ fps[parent])
            found, first, back = np.unique(key, return_index=True, return_inverse=True)
            child = node[first]  # the first of an edge becomes the child, the others descend
            keys.append(found)
            children.append(child)
            parent = child[back]
            rest = node != parent
            node, parent = node[rest], parent[rest]
        order = np.argsort(np.concatenate(keys))
        self.keys, self.children = np.concatenate(keys)[order], np.concatenate(children)[order]

    def search(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yields (query row, node) of every node within the radius of a query."""
        at, node = np.arange(len(queries)), roots
        while len(at):
            d = np.bitwise_count(queries[at] ^ self.fps[node]).astype(np.int64)
            hit = d <= radius
            yield at[hit], node[hit]
            lo = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            hi = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), side="right")
            n = hi - lo
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            edge = np.repeat(lo - (ends - n), n) + np.arange(total)
            at, node = np.repeat(at, n), self.children[edge]


def _least(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] and b[i]: the smallest row of each component."""
    while len(a):
        la, lb = labels[a], labels[b]
        open_ = la != lb
        if not open_.any():
            break
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            deeper = labels[labels]
            if (deeper == labels).all():
                break
            labels = deeper
    return labels


def link_groups(group: np.ndarray, member: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of groups sorted by (group, members first).

    Members of a group are searched in the group's tree, and so are its other
    rows; those are not compared with each other.
    """
    tree_rows = np.flatnonzero(member)
    forest = BkForest(fps[tree_rows], group[tree_rows])
    size = np.diff(np.append(forest.roots, len(tree_rows)))
    heads = group[tree_rows][forest.roots]
    which = np.searchsorted(heads, group)
    labels = np.arange(len(fps))
    cost = np.cumsum(size[which])
    lo = 0
    while lo < len(fps):
        hi = max(lo + 1, int(np.searchsorted(cost, (cost[lo - 1] if lo else 0) + _FRONTIER, side="right")))
        for q, node in forest.search(fps[lo:hi], forest.roots[which[lo:hi]], radius):
            labels = _least(labels, q + lo, tree_rows[node])
        lo = hi
    linked = np.flatnonzero(labels != np.arange(len(labels)))
    return fps[linked], fps[labels[linked]]


def _link_partition(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if len(rows[0]):
                change = (np.diff(rows[0], prepend=rows[0][0]) != 0) | (np.diff(rows[1], prepend=rows[1][0]) != 0)
                a, b = link_groups(np.cumsum(change), rows[2].astype(bool), rows[3].view(np.uint64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held = [np.zeros(0, np.int64) for _ in range(4)]
        for batch in batches:
            new = [column(batch, c, pa.int64()).to_numpy() for c in ("key", "shard", "member", "fp")]
            held = [np.concatenate(x) for x in zip(held, new, strict=True)]
            if len(held[0]) < _BUFFER_ROWS:
                continue
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            if held[2][-1]:  # more members may follow: leave the last group
                yield from links([x[~last] for x in held])
                held = [x[last] for x in held]
            else:  # its tree is whole: keep that for the rows to come
                yield from links(held)
                held = [x[last & (held[2] == 1)] for x in held]
        yield from links(held)

    return run


# ------------------------------------------------------------------- operator


def _block_values(n_blocks: int) -> list[tuple[Column, int]]:
    """Value and width of each of the blocks of near equal width."""
    edges = [64 * k // n_blocks for k in range(n_blocks + 1)]
    return [
        (F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)), hi - lo)
        for lo, hi in zip(edges, edges[1:], strict=False)
    ]


def _deal_keys(radius: int, n_same: int) -> list[Column]:
    """A key for each choice of ``n_same`` of ``radius + n_same`` blocks."""
    blocks = _block_values(radius + n_same)
    keys = []
    for k, chosen in enumerate(combinations(blocks, n_same)):
        key = F.lit(k).cast("long")
        for value, width in chosen:
            key = F.shiftleft(key, width).bitwiseOR(value)
        keys.append(key)
    return keys


def fingerprint_links(distinct: DataFrame, n: int, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, distinct) within the radius.

    More agreeing blocks are asked for as the count ``n`` grows; any choice
    finds every pair, so this changes the cost and never the result.
    """
    n_same = 2 if n <= 1 << 25 else 3 if n <= 1 << 31 else 4
    if radius > 5:
        n_same = 1
    dealt = distinct.select("fp", F.explode(F.array(*_deal_keys(radius, n_same))).alias("key"))
    shared = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = F.pmod(F.xxhash64("fp"), F.col("shards"))
    placed = (
        dealt.join(shared, "key")
        .withColumn("shards", F.ceil(F.col("n") / F.lit(tree_size)).cast("long"))
        .withColumn("own", own)
        .select("key", "fp", "own", F.explode(F.sequence(F.col("own"), F.col("shards") - 1)).alias("shard"))
        .select("key", "shard", (F.col("shard") == F.col("own")).cast("long").alias("member"), "fp")
    )
    by_tree = placed.repartition("key", "shard").sortWithinPartitions("key", "shard", F.desc("member"), "fp")
    return by_tree.mapInArrow(lean(_link_partition(radius)), "a long, b long")


def simhash_components(
    docs: DataFrame, n_words: int = SHINGLE_WORDS, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text",
    tree_size: int = TREE_SIZE,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``radius`` differing bits. Null, empty and wordless texts have fingerprint
    zero and link like any other. Equal texts share a fingerprint and so a
    component. A null doc_id is no candidate for the smallest; a component of
    null ids only has a null id. An empty table gives no rows; extra columns
    are not read.
    """
    rows = store(fingerprints(docs, n_words, id_col, text_col))
    classes = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    n = scalar_row(classes, n=F.count(F.lit(1)))["n"]
    roots = store(components(fingerprint_links(classes.select("fp"), n, radius, tree_size)))
    linked = roots.join(classes, roots["node"] == classes["fp"]).select("node", "root", "least")
    ids = linked.groupBy("root").agg(F.min("least").alias("group_id"))
    named = linked.join(ids, "root").select(F.col("node").alias("fp"), "group_id", F.lit(True).alias("in_group"))
    by_class = classes.join(named, "fp", "left").select(
        "fp", F.when(F.col("in_group"), F.col("group_id")).otherwise(F.col("least")).alias("component_id")
    )
    return rows.join(by_class, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_per_component(docs: DataFrame, n_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's id, all columns kept.

    Rows with one doc_id and one text count as one document and stay once.
    A component's id can't name a row without a doc_id; such rows stay, once
    for each text.
    """
    kept = simhash_components(docs, n_words, radius).filter(F.col("doc_id") == F.col("component_id"))
    ids = kept.select(F.col("doc_id").alias("kept_doc_id")).distinct()
    same = "same_text_" + "_".join(docs.columns)[:40]  # no column of docs has this name
    rows = docs.withColumn(same, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    named = rows.join(ids, rows["doc_id"] == ids["kept_doc_id"], "left_semi")
    parts = [part.dropDuplicates(["doc_id", same]).drop(same) for part in (named, rows.filter(F.col("doc_id").isNull()))]
    return parts[0].union(parts[1])
