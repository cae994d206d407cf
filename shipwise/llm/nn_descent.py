"""Approximate nearest neighbours: an NN-descent graph and greedy graph search.

Distinct vectors are dealt by hash into blocks of bounded size, one packed row
a block. Lists start with random nodes, half of them from the node's own block
and half from its block in a second deal, which links the blocks. Each round
joins neighbours of neighbours: blocks offer their nodes to the neighbours these
have chosen, ask other blocks for the vectors of their own neighbours, compare
all neighbours of a node with each other, and send every improvement to the
block of its node. All exchanges are Spark shuffles of messages from block to
block. The descent is the same at every size and ends when few entries are new.
Queries then walk the graph greedily, all at once: a round sends each
query's best unexpanded nodes to the blocks that hold their edges, the
neighbours to the blocks that hold their vectors, and the distances back to the
team of the query, its home block's number. One message holds all that goes from
one block or team to another, for any number of queries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, scalar_row, store

K, SAMPLE, BLOCK_NODES = 24, 12, 2048
BEAM, REVERSE = 256, 48
STOP_SHARE = 0.02
_CHUNK = 256
_PAIRS = 65_536  # (query, node) pairs measured at a time
_BLOCKS = "block long, ids binary, vecs binary, near binary, dist binary, fresh binary"
_MESSAGE = "dst long, src long, a binary, b binary, c binary, v binary"
_NONE = np.int64(-(2**63))  # an empty place of a neighbour list


class Layout(NamedTuple):
    """How vectors are packed: ``dim`` components of one numpy type, that of the input column."""

    dim: int
    dtype: type = np.float32

    def vectors(self, x: bytes) -> np.ndarray:
        return np.frombuffer(x, self.dtype).reshape(-1, self.dim)


def _i64(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.int64)


def _f64(x: bytes) -> np.ndarray:
    return np.frombuffer(x, np.float64)


def block_of(ids: np.ndarray, n_blocks: int, salt: int = 0) -> np.ndarray:
    """The block of node ids: a mixing hash, the same for every task."""
    x = ids.astype(np.int64).view(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return (x % np.uint64(n_blocks)).astype(np.int64)


class Block:
    """One packed row: sorted node ids, vectors, and each node's neighbour list."""

    def __init__(self, row, dim: Layout):
        self.block = int(row["block"])
        self.ids = _i64(row["ids"])
        self.vecs = dim.vectors(row["vecs"])
        self.near = _i64(row["near"]).reshape(len(self.ids), -1)
        self.dist = _f64(row["dist"]).reshape(self.near.shape)
        self.fresh = np.frombuffer(row["fresh"], np.uint8).reshape(self.near.shape).astype(bool)

    def sampled(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Masks of the fresh entries that take part (the nearest ``n``), and of the old ones (2n)."""
        there = self.near != _NONE
        fresh, old = self.fresh & there, ~self.fresh & there
        return fresh & (np.cumsum(fresh, 1) <= n), old & (np.cumsum(old, 1) <= 2 * n)


def _row(block: int, ids, vecs, near, dist, fresh) -> pd.DataFrame:
    values = [ids.tobytes(), vecs.tobytes(), near.tobytes(), dist.tobytes(), fresh.astype(np.uint8).tobytes()]
    return pd.DataFrame([[block, *values]], columns=["block", "ids", "vecs", "near", "dist", "fresh"])


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of two (stacks of) matrices, in double precision."""
    xx, yy = (x * x).sum(-1)[..., :, None], (y * y).sum(-1)[..., None, :]
    return np.maximum(xx + yy - 2 * np.matmul(x, np.swapaxes(y, -1, -2)), 0)


def _by_block(dst: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(dst):
        return
    order = np.argsort(dst, kind="stable")
    first = np.flatnonzero(np.diff(dst[order], prepend=-1))
    for lo, hi in zip(first, np.append(first[1:], len(order)), strict=True):
        yield int(dst[order[lo]]), order[lo:hi]


def _messages(rows: list[list]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["dst", "src", "a", "b", "c", "v"])


# ----------------------------------------------------------------- the graph


def _random(rows: pd.DataFrame, group: str, k: int, places: int, dtype: type) -> tuple[np.ndarray, ...]:
    """Sorted ids, vectors, and up to ``places`` random other rows of each with squared distances, in lists of ``k``."""
    rows = rows.sort_values("node")
    ids = rows["node"].to_numpy(np.int64)
    vecs = np.stack([np.asarray(v, dtype) for v in rows["vec"]])
    near, dist = np.full((len(ids), k), _NONE), np.full((len(ids), k), np.inf)
    if len(ids) < 2:
        return ids, vecs, near, dist
    # The seed hangs on the group alone, so a repeated task draws the same.
    draw = np.random.default_rng([len(group), int(rows[group].iloc[0])])
    at = np.arange(len(ids))[:, None]
    picked = draw.integers(0, len(ids) - 1, (len(ids), places)) if len(ids) - 1 > places else np.tile(np.arange(len(ids) - 1), (len(ids), 1))
    picked = np.sort(picked + (picked >= at), 1)
    wide = vecs.astype(np.float64)
    for lo in range(0, len(ids), _CHUNK):
        own = picked[lo : lo + _CHUNK]
        d = ((wide[own] - wide[lo : lo + _CHUNK, None]) ** 2).sum(-1)
        d[:, 1:][own[:, 1:] == own[:, :-1]] = np.inf  # drawn twice
        order = d.argsort(1, kind="stable")
        d, own = np.take_along_axis(d, order, 1), np.take_along_axis(own, order, 1)
        near[lo : lo + _CHUNK, : own.shape[1]] = np.where(np.isinf(d), _NONE, ids[own])
        dist[lo : lo + _CHUNK, : own.shape[1]] = d
    return ids, vecs, near, dist


def _start(k: int, places: int, dtype: type) -> Callable:
    """A home block with random neighbours from inside it; all entries are fresh."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, vecs, near, dist = _random(rows, "block", k, places, dtype)
        return _row(int(rows["block"].iloc[0]), ids, vecs, near, dist, near != _NONE)

    return run


def _links(n_blocks: int, k: int, places: int, dtype: type) -> Callable:
    """Random neighbours from inside a block of another deal, sent to the home blocks; these link the blocks."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, _, near, dist = _random(rows, "other", k, places, dtype)
        at, place = np.nonzero(near != _NONE)
        node, other, d = ids[at], near[at, place], dist[at, place]
        return _messages([
            [dst, -1, node[own].tobytes(), other[own].tobytes(), b"", d[own].tobytes()]
            for dst, own in _by_block(block_of(node, n_blocks))
        ])

    return run


def _ask(dim: Layout, n_blocks: int) -> Callable:
    """Requests for the vectors of the block's own sampled neighbours (a: ids)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                b = Block(row, dim)
                fresh, old = b.sampled(SAMPLE)
                wanted = np.unique(b.near[fresh | old])
                yield _messages([[dst, b.block, wanted[at].tobytes(), b"", b"", b""] for dst, at in _by_block(block_of(wanted, n_blocks))])

    return run


def _offer(dim: Layout, n_blocks: int) -> Callable:
    """Offers to the neighbours a node has chosen (a: chosen, b: node, c: fresh, v: vectors and bounds)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                b = Block(row, dim)
                fresh, old = b.sampled(SAMPLE)
                at, place = np.nonzero(fresh | old)
                chosen = b.near[at, place]
                out = []
                for dst, own in _by_block(block_of(chosen, n_blocks)):
                    nodes, inverse = np.unique(at[own], return_inverse=True)
                    out.append([
                        dst, b.block, chosen[own].tobytes(), inverse.astype(np.int64).tobytes(),
                        fresh[at[own], place[own]].astype(np.uint8).tobytes(), _vectors(b, nodes),
                    ])
                yield _messages(out)

    return run


def _vectors(b: Block, nodes: np.ndarray) -> bytes:
    """Ids, bounds (distance of the last neighbour) and vectors of nodes of a block."""
    head = np.array([len(nodes)], np.int64).tobytes()
    return head + b.ids[nodes].tobytes() + b.dist[nodes, -1].tobytes() + b.vecs[nodes].tobytes()


def _read_vectors(v: bytes, dim: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(v, np.int64, 1)[0])
    ids, bound = np.frombuffer(v, np.int64, n, 8), np.frombuffer(v, np.float64, n, 8 + 8 * n)
    return ids, bound, dim.vectors(memoryview(v)[8 + 16 * n :])


def _reply(dim: Layout) -> Callable:
    def run(blocks: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return _messages([])
        b = Block(blocks.iloc[0], dim)
        return _messages([[m.src, b.block, b"", b"", b"", _vectors(b, np.searchsorted(b.ids, _i64(m.a)))] for m in asked.itertuples()])

    return run


def _padded(owner: np.ndarray, member: np.ndarray, n: int, width: int) -> np.ndarray:
    """Member rows of each owner (sorted by owner), -1 beyond its count; at most ``width`` each."""
    start = np.searchsorted(owner, np.arange(n))
    place = np.arange(len(owner)) - start[owner]
    out = np.full((n, width), -1, np.int64)
    ok = place < width
    out[owner[ok], place[ok]] = member[ok]
    return out


def _join(dim: Layout, n_blocks: int, k: int, turn: int) -> Callable:
    """Compare the neighbours of each node of a block; improvements go to their blocks (a: node, b: neighbour, v: distance).

    A node's own fresh entries all take part. Of those that chose it, and of the
    old ones, as many as there is room for: other ones in every round (``turn``).
    """

    def run(blocks: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return _messages([])
        b = Block(blocks.iloc[0], dim)
        parts = [_read_vectors(v, dim) for v in mail["v"]] or [_read_vectors(_vectors(b, np.arange(0)), dim)]
        ids, first = np.unique(np.concatenate([p[0] for p in parts]), return_index=True)
        bound = np.concatenate([p[1] for p in parts])[first]
        if not len(ids):  # no node has neighbours
            return _messages([])
        vecs = np.concatenate([p[2] for p in parts])[first].astype(np.float64)
        fresh, old = b.sampled(SAMPLE)
        at, place = np.nonzero(fresh)
        at_old, place_old = np.nonzero(old)
        owners, members, news = [at, at_old], [b.near[at, place], b.near[at_old, place_old]], [np.ones(len(at), bool), np.zeros(len(at_old), bool)]
        for m in mail.itertuples():
            if len(m.a):
                owners.append(np.searchsorted(b.ids, _i64(m.a)))
                members.append(_read_vectors(m.v, dim)[0][_i64(m.b)])
                news.append(np.frombuffer(m.c, np.uint8).astype(bool))
        owner, member, new = np.concatenate(owners), np.searchsorted(ids, np.concatenate(members)), np.concatenate(news)
        sent = np.arange(len(owner)) >= len(at)  # all but the node's own fresh entries
        # Each (node, member) once, fresh if either side says so; own fresh ones first, the others mixed by a hash.
        order = np.lexsort((sent, ~new, member, owner))
        owner, member, new, sent = owner[order], member[order], new[order], sent[order]
        once = np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(member) != 0)]) if len(owner) else np.zeros(0, bool)
        owner, member, new, sent = owner[once], member[once], new[once], sent[once]
        mixed = np.lexsort((block_of(ids[member] + b.ids[owner], 1 << 30, salt=2 + turn), sent, owner))
        owner, member, new = owner[mixed], member[mixed], new[mixed]
        left = _padded(owner[new], member[new], len(b.ids), 2 * SAMPLE)
        other = _padded(owner[~new], member[~new], len(b.ids), 2 * SAMPLE)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for lo in range(0, len(b.ids), _CHUNK):
            x, y = left[lo : lo + _CHUNK], np.concatenate([left, other], 1)[lo : lo + _CHUNK]
            d = _squares(vecs[x], vecs[y])
            ok = (x[:, :, None] >= 0) & (y[:, None, :] >= 0) & (x[:, :, None] != y[:, None, :])
            u, w = np.broadcast_to(x[:, :, None], d.shape), np.broadcast_to(y[:, None, :], d.shape)
            for p, q in ((u, w), (w, u)):
                better = ok & (d < np.where(p >= 0, bound[p], -1.0))
                found.append((p[better], q[better], d[better]))
            if sum(len(f[0]) for f in found) > 2_000_000:
                found = [_best(*map(np.concatenate, zip(*found, strict=True)), k)]
        if not found:
            return _messages([])
        p, q, d = _best(*map(np.concatenate, zip(*found, strict=True)), k)
        return _messages([
            [dst, b.block, ids[p[own]].tobytes(), ids[q[own]].tobytes(), b"", d[own].tobytes()]
            for dst, own in _by_block(block_of(ids[p], n_blocks))
        ])

    return run


def _best(p: np.ndarray, q: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest distinct q of every p."""
    order = np.lexsort((q, d, p))
    p, q, d = p[order], q[order], d[order]
    # Equal pairs have equal distances up to rounding; a second sort removes the rest.
    order = np.lexsort((d, q, p))
    keep = np.ones(len(p), bool)
    keep[order[1:]] = (np.diff(p[order]) != 0) | (np.diff(q[order]) != 0)
    p, q, d = p[keep], q[keep], d[keep]
    first = np.concatenate([[True], np.diff(p) != 0]) if len(p) else np.zeros(0, bool)
    start = np.flatnonzero(first)
    place = np.arange(len(p)) - np.repeat(start, np.diff(np.append(start, len(p))))
    return p[place < k], q[place < k], d[place < k]


def _update(dim: Layout, k: int, joined: bool = True) -> Callable:
    """Merge improvements into the lists; fresh entries that have been joined become old."""

    def run(blocks: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return _row(0, *[np.zeros(0)] * 5).iloc[:0]
        b = Block(blocks.iloc[0], dim)
        used = b.sampled(SAMPLE)[0] & joined
        at, place = np.nonzero(b.near != _NONE)
        p = np.concatenate([at, *(np.searchsorted(b.ids, _i64(m)) for m in mail["a"])])
        q = np.concatenate([b.near[at, place], *(_i64(m) for m in mail["b"])])
        d = np.concatenate([b.dist[at, place], *(_f64(m) for m in mail["v"])])
        fresh = np.concatenate([(b.fresh & ~used)[at, place], np.ones(len(p) - len(at), bool)])
        came = np.concatenate([np.zeros(len(at), bool), np.ones(len(p) - len(at), bool)])
        order = np.lexsort((came, q, p))
        once = np.concatenate([[True], (np.diff(p[order]) != 0) | (np.diff(q[order]) != 0)]) if len(p) else np.zeros(0, bool)
        order = order[once]
        p, q, d, fresh = p[order], q[order], d[order], fresh[order]
        order = np.lexsort((q, d, p))
        p, q, d, fresh = p[order], q[order], d[order], fresh[order]
        place = np.arange(len(p)) - np.searchsorted(p, np.arange(len(b.ids)))[p]
        ok = place < k
        near, dist, new = np.full((len(b.ids), k), _NONE), np.full((len(b.ids), k), np.inf), np.zeros((len(b.ids), k), bool)
        near[p[ok], place[ok]], dist[p[ok], place[ok]], new[p[ok], place[ok]] = q[ok], d[ok], fresh[ok]
        return _row(b.block, b.ids, b.vecs, near, dist, new)

    return run


def _share(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        f = [np.frombuffer(x, np.uint8) for x in batch["fresh"]]
        yield pd.DataFrame({"fresh": [int(x.sum()) for x in f], "n": [len(x) for x in f]})


def _cogroup(blocks: DataFrame, mail: DataFrame, run: Callable, schema: str) -> DataFrame:
    keyed = mail.withColumn("block", F.col("dst"))
    return blocks.groupBy("block").cogroup(keyed.groupBy("block")).applyInPandas(lambda a, b: run(a, b), schema)


def build_graph(
    nodes: DataFrame, n: int, dim: Layout, k: int = K, rounds: int | None = None, block_nodes: int = BLOCK_NODES
) -> DataFrame:
    """Packed blocks of the neighbour graph of (node, vec): distinct nodes, finite vectors.

    Every round is stored in the shared folder, and the round before it deleted.
    The descent ends when fewer than ``STOP_SHARE`` of all entries are fresh;
    distances only fall, so it does end. ``rounds`` is for tests: so many rounds
    and no more.
    """
    n_blocks = max(1, -(-n // block_nodes))
    kind = nodes.schema["vec"].dataType.simpleString()

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["node"].to_numpy(np.int64)
            yield batch.assign(block=block_of(ids, n_blocks), other=block_of(ids, n_blocks, salt=1))

    dealt = nodes.select("node", "vec").mapInPandas(deal, f"node long, vec {kind}, block long, other long")
    graph = dealt.groupBy("block").applyInPandas(_start(k, k - k // 2, dim.dtype), _BLOCKS)
    links = dealt.groupBy("other").applyInPandas(_links(n_blocks, k, k // 2, dim.dtype), _MESSAGE)
    graph = store(_cogroup(graph, links, _update(dim, k, joined=False), _BLOCKS))
    turn = 0
    while rounds is None or turn < rounds:
        asked = graph.mapInPandas(_ask(dim, n_blocks), _MESSAGE)
        replies = _cogroup(graph, asked, _reply(dim), _MESSAGE)
        offers = graph.mapInPandas(_offer(dim, n_blocks), _MESSAGE)
        better = _cogroup(graph, replies.union(offers), _join(dim, n_blocks, k, turn), _MESSAGE)
        before, graph = graph, store(_cogroup(graph, better, _update(dim, k), _BLOCKS))
        discard(before)
        seen = scalar_row(graph.mapInPandas(_share, "fresh long, n long"), f=F.sum("fresh"), n=F.sum("n"))
        if (seen["f"] or 0) <= STOP_SHARE * (seen["n"] or 0):
            break
        turn += 1
    return graph


# ---------------------------------------------------------------- the search


def _reverse(dim: Layout, n_blocks: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                b = Block(row, dim)
                at, place = np.nonzero(b.near != _NONE)
                chosen = b.near[at, place]
                yield _messages([
                    [dst, b.block, chosen[own].tobytes(), b.ids[at[own]].tobytes(), b"", b.dist[at[own], place[own]].tobytes()]
                    for dst, own in _by_block(block_of(chosen, n_blocks))
                ])

    return run


def _edges(dim: Layout) -> Callable:
    """Edges of a block: own neighbours and the nearest ``REVERSE`` of those that chose a node."""

    def run(blocks: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        columns = ["block", "ids", "vecs", "ends", "edges"]
        if not len(blocks):
            return pd.DataFrame([], columns=columns)
        b = Block(blocks.iloc[0], dim)
        p = np.concatenate([np.zeros(0, np.int64), *(np.searchsorted(b.ids, _i64(m)) for m in mail["a"])]).astype(np.int64)
        q = np.concatenate([np.zeros(0, np.int64), *(_i64(m) for m in mail["b"])])
        d = np.concatenate([np.zeros(0), *(_f64(m) for m in mail["v"])])
        p, q, _ = _best(p, q, d, REVERSE)
        at, place = np.nonzero(b.near != _NONE)
        p, q = np.concatenate([p, at]), np.concatenate([q, b.near[at, place]])
        order = np.lexsort((q, p))
        p, q = p[order], q[order]
        once = np.concatenate([[True], (np.diff(p) != 0) | (np.diff(q) != 0)]) if len(p) else np.zeros(0, bool)
        p, q = p[once], q[once]
        ends = np.searchsorted(p, np.arange(len(b.ids) + 1)).astype(np.int64)
        return pd.DataFrame([[b.block, b.ids.tobytes(), b.vecs.tobytes(), ends.tobytes(), q.tobytes()]], columns=columns)

    return run


_STATE = "team long, node long, vec binary, ids binary, dist binary, done binary, open long"
_FOUND = "team long, node binary, ids binary, dist binary"


def _packed(dst: int, src: int, node: np.ndarray, bound: np.ndarray, vecs: np.ndarray, query: np.ndarray, ids: np.ndarray) -> list:
    """One message on many queries (a: node ids of one query after the other, b: bounds, c: queries and their counts, v: vectors).

    ``query``, ascending, gives the row in ``node``, ``bound`` and ``vecs`` that each of ``ids`` is for.
    """
    rows, counts = np.unique(query, return_counts=True)
    heads = np.stack([node[rows], counts.astype(np.int64)])
    return [dst, src, ids.tobytes(), bound[rows].tobytes(), heads.tobytes(), vecs[rows].tobytes()]


def _unpacked(mail: pd.DataFrame, dim: Layout) -> tuple[np.ndarray, ...]:
    """Queries, bounds, vectors, and the (row, node id) pairs of packed messages; a query has a row for each message on it."""
    heads = [_i64(c).reshape(2, -1) for c in mail["c"]]
    node, counts = np.concatenate([np.zeros((2, 0), np.int64), *heads], 1)
    bound = np.concatenate([np.zeros(0), *map(_f64, mail["b"])])
    vecs = np.concatenate([np.zeros((0, dim.dim), dim.dtype), *map(dim.vectors, mail["v"])])
    ids = np.concatenate([np.zeros(0, np.int64), *map(_i64, mail["a"])])
    return node, bound, vecs, np.repeat(np.arange(len(node)), counts), ids


def _distinct_pairs(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Places of the first of each distinct (p, q), in their order."""
    order = np.lexsort((q, p))
    return order[np.concatenate([[True], (np.diff(p[order]) != 0) | (np.diff(q[order]) != 0)])] if len(p) else order


def _frontier(dim: Layout, n_blocks: int, beam: int) -> Callable:
    """The unexpanded nodes of the beams, packed by block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dist = [_f64(x) for x in batch["dist"]]
            bound = np.array([d[-1] if len(d) >= beam else np.inf for d in dist])
            todo = [_i64(i)[np.frombuffer(d, np.uint8) == 0] for i, d in zip(batch["ids"], batch["done"], strict=True)]
            query = np.repeat(np.arange(len(todo)), [len(t) for t in todo])
            ids = np.concatenate([np.zeros(0, np.int64), *todo])
            node, vecs = batch["node"].to_numpy(np.int64), dim.vectors(b"".join(batch["vec"]))
            yield _messages([_packed(dst, -1, node, bound, vecs, query[own], ids[own]) for dst, own in _by_block(block_of(ids, n_blocks))])

    return run


def _expand(dim: Layout, n_blocks: int) -> Callable:
    """The ends of the edges of the nodes asked for, packed by block."""

    def run(blocks: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks):
            return _messages([])
        row = blocks.iloc[0]
        ids, ends, edges = _i64(row["ids"]), _i64(row["ends"]), _i64(row["edges"])
        node, bound, vecs, query, wanted = _unpacked(mail, dim)
        at = np.searchsorted(ids, wanted)
        counts = ends[at + 1] - ends[at]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        query, reached = np.repeat(query, counts), edges[np.repeat(ends[at], counts) + within]
        other = np.flatnonzero(reached != node[query])
        other = other[_distinct_pairs(query[other], reached[other])]
        query, reached = query[other], reached[other]
        return _messages([
            _packed(dst, row["block"], node, bound, vecs, query[own], reached[own]) for dst, own in _by_block(block_of(reached, n_blocks))
        ])

    return run


def _measure(dim: Layout, n_blocks: int, beam: int) -> Callable:
    """Squared distances of the reached nodes that beat the bound, best ``beam`` per query, packed by team."""

    def run(blocks: pd.DataFrame, mail: pd.DataFrame) -> pd.DataFrame:
        columns = ["team", "node", "ids", "dist"]
        if not len(blocks):
            return pd.DataFrame([], columns=columns)
        row = blocks.iloc[0]
        ids, own_vecs = _i64(row["ids"]), dim.vectors(row["vecs"])
        node, bound, vecs, query, reached = _unpacked(mail, dim)
        once = _distinct_pairs(node[query], reached)  # several blocks may send one pair
        query, reached = query[once], reached[once]
        at, d = np.searchsorted(ids, reached), np.empty(len(reached))
        for lo in range(0, len(reached), _PAIRS):
            pair = slice(lo, lo + _PAIRS)
            diff = own_vecs[at[pair]].astype(np.float64) - vecs[query[pair]].astype(np.float64)
            d[pair] = (diff * diff).sum(1)
        near = d < bound[query]
        p, q, d = _best(node[query[near]], reached[near], d[near], beam)
        return pd.DataFrame(
            [[team, p[own].tobytes(), q[own].tobytes(), d[own].tobytes()] for team, own in _by_block(block_of(p, n_blocks))], columns=columns
        )

    return run


def _advance(beam: int) -> Callable:
    """Beams of one team of queries after a round."""

    def run(state: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        node, near = (np.concatenate([np.zeros(0, np.int64), *map(_i64, found[c])]) for c in ("node", "ids"))
        d = np.concatenate([np.zeros(0), *map(_f64, found["dist"])])
        order = np.argsort(node, kind="stable")
        node, near, d = node[order], near[order], d[order]
        asked = state["node"].to_numpy(np.int64)
        first, stop = np.searchsorted(node, asked), np.searchsorted(node, asked, "right")
        out = []
        for row, lo, hi in zip(state.itertuples(), first, stop, strict=True):
            held = _i64(row.ids)
            ids, dist = np.concatenate([held, near[lo:hi]]), np.concatenate([_f64(row.dist), d[lo:hi]])
            done = np.arange(len(ids)) < len(held)  # what was held has been expanded by now
            ids, once = np.unique(ids, return_index=True)  # the first of an id is the held one
            dist, done = dist[once], done[once]
            order = np.lexsort((ids, dist))[:beam]
            ids, dist, done = ids[order], dist[order], done[order]
            out.append([row.team, row.node, row.vec, ids.tobytes(), dist.tobytes(), done.astype(np.uint8).tobytes(), int((~done).sum())])
        return pd.DataFrame(out, columns=["team", "node", "vec", "ids", "dist", "done", "open"])

    return run


def search_graph(
    graph: DataFrame, nodes: DataFrame, n: int, dim: Layout, block_nodes: int = BLOCK_NODES, beam: int = BEAM
) -> DataFrame:
    """(node, near, distance) of the beam around each distinct (node, vec) of ``nodes``.

    A search starts at the node itself and ends when its beam of ``beam``
    nodes is expanded, which it always comes to: every round expands all open
    nodes, and a node enters a full beam only by being nearer.
    """
    n_blocks = max(1, -(-n // block_nodes))
    edges = store(
        _cogroup(graph, graph.mapInPandas(_reverse(dim, n_blocks), _MESSAGE), _edges(dim), "block long, ids binary, vecs binary, ends binary, edges binary")
    )

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "team": block_of(batch["node"].to_numpy(np.int64), n_blocks), "node": batch["node"], "vec": [np.asarray(v, dim.dtype).tobytes() for v in batch["vec"]],
                "ids": [np.int64(i).tobytes() for i in batch["node"]], "dist": [np.zeros(1).tobytes()] * len(batch),
                "done": [b"\0"] * len(batch), "open": 1,
            })

    state = store(nodes.select("node", "vec").mapInPandas(begin, _STATE))
    while scalar_row(state, n=F.sum("open"))["n"]:
        going = state.filter("open > 0")
        reached = _cogroup(
            edges.select("block", "ids", "ends", "edges"), going.mapInPandas(_frontier(dim, n_blocks, beam), _MESSAGE), _expand(dim, n_blocks), _MESSAGE
        )
        found = _cogroup(edges.select("block", "ids", "vecs"), reached, _measure(dim, n_blocks, beam), _FOUND)
        moved = going.groupBy("team").cogroup(found.groupBy("team")).applyInPandas(_advance(beam), _STATE)
        before, state = state, store(moved.union(state.filter("open = 0")))
        discard(before)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids, dist = _i64(row.ids), np.sqrt(_f64(row.dist))
                yield pd.DataFrame({"node": row.node, "near": ids, "distance": dist})

    return state.mapInPandas(finish, "node long, near long, distance double")


def nearest(
    embeddings: DataFrame, n_neighbours: int = 10, every: int = 100, id_col: str = "vec_id", vec_col: str = "embedding",
    k: int = K, rounds: int | None = None, block_nodes: int = BLOCK_NODES, beam: int = BEAM,
) -> DataFrame:
    """The nearest rows found of every row whose id is divisible by ``every``.

    Returns query_id, rank (from 1), vec_id, score (Euclidean distance in
    double precision), nearest first, ties to the smaller vec_id; fewer rows
    where there are fewer candidates. Null ids, and vectors that are null,
    zero, or hold null or non-finite components take no part, nor do vectors
    of another length than the most frequent one (the smaller of two equally
    frequent). A column of floats is compared as floats, any other as doubles;
    distances are in double precision. Equal vectors are one node of the graph, and its rows come back
    at distance 0 of each other. An empty table gives no rows; extra columns
    are not read.
    """
    single = isinstance(getattr(embeddings.schema[vec_col].dataType, "elementType", None), T.FloatType)
    item, dtype = ("float", np.float32) if single else ("double", np.float64)
    rows = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast(f"array<{item}>").alias("vec"))
    usable = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = store(rows.filter(F.col("id").isNotNull() & usable).select("id", F.transform("vec", lambda x: x + F.lit(0).cast(item)).alias("vec")))
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    dim = Layout(sizes[0]["dim"] if sizes else 1, dtype)
    rows = rows.filter(F.size("vec") == dim.dim)
    # The first n + 1 ids of a vector are all that a list of n neighbours can need.
    ranked = Window.partitionBy("vec").orderBy("id")
    first = rows.withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= n_neighbours + 1)
    classes = store(first.groupBy("vec").agg(F.min("id").alias("node"), F.array_sort(F.collect_list("id")).alias("members")))
    n = scalar_row(classes, n=F.count(F.lit(1)))["n"]
    graph = build_graph(classes, n, dim, max(k, n_neighbours), rounds, block_nodes)
    asked = store(rows.filter(F.col("id") % every == 0).join(classes.select("vec", "node"), "vec").select("id", "node"))
    starts = classes.join(asked.select("node").distinct(), "node", "left_semi").select("node", "vec")
    reached = search_graph(graph, starts, n, dim, block_nodes, max(beam, 2 * n_neighbours))
    order = Window.partitionBy("node").orderBy("distance", "vec_id")
    members = classes.select(F.col("node").alias("near"), "members")
    listed = (
        reached.join(members, "near").select("node", "distance", F.explode("members").alias("vec_id"))
        .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n_neighbours + 1)
        .groupBy("node").agg(F.array_sort(F.collect_list(F.struct("distance", "vec_id"))).alias("found"))
    )
    others = F.filter("found", lambda x: x["vec_id"] != F.col("id"))
    return asked.join(listed, "node").select(
        F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, n_neighbours)).alias("at", "hit")
    ).select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.distance").alias("score"))
