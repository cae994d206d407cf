from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash

from shipwise.llm.components import components
from shipwise.llm.simhash import BkForest, keep_one_per_component, link_groups, simhash_components
from shipwise.llm.substring import pack_sorted, remove_repeats, substring_digests, unpack_sorted

from .conftest import words


def fingerprint(text):
    ws = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i : i + 4]).encode(), 42) for i in range(max(1, len(ws) - 3))]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hs) > len(hs))


def classes(fps, radius=4):
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_components_equal_brute_force(edge_docs, edge_rows, no_docs):
    got = simhash_components(edge_docs, tree_size=2).collect()
    prints = [(d, fingerprint(t)) for d, t, *_ in edge_rows]
    root = classes(f for _, f in prints)
    least: dict[int, int] = {}
    for d, f in prints:
        if d is not None:
            least[root[f]] = min(d, least.get(root[f], d))
    want = sorted((d or -1, f"{f:016x}", least.get(root[f], -1)) for d, f in prints)
    assert sorted((r.doc_id or -1, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in got) == want
    assert simhash_components(no_docs).count() == 0


@pytest.mark.parametrize("tree_size", [4, 64, 4096])
def test_forest_links_all_near_pairs(tree_size):
    rng = random.Random(3)
    heads = [rng.getrandbits(64) for _ in range(20)]
    fps = sorted({h ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(7))}) for h in heads for _ in range(40)})
    shard = np.arange(len(fps)) * tree_size // max(tree_size, len(fps)) if tree_size < len(fps) else np.zeros(len(fps), int)
    links = []
    for s in set(shard.tolist()):  # a shard's tree gets its own rows first, then those of earlier shards
        own = np.array([f for f, x in zip(fps, shard, strict=True) if x == s], np.uint64)
        rest = np.array([f for f, x in zip(fps, shard, strict=True) if x < s], np.uint64)
        both = np.concatenate([own, rest])
        a, b = link_groups(np.zeros(len(both), int), np.arange(len(both)) < len(own), both, 4)
        links += zip(a.tolist(), b.tolist(), strict=True)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in links:
        root[find(a)] = find(b)
    want = classes(fps)
    same = lambda find_: {frozenset(f for f in fps if find_(f) == r) for r in {find_(f) for f in fps}}
    assert same(find) == same(lambda f: want[f])


def test_bk_children_are_keyed_by_distance():
    fps = np.array([0, 1, 3, 7, 2, 4], np.uint64)
    forest = BkForest(fps, np.zeros(6, int))
    edges = {(int(k) // 65, int(k) % 65): int(c) for k, c in zip(forest.keys, forest.children, strict=True)}
    assert edges[0, 1] == 1 and edges[0, 2] == 2 and edges[0, 3] == 3
    assert edges[1, 2] == 4 and edges[4, 2] == 5


def test_hot_fingerprints_over_several_shards(spark):
    # One large group of near copies: all agree on most blocks, far more than a tree holds.
    base = " ".join(f"w{i}" for i in range(400))
    docs = [(i, base + f" tail{i} end{i}") for i in range(300)] + [(1000 + i, f"lone{i} " * 30 + f"x{i} y z q") for i in range(50)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash_components(frame, tree_size=16).collect()}
    prints = {d: fingerprint(t) for d, t in docs}
    root = classes(prints.values())
    least: dict[int, int] = {}
    for d, f in prints.items():
        least[root[f]] = min(d, least.get(root[f], d))
    assert got == {d: least[root[f]] for d, f in prints.items()}


def test_keep_one_per_component(edge_docs, no_docs):
    kept = keep_one_per_component(edge_docs)
    assert kept.dtypes == edge_docs.dtypes
    named = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert len(named) == len(set(named)) and 1 in named and 2 not in named and 4 not in named and 3 in named
    assert sum(r.doc_id is None for r in kept.collect()) == 2
    assert keep_one_per_component(no_docs).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 5000)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, **{1000 + i: 1000 for i in range(60)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -------------------------------------------------------------- substring


def brute_substring(rows, window=13):
    least: dict[tuple, int] = {}
    texts = [(d, words(t)) for d, t, *_ in rows]
    for d, ws in texts:
        for i in range(len(ws) - window + 1) if d is not None else ():
            k = tuple(ws[i : i + window])
            least[k] = min(d, least.get(k, d))
    out = []
    for d, ws in texts:
        gone = set()
        for i in range(len(ws) - window + 1) if d is not None else ():
            if d > least[tuple(ws[i : i + window])]:
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(ws) if i not in gone]
        out.append((-1 if d is None else d, len(ws), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 30_000, 200])
def test_substring_equals_brute_force(edge_docs, edge_rows, block_bytes):
    got = substring_digests(edge_docs, block_bytes=block_bytes).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_substring(edge_rows)


def test_substring_over_many_blocks(spark):
    rng = random.Random(5)
    shared = [" ".join(f"p{p}w{i}" for i in range(rng.randrange(13, 60))) for p in range(6)]
    rows = []
    for d in range(120):
        parts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(rng.randrange(0, 40)))]
        parts += rng.choices(shared, k=rng.randrange(3))
        rng.shuffle(parts)
        rows.append((d * 37 - 500, " \n".join(parts)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring_digests(frame, block_bytes=1500).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_substring(rows)


def test_remove_repeats_keeps_columns(edge_docs, no_docs):
    out = remove_repeats(edge_docs)
    assert out.dtypes == edge_docs.dtypes
    assert out.count() == edge_docs.count()
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[7].text.startswith("one two shared0") and rows[8].text == "five six"
    assert rows[3].text is None and rows[5].text == " \t\n " and rows[2].block is None
    assert remove_repeats(no_docs).count() == substring_digests(no_docs).count() == 0


def test_packed_values_round_trip():
    rng = np.random.default_rng(2)
    for n in (1, 2, 1000):
        values = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
        assert (unpack_sorted(pack_sorted(values)) == values).all()
    assert (unpack_sorted(pack_sorted(np.array([0, 2**64 - 1], np.uint64))) == np.array([0, 2**64 - 1], np.uint64)).all()
