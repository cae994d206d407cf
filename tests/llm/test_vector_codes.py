from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from shipwise.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label string, code string, points int"


def brute_nearest(points, entries):
    out = []
    for x in points.tolist():
        d = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in entries.tolist()]
        out.append((d.index(min(d)), min(d)))
    return out


def brute(rows, rounds=V.ROUNDS):
    """Plain Lloyd rounds over Python integers."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // 8))
    ints = [[math.floor(4096 * x) for x in v] + [0] * (8 * width - len(v)) for _, v, _ in kept]
    parts = [[tuple(q[p * width : (p + 1) * width]) for q in ints] for p in range(8)]
    books = [list(own[:16]) for own in parts]

    def assign():
        return [[brute_nearest(np.array([x], object), np.array(books[p], object).reshape(-1, width))[0] for x in parts[p]] for p in range(8)]

    for _ in range(rounds):
        found = assign()
        for p in range(8):
            for e in range(len(books[p])):
                own = [x for x, (c, _) in zip(parts[p], found[p], strict=True) if c == e]
                if own:
                    books[p][e] = tuple(sum(col) // len(own) for col in zip(*own, strict=True))
    found = assign()
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(found[p][k][1] for p in range(8)) for k in range(len(kept))]
    out = []
    for k, (i, _, lab) in enumerate(kept):
        total = sum(e for e, other in zip(errors, kept, strict=True) if other[2] == lab)
        out.append((i, "".join(f"{found[p][k][0]:02x}" for p in range(8)), errors[k], total, sha))
    return out


def by_key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, *(x if x is not None else -1 for x in r)))


@pytest.mark.parametrize(("n", "spread", "clusters"), [(1, 5, 1), (15, 3, 2), (700, 2, 3), (3000, 400, 12), (3000, 1, 40), (64, 0, 1)])
def test_trees_give_the_nearest_entries(n, spread, clusters):
    """Few values make ties everywhere; the lower entry wins."""
    rng = np.random.default_rng(n + spread)
    centres = rng.integers(-2000, 2000, (clusters, 4))
    points = centres[rng.integers(0, clusters, n)] + rng.integers(-spread, spread + 1, (n, 4))
    for k in (1, 2, 3, 16):
        entries = points[rng.integers(0, n, k)] if n > 1 else np.repeat(points, k, axis=0)
        tree = V.part_tree(points)
        codes, errors = V.point_codes(tree, entries)
        assert list(zip(codes.tolist(), errors.tolist(), strict=True)) == brute_nearest(points, entries)
        counts, sums = V.round_sums(tree, entries)
        assert counts.tolist() == np.bincount(codes, minlength=k).tolist()
        assert sums.tolist() == [points[codes == e].sum(0).tolist() for e in range(k)]


def test_bounds_prune_and_nodes_are_assigned_whole():
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (16, 8))
    points = centres[rng.integers(0, 16, 4096)] + rng.integers(-50, 50, (4096, 8))
    whole, rows, _ = V.nearest_entries(V.part_tree(points), centres)
    assert len(rows) < 600 and sum(len(nodes) for _, nodes, _ in whole) < 400


def test_equals_plain_lloyd_on_edges(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), (rng.normal(size=24) / 4).tolist(), str(i % 3) if i % 5 else None) for i in rng.permutation(400)]
    rows += rows[:30]  # repeated rows
    rows += [(5000, [0.25] * 24, "a"), (5001, [0.25] * 24, "b"), (None, [-0.1] * 24, None), (5002, [], "c"), (5003, [0.5] * 5, "c")]
    rows += [(-1, None, "a"), (-2, [None] * 24, "a"), (-3, [math.nan] * 24, "a"), (-4, [math.inf] * 24, "a"), (-5, [0.1] * 23 + [None], "a")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert by_key(V.vector_codes(df.repartition(3)).collect()) == by_key(brute(rows))


def test_few_rows_and_none(spark):
    rows = [(3, [0.5, -0.5], "a"), (1, [0.25, 0.125], None), (2, [0.5, -0.5], "a")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert by_key(V.vector_codes(df).collect()) == by_key(brute(rows))
    assert V.vector_codes(df.limit(0)).count() == 0
    assert V.vector_codes(df.filter("vec_id > 9")).count() == 0


def test_outsized_components_are_clamped(spark):
    rows = [(k, [float(k) * 1e300, 1.0] + [0.0] * 6, "a") for k in range(40)]
    got = V.vector_codes(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    assert len(got) == 40 and len({r.code for r in got}) > 1


def test_labels_beyond_the_broadcast_bound(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    want = by_key(V.vector_codes(df).collect())
    monkeypatch.setattr(V, "BROADCAST_LABELS", 0)
    assert by_key(V.vector_codes(df).collect()) == want
