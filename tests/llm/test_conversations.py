from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from shipwise.llm import conversations as C

SHAPE = re.compile(r"(s?(ua)+)?\Z")
SEEN = re.compile(r"[^\x20\x09-\x0D]")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        chars = SEEN.findall(text)
        if not chars:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif chars[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def every_edit(rows, inserts):
    """Every edit list with at most ``inserts`` inserts: (cost, audit, repaired rows)."""
    faults = faults_of(rows)

    def go(i, left):
        if left:
            for role in ("user", "assistant"):
                for cost, audit, rest in go(i, left - 1):
                    yield cost + 5, "I" + audit, [(role, "")] + rest
        if i == len(rows):
            yield 0, "", []
            return
        for cost, audit, rest in go(i + 1, left):
            yield cost + 2, "D" + audit, rest
            if faults[i] not in ("blank", "duplicate"):
                late = 5 * (faults[i] == "truncated")
                yield cost + late, "K" + audit, [rows[i]] + rest
                for role in ("user", "assistant"):
                    yield cost + late + 1, "R" + audit, [(role, rows[i][1])] + rest

    return go(0, inserts)


def by_suffixes(rows):
    """Cheapest (cost, audit) from each row and state to the end, with plain strings."""
    faults = faults_of(rows)
    steps = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i, state, inserted):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 2:
            for role in ("user", "assistant"):
                if (state, role[0]) in steps:
                    cost, audit, rest = best(i, role[0], inserted + 1)
                    found.append((cost + 5, "I" + audit, ((role, ""), *rest)))
        if i < len(rows):
            cost, audit, rest = best(i + 1, state, 0)
            found.append((cost + 2, "D" + audit, rest))
            if faults[i] not in ("blank", "duplicate"):
                late = 5 * (faults[i] == "truncated")
                for letter, role, more in (("K", rows[i][0], 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if (state, role[:1]) in steps:
                        cost, audit, rest = best(i + 1, role[:1], 0)
                        found.append((cost + late + more, letter + audit, ((role, rows[i][1]), *rest)))
        return min(found, default=(10**9, "", ()))

    for i in range(len(rows), 0, -1):  # keeps the recursion shallow
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def damage(table):
    """conv_id -> rows after damage as (turn, role, text), in order."""
    out = {}
    for conv, turn, role, text in table:
        rows = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    def key(r):
        whole = f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()
        return (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(whole).digest())

    return {c: sorted(rows, key=key) for c, rows in out.items()}


def brute(table):
    out = {}
    for conv, rows in damage(table).items():
        turns = {t for t, _, _ in rows if t is not None}
        pairs = [r[1:] for r in rows]
        faults = faults_of(pairs)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
        cost, audit, fixed = by_suffixes(pairs)
        assert SHAPE.match("".join(r[:1] or "?" for r, _ in fixed))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest)
    return out


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "u2"]
    return [(rng.choice(roles), rng.choice(["ok.", "cut", "", " ", "no!", "so"]) + rng.choice(["", " ", str(rng.randrange(3)) + "."])) for _ in range(n)]


def answer(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_suffix_search_equals_all_edits():
    rng = random.Random(1)
    for _ in range(150):
        rows = random_rows(rng, rng.randrange(4))
        legal = [e for e in every_edit(rows, 3) if SHAPE.match("".join(r[:1] or "?" for r, _ in e[2]))]
        cost, audit, fixed = min(legal)
        assert by_suffixes(rows) == (cost, audit, tuple(fixed))


def test_dp_equals_suffix_search_in_any_segments():
    rng = random.Random(2)
    for _ in range(300):
        rows = random_rows(rng, rng.randrange(12))
        names = {"": C.OK, "blank": C.BLANK, "duplicate": C.DUPLICATE, "truncated": C.TRUNCATED}
        whole = C.Repair()
        seg = C.Segment()
        for k, ((role, text), fault) in enumerate(zip(rows, faults_of(rows), strict=True)):
            if rng.random() < 0.3:
                whole.fold(seg, seg.paths(range(4)) if rng.random() < 0.5 else None) if seg.rows else None
                seg = C.Segment()
            seg.add(k, role, text, names[fault], 1)
        whole.fold(seg)
        cost, audit, fixed = by_suffixes(rows)
        got = whole.finish()
        assert got[5:] == (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())


@pytest.mark.parametrize(("base", "prime"), [(C.Audits.BASE, C.Audits.PRIME), (3, 5), (1, 1)])
def test_order_of_audits_survives_collisions(base, prime):
    """With few hash values nearly all prefixes collide; the order stays right."""
    rng = random.Random(3)
    audits, nodes = C.Audits(base, prime), [0]
    for _ in range(300):
        nodes.append(audits.add(rng.choice(nodes[-40:]), rng.choice("DIKR" if rng.random() < 0.3 else "K")))
    for _ in range(4000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert audits.less(a, b) == (audits.text(a) < audits.text(b))
    deep = nodes[-1]
    assert [audits.text(audits.ancestor(deep, d)) for d in range(audits.depth[deep] + 1)] == [
        audits.text(deep)[:d] for d in range(audits.depth[deep] + 1)
    ]


def test_whole_table_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert answer(C.repair_damaged(table)) == brute([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])


def test_edges_and_long_conversations(spark, monkeypatch):
    """Nulls, repeated rows, gaps, long texts, extra columns; a conversation over many ranges and segments."""
    rng = random.Random(4)
    table = [(c, t, *random_rows(rng, 1)[0]) for c in range(60) for t in rng.sample(range(9), rng.randrange(1, 7))]
    table += [(777, t, *random_rows(rng, 1)[0]) for t in range(900)]
    table += [(778, 5, "user", "same.")] * 40 + [(778, None, "user", "same.")] * 3 + [(778, None, None, None)]
    table += [(None, 1, "user", "hi."), (None, None, "assistant", "yo."), (779, 1, "user", "long " * 50_000 + ".")]
    table += [(780, t, None, None) for t in range(3)] + [(781, None, "user", "a."), (781, None, "assistant", "b.")]
    df = spark.createDataFrame([(*r, 1, "x") for r in table], "conv_id long, turn long, role string, text string, copies int, key string")
    want = brute(table)
    assert answer(C.repair_damaged(df.repartition(5))) == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert answer(C.repair_damaged(df.repartition(5))) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert C.repair_damaged(df.limit(0)).count() == 0


def test_segments_are_bounded():
    seg = C.Segment()
    for t in range(C.SEGMENT_ROWS):
        assert not seg.full
        seg.add(t, "user", "x.", C.OK, 1)
    assert seg.full
