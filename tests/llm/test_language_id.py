from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shipwise.llm import language_id as L

SF = "/root/testdata/sf0.01"


def symbols(text: str | None) -> bytes:
    out = bytearray()
    for b in (text or "").lower().encode() if (text or "").isascii() else bytes(x + 32 if 65 <= x <= 90 else x for x in (text or "").encode()):
        b = b if b >= 128 or 97 <= b <= 122 else 32
        if b != 32 or not out or out[-1] != 32:
            out.append(b)
    return bytes(out)


def plain_counts(texts, least=1):
    """context -> symbol -> count, for contexts of 0 to ORDER symbols (pads before the text)."""
    out: dict[bytes, Counter] = {}
    for t in texts:
        s = bytes(L.ORDER) + symbols(t)
        for i in range(L.ORDER, len(s)):
            for k in range(L.ORDER + 1):
                out.setdefault(s[i - k : i], Counter())[s[i]] += 1
    return out


def plain_length(counts, text):
    """PPM method C with exclusion, symbol by symbol."""
    s, nats = bytes(L.ORDER) + symbols(text), 0.0
    for i in range(L.ORDER, len(s)):
        gone: set[int] = set()
        for k in range(L.ORDER, -1, -1):
            own = {b: c for b, c in counts.get(s[i - k : i], {}).items() if b not in gone}
            if not own:
                continue
            n, d = sum(own.values()), len(own)
            if s[i] in own:
                nats -= math.log(own[s[i]] / (n + d))
                break
            nats -= math.log(d / (n + d))
            gone |= set(own)
        else:
            nats += math.log(256 - len(gone))
    return nats


def words(rng, alphabet, n):
    return " ".join("".join(rng.choices(alphabet, k=rng.randrange(1, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    rows = [(k, words(rng, "abcdeé", 30), "aa") for k in range(40)] + [(100 + k, words(rng, "xyzuvö", 30), "bb") for k in range(40)]
    return rows + [(200, words(rng, "ab-XY 12\n", 40), "aa"), (201, None, "aa"), (202, "", "bb"), (203, "zz", None)]


@pytest.fixture(scope="module")
def trees(spark, corpus):
    docs = spark.createDataFrame([(t, lang) for _, t, lang in corpus], "text string, lang string").repartition(3)
    return L.fit_context_trees(docs)


def test_code_lengths_equal_plain_ppm(trees, corpus):
    assert sorted(trees) == ["aa", "bb"]
    probes = ["abc dé", "xyz", "", "Hello 12 WORLD", "abab  --  abab", "日本", "é", words(random.Random(1), "abxyéö ", 50), None]
    got = L.Scorer([trees["aa"], trees["bb"]]).totals(pa.array(probes))
    for j, lang in enumerate(("aa", "bb")):
        counts = plain_counts([t for _, t, own in corpus if own == lang])
        assert np.allclose(got[:, j], [plain_length(counts, p) for p in probes], rtol=1e-12)


def test_every_context_is_a_code(spark, corpus, trees):
    """The probabilities of all 256 symbols after a context add up to one, in pruned trees too."""
    docs = spark.createDataFrame([(t, lang) for _, t, lang in corpus], "text string, lang string")
    for max_nodes, found in ((L.MAX_NODES, trees), (120, L.fit_context_trees(docs, 120))):
        assert all(sum(len(t.keys[k]) for t in found.values()) <= max_nodes for k in range(L.ORDER + 1))
        for tree in found.values():
            for k in range(1, L.ORDER + 1):  # each node's suffix is a node
                assert np.isin(tree.keys[k] & np.uint64((1 << (8 * k)) - 1), tree.keys[k - 1]).all()
            for context in (b"\0\0\0\0", b"abcd", b" a b", b"qqqq", b"\0xyz"):
                base = int.from_bytes(context, "big") << 8
                nats = tree.code_lengths(np.arange(256, dtype=np.uint64) + np.uint64(base))
                assert abs(np.exp(-nats).sum() - 1) < 1e-9


def test_slices_and_slots_do_not_matter(trees, monkeypatch):
    trees = list(trees.values())
    rng = random.Random(2)
    texts = pa.array([words(rng, "abcxyz  -é", rng.randrange(200)) for _ in range(60)] + ["", None, " " * 500, "a" * 5000])
    whole = L.Scorer(trees).totals(texts)
    monkeypatch.setattr(L, "_TABLE_BITS", 3)
    monkeypatch.setattr(L, "SLICE_BYTES", 1)
    small = L.Scorer(trees)
    assert np.allclose(whole, small.totals(texts))
    for slice_bytes in (7, 100, 1 << 20):
        seen = [np.concatenate([g[r == k] for g, r in L.text_grams(texts, slice_bytes)]) for k in range(len(texts))]
        assert [len(s) for s in seen] == [len(symbols(t)) for t in texts.to_pylist()]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = L.language_ids(docs).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.95


def test_edges(spark, edge_docs, edge_rows, no_docs):
    rows = L.language_ids(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    by_id: dict = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r.lang_pred, r.score))
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und")
    assert by_id[3] == by_id[4] == by_id[5] == {("und", 0.0)}
    assert len(by_id[2]) == 1 and by_id[1] == by_id[2]
    assert L.language_ids(no_docs).count() == 0
    unlabelled = edge_docs.selectExpr("doc_id", "text", "cast(null as string) as lang", "1 as n", "2 as gram")
    assert {(r.lang_pred, r.score) for r in L.language_ids(unlabelled).collect()} == {("und", 0.0)}
