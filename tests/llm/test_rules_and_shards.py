from __future__ import annotations

import zlib

import pytest

from shipwise.llm.quality_rules import Rule, compile_rules, keep_quality, quality_rules
from shipwise.llm.sharding import shard_by_bytes

from .conftest import words


def brute(text):
    ws = words(text)
    where: dict[tuple, list[int]] = {}
    for i in range(len(ws) - 7):
        where.setdefault(tuple(ws[i : i + 8]), []).append(i)
    covered = {j for at in where.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [s for s in (text or "").split("\n") if words(s)]
    return (
        len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def test_counts_equal_brute_force(edge_docs, edge_rows):
    got = sorted(
        ((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules(edge_docs).collect())
    )
    want = []
    for d, t, *_ in edge_rows:
        n, c, s, dup, rep = brute(t)
        want.append((d or -1, n, c, s, dup, rep, n < 20 or 100 * rep > 30 * n))
    assert got == sorted(want)


def test_keep_returns_own_columns(edge_docs, no_docs):
    kept = keep_quality(edge_docs)
    assert kept.dtypes == edge_docs.dtypes
    verdicts = sum(r.kept for r in quality_rules(edge_docs).collect())
    assert kept.count() == verdicts > 0
    assert keep_quality(no_docs).count() == quality_rules(no_docs).count() == 0
    assert "Python" not in kept._jdf.queryExecution().executedPlan().toString()


def test_open_bounds():
    assert "symbol_ratio" in str(compile_rules((Rule("symbol_ratio", None, 0.1),)))


@pytest.mark.parametrize(("n_words", "kept"), [(19, False), (20, True), (10_000_000, True), (10_000_001, True), (3_000_000_000, True)])
def test_long_texts_are_judged_by_quality(spark, n_words, kept):
    row = ((n_words, 5.0, 0.01, 0.3, 0.0, 0.0),)
    kind = "quality struct<n_words:long,mean_word_chars:double,symbol_ratio:double,stop_ratio:double,dup_line_ratio:double,repeat_ratio:double>"
    assert spark.createDataFrame([row], kind).select(compile_rules()).first()[0] is kept


@pytest.mark.parametrize("n_shards", [1, 3, 8])
def test_shards_are_contiguous_and_balanced(edge_docs, edge_rows, n_shards):
    got = shard_by_bytes(edge_docs, n_shards, rows_per_range=4).collect()
    sizes = [len((t or "").encode()) + 1 for _, t, *_ in edge_rows]
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted(
        (d or -1, n, zlib.crc32((t or "").encode())) for (d, t, *_), n in zip(edge_rows, sizes, strict=True)
    )
    by_shard: dict[int, list] = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r)
    last = -2
    for shard in sorted(by_shard):
        rows = sorted(by_shard[shard], key=lambda r: r.slot)
        assert [r.slot for r in rows] == list(range(len(rows)))
        ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
        assert ids == sorted(ids) and ids[0] >= last
        last = ids[-1]
        assert sum(r.size for r in rows) <= sum(sizes) / n_shards + max(sizes)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_hot_id_spans_shards(spark):
    docs = spark.createDataFrame([(7, "same text")] * 400 + [(i, "other") for i in range(20)], "doc_id long, text string")
    got = shard_by_bytes(docs, 4, rows_per_range=50).collect()
    assert len(got) == 420 and len({r.shard for r in got if r.doc_id == 7}) == 4


def test_empty_table(no_docs):
    assert shard_by_bytes(no_docs).count() == 0
