from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from shipwise.llm.quality_model import quality_scores
from shipwise.llm.quality_rules import quality_rules

from .conftest import words
from .test_duplicates import classes, fingerprint
from .test_rules_and_shards import brute

SF = "/root/testdata/sf0.001"
OPERATORS = [f"op{n}" for n in range(1, 11)]


def test_every_operator_is_registered_once():
    names = [n.split("_")[0] for n in entry.queries() if n.startswith("op")]
    assert sorted(n for n in names if n in OPERATORS) == sorted(OPERATORS)
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


def test_stages_equal_brute_force(spark):
    """Each stage on its own input; the learned score is the operator's own."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, frames = docs.dtypes, [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF).cache())
    assert all(f.dtypes == columns for f in frames[:-1])
    texts = [{r.doc_id: r.text for r in f.collect()} for f in frames[:-1]]

    passed = {r.doc_id for r in quality_rules(docs).collect() if r.kept}
    base = {d for d, t in texts[0].items() if (c := brute(t))[0] >= 20 and 100 * c[4] <= 30 * c[0]}
    assert set(texts[1]) == passed and passed <= base
    # The score is learned from all labelled documents.
    scores = quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert set(texts[2]) == {r.doc_id for r in scores if r.score >= 0.3} & set(texts[1])
    prints = {d: fingerprint(t) for d, t in texts[2].items()}
    root = classes(prints.values())
    least: dict[int, int] = {}
    for d, f in prints.items():
        least[root[f]] = min(d, least.get(root[f], d))
    assert set(texts[3]) == set(least.values())
    first: dict[tuple, int] = {}
    for d in sorted(texts[3]):
        ws = words(texts[3][d])
        for i in range(len(ws) - 12):
            first.setdefault(tuple(ws[i : i + 13]), d)
    for d, t in texts[3].items():
        ws = words(t)
        gone = {j for i in range(len(ws) - 12) if first[tuple(ws[i : i + 13])] < d for j in range(i, i + 13)}
        assert texts[4][d] == (" ".join(w for i, w in enumerate(ws) if i not in gone) if gone else t)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths: dict[int, int] = {}
    for r in frames[5].collect():
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts[4].items()}


def test_pipeline_on_edges(spark, edge_docs, no_docs, tmp_path):
    for name, docs in (("edge", edge_docs), ("none", no_docs)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (8, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        assert corpus_pipeline.run(spark, folder).count() >= (name == "edge")


@pytest.mark.parametrize("name", ["op9_sharding", "op2_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
