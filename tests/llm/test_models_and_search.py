from __future__ import annotations

import itertools
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from shipwise.llm import nn_descent
from shipwise.llm.nn_descent import nearest
from shipwise.llm.quality_model import GatedAttention, keep_scored, quality_scores
from shipwise.llm.sentence_pieces import PieceDecoder, PieceModel, piece_digests
from shipwise.llm.toxicity import CharModel, N_CLASSES, Restorer, _trigrams, restore, toxicity_scores

SF = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# ----------------------------------------------------------------- pieces


def best_path(word, model):
    """All segmentations: the greatest score, ties to the path whose pieces from the end are longest."""
    best = None
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(word)]
        parts = [word[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        if any(len(p) > 1 and p not in model.score for p in parts):
            continue
        score = sum(model.score[p][0] if p in model.score else model.unknown for p in parts)
        key = (score, [len(p) for p in reversed(parts)])
        if best is None or key > best[0]:
            best = key, parts
    return best[1]


def test_words_equal_brute_force():
    model = PieceModel(PIECES)
    found = ["▁the", "▁hestan", "▁thing", "▁a", "▁Ünï", "▁\x01b", "▁therefore", "▁thereof", "▁don't"]
    ids, lengths = model.encode_words(found)
    ends = np.cumsum(lengths)
    for w, own in zip(found, np.split(ids, ends[:-1]), strict=True):
        want = [i for p in best_path(w, model) for i in ([model.score[p][1]] if p in model.score else model._unknown_ids(p))]
        assert own.tolist() == want


def test_equals_library_unigram_with_the_same_scores(tmp_path):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from sentencepiece import SentencePieceProcessor

    proto = pb.ModelProto()
    proto.ParseFromString(SentencePieceProcessor(model_file=PIECES).serialized_model_proto())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:  # scores of -1e9 exceed the library's single precision
        p.score = max(p.score, -40000.0)
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    rng = random.Random(4)
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    texts = [" ".join("".join(rng.choices(syllables, k=rng.randrange(1, 5))) for _ in range(20)) for _ in range(200)]
    texts += ["a  b", "  日 本\t 語 🙂", " x ", "▁▁ hi▁there ▁", "", None]
    model = PieceModel(path, cache_size=50)
    for _ in range(2):
        ids, offsets = model.encode(pa.array(texts))
        for t, a, b in zip(texts, offsets, offsets[1:], strict=False):
            assert ids[a:b].tolist() == model.sp.encode(t or "")


def test_decoding_gives_the_text_back(edge_docs, edge_rows, no_docs):
    import zlib

    got = sorted((r.doc_id or -1, r.decoded_crc32, r.decoded_chars) for r in piece_digests(edge_docs, PIECES).collect())
    plain = [(d or -1, (t or "").replace("▁", " ")) for d, t, *_ in edge_rows]
    assert got == sorted((d, zlib.crc32(t.encode()), len(t)) for d, t in plain)
    assert piece_digests(no_docs, PIECES).count() == 0
    assert PieceDecoder(PIECES).decode(np.zeros(0, int)) == ""


# ------------------------------------------------------------ classifiers


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    x, ends, y = rng.normal(size=(9, 5)), np.array([0, 1, 4, 9]), np.array([1.0, 0.0, 1.0])
    model = GatedAttention(5)

    def loss():
        p = model.score(x, ends)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = model.gradient(x, ends, y)
    for name, value in model.p.items():
        for at in itertools.islice(np.ndindex(value.shape), 6):
            keep = value[at]
            value[at] = keep + 1e-6
            up = loss()
            value[at] = keep - 1e-6
            down = loss()
            value[at] = keep
            assert abs((up - down) / 2e-6 - grads[name][at]) < 1e-6


def auc(rows, labels):
    pos = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 1]
    neg = [r.score for r in rows if r.held_out and labels.get(r.doc_id) == 0]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@pytest.mark.parametrize(("score", "column", "least"), [(quality_scores, "quality", 0.97), (toxicity_scores, "toxic", 0.75)])
def test_held_out_ranking(spark, score, column, least):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert auc(rows, {r.doc_id: r[column] for r in labels.collect()}) > least


@pytest.mark.parametrize("score", [quality_scores, toxicity_scores])
def test_scores_on_edges(spark, edge_docs, no_docs, score):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in score(edge_docs, none).collect()} == {0.5}
    assert score(no_docs, none).count() == 0
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 13)] + [(None, 1, 1), (3, None, None)], none.schema)
    rows = score(edge_docs, labels).collect()
    assert len(rows) == 15 and all(0 <= r.score <= 1 for r in rows)
    by_id: dict = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert len(by_id[2]) == 1 and by_id[1] == by_id[2]
    assert keep_scored(edge_docs, none).dtypes == edge_docs.dtypes


def test_disguised_words_are_restored():
    clean = ["stupid", "idiot", "loser", "the", "and", "trash", "worthless", "ring", "nation"]
    model = CharModel(_trigrams(clean, np.full(len(clean), 50)))
    assert _trigrams(["ab"], np.array([3])).sum() == 9 and N_CLASSES**3 == len(_trigrams(["a"], np.array([1])))
    for seen, want in [("1d10t", "idiot"), ("st*pid", "stupid"), ("l0s3r", "loser"), ("s.t.u.p.i.d", "stupid"), ("stuuuupid", "stupid"), ("tra$h", "trash")]:
        assert restore(seen, model)[0] == want
    assert "the loser" in restore("theloser", model, spelled=True)


def test_disguised_toxic_documents_score_high(spark):
    rng = random.Random(2)
    plain = ["river", "garden", "window", "market", "summer", "paper", "morning", "village"]
    toxic = ["idiot", "loser", "stupid", "trash"]
    rows, labels = [], []
    for i in range(400):
        ws = rng.choices(plain, k=30)
        if i % 4 == 0:
            ws += [rng.choice(toxic), rng.choice(toxic)]
        rng.shuffle(ws)
        rows.append((i, " ".join(ws)))
        labels.append((i, int(i % 4 == 0)))
    hidden = ["1d10t", "l0s3r", "s t u p i d", "t.r.a.s.h"]
    rows += [(1000 + i, " ".join(plain + [h])) for i, h in enumerate(hidden)] + [(2000, " ".join(plain)), (2001, "y a s 3.14 e.g. 2024-01-01")]
    got = toxicity_scores(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    scores = {r.doc_id: r.score for r in got.collect()}
    assert all(scores[1000 + i] > 0.5 for i in range(len(hidden))) and scores[2000] < 0.5 and scores[2001] < 0.5


EDGED = [("|oser", "loser"), ("sh!+", "shit"), ("(unt", "cunt"), ("#ate", "hate"), ("!d!ot", "idiot"), ("4$$", "ass"), ("$7@8", "stab"), ('"!diot!",', "idiot"), ("$tup!d!", "stupid")]


@pytest.mark.parametrize(("seen", "want"), EDGED)
def test_signs_at_word_edges_are_read_as_letters(seen, want):
    clean = ["loser", "shit", "cunt", "hate", "idiot", "ass", "stab", "stupid", "fate", "the", "and", "ring", "nation"]
    restorer = Restorer(CharModel(_trigrams(clean, np.full(len(clean), 50))))
    words, codes, owner = restorer.words(pa.array(["the ring", f"the {seen} nation", None]))
    assert want in {words[c] for c, o in zip(codes, owner, strict=True) if o == 1}
    assert {words[c] for c, o in zip(codes, owner, strict=True) if o == 0} == {"the", "ring"}


SPELLED = [("s h i +", "shit"), ("# a t e", "hate"), ("i d i 0 +", "idiot"), ("i d\ni o\tt", "idiot"), ("ѕtupіd", "stupid"), ("lоser", "loser")]


@pytest.mark.parametrize(("seen", "want"), SPELLED)
def test_spelled_signs_line_breaks_and_look_alikes_are_read(seen, want):
    clean = ["loser", "shit", "hate", "idiot", "stupid", "fate", "the", "and", "ring", "nation"]
    restorer = Restorer(CharModel(_trigrams(clean, np.full(len(clean), 50))))
    words, codes, _ = restorer.words(pa.array([f"the ring {seen}"]))
    assert want in {words[c] for c in codes}
    words, codes, _ = restorer.words(pa.array(["слово ring"]))  # a word of one script stands for itself
    assert {words[c] for c in codes} == {"слово", "ring"}


def test_masked_word_ends_are_read_as_letters():
    model = CharModel(_trigrams(["fool", "the", "and"], np.array([50, 50, 50])))
    assert restore("f***", model)[0] == "fool"
    words, *_ = Restorer(model).words(pa.array(["the f***", "*the* and?"]))
    assert {"fool", "the", "and"} <= set(words)


COMMON = ["the", "day", "you", "are", "idiot", "stupid", "loser", "and", "ring", "nation", "garden", "window", "morning"]
LONG = [
    ("st" + "u" * 50 + "pid", {"stupid"}),
    ("day.idiot", {"day", "idiot"}),
    ("you-idiot", {"you", "idiot"}),
    ("you--!d!ot", {"you", "idiot"}),
    ("y.o.u.i.d.i.o.t", {"you", "idiot"}),
    (".".join("theidiotandtheloser"), {"the", "idiot", "and", "loser"}),
    ("/".join(["garden", "window", "morning"] * 6 + ["1d10t", "and", "st*pid"]), {"idiot", "stupid", "garden", "window", "morning"}),
    (" ".join("thegardenandthewindowandthemorningandthestupidnationandtheloser"), {"stupid", "nation", "loser", "garden"}),
    ("/".join(["garden", "window"] * 400 + ["1d10t"] + ["morning"] * 300 + ["st*pid"]), {"idiot", "stupid"}),
]


@pytest.mark.parametrize(("seen", "want"), LONG)
def test_long_and_joined_words_are_read_whole(seen, want):
    restorer = Restorer(CharModel(_trigrams(COMMON, np.full(len(COMMON), 50))))
    words, codes, _ = restorer.words(pa.array([seen]))
    assert want <= {words[c] for c in codes}


@pytest.mark.parametrize("seen", ["you-1d10t", "y0u", "day###", "stupi***", "ring.$$$", "e.g.day", "o0o", "stuuu-pid"])
def test_shared_word_ends_read_as_the_whole_word(seen):
    model = CharModel(_trigrams(COMMON, np.full(len(COMMON), 50)))
    want = {w for r in restore(seen, model) for w in r.split()}
    assert set(Restorer(model)._readings(seen)) == want


# ------------------------------------------------------------------ search


def brute_nearest(rows, every=100, k=10):
    ok = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in ok:
        if q % every == 0:
            d = sorted((float(np.sqrt(((ok[q] - v) ** 2).sum())), i) for i, v in ok.items() if i != q)
            out[q] = d[:k]
    return out


def test_recall_over_several_blocks(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=25, block_nodes=200).collect()
    want = brute_nearest(rows, 25)
    hits = sum(r.vec_id in {i for _, i in want[r.query_id]} for r in got)
    assert len(got) == 600 and hits / 600 >= 0.9
    for r in got:
        assert r.score == pytest.approx(float(np.sqrt(((x[r.query_id].astype(float) - x[r.vec_id]) ** 2).sum())), rel=1e-12)


def test_the_descent_finds_the_neighbours(spark):
    """Random lists alone don't lead there, in one block or in many; the descent does, on doubles too."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").cache()
    want = {}
    for q in range(0, 3000, 60):
        d = np.sqrt(((x[q] - x) ** 2).sum(1))
        want[q] = set(np.argsort(d, kind="stable")[1:11].tolist())

    def recall(**how):
        got = nearest(frame, every=60, k=12, beam=20, **how).collect()
        assert all(r.score == np.sqrt(((x[r.query_id] - x[r.vec_id]) ** 2).sum()) for r in got)
        return sum(r.vec_id in want[r.query_id] for r in got) / 500

    for block_nodes in (250, 5000):
        assert recall(rounds=0, block_nodes=block_nodes) < 0.6
        assert recall(block_nodes=block_nodes) >= 0.9


def test_messages_of_the_search_dont_grow_with_queries_times_blocks(spark, monkeypatch):
    """A step sends at most one row from a block to another one, however many queries pass there."""
    x = np.random.default_rng(2).normal(size=(240, 4))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    sent, plain = {}, nn_descent._cogroup

    def counted(blocks, mail, run, schema):
        out = plain(blocks, mail, run, schema).cache()
        step = run.__qualname__.split(".")[0]
        sent[step] = max(sent.get(step, 0), out.count())
        return out

    monkeypatch.setattr(nn_descent, "_cogroup", counted)
    got = nearest(frame, every=1, k=12, block_nodes=60, beam=20).collect()
    assert len(got) == 2400
    assert set(sent) >= {"_expand", "_measure"}
    assert max(sent.values()) <= 16, sent  # 4 blocks


def test_search_edges(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (200, [0.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [3.0, 0.0]), (4, [-1.0, 0.0]),
            (5, None), (6, []), (7, [0.0, 0.0]), (300, [0.0, -0.0]), (400, [float("nan"), 1.0]), (8, [None, 1.0]), (9, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    rows += [(1000 + i, [1.0, 0.0]) for i in range(1, 40)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, node string")
    got: dict = {}
    for r in sorted(nearest(frame).collect(), key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert got == brute_nearest(rows)
    assert nearest(spark.createDataFrame([], frame.schema)).count() == 0
    assert nearest(spark.createDataFrame([(100, [1.0, 2.0], "x")], frame.schema)).count() == 0
