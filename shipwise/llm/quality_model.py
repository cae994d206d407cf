"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Every passage is
encoded (character-class shares, hashed word counts, word length), projected
by a learned layer, weighted by learned gated attention, and the document's
score is read from the weighted passage representation. All weights are
learned from document labels alone, on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, lean, narrow, split_words, text_chunks
from .labels import scored, training_rows
from .substring import word_hashes

PASSAGE_WORDS = 48
WORD_BUCKETS = 96
HIDDEN, GATES = 24, 12
MAX_TRAIN_ROWS, MAX_TRAIN_BYTES = 4000, 1 << 16
EPOCHS, BATCH_BAGS, RATE, DECAY = 25, 128, 0.01, 1e-4

# Byte classes: lower, upper and digits as one each, every other printable
# ASCII character alone, bytes of other characters together.
_CLASS = np.zeros(256, np.int64)
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = np.arange(1, 33)
_CLASS[ord("a") : ord("z") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("0") : ord("9") + 1] = 33, 34, 35
_CLASS[128:] = 36
N_CLASSES = 37
N_FEATURES = N_CLASSES + WORD_BUCKETS + 2


def passage_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, bag ends): passages of text i are rows ``ends[i]:ends[i + 1]``.

    A text without words is one passage of zeros.
    """
    words, starts = split_words(texts)
    sizes = np.diff(starts)
    bags = np.maximum(1, -(-sizes // PASSAGE_WORDS))
    ends = np.concatenate([[0], np.cumsum(bags)])
    x = np.zeros((ends[-1], N_FEATURES), np.float32)
    if len(words):
        within = np.arange(len(words)) - np.repeat(starts[:-1], sizes)
        passage = np.repeat(ends[:-1], sizes) + within // PASSAGE_WORDS
        lengths = pc.binary_length(words).to_numpy().astype(np.int64)
        raw = words.cast(pa.binary())
        data = np.frombuffer(raw.buffers()[2], np.uint8)
        offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1]
        data = data[offsets[0] : offsets[-1]]
        n = np.bincount(passage, minlength=len(x)).astype(np.float32)
        size = np.bincount(passage, lengths, minlength=len(x)).astype(np.float32)
        kinds = np.bincount(np.repeat(passage, lengths) * N_CLASSES + _CLASS[data], minlength=len(x) * N_CLASSES)
        x[:, :N_CLASSES] = np.sqrt(kinds.reshape(len(x), N_CLASSES) / np.maximum(size, 1)[:, None])
        bucket = (word_hashes(words) % np.uint64(WORD_BUCKETS)).astype(np.int64)
        counts = np.bincount(passage * WORD_BUCKETS + bucket, minlength=len(x) * WORD_BUCKETS)
        x[:, N_CLASSES : N_CLASSES + WORD_BUCKETS] = np.sqrt(counts.reshape(len(x), WORD_BUCKETS) / np.maximum(n, 1)[:, None])
        x[:, -2] = np.log1p(size / np.maximum(n, 1))
        x[:, -1] = np.log1p(n) / 4
    return x, ends


class GatedAttention:
    """h = tanh(x W + b); attention from tanh(h V) * sigmoid(h U); score from the weighted h."""

    def __init__(self, n_features: int = N_FEATURES, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
        self.p = {
            "W": draw(n_features, HIDDEN), "b": np.zeros(HIDDEN), "V": draw(HIDDEN, GATES), "U": draw(HIDDEN, GATES),
            "w": draw(GATES, 1)[:, 0], "c": draw(HIDDEN, 1)[:, 0], "d": np.zeros(1),
        }

    def forward(self, x: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
        p, first = self.p, ends[:-1]
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(first)), np.diff(ends))
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"][0], -30, 30)))
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "y": y, "bag": bag}

    def score(self, x: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.forward(x, ends)["y"]

    def gradient(self, x: np.ndarray, ends: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p, f, first = self.p, self.forward(x, ends), ends[:-1]
        h, t, g, a, bag = f["h"], f["t"], f["g"], f["a"], f["bag"]
        dy = (f["y"] - label) / len(label)
        dz = dy[:, None] * p["c"]
        da = (dz[bag] * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, first)[bag])
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
        return {
            "W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": f["z"].T @ dy,
            "d": np.array([dy.sum()]),
        }

    def fit(self, x: np.ndarray, ends: np.ndarray, label: np.ndarray, seed: int = 7) -> GatedAttention:
        rng, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(v) for k, v in self.p.items()}
        for _ in range(EPOCHS):
            order = rng.permutation(len(label))
            for lo in range(0, len(order), BATCH_BAGS):
                own = order[lo : lo + BATCH_BAGS]
                rows = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in own])
                cut = np.concatenate([[0], np.cumsum(ends[own + 1] - ends[own])])
                step += 1
                for k, grad in self.gradient(x[rows], cut, label[own]).items():
                    grad = grad + DECAY * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad * grad
                    self.p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = column(batch, "text", pa.string())
        for lo, hi in text_chunks(texts, 1 << 21):
            x, ends = passage_features(texts.slice(lo, hi - lo))
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id", pa.int64()).slice(lo, hi - lo),
                    column(batch, "label", pa.int64()).slice(lo, hi - lo),
                    pa.array([x[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary()),
                ],
                names=["doc_id", "label", "bag"],
            )


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAIN_ROWS, max_bytes: int = MAX_TRAIN_BYTES
) -> GatedAttention | None:
    """The model, or None if the sample doesn't hold both labels.

    At most ``max_rows`` bags of texts up to ``max_bytes`` reach the driver.
    """
    sample = training_rows(narrow(docs), labels, label, max_rows, max_bytes)
    bags = sample.mapInArrow(lean(_encode), "doc_id long, label long, bag binary").orderBy("doc_id").collect()
    if len({b["label"] for b in bags}) < 2:
        return None
    each = [np.frombuffer(b["bag"], np.float32).reshape(-1, N_FEATURES) for b in bags]
    ends = np.concatenate([[0], np.cumsum([len(e) for e in each])])
    return GatedAttention().fit(np.concatenate(each), ends, np.array([b["label"] for b in bags], float))


def _score(model: GatedAttention | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, docs = column(batch, "text", pa.string()), column(batch, "doc_id", pa.int64())
            for lo, hi in text_chunks(texts, 1 << 21):
                if model is None:
                    y = np.full(hi - lo, 0.5)
                else:
                    y = model.score(*passage_features(texts.slice(lo, hi - lo)))
                yield pa.RecordBatch.from_arrays([docs.slice(lo, hi - lo), pa.array(y, pa.float64())], names=["doc_id", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score of label 1, good quality).

    Every text is scored whole. Null, empty and wordless texts are one empty
    passage and get its score. Without both labels in the sample every score
    is 0.5. Repeated rows get equal scores; an empty table gives no rows;
    extra columns are not read.
    """
    rows = narrow(docs)
    return scored(rows.mapInArrow(lean(_score(fit_quality(docs, labels))), "doc_id long, score double"), threshold)


def keep_scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, labelled: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, all columns kept.

    The score is learned from the rows of ``labelled`` (where not given, of
    ``docs``) that have labels. Rows with a null id are scored like others; null
    and empty texts get the score of an empty passage; of repeated rows all stay
    or all go. Without both labels every row stays, and an empty table gives none.
    """
    model = fit_quality(docs if labelled is None else labelled, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, "text", pa.string())
            for lo, hi in text_chunks(texts, 1 << 21):
                part = batch.slice(lo, hi - lo)
                if model is not None:
                    part = part.filter(pa.array(model.score(*passage_features(texts.slice(lo, hi - lo))) >= threshold))
                yield part

    return docs.mapInArrow(lean(run), docs.schema)
