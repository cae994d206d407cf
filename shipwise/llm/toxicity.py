"""Toxicity scores of text restored by noisy-channel deobfuscation.

1. A character trigram model is counted over the words of all documents.
2. Words that look disguised (digits or signs among letters, long letter
   runs, words spelled out with spaces) become character lattices: each sign
   may stand for a letter, a separator or a repeated letter may vanish, and a
   Viterbi search over the lattice under the trigram model restores them.
3. Evidence of words and word beginnings is counted on labelled rows; a small
   logistic model over the strongest evidence scores the restored text.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, lean, narrow, sorted_distinct, split_words, text_chunks
from .labels import scored, training_rows

# Letters of the model; 0 is a word's edge and the last class any other letter.
LETTERS = "abcdefghijklmnopqrstuvwxyzàâäáãåæçéèêëíìîïñóòôöõøœúùûüýÿß"
_CLASS = {c: k + 1 for k, c in enumerate(LETTERS)}
N_CLASSES = len(LETTERS) + 2
# Letters that a sign or digit may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "#": "h", "%": "x",
}
# Letters of other scripts that look like a Latin one.
LETTER_LOOKS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ј": "j",
    "ο": "o", "α": "a", "ι": "i", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "κ": "k",
}
MASKS = "*#_?"  # may stand for any letter
# Channel costs in nats. A sign that looks like a letter seldom stands for
# nothing, at a word's edge more often; a gap ends a word among letters spelled
# out with spaces, a break at a sign.
SUBSTITUTE, VANISH, LOST, EDGE, MASKED, SQUEEZE, GAP, BREAK = 1.0, 0.7, 5.0, 2.0, 3.0, 0.3, 2.0, 0.7
N_BEST, BEAM = 3, 48
# Every EMIT characters the words that ended over LAG letters ago are given out.
EMIT, LAG, LONGEST, MAX_CACHED = 48, 24, 256, 64
EDGE_SIGNS = ".,;:!?\"'()[]{}<>#*%&~_/\\|=+^-«»“”‘’…"
SIGNS = "".join(dict.fromkeys([*LOOKS_LIKE, *MASKS]))
OUTER_SIGNS = "".join(c for c in EDGE_SIGNS if c not in SIGNS)
MAX_TRAIN_ROWS, MAX_TRAIN_BYTES = 12_000, 1 << 16
MIN_TOXIC_ROWS, MAX_EVIDENCE, STARTS = 3, 20_000, (4, 5, 6)
_RUN = "|".join(c * 3 for c in LETTERS)
_RUNS = re.compile(r"(.)\1\1")
# A sign that may stand for a letter, next to a letter or another such sign.
_SIGN = "[" + re.escape(SIGNS) + "]"
_SIGNED = rf"{_SIGN}(?:\p{{L}}|{_SIGN})|\p{{L}}{_SIGN}"
_READABLE = r"[\p{L}" + re.escape("".join(LOOKS_LIKE)) + "]"
_CROSSED = "[" + "".join(LETTER_LOOKS) + "]"
# Single letters and signs that may be letters, between any white space; the first no mask.
_SPELLED = re.compile(
    r"(?<!\S)(?:[^\W_]|[" + re.escape("".join(LOOKS_LIKE)) + r"])(?:\s+(?:[^\W_]|" + _SIGN + r")){2,}(?!\S)"
)


# ----------------------------------------------------------- character model


def _trigrams(words: list[str], times: np.ndarray) -> np.ndarray:
    """Counts of class trigrams of distinct words, each ``times`` as often."""
    out = np.zeros(N_CLASSES**3)
    joined = "\0\0" + "\0\0".join(words) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    table = np.full(0x250, N_CLASSES - 1, np.int64)
    table[0] = 0
    for c, k in _CLASS.items():
        table[ord(c)] = k
    c = np.where(codes < len(table), table[np.minimum(codes, len(table) - 1)], N_CLASSES - 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    # A word of n letters gives n + 1 trigrams, the last one ending at its edge.
    at = np.repeat(np.cumsum(lengths + 2) - lengths - 2, lengths + 1)
    at = at + np.arange(len(at)) - np.repeat(np.cumsum(lengths + 1) - lengths - 1, lengths + 1)
    key = (c[at] * N_CLASSES + c[at + 1]) * N_CLASSES + c[at + 2]
    np.add.at(out, key, np.repeat(times, lengths + 1))
    return out


def _plain_words(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case distinct words without edge signs, and the code of each word."""
    coded = pc.utf8_lower(pc.utf8_trim(words, characters=EDGE_SIGNS)).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)


def _disguised(distinct: pa.Array) -> np.ndarray:
    """Words that hold signs or digits too, letters of another script among Latin ones, or a letter three times in a row.

    A word without a letter counts if it has signs that may stand for letters
    side by side.
    """
    mixed = pc.and_(pc.match_substring_regex(distinct, r"\p{L}"), pc.match_substring_regex(distinct, r"[^\p{L}\p{M}]"))
    crossed = pc.and_(pc.match_substring_regex(distinct, _CROSSED), pc.match_substring_regex(distinct, "[a-z]"))
    return pc.or_(pc.or_(pc.or_(mixed, crossed), _signed(distinct)), pc.match_substring_regex(distinct, _RUN)).to_numpy(zero_copy_only=False)


def _signed(distinct: pa.Array) -> pa.Array:
    return pc.and_(pc.match_substring_regex(distinct, _SIGNED), pc.match_substring_regex(distinct, _READABLE))


def _edged_words(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case distinct words with a sign at an edge that may stand for a letter, and each word's code (or -1)."""
    coded = words.dictionary_encode()
    outer = pc.utf8_lower(pc.utf8_trim(coded.dictionary, characters=OUTER_SIGNS))
    edged = pc.and_(pc.not_equal(outer, pc.utf8_trim(outer, characters=EDGE_SIGNS)), _signed(outer))
    kept = outer.filter(edged).dictionary_encode()
    code = np.full(len(outer), -1)
    code[edged.to_numpy(zero_copy_only=False)] = kept.indices.to_numpy(zero_copy_only=False)
    return kept.dictionary, code[coded.indices.to_numpy(zero_copy_only=False)]


def _count_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(N_CLASSES**3)
    for batch in batches:
        texts = column(batch, "text", pa.string())
        for lo, hi in text_chunks(texts):
            distinct, codes = _plain_words(split_words(texts.slice(lo, hi - lo))[0])
            plain = ~_disguised(distinct) & (pc.binary_length(distinct).to_numpy() > 0)
            times = np.bincount(codes, minlength=len(distinct))[plain]
            total += _trigrams(distinct.filter(pa.array(plain)).to_pylist(), times)
    key = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(total[key].astype(np.int64))], names=["key", "n"])


class CharModel:
    """Log probabilities of a letter class after two others (interpolated)."""

    def __init__(self, counts: np.ndarray):
        c3 = counts.reshape(N_CLASSES, N_CLASSES, N_CLASSES)
        c2, c1 = c3.sum(0), c3.sum((0, 1))
        p1 = (c1 + 1) / (c1.sum() + N_CLASSES)
        p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
        p3 = (c3 + 5 * p2) / (c3.sum(2, keepdims=True) + 5)
        self.log = np.log(p3)


def char_model(docs: DataFrame) -> CharModel:
    """Counted over all documents; at most the cube of the classes reaches the driver."""
    rows = narrow(docs).select("text").mapInArrow(lean(_count_partition), "key long, n long")
    counts = np.zeros(N_CLASSES**3)
    for r in rows.groupBy("key").agg(F.sum("n").alias("n")).collect():
        counts[r["key"]] = r["n"]
    return CharModel(counts)


# -------------------------------------------------------------- deobfuscation


def _options(word: str, inner: bool = False) -> list[list[tuple[str, float]]]:
    """The lattice: per place, letters with their channel costs ('' vanishes).

    With ``inner`` letters stand before the word.
    """
    out = []
    first, last = 0 if inner else len(word) - len(word.lstrip(EDGE_SIGNS)), len(word.rstrip(EDGE_SIGNS))
    for k, c in enumerate(word):
        if c.isalpha():
            run = k > 0 and word[k - 1] == c and c * 3 in word[max(0, k - 2) : k + 2]
            out.append([(c, 0.0), ("", SQUEEZE)] if run else [(c, 0.0)])
            if c in LETTER_LOOKS:
                out[-1].append((LETTER_LOOKS[c], SUBSTITUTE))
            continue
        like = LOOKS_LIKE.get(c, "")
        vanish = LOST if like else VANISH
        if (k < first or k >= last) and c in SIGNS:
            # The word without its edge signs is read besides: here they rather are letters.
            vanish = LOST if c in MASKS else EDGE
        out.append([("", vanish)] + [(x, SUBSTITUTE) for x in like])
        if c in MASKS:
            out[-1] += [(x, MASKED) for x in LETTERS[:26]]
    return out


def _finished(text: str) -> int:
    """Where the words begin that ended at most ``LAG`` letters ago, or have not ended."""
    return text.rfind(" ", 0, max(0, len(text) - LAG)) + 1


def _best(paths: list[tuple[float, str]], n_best: int) -> list[tuple[float, str]]:
    """The ``n_best`` best paths of different text."""
    return heapq.nlargest(n_best, ((s, t) for t, s in {t: s for s, t in sorted(paths)}.items()))


def _reached(states: dict, options: list[tuple[str, float]], log: np.ndarray) -> dict:
    """The paths into the ``BEAM`` best states after one more place.

    The beam is chosen by the scores: only the paths of its states are built.
    """
    keys = list(states)
    classes = [_CLASS.get(x, N_CLASSES - 1) if x else -1 for x, _ in options]
    if len(keys) * len(options) <= BEAM:
        out: dict = {}
        for a, b in keys:
            for (letter, cost), k in zip(options, classes, strict=True):
                add = (float(log[a, b, k]) if letter else 0.0) - cost
                out.setdefault((b, k) if letter else (a, b), []).extend((s + add, t + letter) for s, t in states[a, b])
        return out
    a, b = np.array(keys).T
    add = np.where(np.array(classes) < 0, 0.0, log[a, b][:, classes]) - np.array([c for _, c in options])
    order = np.argsort(-(np.array([states[k][0][0] for k in keys])[:, None] + add), axis=None, kind="stable")
    out = {}
    for at in order.tolist():
        i, j = divmod(at, len(options))
        out.setdefault((keys[i][1], classes[j]) if classes[j] >= 0 else keys[i], [])
        if len(out) == BEAM:
            break
    ending: dict[int, list[int]] = {}
    for i, (_, last) in enumerate(keys):
        ending.setdefault(last, []).append(i)
    place: dict[int, list[int]] = {}
    for j, k in enumerate(classes):
        place.setdefault(k, []).append(j)
    row, add = {k: i for i, k in enumerate(keys)}, add.tolist()
    for to, paths in out.items():
        steps = [(i, j) for i in ending.get(to[0], ()) for j in place.get(to[1], ())]
        steps += [(row[to], j) for j in place.get(-1, ()) if to in row]
        for i, j in steps:
            letter, more = options[j][0], add[i][j]
            paths.extend((s + more, t + letter) for s, t in states[keys[i]])
    return out


def restore(word: str, model: CharModel, n_best: int = N_BEST, spelled: bool = False, ended: dict[str, None] | None = None) -> list[str]:
    """The ``n_best`` most likely readings of a lower-case disguised word, best first."""
    return [t.strip() for t in _search(word, model, n_best, spelled, ended)]


def _search(
    word: str, model: CharModel, n_best: int, spelled: bool = False, ended: dict[str, None] | None = None, start: tuple[int, int] | None = None
) -> list[str]:
    """The readings of ``restore``, or how a word goes on after the two letters ``start``.

    A state is the last two letters; each keeps its best ``n_best`` paths. A
    reading may hold spaces between words at signs, with ``spelled`` anywhere.
    With ``ended`` the search goes on over any length in bounded memory: words
    that the best readings have finished go there, the readings returned are of
    the rest, and an unfinished word is held to its first ``LONGEST`` letters
    (features other than the whole word see at most six).
    """
    log, edge = model.log, 0
    states: dict[tuple[int, int], list[tuple[float, str]]] = {start or (edge, edge): [(0.0, "")]}
    for at, options in enumerate(_options(word, start is not None)):
        sign = not word[at].isalnum()
        if spelled or sign:
            gaps = [(s + float(log[a, b, edge]) - (BREAK if sign else GAP), t + " ") for (a, b), ps in states.items() if b != edge for s, t in ps]
            if gaps:
                states[edge, edge] = _best(states.get((edge, edge), []) + gaps, n_best)
        reached = _reached(states, options, log)
        states = {to: paths if len(paths) == 1 else _best(paths, n_best) for to, paths in reached.items()}
        if ended is not None and at % EMIT == EMIT - 1:
            for _, t in heapq.nlargest(n_best, (x for ps in states.values() for x in ps)):
                ended.update(dict.fromkeys(t[: _finished(t)].split()))
            states = {to: _best([(s, _held(t)) for s, t in ps], n_best) for to, ps in states.items()}
    final = [(s + (float(log[a, b, edge]) if b != edge else 0.0), t.rstrip()) for (a, b), paths in states.items() for s, t in paths]
    return list(dict.fromkeys(t for _, t in heapq.nlargest(4 * n_best, final)))[:n_best]


def _held(text: str) -> str:
    *whole, last = text[_finished(text) :].split(" ")
    return " ".join([*whole, last[:LONGEST]])


class Restorer:
    """Readings of disguised words, a bounded number kept between batches."""

    def __init__(self, model: CharModel):
        self.model = model
        # Words of the same last letters before the same signs go on in the same way.
        self._tails = lru_cache(maxsize=100_000)(lambda tail, start: _search(tail, model, N_BEST, start=start))
        # Long strings seldom come twice, and would fill the cache.
        self._cached = lru_cache(maxsize=100_000)(self._read)

    def words(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(distinct restored words, code of every occurrence, text of every occurrence).

        Plain words stand for themselves, disguised ones for their readings;
        words with edge signs that may be letters add the readings with these;
        words spelled out letter by letter add the readings of the whole.
        """
        raw, starts = split_words(texts)
        distinct, codes = _plain_words(raw)
        owner = np.repeat(np.arange(len(texts)), np.diff(starts))
        hidden = np.flatnonzero(_disguised(distinct))
        words = distinct.to_pylist()
        known = {w: k for k, w in enumerate(words)}
        readings = {int(k): [known.setdefault(r, len(known)) for r in self._readings(words[k])] for k in hidden}
        out_codes, out_owner = [codes], [owner]
        edged, at = _edged_words(raw)
        signed = [[known.setdefault(r, len(known)) for r in self._readings(w)] for w in edged.to_pylist()]
        hits = [(readings, codes, np.isin(codes, hidden)), (signed, at, at >= 0)]
        for found, of, there in hits:
            more = [(r, o) for c, o in zip(of[there].tolist(), owner[there].tolist(), strict=True) for r in found[c]]
            if more:
                out_codes.append(np.array([m[0] for m in more]))
                out_owner.append(np.array([m[1] for m in more]))
        spelled = pc.match_substring_regex(texts.fill_null(""), r"(^|\s)[^\s]\s+[^\s]\s+[^\s](\s|$)")
        for i in np.flatnonzero(spelled.to_numpy(zero_copy_only=False)):
            for found in _SPELLED.finditer(texts[int(i)].as_py()):
                letters = "".join(found.group().split()).lower()
                own = [known.setdefault(r, len(known)) for r in [letters, *self._readings(letters, True)]]
                out_codes.append(np.array(own))
                out_owner.append(np.full(len(own), i))
        return list(known), np.concatenate(out_codes).astype(np.int64), np.concatenate(out_owner).astype(np.int64)

    def _readings(self, word: str, spelled: bool = False) -> tuple[str, ...]:
        """The words of the most likely readings."""
        return (self._cached if len(word) <= MAX_CACHED else self._read)(word, spelled)

    def _read(self, word: str, spelled: bool) -> tuple[str, ...]:
        ended: dict[str, None] = {}
        n = next((k for k, c in enumerate(word) if not c.isalpha() or c in LETTER_LOOKS), 0)
        if n and len(word) <= MAX_CACHED and not spelled and not _RUNS.search(word, 0, n):
            start = tuple(_CLASS.get(c, N_CLASSES - 1) for c in word[max(0, n - 2) : n])
            rest = [word[:n] + t for t in self._tails(word[n:], (0, 0, *start)[-2:])]
        else:
            rest = restore(word, self.model, spelled=spelled, ended=ended if len(word) > MAX_CACHED else None)
        return tuple(dict.fromkeys([*ended, *(w for r in rest for w in r.split())]))


# ------------------------------------------------------------------- evidence


def _features(word: str) -> list[str]:
    return [f"={word}", *(f"{word[:n]}-" for n in STARTS if len(word) > n)]


def _count_evidence(model: CharModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            texts, label = column(batch, "text", pa.string()), column(batch, "label", pa.int64()).to_numpy()
            for lo, hi in text_chunks(texts):
                words, codes, owner = restorer.words(texts.slice(lo, hi - lo))
                rows, toxic = Counter(), Counter()
                pairs = sorted_distinct(owner * len(words) + codes)
                by_row: dict[int, set[str]] = {}
                for o, c in zip((pairs // len(words)).tolist(), (pairs % len(words)).tolist(), strict=True):
                    by_row.setdefault(o, set()).update(_features(words[c]))
                for o, found in by_row.items():
                    rows.update(found)
                    if label[lo + o]:
                        toxic.update(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(rows)), pa.array(list(rows.values()), pa.int64()), pa.array([toxic[f] for f in rows], pa.int64())],
                    names=["feature", "n", "toxic"],
                )

    return run


class Evidence:
    """Rows and toxic rows of each feature, of ``n0`` clean and ``n1`` toxic rows."""

    def __init__(self, counts: dict[str, tuple[int, int]], n0: int, n1: int):
        self.counts, self.n0, self.n1 = counts, n0, n1

    def odds(self, n: int, toxic: int, without: int | None) -> float:
        """Log odds of a feature, counted without one row of label ``without``."""
        n0, n1 = self.n0 - (without == 0), self.n1 - (without == 1)
        # A feature that the row can't hold isn't read, so a count below zero is none.
        n, toxic = max(0, n - (without is not None)), max(0, toxic - (without == 1))
        return float(np.log((toxic + 0.1) / (n1 + 1)) - np.log((max(0, n - toxic) + 0.1) / (n0 + 1)))

    def weights(self, words: list[str], without: int | None = None) -> np.ndarray:
        """The strongest evidence of each word's features, 0 without any."""
        own = {f: max(0.0, self.odds(*c, without)) for f, c in self.counts.items()}
        return np.array([max((own.get(f, 0.0) for f in _features(w)), default=0.0) for w in words] or [0.0])


def _signals(words: list[str], codes: np.ndarray, owner: np.ndarray, n_texts: int, weight: np.ndarray) -> np.ndarray:
    """Per text: strongest evidence, the next two words', and the share of words with strong evidence."""
    out = np.zeros((n_texts, 4))
    pairs = sorted_distinct(owner * len(words) + codes)  # a word counts once a text
    own, w = pairs // max(1, len(words)), weight[pairs % max(1, len(words))] if len(words) else np.zeros(len(pairs))
    order = np.lexsort((-w, own))
    own, w = own[order], w[order]
    first = np.searchsorted(own, np.arange(n_texts))
    for k in range(3):
        at = np.minimum(first + k, len(own) - 1)
        there = (first + k < len(own)) & (own[at] == np.arange(n_texts)) if len(own) else np.zeros(n_texts, bool)
        out[there, k] = w[at[there]]
    total = np.bincount(owner, minlength=n_texts)
    strong = np.bincount(owner, weight[codes] > 2.0, minlength=n_texts) if len(codes) else total * 0.0
    out[:, 3] = np.sqrt(strong / np.maximum(total, 1))
    return out


def _signal_rows(model: CharModel, evidence: Evidence):
    """Training signals: each row's evidence is counted without the row itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            texts, label = column(batch, "text", pa.string()), column(batch, "label", pa.int64()).to_numpy()
            for lo, hi in text_chunks(texts):
                found = restorer.words(texts.slice(lo, hi - lo))
                each = [_signals(*found, hi - lo, evidence.weights(found[0], y)) for y in (0, 1)]
                x = np.where(label[lo:hi, None] == 1, each[1], each[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        column(batch, "label", pa.int64()).slice(lo, hi - lo),
                        pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 4).cast(pa.list_(pa.float64())),
                    ],
                    names=["label", "x"],
                )

    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Newton steps of a ridge logistic regression; the last weight is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + ridge * w)
    return w


class ToxicityModel:
    """Character model, evidence in log odds, and the logistic weights over the signals."""

    def __init__(self, chars: CharModel, evidence: Evidence, weights: np.ndarray):
        self.chars, self.evidence, self.weights = chars, evidence, weights

    def score(self, texts: pa.Array, restorer: Restorer) -> np.ndarray:
        found = restorer.words(texts)
        x = _signals(*found, len(texts), self.evidence.weights(found[0]))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_TRAIN_ROWS) -> ToxicityModel | None:
    """The model, or None if the labelled sample doesn't hold both labels.

    The character model covers all documents. Evidence is counted in Spark on
    at most ``max_rows`` labelled rows; the logistic weights are learned on the
    same rows, each with its own counts left out. At most ``MAX_EVIDENCE``
    features reach the driver, the strongest first.
    """
    rows = training_rows(narrow(docs), labels, label, max_rows, MAX_TRAIN_BYTES)
    size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(size) < 2:
        return None
    chars, n0, n1 = char_model(docs), size[0], size[1]
    odds = F.log((F.col("toxic") + 0.1) / (n1 + 1.0)) - F.log((F.col("n") - F.col("toxic") + 0.1) / (n0 + 1.0))
    best = (
        rows.mapInArrow(_count_evidence(chars), "feature string, n long, toxic long")
        .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
        .filter(F.col("toxic") >= MIN_TOXIC_ROWS)
        .withColumn("w", odds).filter("w > 1.5").orderBy(F.desc("w"), F.desc("toxic"), "feature").limit(MAX_EVIDENCE)
    )
    evidence = Evidence({r["feature"]: (r["n"], r["toxic"]) for r in best.collect()}, n0, n1)
    fit = rows.mapInArrow(_signal_rows(chars, evidence), "label long, x array<double>").collect()
    x, y = np.array([r["x"] for r in fit], float).reshape(-1, 4), np.array([r["label"] for r in fit], float)
    return ToxicityModel(chars, evidence, _logistic(x, y))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score of label 1, toxic).

    Every text is restored and scored whole. Null, empty and wordless texts
    have no evidence and get that score. Without both labels in the sample
    every score is 0.5. Repeated rows get equal scores; an empty table gives
    no rows; extra columns are not read.
    """
    model = fit_toxicity(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.chars) if model else None
        for batch in batches:
            texts, ids = column(batch, "text", pa.string()), column(batch, "doc_id", pa.int64())
            for lo, hi in text_chunks(texts):
                y = model.score(texts.slice(lo, hi - lo), restorer) if model else np.full(hi - lo, 0.5)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(y, pa.float64())], names=["doc_id", "score"])

    return scored(narrow(docs).mapInArrow(lean(run), "doc_id long, score double"), threshold)
