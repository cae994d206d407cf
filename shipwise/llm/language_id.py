"""Language ID by prediction by partial matching (PPM).

Per language a byte context tree of orders 0 to ``ORDER`` is counted over all
training texts. A symbol is coded in its longest context of the tree; where it
is not a child there, an escape leads to the next shorter context, without the
symbols already ruled out. Escape probabilities follow method C: with n
occurrences and d distinct symbols, d / (n + d). Below order 0 all remaining
byte values are equally likely. The statistics stay frozen while texts are
scored, so the code length of a symbol depends on its last ``ORDER + 1`` symbols
alone: each distinct gram is worked out once and kept in a table.

Texts are coded as bytes in lower case, with runs of ASCII characters other than
letters as one blank; each text starts in an empty context.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, lean, narrow, sorted_distinct, store, text_chunks
from .labels import fold

ORDER = 4
# Nodes of one order over all languages: bounds the model (12 bytes a node).
MAX_NODES = 1 << 20
UNDETERMINED = "und"
SLICE_BYTES = 1 << 21
_TABLE_BITS = 20
_HELD_GRAMS = 1 << 21
_MIX = np.uint64(0x9E3779B97F4A7C15)

# Bytes to symbols: letters in lower case, other ASCII a blank, the rest as is.
# 0xFF occurs in no UTF-8 text and becomes 0, which stands before a text's start.
PAD, BLANK = 0, 32
_SYMBOL = np.arange(256, dtype=np.uint8)
_SYMBOL[:128] = BLANK
_SYMBOL[97:123] = np.arange(97, 123)
_SYMBOL[65:91] = np.arange(97, 123)
_SYMBOL[255] = PAD


# ---------------------------------------------------------------- grams


def grams(data: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram of each kept byte, kept symbols after ``before``, positions of the kept bytes).

    A gram holds a symbol in its lowest byte and the ORDER symbols before it
    above. ``before`` are the ORDER symbols that come before ``data``.
    """
    symbols = _SYMBOL[data]
    blank = symbols == BLANK
    again = blank.copy()
    again[1:] &= blank[:-1]
    if len(again):
        again[0] &= before[-1] == BLANK
    at = np.flatnonzero(~again)
    joined = np.concatenate([before, symbols[at]])
    out = joined[ORDER:].astype(np.uint64)
    for k in range(1, ORDER + 1):
        out |= joined[ORDER - k : len(joined) - k].astype(np.uint64) << np.uint64(8 * k)
    return out, joined, at


def text_grams(texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, row of each) of texts in slices of bounded size; a long text goes on in the next slice."""
    raw = texts.fill_null("").cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] is not None else np.zeros(0, np.uint8)
    start = np.full(ORDER, PAD, np.uint8)
    for lo, hi in text_chunks(texts, slice_bytes):
        a, b = ends[lo], ends[hi]
        if b - a > slice_bytes:
            for k in range(lo, hi):
                before = start
                for at in range(ends[k], ends[k + 1], slice_bytes):
                    own, joined, _ = grams(data[at : min(ends[k + 1], at + slice_bytes)], before)
                    before = joined[-ORDER:]
                    yield own, np.full(len(own), k)
            continue
        sizes = np.diff(ends[lo : hi + 1])
        # every text after a gap of ORDER pads
        spaced = np.full(b - a + ORDER * (hi - lo), 255, np.uint8)
        spaced[np.arange(b - a) + np.repeat(ORDER * np.arange(1, hi - lo + 1), sizes)] = data[a:b]
        own, joined, at = grams(spaced, start)
        real = joined[ORDER:] != PAD
        row = np.repeat(np.arange(lo, hi), sizes + ORDER)
        yield own[real], row[at[real]]


def counted(values: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often each occurs."""
    if times is None:
        values = np.sort(values)
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
        return values[first], np.diff(np.append(first, len(values)))
    order = np.argsort(values, kind="stable")
    values, times = values[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(times, first) if len(first) else times[:0]


# ---------------------------------------------------------------- model


@dataclass
class ContextTree:
    """One language: per order k the grams of k + 1 symbols in order, and their counts."""

    keys: list[np.ndarray]
    counts: list[np.ndarray]

    def __post_init__(self):
        self.contexts, self.n, self.d, self.ruled_out = [], [], [], []
        for k, (keys, counts) in enumerate(zip(self.keys, self.counts, strict=True)):
            context, first = np.unique(keys >> np.uint64(8), return_index=True)
            self.contexts.append(context)
            self.n.append(np.add.reduceat(counts, first).astype(float) if len(first) else np.zeros(0))
            self.d.append(np.diff(np.append(first, len(keys))).astype(float))
            # what the context's own symbols weigh in the next shorter context
            if k:
                shorter = np.uint64((1 << (8 * k)) - 1)
                weight = self._count(k - 1, keys & shorter)[1]
                self.ruled_out.append(np.add.reduceat(weight, first).astype(float) if len(first) else np.zeros(0))

    def _count(self, k: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = self.keys[k], self.counts[k]
        if not len(keys):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = keys[at] == wanted
        return found, np.where(found, counts[at], 0).astype(float)

    def _context(self, k: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        contexts = self.contexts[k]
        if not len(contexts):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(contexts, wanted), len(contexts) - 1)
        return contexts[at] == wanted, at

    def code_lengths(self, wanted: np.ndarray) -> np.ndarray:
        """Nats of each gram's last symbol after the symbols before it."""
        out = np.zeros(len(wanted))
        left = np.arange(len(wanted))  # grams whose symbol isn't coded yet
        out_n, out_d = np.zeros(len(wanted)), np.zeros(len(wanted))  # weight and number of symbols ruled out
        for k in reversed(range(len(self.keys))):
            gram = wanted[left] & np.uint64((1 << (8 * (k + 1))) - 1)
            known, at = self._context(k, gram >> np.uint64(8))
            hit, count = self._count(k, gram)
            n = np.where(known, self.n[k][at] if len(self.n[k]) else 0, 0) - out_n[left]
            d = np.where(known, self.d[k][at] if len(self.d[k]) else 0, 0) - out_d[left]
            some = known & (d > 0)  # a context with no symbol left is passed at no cost
            p = np.where(hit, count, d) / np.where(some, n + d, 1)
            out[left[some]] -= np.log(p[some])
            # the next shorter context rules out this one's symbols
            out_n[left] = np.where(known, self.ruled_out[k - 1][at] if k and len(self.ruled_out[k - 1]) else 0, 0)
            out_d[left] = np.where(known, self.d[k][at] if len(self.d[k]) else 0, 0)
            left = left[~hit]
        out[left] += np.log(256 - out_d[left])
        return out


class Scorer:
    """Code lengths per language (columns) of grams; a table of fixed size holds those seen last."""

    def __init__(self, trees: list[ContextTree]):
        self.trees = trees
        self.held = np.zeros(1 << _TABLE_BITS, np.uint64)  # 0 is no gram: its symbol would be a pad
        self.bits = np.zeros((1 << _TABLE_BITS, len(trees)))

    def lengths(self, wanted: np.ndarray) -> np.ndarray:
        slot = ((wanted * _MIX) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        miss = np.flatnonzero(self.held[slot] != wanted)
        out = self.bits[slot]
        if len(miss):
            distinct = sorted_distinct(wanted[miss])
            found = np.stack([t.code_lengths(distinct) for t in self.trees], 1)
            out[miss] = found[np.searchsorted(distinct, wanted[miss])]
            at = ((distinct * _MIX) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
            # of grams that share a slot the last one stays, with its own lengths
            at, last = np.unique(at[::-1], return_index=True)
            last = len(distinct) - 1 - last
            self.held[at], self.bits[at] = distinct[last], found[last]
        return out

    def totals(self, texts: pa.Array) -> np.ndarray:
        """Nats of every text (rows) in every language (columns)."""
        out = np.zeros((len(texts), len(self.trees)))
        for own, row in text_grams(texts, max(1 << 14, SLICE_BYTES // max(1, len(self.trees) // 4))):
            if len(own):
                first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                out[row[first]] += np.add.reduceat(self.lengths(own), first, axis=0)
        return out


# ---------------------------------------------------------------- Spark


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's texts, added up while they fit in memory."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(parts):
        return counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))

    def give():
        for lang, parts in held.items():
            keys, times = merged(parts)
            for lo in range(0, len(keys), 1 << 17):
                own = keys[lo : lo + (1 << 17)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array(own.astype(np.int64)), pa.array(times[lo : lo + (1 << 17)])],
                    names=["lang", "gram", "n"],
                )

    for batch in batches:
        texts, langs = column(batch, "text", pa.string()), column(batch, "lang", pa.string()).dictionary_encode()
        code = langs.indices.to_numpy(zero_copy_only=False)
        for own, row in text_grams(texts):
            lang_of = code[row]
            for k in sorted_distinct(lang_of):
                found = counted(own[lang_of == k])
                held.setdefault(langs.dictionary[int(k)].as_py(), []).append(found)
                size += len(found[0])
            if size > _HELD_GRAMS:
                held = {lang: [merged(parts)] for lang, parts in held.items()}
                size = sum(len(p[0][0]) for p in held.values())
                if size > _HELD_GRAMS:
                    yield from give()
                    held, size = {}, 0
    yield from give()


def _thresholds(counts: DataFrame, share: int) -> dict[str, int]:
    """Per language the least power of two as a count at which ``share`` grams at most remain."""
    powers = [F.count_if(F.col("n") >= (1 << k)).alias(f"k{k}") for k in range(62)]
    rows = counts.groupBy("lang").agg(*powers).collect()  # bounded: one row a language
    return {r["lang"]: next((1 << k for k in range(62) if r[f"k{k}"] <= share), 1 << 62) for r in rows}


def fit_context_trees(docs: DataFrame, max_nodes: int = MAX_NODES, order: int = ORDER) -> dict[str, ContextTree]:
    """Context tree of each language of ``docs`` (text, lang), counted over all its rows.

    Grams of ``order + 1`` symbols are counted; shorter ones follow by adding up.
    A node stays if its count reaches a power of two chosen so that no order
    holds over ``max_nodes`` nodes in all languages together; deeper orders ask
    for no less than shallower ones, so that every node's suffix is a node too.
    """
    counted_rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    level = (
        counted_rows.mapInArrow(lean(_count_grams), "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    levels = [store(level, "grams")]
    for k in reversed(range(order)):
        gram = F.col("gram").bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1)).alias("gram")
        levels.append(store(levels[-1].groupBy("lang", gram).agg(F.sum("n").alias("n")), "grams"))
    languages = sorted(r["lang"] for r in levels[-1].select("lang").distinct().collect())  # order 0: one byte values
    share = max_nodes // max(1, len(languages))
    keys: dict[str, list] = {lang: [] for lang in languages}
    least: dict[str, int] = {}
    for counts in reversed(levels):
        least = {lang: max(t, least.get(lang, 1)) for lang, t in _thresholds(counts, share).items()}
        enough = F.col("n") >= F.lit(1 << 62)
        for lang, t in least.items():
            enough = enough | ((F.col("lang") == lang) & (F.col("n") >= t))
        got = counts.filter(enough).toArrow()  # bounded: max_nodes rows
        codes = got.column("lang").combine_chunks().dictionary_encode()
        lang_of, names = codes.indices.to_numpy(), codes.dictionary.to_pylist()
        gram, n = got.column("gram").to_numpy().astype(np.uint64), got.column("n").to_numpy()
        for lang in languages:
            mine = np.flatnonzero(lang_of == names.index(lang)) if lang in names else np.zeros(0, np.int64)
            mine = mine[np.argsort(gram[mine])]
            keys[lang].append((gram[mine], n[mine]))
    return {lang: ContextTree([k for k, _ in own], [c for _, c in own]) for lang, own in keys.items()}


def _predict(languages: list[str], trees: list[ContextTree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(trees)
        for batch in batches:
            texts = column(batch, "text", pa.string())
            none, total = texts.is_null().to_numpy(zero_copy_only=False), scorer.totals(texts)
            best = total.argmin(1)
            gap = total - total[np.arange(len(total)), best][:, None]
            score = np.where(none, 0.0, 1 / np.exp(-gap).sum(1))
            names = [UNDETERMINED if no else languages[k] for k, no in zip(best, none, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id", pa.int64()), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "lang_pred", "score"],
            )

    return run


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def language_ids(docs: DataFrame, max_nodes: int = MAX_NODES) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Context trees are learned from text and lang of the rows outside the
    held-out fold whose lang is not null; a null doc_id is outside any fold and
    teaches nothing. Every text is coded whole in each language and gets the one
    of the least code length, ties the smallest name; the score is its share of
    the probabilities of all languages. Texts that are null or hold no letter,
    and all texts where no language was learned, are ``und`` with score 0.
    Repeated rows get equal results and each count as training rows. An empty
    table gives no rows; other columns are not read.
    """
    rows = narrow(docs)
    lang = docs.select(
        F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").cast("string").alias("text"),
        F.col("`lang`").cast("string").alias("lang"),
    )
    trees = fit_context_trees(lang.filter(fold(F.col("doc_id")) != 0).select("text", "lang"), max_nodes)
    held_out = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    if not trees:
        return rows.select("doc_id", held_out, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    lettered = has_letter(F.col("text"))
    # texts without a letter go through as nulls
    found = rows.select("doc_id", F.when(lettered, F.col("text")).alias("text")).mapInArrow(
        lean(_predict(sorted(trees), [trees[x] for x in sorted(trees)])), "doc_id long, lang_pred string, score double"
    )
    return found.select("doc_id", held_out, "lang_pred", "score")
