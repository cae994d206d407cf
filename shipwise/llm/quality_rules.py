"""Quality rules: a threshold table compiled into one projection.

Every metric is a native column expression over the whole text; the threshold
rows become one boolean each and their conjunction is the verdict.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, let

REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"

# Frequent function words of the languages of the corpus (a parameter).
STOP_WORDS = {
    "en": "the of and to in a is that it for on with as was by at be this are from or an have not",
    "fr": "le la les de des du un une et est en que qui dans pour pas sur au ce il elle on ou",
    "de": "der die das und ist von zu mit den dem im nicht ein eine auf als für sich des es in",
    "es": "el la los las de y que en un una es se por con para no su lo del al como o",
}


@dataclass(frozen=True)
class Rule:
    """Keep a document only if ``low <= metric <= high`` (an absent bound is open)."""

    metric: str
    low: float | None = None
    high: float | None = None


THRESHOLDS: tuple[Rule, ...] = (
    Rule("n_words", 20, None),
    Rule("mean_word_chars", 1.5, 20.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_ratio", 0.04, None),
    Rule("dup_line_ratio", None, 0.5),
    Rule("repeat_ratio", None, 0.30),
)


def _covered_words(hashes: Column) -> Column:
    """Words covered by the 8-word windows whose hash is in the text at least twice."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        n = F.size(s)
        same = F.filter(
            s,
            lambda e, k: ((k > 0) & (e["h"] == F.get(s, k - 1)["h"]))
            | ((k < n - 1) & (e["h"] == F.get(s, k + 1)["h"])),
        )
        return F.sort_array(F.transform(same, lambda e: e["i"]))

    def length(at: Column) -> Column:
        steps = F.transform(
            at, lambda p, k: F.least(F.lit(REPEAT_WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(REPEAT_WINDOW)))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(let(ordered, repeated), length)


def _repeat_words(words: Column) -> Column:
    def windows(w: Column) -> Column:
        return F.when(
            F.size(w) >= REPEAT_WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - REPEAT_WINDOW),
                lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(REPEAT_WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    # Each word is hashed once; a window is the hash of its eight word hashes.
    hashed = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return let(
        hashed,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered_words(h)),
    )


def quality_metrics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (all of ``docs`` by default) plus one struct ``quality``.

    The struct holds n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and the ratios the rules use. A null text is an empty one.
    """
    kept = [f"`{c}`" for c in (docs.columns if keep is None else keep)]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws.split()})
    full_line = F.filter(F.split(text, "\n"), lambda s: F.length(F.translate(s, _SPACES, "")) > 0)

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(text, _SPACES, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(full_line, lambda s: (F.size(s) - F.size(F.array_distinct(s))).cast("long")).alias("n_dup_lines"),
            let(full_line, lambda s: F.size(s).cast("long")).alias("n_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(stop))).cast("long").alias("n_stop"),
        )

    words = F.filter(F.split(text, SPACE_CLASS), lambda w: w != "")
    base = docs.select(*kept, let(words, counts).alias("quality"))
    q = F.col("quality")
    n = F.greatest(q["n_words"], F.lit(1))
    return base.withColumn(
        "quality",
        F.struct(
            *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            (q["word_chars"] / n).alias("mean_word_chars"),
            (q["n_symbols"] / n).alias("symbol_ratio"),
            (q["n_stop"] / n).alias("stop_ratio"),
            (q["n_dup_lines"] / F.greatest(q["n_lines"], F.lit(1))).alias("dup_line_ratio"),
            (q["n_repeat_words"] / n).alias("repeat_ratio"),
        ),
    )


def compile_rules(rules: tuple[Rule, ...] = THRESHOLDS, metrics: str = "quality") -> Column:
    """The conjunction of all threshold rows as one column."""
    verdict = F.lit(True)
    for r in rules:
        value = F.col(metrics)[r.metric]
        if r.low is not None:
            verdict = verdict & (value >= F.lit(r.low))
        if r.high is not None:
            verdict = verdict & (value <= F.lit(r.high))
    return verdict


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = THRESHOLDS
) -> DataFrame:
    """One row per document: the counts, ``base_failed`` and ``kept``.

    ``base_failed`` is fewer than 20 words, or more than 30 % of the words in
    repeated 8-word windows. Null and empty texts have zero counts and fail.
    Repeated rows are judged one by one; an empty table gives no rows.
    Windows are compared by 64-bit hashes within one text.
    """
    q = F.col("quality")
    base = (q["n_words"] < 20) | (F.lit(100) * q["n_repeat_words"] > F.lit(30) * q["n_words"])
    one = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return quality_metrics(one, "text", keep=["doc_id"]).select(
        "doc_id",
        *[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base.alias("base_failed"),
        (~base & compile_rules(rules)).alias("kept"),
    )


def keep_quality(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns only.

    Null, empty and wordless texts go. Ids aren't looked at, so rows with null
    ids and repeated rows are judged each; an empty table gives no rows.
    """
    judged = quality_metrics(docs.select(F.struct("*").alias("row")).select("row", F.col(f"row.`{text_col}`").alias("text")), "text", keep=["row"])
    q = F.col("quality")
    base = (q["n_words"] < 20) | (F.lit(100) * q["n_repeat_words"] > F.lit(30) * q["n_words"])
    return judged.filter(~base & compile_rules(rules)).select("row.*")
