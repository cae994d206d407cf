"""Substring dedup by Rabin-Karp hashes of every fixed-length word window.

A document block is a range of ids. Each block reports its distinct window
hashes, sorted and packed into blobs by hash bucket; a bucket counts in how
many blocks a hash occurs and tells every block after the first which of its
hashes came before. A block then has, for each window, whether an earlier
block holds it (from the bucket) or an earlier document of its own does, and
merges the covered words into maximal removal intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_strings, column, lean, narrow, release, scalar_row, sorted_distinct, split_words, text_chunks

WINDOW = 13
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
_HELD_WINDOWS = 2_000_000
_MAX_CUTS = 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)  # any odd number serves


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; every distinct word is hashed once."""
    coded = words.dictionary_encode()
    distinct = byte_strings(coded.dictionary)
    table = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    return table[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint64)


def window_hashes(hashes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, Rabin-Karp hash) of every window that lies in one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rolled = np.zeros(n, np.uint64)
    for j in range(size):
        rolled *= _BASE
        rolled += hashes[j : j + n]
    inside = np.ones(n, bool)
    for end in starts[1:-1]:
        inside[max(0, end - size + 1) : end] = False
    at = np.flatnonzero(inside)
    return at, rolled[at]


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted distinct 64-bit values as the first and the gaps in as few bytes each as the widest needs."""
    gaps = np.diff(values)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    body = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + values[:1].astype("<u8").tobytes() + body.tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    body = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, blob[0])
    gaps = np.zeros((len(body), 8), np.uint8)
    gaps[:, : blob[0]] = body
    return np.cumsum(np.concatenate([np.frombuffer(blob, "<u8", 1, 1), gaps.view("<u8").ravel()]), dtype=np.uint64)


def _blobs(values: np.ndarray, n_buckets: int) -> Iterator[tuple[int, bytes]]:
    """Sorted distinct values cut by bucket, the high half of a value scaled."""
    bucket = ((values >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
    for lo, hi in zip(first, np.append(first[1:], len(values)), strict=True):
        yield int(bucket[lo]), pack_sorted(values[lo:hi])


def _report(size: int, n_buckets: int):
    """Pass 1: (bucket, block, blob) of the distinct window hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        n_held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for block, parts in held.items():
                rows = list(_blobs(sorted_distinct(np.concatenate(parts)), n_buckets))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows]), pa.array([block] * len(rows)), pa.array([r[1] for r in rows])],
                        names=["bucket", "block", "blob"],
                    )
            held.clear()

        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(batch.schema.get_field_index("doc_id"))))
            texts, blocks = column(batch, "text", pa.string()), column(batch, "block", pa.int64()).to_numpy()
            for lo, hi in text_chunks(texts):
                words, starts = split_words(texts.slice(lo, hi - lo))
                at, rolled = window_hashes(word_hashes(words), starts, size)
                owner = blocks[lo + np.searchsorted(starts, at, side="right") - 1]
                for b in np.unique(owner):
                    held.setdefault(int(b), []).append(sorted_distinct(rolled[owner == b]))
                n_held += len(rolled)
                if n_held > _HELD_WINDOWS:
                    yield from flush()
                    n_held = 0
        yield from flush()

    return run


def _count_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """The hashes that each block shares with an earlier one."""
    rows = rows.sort_values("block", kind="stable")
    parts = [unpack_sorted(b) for b in rows["blob"]]
    values = np.concatenate(parts)
    blocks = np.repeat(rows["block"].to_numpy(), [len(p) for p in parts])
    order = np.argsort(values, kind="stable")  # within a hash, blocks ascend
    values, blocks = values[order], blocks[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    least = np.repeat(blocks[first], np.diff(np.append(first, len(values))))
    later = blocks > least
    values, blocks = values[later], blocks[later]
    out = [(int(b), pack_sorted(sorted_distinct(values[blocks == b]))) for b in np.unique(blocks)]
    return pd.DataFrame(out, columns=["block", "blob"])


def covered_words(n_words: int, at: np.ndarray, size: int) -> np.ndarray:
    """Mask of the words that the windows starting at ``at`` cover."""
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + size, -1)
    return np.cumsum(steps[:-1]) > 0


def _resolve(size: int, digest: bool):
    """Pass 2: one block with the hashes that earlier blocks hold."""

    def run(docs: pa.Table, earlier: pa.Table) -> pa.Table:
        release()  # of the block before
        docs = docs.combine_chunks()
        # Null ids come last and neither remove nor lose words.
        docs = docs.take(pc.sort_indices(docs, [("doc_id", "ascending")], null_placement="at_end"))
        ids = docs["doc_id"].combine_chunks()
        known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
        id_values = ids.fill_null(0).to_numpy()
        texts = docs["text"].combine_chunks().cast(pa.string())
        seen = [unpack_sorted(b) for b in earlier["blob"].to_pylist()]
        seen = np.sort(np.concatenate(seen)) if seen else np.zeros(0, np.uint64)
        n_words, all_at, all_rolled, all_doc = [], [], [], []
        for lo, hi in text_chunks(texts):
            words, starts = split_words(texts.slice(lo, hi - lo))
            at, rolled = window_hashes(word_hashes(words), starts, size)
            row = np.searchsorted(starts, at, side="right") - 1
            n_words.append(np.diff(starts))
            keep = known[lo + row]
            all_at.append((at - starts[row])[keep])
            all_rolled.append(rolled[keep])
            all_doc.append((lo + row)[keep])
        at, rolled, doc = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (all_at, all_rolled, all_doc))
        order = np.argsort(rolled, kind="stable")  # within a hash, ids ascend
        ordered = rolled[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
        least = np.empty(len(order), np.int64)
        least[order] = np.repeat(id_values[doc[order[first]]], np.diff(np.append(first, len(ordered))))
        gone = id_values[doc] > least if len(doc) else np.zeros(0, bool)
        if len(seen):
            k = np.minimum(np.searchsorted(seen, rolled), len(seen) - 1)
            gone |= seen[k] == rolled
        at, doc = at[gone], doc[gone]
        by_doc = np.argsort(doc, kind="stable")
        at, doc = at[by_doc], doc[by_doc]
        ends = np.searchsorted(doc, np.arange(len(ids) + 1))
        counts, removed, kept = np.concatenate([np.zeros(0, np.int64), *n_words]), [], []
        for k, text in enumerate(texts):
            mask = covered_words(counts[k], at[ends[k] : ends[k + 1]], size) if ends[k + 1] > ends[k] else None
            removed.append(0 if mask is None else int(mask.sum()))
            if mask is None and not digest:
                kept.append(text.as_py())
                continue
            own = (text.as_py() or "").encode().split()  # bytes: the same separators
            if mask is not None:
                own = [w for w, gone in zip(own, mask.tolist(), strict=True) if not gone]
            plain = b" ".join(own)
            kept.append(hashlib.sha256(plain).hexdigest() if digest else plain.decode())
        rest = [docs[c] for c in docs.column_names if c not in ("block", "doc_id", "text")]
        names = [c for c in docs.column_names if c not in ("block", "doc_id", "text")]
        return pa.table(
            [ids, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), *rest],
            names=["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "text", *names],
        )

    return run


def _with_blocks(rows: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Adds ``block``: ranges of doc_id of about ``block_bytes`` of text each.

    At most 4,096 cut points are literals; beyond, each range is cut further
    by interpolation. The map never falls as doc_id rises, so an earlier block
    holds smaller ids. Null ids, which take no part, are spread by text.
    """
    seen = scalar_row(
        rows, b=F.sum(F.octet_length("text").cast("long")), lo=F.min("doc_id"), hi=F.max("doc_id")
    )
    total = seen["b"] or 0
    n_blocks = max(1, -(-total // block_bytes))
    n_cuts = min(n_blocks, _MAX_CUTS)
    within = -(-n_blocks // n_cuts)
    spread = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(n_cuts * within))
    if n_cuts == 1 or seen["lo"] is None:
        return rows.withColumn("block", F.lit(0).cast("long")), total
    cuts = rows.agg(F.percentile_approx("doc_id", [k / n_cuts for k in range(1, n_cuts)], 10 * n_cuts)).first()[0]
    edges = sorted({float(seen["lo"]), *map(float, cuts), float(seen["hi"]) + 1.0})
    marked = Bucketizer(
        splits=[-float("inf"), *edges[1:-1], float("inf")], inputCol="_at", outputCol="_cut", handleInvalid="keep"
    ).transform(rows.withColumn("_at", F.coalesce(F.col("doc_id").cast("double"), F.lit(edges[0]))))
    low, high = (F.get(F.lit(x), F.col("_cut").cast("int")) for x in (edges[:-1], edges[1:]))
    inner = F.least(F.lit(within - 1), F.floor((F.col("_at") - low) * within / (high - low)))
    block = F.col("_cut").cast("long") * within + inner.cast("long")
    return marked.withColumn("block", F.when(F.col("doc_id").isNull(), spread).otherwise(block)).drop("_at", "_cut"), total


def _dedup(rows: DataFrame, window: int, block_bytes: int, digest: bool, schema: str) -> DataFrame:
    rows, total = _with_blocks(rows, block_bytes)
    n_buckets = max(1, -(-total // BUCKET_BYTES))
    reports = rows.select("block", "doc_id", "text").mapInArrow(
        lean(_report(window, n_buckets)), "bucket long, block long, blob binary"
    )
    earlier = reports.groupBy("bucket").applyInPandas(
        lambda pdf: _count_bucket(pdf), "block long, blob binary"
    )
    return rows.groupBy("block").cogroup(earlier.groupBy("block")).applyInArrow(_resolve(window, digest), schema)


def substring_digests(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    A word goes if a window over it, judged on the input, also starts in a
    document with a smaller doc_id. Null and empty texts have no words.
    Documents with one doc_id do not remove each other's words; those with a
    null doc_id neither remove nor lose any. An empty table gives no rows;
    extra columns are not read. Windows are compared by 64-bit hashes.
    """
    return _dedup(
        narrow(docs, id_col, text_col), window, block_bytes, True,
        "doc_id long, n_words long, n_removed long, kept_sha256 string",
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with repeated windows cut out of ``text``, all columns kept.

    A text that loses words becomes its kept words joined by one space;
    ``n_chars``, where present, follows. Other texts stay as they are.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("none")]).alias("rest"),
    )
    kind = packed.schema["rest"].dataType.simpleString()
    out = _dedup(packed, window, block_bytes, False, f"doc_id long, n_words long, n_removed long, text string, rest {kind}")
    names = {c: F.col("rest").getField(c) for c in rest}
    if "n_chars" in names:
        names["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(names["n_chars"])
    return out.select(
        *[F.col(c) if c in ("doc_id", "text") else names[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns]
    )
