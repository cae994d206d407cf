"""SentencePiece encoding and decoding by shared-prefix Viterbi.

The text is normalised and marked by the model; a marked word is a run of word
marks with the characters up to the next mark. No piece crosses such a
boundary (checked when the model is read), so the best path of a text is the
best paths of its words in a row. The distinct words of a batch are sorted,
which walks their trie depth-first: each word keeps the forward scores of the
prefix it shares with the word before and scores only its new characters.

The best path has the greatest sum of the model's piece scores, as in the
library's unigram mode; ties go to the path whose last piece is longest.
A character without a piece scores as the library's unknown does and becomes
its byte pieces, or the unknown id in a model without them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_strings, column, lean, narrow, text_chunks
from .piece_table import PieceTable

MARK = "▁"
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_ODD = f"{MARK}{MARK}|{MARK}$|^[^{MARK}]"


class PieceModel:
    """The pieces of one model file with encoding and decoding."""

    def __init__(self, path: str, cache_size: int = 700_000):
        from sentencepiece import SentencePieceProcessor

        self.sp = SentencePieceProcessor(model_file=path)
        sp, n = self.sp, self.sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = {int(self.pieces[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.score = {self.pieces[i]: (sp.get_score(i), i) for i in range(n) if i not in special}
        if any(MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError("a piece crosses words")
        self.unknown = min((s for s, _ in self.score.values()), default=0.0) - 10.0
        # Every ending of a piece: a longer string can't be a piece once its ending isn't here.
        self.endings = {p[k:] for p in self.score for k in range(len(p))}
        self.table = PieceTable(cache_size)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of distinct marked words, in the order given."""
        order = sorted(range(len(words)), key=words.__getitem__)
        score, endings, unknown = self.score, self.endings, self.unknown
        found: list[list[int]] = [[]] * len(words)
        best, back, before = [0.0], [0], ""  # by characters from the word's start
        for k in order:
            word = words[k]
            shared, top = 0, min(len(word), len(before))
            while shared < top and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1 :], back[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                top_score, top_start = best[end - 1] + unknown, end - 1
                for start in range(end - 1, -1, -1):
                    piece = word[start:end]
                    if piece not in endings:
                        break
                    known = score.get(piece)
                    if known is not None and best[start] + known[0] >= top_score:
                        top_score, top_start = best[start] + known[0], start
                best.append(top_score)
                back.append(top_start)
            before = word
            ids, end = [], len(word)
            while end:
                start = back[end]
                known = score.get(word[start:end])
                ids += [known[1]] if known else self._unknown_ids(word[start:end])[::-1]
                end = start
            found[k] = ids[::-1]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.uint32, int(lengths.sum())), lengths

    def _unknown_ids(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.sp.unk_id()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts; a null text is empty."""
        marked = pa.array([self.sp.normalize(t) for t in texts.fill_null("").to_pylist()], pa.string())
        n = len(marked)
        odd = pc.match_substring_regex(marked, _ODD).to_numpy(zero_copy_only=False)
        # A plain text is a mark before every word; its first part is empty.
        plain = marked.filter(pa.array(~odd))
        parts = pc.split_pattern(plain, MARK)
        counts = np.zeros(n, np.int64)
        counts[~odd] = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        words = parts.flatten()
        heads = np.cumsum(counts[~odd]) - counts[~odd]
        coded = words.dictionary_encode()
        mark = MARK.encode()
        pieces = [mark + p for p in byte_strings(coded.dictionary)]
        used = np.zeros(len(pieces), bool)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        inner = np.ones(len(codes), bool)
        inner[heads] = False
        used[codes[inner]] = True
        at = self.table.rows_of(pieces, self.encode_words, used)[codes][inner]
        counts[~odd] = np.maximum(counts[~odd] - 1, 0)
        if odd.any():
            rest = [_WORD.findall(t) for t in marked.filter(pa.array(odd)).to_pylist()]
            counts[odd] = [len(w) for w in rest]
            distinct = sorted({w for ws in rest for w in ws})
            kept = len(self.table.starts), len(self.table.ids)
            first = self.table.append(*self.encode_words(distinct))
            row = {w: first + k for k, w in enumerate(distinct)}
            mask = np.repeat(odd, counts)
            both = np.empty(len(mask), np.int64)
            both[~mask], both[mask] = at, [row[w] for ws in rest for w in ws]
            ids, size = self.table.gather(both)
            self.table.cut(*kept)
        else:
            ids, size = self.table.gather(at)
        word_ends = np.concatenate([[0], np.cumsum(size)])
        return ids, word_ends[np.concatenate([[0], np.cumsum(counts)])]


class PieceDecoder:
    """The bytes of every id of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.raw = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.raw.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                self.raw.append(b"" if sp.is_control(i) else piece.replace(MARK, " ").encode())

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, marks as spaces, without the mark put before a text."""
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model per Python worker and file."""
    return PieceModel(path)


@lru_cache(maxsize=2)
def piece_decoder(path: str) -> PieceDecoder:
    return PieceDecoder(path)


def _encode_partition(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            docs, texts = column(batch, "doc_id", pa.int64()), column(batch, "text", pa.string())
            for lo, hi in text_chunks(texts, 2 << 20):
                ids, offsets = model.encode(texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [docs.slice(lo, hi - lo), pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(ids.astype(np.int32)))],
                    names=["doc_id", "ids"],
                )

    return run


def _decode_partition(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_decoder(path)
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index("ids"))
            for lo in range(0, batch.num_rows, 1000):
                part = rows.slice(lo, 1000)
                flat, ends = part.flatten().to_numpy(), np.cumsum(pc.list_value_length(part).fill_null(0).to_numpy())
                own = np.split(flat, ends[:-1])
                texts = [model.decode(i) for i in own]
                plain = [np.ascontiguousarray(i, "<u4") for i in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        column(batch, "doc_id", pa.int64()).slice(lo, 1000),
                        pa.array([len(i) for i in own], pa.int64()),
                        pa.array([zlib.crc32(i) for i in plain], pa.int64()),
                        pa.array(texts, pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_crc32", "text"],
                )

    return run


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) per document.

    Null and empty texts have no ids. Texts of any length are encoded whole.
    Repeated rows and null ids are encoded row by row; an empty table gives no
    rows; extra columns are not read.
    """
    return narrow(docs, id_col, text_col).mapInArrow(lean(_encode_partition(model_path)), "doc_id long, ids array<int>")


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, text) of rows (doc_id, ids); null ids are none."""
    return encoded.select("doc_id", "ids").mapInArrow(
        lean(_decode_partition(model_path)), "doc_id long, n_tokens long, ids_crc32 long, text string"
    )


def piece_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Encode, decode, and digest: doc_id, n_tokens, ids_crc32, decoded_crc32 (of UTF-8), decoded_chars."""
    return decode_pieces(encode_pieces(docs, model_path), model_path).select(
        "doc_id", "n_tokens", "ids_crc32", F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"),
        F.length("text").cast("long").alias("decoded_chars"),
    )
