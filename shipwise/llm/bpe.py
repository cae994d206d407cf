"""Token ids of whole texts by the tokenizers library, for use inside tasks.

A byte-level BPE file without a normalizer splits a text before every single
space that a visible character follows, so such texts are cut there, each
distinct piece is encoded once, and ids are gathered by position. Texts with
other spacing, or with an added token's string, go to the library whole.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import byte_strings
from .piece_table import PieceTable

# A space before white space of any kind, or at the end of a text.
_LOOSE_SPACE = r" ([\s\x0B\x1C-\x1F\x{85}\p{Z}]|$)"


class BpeEncoder:
    """Encodes text arrays; a bounded table keeps the ids of pieces between calls."""

    def __init__(self, path: str, cache_size: int = 1_400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.by_piece = plain and spec.get("normalizer") is None and not spec["model"].get("dropout")
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.table = PieceTable(cache_size)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter((i for r in rows for i in r), np.uint32, int(lengths.sum()))
        return flat, lengths

    def _joined(self, pieces: list[str], per_text: int = 2000) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each piece after a space, encoded as texts of many pieces."""
        flat, lengths = [], []
        groups = [pieces[k : k + per_text] for k in range(0, len(pieces), per_text)]
        for group, e in zip(groups, self.tokenizer.encode_batch(["".join(" " + p for p in g) for g in groups], add_special_tokens=False), strict=True):
            sizes = np.fromiter(map(len, group), np.int64, len(group)) + 1
            at = np.fromiter((o[0] for o in e.offsets), np.int64, len(e))
            owner = np.searchsorted(np.cumsum(sizes) - sizes, at, side="right") - 1
            flat.append(np.array(e.ids, np.uint32))
            lengths.append(np.bincount(owner, minlength=len(group)))
        return np.concatenate(flat), np.concatenate(lengths)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of text i are ``ids[offsets[i]:offsets[i + 1]]``; null is empty."""
        texts = texts.fill_null("")
        n = len(texts)
        whole = np.zeros(n, bool)
        if self.by_piece:
            odd = pc.match_substring_regex(texts, _LOOSE_SPACE)
            for token in self.added:
                odd = pc.or_(odd, pc.match_substring(texts, token))
            whole = odd.to_numpy(zero_copy_only=False)
        else:
            whole[:] = True
        rest = texts.filter(pa.array(~whole))
        ids, lengths = self._by_piece(rest)
        if not whole.any():
            return ids, np.concatenate([[0], np.cumsum(lengths)])
        flat, odd_lengths = self._whole(texts.filter(pa.array(whole)).to_pylist())
        sizes = np.empty(n, np.int64)
        sizes[~whole], sizes[whole] = lengths, odd_lengths
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(offsets[-1], np.uint32)
        mask = np.repeat(whole, sizes)
        out[~mask], out[mask] = ids, flat
        return out, offsets

    def _by_piece(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        parts = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        heads = np.cumsum(counts) - counts
        coded = parts.flatten().dictionary_encode()
        pieces = byte_strings(coded.dictionary)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        inner = np.ones(len(codes), bool)
        inner[heads] = False
        used = np.zeros(len(pieces), bool)
        used[codes[inner]] = True
        at = self.table.rows_of(pieces, self._joined, used)[codes]
        kept = len(self.table.starts), len(self.table.ids)
        # The first piece of a text has no space before it.
        own, inverse = np.unique(codes[heads], return_inverse=True)
        at[heads] = self.table.append(*self._whole([pieces[i].decode() for i in own])) + inverse
        out, size = self.table.gather(at)
        self.table.cut(*kept)
        return out, np.add.reduceat(size, heads)


@lru_cache(maxsize=2)
def encoder(path: str) -> BpeEncoder:
    """One encoder per Python worker and file."""
    return BpeEncoder(path)
