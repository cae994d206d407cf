from __future__ import annotations

import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shipwise.llm.bpe import BpeEncoder
from shipwise.llm.common import work_path
from shipwise.llm.packing import OpenWindows, pack
from shipwise.llm.token_files import FrameReader, filesystem, read_token_files, token_round_trip, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


@lru_cache(maxsize=None)
def ids_of(text, end):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_library_on_loose_spacing():
    texts = [None, "", " ", " a", "a ", "a  b", "a\n b", "a \n b", "\n\n a\t b", "<|endoftext|> hi", "don't  we'll 12 3!!",
             "　 x  y", "café 日本 語 \U0001f642 é", "\nfoo bar \nfoo bar", "foo bar foo, bar."]
    bpe = BpeEncoder(PATH, cache_size=3)
    for _ in range(3):
        ids, offsets = bpe.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [ids_of(t, 0)[:-1] for t in texts]


@pytest.mark.parametrize("n_open", [1, 3, 128])
def test_pieces_cover_every_document_once(edge_docs, edge_rows, n_open):
    got = pack(edge_docs, PATH, size=64, n_open=n_open).collect()
    by_doc = Counter()
    for r in got:
        by_doc[r.doc_id, r.doc_tokens] += r.length
    want = Counter()
    for d, t, *_ in edge_rows:
        n = len(ids_of(t, 0))
        want[d, n] += n
    assert by_doc == want
    texts = {d: t for d, t, *_ in edge_rows if d is not None}
    for r in got:
        if r.doc_id is not None:
            assert r.ids_crc32 == crc(ids_of(texts[r.doc_id], 0)[r.start : r.start + r.length])
    sequences: dict[int, list] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64


def test_best_fit_and_fullest_emitted():
    w = OpenWindows(10, 2)
    assert [w.place(n) for n in (6, 3, 4, 7, 10, 8)] == [(0, 0), (0, 6), (1, 0), (2, 0), (3, 0), (4, 0)]
    # Window 0 (9 used) went out for window 2, window 2 (7 used) went before window 1 (4 used).
    assert [f[1] for f in w.free] == [4, 1]


def test_round_trip_in_id_order(edge_docs, edge_rows):
    got = token_round_trip(edge_docs, PATH, end_id=2).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (d, len(ids_of(t, 2)), crc(ids_of(t, 2))) for d, t, *_ in edge_rows
    )
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == list(np.cumsum([0, *(r.n_tokens for r in ordered)][:-1]))
    known = [r.doc_id for r in ordered if r.doc_id is not None]
    assert known == sorted(known)


def test_wanted_documents_and_checksums(spark, edge_docs, edge_rows):
    folder = work_path(spark, "token-files")
    manifest = write_token_files(edge_docs, folder, PATH, bytes_per_file=100_000)
    got = read_token_files(spark, manifest, folder, wanted=[7, 10, 999]).collect()
    texts = {d: t for d, t, *_ in edge_rows}
    assert {r.doc_id: r.ids for r in got} == {d: ids_of(texts[d], 2) for d in (7, 10)}
    files = filesystem(folder)[0]
    path = max((r for r in manifest.collect()), key=lambda r: r.n_docs).path
    with files.open_input_file(path) as f:
        data = bytearray(f.read())
    data[len(data) // 3] ^= 1

    class Source:
        def size(self):
            return len(data)

        def read_at(self, n, at):
            return bytes(data[at : at + n])

    with pytest.raises(Exception):  # noqa: B017
        list(FrameReader(Source()).documents())


def test_empty_tables(no_docs):
    assert pack(no_docs, PATH).count() == 0
    assert token_round_trip(no_docs, PATH).count() == 0
