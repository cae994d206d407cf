"""Token-id files of independent zstandard frames with a trailing seek table.

Layout of a file (the public seekable format over zstandard frames):

- one or more frames per document, each at most ``FRAME_TOKENS`` ids, ids as
  little-endian unsigned integers of 2 or 4 bytes, with a content checksum;
- a skippable frame, the index: count of documents, id width, then the arrays
  doc_id (int64), known (uint8, 0 for a null id) and n_tokens (int64);
- a skippable frame, the seek table: per frame its stored size, its size and
  the low 32 bits of the XXH64 of its content, then the footer.

A reader takes the tail, the index and then only the frames it wants.
Files are written under names of their own by each task attempt; the manifest
table, written by Spark, lists those of the attempts that counted.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .common import column, lean, narrow, scalar_row, store, text_chunks, work_path

FRAME_TOKENS = 1 << 20
BYTES_PER_FILE = 32 << 20
# Fixed values of the seekable format.
SKIPPABLE_INDEX, SKIPPABLE_TABLE, TABLE_MAGIC, CHECKSUM_FLAG = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80
_MANIFEST = "part long, path string, n_docs long, n_tokens long"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder URI (``file:/x``, ``s3://...``, plain paths)."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


class FrameWriter:
    """Appends documents to one file."""

    def __init__(self, sink, width: int, level: int = 1):
        self.sink, self.width = sink, width
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.table: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.n_tokens: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        for k in range(0, max(len(ids), 1), FRAME_TOKENS):
            data = ids[k : k + FRAME_TOKENS].astype(f"<u{self.width}").tobytes()
            frame = self.zstd.compress(data)
            self.sink.write(frame)
            self.table.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.doc_ids.append(doc_id)
        self.n_tokens.append(len(ids))

    def finish(self) -> None:
        index = (
            struct.pack("<QQ", len(self.doc_ids), self.width)
            + np.array([d or 0 for d in self.doc_ids], "<i8").tobytes()
            + np.array([d is not None for d in self.doc_ids], "u1").tobytes()
            + np.array(self.n_tokens, "<i8").tobytes()
        )
        frame = struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index
        self.sink.write(frame)
        entries = np.array([*self.table, (len(frame), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)], "<u4").tobytes()
        footer = struct.pack("<IBI", len(self.table) + 1, CHECKSUM_FLAG, TABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_TABLE, len(entries) + len(footer)) + entries + footer)


class FrameReader:
    """Random access to one file: ``source`` has read_at(n, offset) and size()."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        frames, flag, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
        if magic != TABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("not a file of this format")
        table = np.frombuffer(source.read_at(12 * frames, end - 9 - 12 * frames), "<u4").reshape(-1, 3)
        self.table = table[:-1].astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        index = source.read_at(int(table[-1, 0]), int(self.at[-1]))
        n, self.width = struct.unpack_from("<QQ", index, 8)
        self.doc_ids = np.frombuffer(index, "<i8", n, 24)
        self.known = np.frombuffer(index, "u1", n, 24 + 8 * n).astype(bool)
        self.n_tokens = np.frombuffer(index, "<i8", n, 24 + 9 * n)
        frames_of = np.maximum(1, -(-self.n_tokens // FRAME_TOKENS))
        self.first = np.concatenate([[0], np.cumsum(frames_of)])
        self.zstd = zstandard.ZstdDecompressor()

    def _ids(self, block: bytes, base: int, k: int) -> np.ndarray:
        out = []
        for f in range(self.first[k], self.first[k + 1]):
            lo = int(self.at[f]) - base
            data = self.zstd.decompress(block[lo : lo + int(self.table[f, 0])])
            if len(data) != self.table[f, 1] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table[f, 2]:
                raise ValueError(f"frame {f} fails its checksum")
            out.append(np.frombuffer(data, f"<u{self.width}"))
        return out[0] if len(out) == 1 else np.concatenate(out)

    def documents(self, wanted: Iterable[int] | None = None, block_bytes: int = 4 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of the rows whose id is wanted, or of all; nearby frames share a read."""
        rows = np.arange(len(self.doc_ids))
        if wanted is not None:
            rows = rows[self.known & np.isin(self.doc_ids, np.fromiter(wanted, np.int64))]
        i = 0
        while i < len(rows):
            j, base = i, int(self.at[self.first[rows[i]]])
            while j + 1 < len(rows) and rows[j + 1] == rows[j] + 1 and self.at[self.first[rows[j + 1] + 1]] - base <= block_bytes:
                j += 1
            block = self.source.read_at(int(self.at[self.first[rows[j] + 1]]) - base, base)
            for k in rows[i : j + 1]:
                yield int(k), self._ids(block, base, int(k))
            i = j + 1


def _write_partition(folder: str, tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, files, writer, sink = encoder(tokenizer_path), filesystem(folder), None, None
        part = TaskContext.get().partitionId()
        path = f"{files[1]}/part-{part:06d}-{uuid.uuid4().hex}.zst"
        width = 2 if max(bpe.vocab_size, end_id + 1) <= 1 << 16 else 4
        for batch in batches:
            docs, texts = column(batch, "doc_id", pa.int64()).to_pylist(), column(batch, "text", pa.string())
            if writer is None and len(docs):
                files[0].create_dir(files[1], recursive=True)
                sink = files[0].open_output_stream(path, compression=None)
                writer = FrameWriter(sink, width)
            for lo, hi in text_chunks(texts, 4 << 20):
                ids, offsets = bpe.encode(texts.slice(lo, hi - lo))
                for k in range(hi - lo):
                    writer.add(docs[lo + k], np.append(ids[offsets[k] : offsets[k + 1]], end_id))
        if writer is not None:
            writer.finish()
            sink.close()
            row = [[part], [path], [len(writer.n_tokens)], [sum(writer.n_tokens)]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], names=["part", "path", "n_docs", "n_tokens"])

    return run


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    bytes_per_file: int = BYTES_PER_FILE,
) -> DataFrame:
    """Write the ids of ``docs`` in ascending id order; returns the stored manifest.

    Null text is empty (the end id alone). Null ids come first. Equal ids keep
    one order by text checksum and place. Files hold id ranges, so a hot id
    can span files. An empty table writes no file and gives an empty manifest.
    """
    rows = narrow(docs, id_col, text_col)
    total = scalar_row(rows, b=F.sum(F.octet_length("text").cast("long")))["b"] or 0
    order = ["doc_id", "tie", "place"]
    ranged = rows.select(
        "doc_id", "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("tie"),
        F.monotonically_increasing_id().alias("place"),
    ).repartitionByRange(max(1, -(-total // bytes_per_file)), *order).sortWithinPartitions(*order)
    # Tasks write the files; the manifest keeps one row for each attempt that counted.
    return store(ranged.select("doc_id", "text").mapInArrow(lean(_write_partition(folder, tokenizer_path, end_id)), _MANIFEST), "manifests")


def _read_files(folder: str, wanted: tuple[int, ...] | None, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = filesystem(folder)[0]
        for batch in batches:
            for f in batch.to_pylist():
                with files.open_input_file(f["path"]) as source:
                    reader = FrameReader(source)
                    starts = f["tokens_before"] + np.cumsum(reader.n_tokens) - reader.n_tokens
                    held: list[tuple] = []
                    for k, ids in reader.documents(wanted):
                        plain = np.ascontiguousarray(ids, "<u4")
                        last = zlib.crc32(plain) if digest else plain
                        held.append((int(reader.doc_ids[k]) if reader.known[k] else None, int(starts[k]), len(ids), last))
                        if len(held) == 5000:
                            yield _rows(held, digest)
                            held = []
                    if held:
                        yield _rows(held, digest)

    return run


def _rows(held: list[tuple], digest: bool) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.int64() if digest else pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)],
        names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
    )


def read_token_files(
    spark: SparkSession, manifest: DataFrame, folder: str, wanted: Iterable[int] | None = None, digest: bool = False
) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens and ids (or their crc32 with ``digest``).

    ``start`` counts the ids of all documents before. With ``wanted`` only the
    frames of these ids are decompressed.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("tokens_before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n = max(1, manifest.count())
    kind = "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<long>")
    return files.repartition(n, "part").mapInArrow(_read_files(folder, None if wanted is None else tuple(wanted), digest), kind)


def token_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write all documents, read the files back, one digest row per document."""
    spark = docs.sparkSession
    folder = work_path(spark, "token-files")
    return read_token_files(spark, write_token_files(docs, folder, tokenizer_path, end_id), folder, digest=True)
