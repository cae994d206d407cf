"""Helpers the operators share: narrow inputs, work folders, word splitting."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, configure

# Fixed value: the characters that separate words, as a regex class.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), so no other column can clash with an operator's own."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )


def work_path(spark: SparkSession, kind: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


def store(df: DataFrame, kind: str = "tables") -> DataFrame:
    """Write once to the shared folder and read back (cuts the lineage).

    The stored table keeps the schema of ``df``, also when it has no rows.
    """
    spark = df.sparkSession
    path = work_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``store`` wrote and that no later step reads."""
    spark = df.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def scalar_row(df: DataFrame, **aggs: Column) -> dict:
    """One row of aggregates as a dict (bounded: a single row)."""
    return df.agg(*[c.alias(n) for n, c in aggs.items()]).first().asDict()


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and the row of each text's first word.

    Words are the runs outside space and \\x09-\\x0D. Null texts have none.
    Returns (words, starts) with ``len(starts) == len(texts) + 1``.
    """
    parts = pc.ascii_split_whitespace(texts.fill_null(""))
    words = parts.flatten()
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(full)])
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))])
    return words.filter(pa.array(full)), ends[offsets].astype(np.int64)


def text_chunks(texts: pa.Array, max_bytes: int = 8 << 20):
    """(from, to) row ranges of at most ``max_bytes`` of text, a longer text alone."""
    sizes = pc.binary_length(texts.fill_null("")).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > max_bytes:
            yield start, i
            start, held = i, 0
        held += int(n)
    if start < len(sizes):
        yield start, len(sizes)


def column(batch: pa.RecordBatch, name: str, kind: pa.DataType) -> pa.Array:
    """A column as one plain array (large or dictionary forms cast away)."""
    return batch.column(batch.schema.get_field_index(name)).cast(kind)


def byte_strings(values: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string array without nulls (``to_pylist`` takes ten times as long)."""
    values = values.cast(pa.binary())
    if not len(values):
        return []
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].tolist()
    data = values.buffers()[2].to_pybytes() if values.buffers()[2] is not None else b""
    return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def sorted_distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order, by sorting (np.unique may hash, which is slower here)."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def lean(run: Callable) -> Callable:
    """A task function that gives freed memory back when it ends.

    Python workers are kept for later tasks, and what their allocators hold on
    to would count against the executor meanwhile.
    """

    def held(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return held


def release() -> None:
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)
