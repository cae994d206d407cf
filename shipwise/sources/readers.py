"""Source readers: the raw table catalog from CSV or parquet (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .contracts import TABLE_SPECS, require_files

# Text tokens the reference's CSV reader treats as missing.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
               "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, on_malformed: str = "null") -> DataFrame:
    """Header CSV bound by column name, whatever the column order in the file.

    Only the header line is read ahead. Missing columns raise; further columns
    are ignored. The null tokens are null in every column, so no number is
    ever NaN. A cell that isn't of its column's type is null, or fails the job
    with ``on_malformed="fail"``; ``malformed_cells`` counts them.
    """
    if on_malformed not in ("null", "fail"):
        raise ValueError(f"on_malformed must be 'null' or 'fail', not {on_malformed!r}")
    text = _as_text(spark, path, schema)
    cast = (lambda c, t: c.try_cast(t)) if on_malformed == "null" else (lambda c, t: c.cast(t))
    return text.select(*[cast(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def malformed_cells(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(column, malformed): per column the non-null cells that aren't of its type."""
    text = _as_text(spark, path, schema)
    counts = text.agg(
        *[F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in schema.fields]
    )
    return counts.unpivot([], [f.name for f in schema.fields], "column", "malformed")


def _as_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The schema's columns by header name as strings, null tokens as nulls."""
    options = {"header": True, "escape": '"', "multiLine": False}
    header = spark.read.options(**options).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    as_strings = T.StructType([T.StructField(c, T.StringType()) for c in header])
    # Files of one folder must share a header; a different one raises.
    raw = spark.read.schema(as_strings).options(**options, enforceSchema=False).csv(path)
    return raw.select(*[
        F.when(~F.trim(f"`{f.name}`").isin(NULL_TOKENS), F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields
    ])


def load_tables(spark: SparkSession, data_dir: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Load the six marketplace tables keyed by logical name (lazy).

    ``fmt='csv'`` reads the raw file names; ``fmt='parquet'`` reads
    ``<data_dir>/<logical name>.parquet`` (for example a converted copy).
    """
    if fmt == "csv":
        require_files(spark, data_dir)
        return {
            spec.name: read_csv_table(spark, f"{data_dir.rstrip('/')}/{spec.file_name}", spec.schema)
            for spec in TABLE_SPECS
        }
    if fmt == "parquet":
        names = [f"{spec.name}.parquet" for spec in TABLE_SPECS]
        require_files(spark, data_dir, names)
        return {spec.name: spark.read.parquet(f"{data_dir.rstrip('/')}/{spec.name}.parquet") for spec in TABLE_SPECS}
    raise ValueError(f"unsupported format {fmt!r}")


def register_views(tables: dict[str, DataFrame], extra: dict[str, DataFrame] | None = None) -> list[str]:
    """Register the catalog (and e.g. the order frame / model dataset) as temp
    views, so the same lazy plans are reachable from ``spark.sql``."""
    names = []
    for name, df in {**tables, **(extra or {})}.items():
        df.createOrReplaceTempView(name)
        names.append(name)
    return names
