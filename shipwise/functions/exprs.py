"""Scalar column expressions (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_number(col: str | Column) -> Column:
    """Numeric coercion; text that is not a number becomes null (F1)."""
    return F.try_cast(_c(col), "double") if hasattr(F, "try_cast") else F.expr(f"try_cast({col} AS DOUBLE)")


def product3(a: str | Column, b: str | Column, c: str | Column) -> Column:
    """Product of three columns, null if any is null (F2)."""
    return _c(a) * _c(b) * _c(c)


def all_null(cols: Sequence[str | Column]) -> Column:
    """1 when every column is null, else 0."""
    cond = None
    for col in cols:
        term = _c(col).isNull()
        cond = term if cond is None else cond & term
    return cond.cast("int")


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Signed difference ``end - start`` in fractional days."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)).cast("double") / F.lit(MICROS_PER_DAY)


def weekday_mon0(ts: str | Column) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(_c(ts))


def is_weekend(ts: str | Column) -> Column:
    """1 for Saturday / Sunday."""
    return F.weekday(_c(ts)).isin(5, 6).cast("int")


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """Ratio with a zero denominator giving null instead of an ANSI error (F8)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def null_safe_same(a: str | Column, b: str | Column, fill: str = "unknown") -> Column:
    """Equality after filling nulls, as int: two missing values compare equal."""
    return (F.coalesce(_c(a), F.lit(fill)) == F.coalesce(_c(b), F.lit(fill))).cast("int")


def finite_or_null(col: str | Column) -> Column:
    """NaN and +-inf to null."""
    c = _c(col)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def year_month(ts: str | Column) -> Column:
    """``yyyy-MM`` label."""
    return F.date_format(_c(ts), "yyyy-MM")


def iso_year_week(ts: str | Column) -> Column:
    """ISO ``%G-W%V`` label, e.g. 2018-12-31 -> 2019-W01."""
    c = _c(ts)
    return F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), c), F.weekofyear(c))


def weekday_name(ts: str | Column) -> Column:
    """English weekday name."""
    return F.date_format(_c(ts), "EEEE")


# Weekday names in Monday-first order.
WEEKDAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def bucket_right_open(col: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Bins ``[e0, e1) [e1, e2) ...``; values below the first edge or null get null.

    ``edges`` has ``len(labels) + 1`` entries; the last may be ``inf``.
    """
    c = _c(col)
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = c >= F.lit(lo)
        if hi != float("inf"):
            cond = cond & (c < F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bucket_right_closed(
    col: str | Column, edges: Sequence[float | Column], labels: Sequence[str], include_lowest: bool = True
) -> Column:
    """Bins ``[e0, e1] (e1, e2] ...`` (F16); outside the edges or null gives null.

    Edges may be columns (data-dependent top edge).
    """
    c = _c(col)
    expr = None
    for i, (lo, hi, label) in enumerate(zip(edges[:-1], edges[1:], labels)):
        lo_c = lo if isinstance(lo, Column) else F.lit(lo)
        hi_c = hi if isinstance(hi, Column) else F.lit(hi)
        lower = (c >= lo_c) if (i == 0 and include_lowest) else (c > lo_c)
        cond = lower & (c <= hi_c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def completeness_label(share: str | Column) -> Column:
    """Metadata completeness label of a missing share."""
    s = _c(share)
    return (
        F.when(s.isNull(), F.lit("no_items"))
        .when(s == 0, F.lit("all_metadata_present"))
        .when(s < 1, F.lit("partial"))
        .otherwise(F.lit("all_metadata_missing"))
    )


# The metadata buckets in report order.
METADATA_BUCKETS = ["all_metadata_present", "partial", "all_metadata_missing", "no_items"]


def round_half_even(col: str | Column, digits: int) -> Column:
    """Rounding as numpy does it (F19): ``rint(x * 10^d) / 10^d``, half to even
    on the scaled binary value (``bround`` rounds the decimal text instead)."""
    scale = float(10**digits)
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale)


def labelled(prefix: str, col: str | Column) -> Column:
    """Slice label ``prefix=value``."""
    return F.concat(F.lit(f"{prefix}="), _c(col).cast("string"))


def json_sorted(mapping: dict) -> str:
    """JSON text of a parameter map with sorted keys (F22, driver-side metadata)."""
    import json

    return json.dumps(mapping, sort_keys=True)


def key_label(cols: Sequence[str]) -> str:
    """Composite key label ``a + b``."""
    return " + ".join(cols)


def attach_one_row(df, one_row):
    """Attach the columns of a one-row global aggregate to every row.

    The aggregate becomes an uncorrelated scalar subquery: Spark evaluates it
    once, before the main plan runs, and inlines the value. So there is no
    join, no broadcast of data and no Cartesian product. All columns travel
    in one struct, so the aggregate runs once.
    """
    cols = list(one_row.columns)
    packed = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("_one_row")).scalar()
    return df.withColumn("_one_row", packed).withColumns(
        {c: F.col("_one_row").getField(c) for c in cols}
    ).drop("_one_row")
