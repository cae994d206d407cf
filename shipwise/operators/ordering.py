"""Ordered work without a single-partition window: exact distributed rank and
prefix sums (R1), chronological split (W2), walk-forward folds (W3), drift
(W6, W7) and a stratified holdout (X3).

R1 recipe
---------
1. A numeric proxy of the leading sort key (timestamp micros, score, hash
   prefix) is cut into ranges with ``percentile_approx``. Only a bounded array
   of cut points reaches the driver. ``Bucketizer`` then assigns every row
   its range by binary search.
2. A value that fills more than one range (a hot key, up to a third of the
   data) gets a range of its own, ``[v, nextafter(v))``. Its rows are
   sub-ranged on the tie-break key with a second set of cut points. So no
   cell holds more than about ``rows / buckets`` rows, whatever the skew.
3. Per-cell totals form a small table (cells x sum columns). A window over
   that table gives each cell its offset, and the offsets are joined back.
   Spark broadcasts them only when their measured size allows it.
4. Inside each cell a window ``partitionBy(cell).orderBy(keys)`` adds the
   local running sum. Cell ids are pure functions of the key, so a
   recomputed task lands every row in the same cell.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.exprs import attach_one_row

# Rows per cell the per-cell window sorts (spilling if needed); 2^20 cells of
# that size hold 2 * 10^11 rows, beyond which cells grow. The cut points (one
# double per cell, at most 8 MB) are the only data that reaches the driver.
# (SHIPWISE_ROWS_PER_CELL lowers it to run the multi-cell path on small data.)
DEFAULT_ROWS_PER_CELL = int(os.environ.get("SHIPWISE_ROWS_PER_CELL", "200000"))
MAX_BUCKETS = 1 << 20
# Offsets of so many cells at most are broadcast.
_BROADCAST_CELLS = 50_000


def ts_micros(col: str | Column) -> Column:
    """Timestamp (NTZ or LTZ) to epoch microseconds as double (exact below 2^53)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c.cast("timestamp_ntz")).cast(
        "double"
    )


# Strings that a proxy's cut points are drawn from at most, and cut points kept.
STRING_SAMPLE, STRING_CUTS = 50_000, 1024
_TAIL_BYTES = 5


def _string_proxy(df: DataFrame, c: Column) -> Column:
    """Place of a string among sampled cut points, by binary search, plus a fraction between two of them.

    The fraction comes from the 5 bytes after the prefix that the two
    neighbouring cut points share (all strings between them share it too). So
    strings of several long prefixes still spread over the ranges. Hex text keeps
    Spark's byte order. At most ``STRING_SAMPLE`` strings reach the driver.
    """
    text = F.hex(c.cast("binary"))
    ends = df.agg(F.min(text).alias("lo"), F.max(text).alias("hi"), F.count(text).alias("n")).first()
    if ends["lo"] is None:
        return F.lit(None).cast("double")
    share = min(1.0, STRING_SAMPLE / 2 / ends["n"])
    found = df.select(text.alias("t")).where("t IS NOT NULL").sample(fraction=share, seed=1).limit(STRING_SAMPLE).distinct().collect()
    drawn = sorted({ends["lo"], ends["hi"], *[r["t"] for r in found]})
    step = -(-len(drawn) // STRING_CUTS)
    cuts = sorted({ends["lo"], ends["hi"], *drawn[::step]})
    # bytes shared by a cut point and the next one, in hex digits
    shared = [len(os.path.commonprefix(p)) // 2 * 2 for p in zip(cuts, cuts[1:])] + [len(cuts[-1])]
    points, lengths = F.split(F.lit(",".join(cuts)), ","), F.split(F.lit(",".join(map(str, shared))), ",")
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    place = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when((at + s <= len(cuts)) & (F.get(points, F.least(at + s, F.lit(len(cuts))) - 1) <= text), at + s).otherwise(at),
    )
    # one before the last: both neighbours are known
    place = F.greatest(place, F.lit(1))
    own = F.get(lengths, place - 1).cast("int")
    tail = F.rpad(text.substr(own + 1, F.lit(2 * _TAIL_BYTES)), 2 * _TAIL_BYTES, "0")
    return place + F.conv(tail, 16, 10).cast("double") / F.lit(float(1 << (8 * _TAIL_BYTES)))


def sort_proxy(df: DataFrame, name: str) -> Column:
    """A double that never decreases along the column's own sort order (R1 cut points).

    Timestamps become epoch micros, dates days, numbers themselves, strings
    their place among sampled strings (``_string_proxy``). Equal proxies only put
    rows in the same range; the exact order comes from the real column inside
    a cell. Where any fixed order will do, rank by a hash instead (as
    permutation importance does).
    """
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return ts_micros(c)
    if isinstance(dt, T.DateType):
        return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double")
    if isinstance(dt, T.StringType):
        return _string_proxy(df, c)
    if isinstance(dt, T.BooleanType):
        return c.cast("int").cast("double")
    return c.cast("double")


def _splits(values: Sequence[float]) -> tuple[list[float], list[float]]:
    """Bucketizer splits from approximate quantiles; returns (splits, hot values).

    A value repeated among the quantiles covers more than one range: it is
    isolated in ``[v, nextafter(v))`` and reported as hot.
    """
    vals = [v for v in values if v is not None and not math.isnan(v)]
    hot = sorted(v for v, times in Counter(vals).items() if times > 1)
    pts = set(vals)
    for v in hot:
        pts.add(math.nextafter(v, math.inf))
    return [-math.inf, *sorted(pts), math.inf], hot


def _bucketize(df: DataFrame, input_col: str, output_col: str, splits: list[float], null_cell: float = -1.0) -> DataFrame:
    """Range of every value; NaN after all ranges (as it sorts), null in ``null_cell``."""
    if len(splits) > 2:
        out = Bucketizer(splits=splits, inputCol=input_col, outputCol=output_col, handleInvalid="keep").transform(df)
    else:
        out = df.withColumn(output_col, F.lit(0.0))
    return out.withColumn(output_col, F.when(F.col(input_col).isNull(), F.lit(null_cell)).otherwise(F.col(output_col)))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that keeps null keys: nulls equal each other, as they do in ``groupBy``."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def bucket_count(n_rows: int | None, buckets: int | None = None, rows_per_cell: int = DEFAULT_ROWS_PER_CELL) -> int:
    if buckets:
        return max(1, min(buckets, MAX_BUCKETS))
    if n_rows is None:
        return 64
    return max(1, min(MAX_BUCKETS, -(-n_rows // rows_per_cell)))


def range_cells(df: DataFrame, lead: Column, b: int, out: str, nulls_last: bool = False) -> tuple[DataFrame, list[float]]:
    """Add the range of ``lead`` among about ``b`` of equal size; returns (frame, hot values, which have a range each)."""
    probs = [i / b for i in range(1, b)]
    q = df.agg(F.percentile_approx(lead.cast("double"), probs, max(10_000, 4 * b)).alias("q")).first()["q"] if probs else None
    splits, hot = _splits(q or [])
    cells = _bucketize(df.withColumn("_lead", lead.cast("double")), "_lead", out, splits, math.inf if nulls_last else -1.0)
    return cells.drop("_lead"), hot


def with_cells(
    df: DataFrame,
    lead: Column | Callable[[], Column],
    tie: Column | Callable[[], Column] | None = None,
    buckets: int | None = None,
    rows_per_cell: int = DEFAULT_ROWS_PER_CELL,
    accuracy: int | None = None,
    n_rows: int | None = None,
    nulls_last: bool = False,
) -> tuple[DataFrame, bool]:
    """Add ``_b1`` / ``_b2`` range cells (monotone in (lead, tie)).

    ``lead`` and ``tie`` may be functions, called only if cells are needed.
    Null leads form a cell before all ranges (after them with ``nulls_last``),
    cut by the tie-break key like a hot value.

    Returns (frame, single): ``single`` means the counted input fits one cell
    (at most ``rows_per_cell`` rows) and no cell columns were added.
    """
    n = None if buckets else (n_rows if n_rows is not None else df.count())
    b = bucket_count(n, buckets, rows_per_cell)
    if b <= 1:
        return df, True
    df = df.withColumn("_k1", (lead() if callable(lead) else lead).cast("double"))
    if tie is not None:
        df = df.withColumn("_k2", (tie() if callable(tie) else tie).cast("double"))
    probs = [i / b for i in range(1, b)]
    # rank error of the cut points ~ n / accuracy: keep it below a quarter cell
    accuracy = accuracy or max(10_000, 4 * b)
    seen = df.agg(
        F.percentile_approx("_k1", probs, accuracy).alias("q"), F.count_if(F.col("_k1").isNull()).alias("nulls")
    ).first()
    splits, hot = _splits(seen["q"] or [])
    out = _bucketize(df, "_k1", "_b1", splits, math.inf if nulls_last else -1.0)
    if tie is None or not (hot or seen["nulls"]):
        return out.withColumn("_b2", F.lit(0.0)), False
    is_hot = F.col("_k1").isNull() | F.coalesce(F.col("_k1").isin(hot), F.lit(False))
    q2 = out.where(is_hot).agg(F.percentile_approx("_k2", probs, accuracy).alias("q")).first()["q"] or []
    splits2, _ = _splits(q2)
    out = _bucketize(out.withColumn("_k2h", F.when(is_hot, F.col("_k2")).otherwise(F.lit(0.0))), "_k2h", "_b2", splits2)
    return out.withColumn("_b2", F.when(is_hot, F.col("_b2")).otherwise(F.lit(0.0))).drop("_k2h"), False


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column],
    lead: Column | Callable[[], Column],
    values: dict[str, Column],
    partition: Sequence[str] = (),
    tie: Column | Callable[[], Column] | None = None,
    inclusive: bool = True,
    buckets: int | None = None,
    rows_per_cell: int = DEFAULT_ROWS_PER_CELL,
    n_rows: int | None = None,
    nulls_last: bool = False,
) -> DataFrame:
    """Running sums of ``values`` in the total order ``order`` (per ``partition``).

    ``lead`` is a numeric proxy monotone (non-decreasing) in ``order`` and
    ``tie`` one in the remaining keys. ``inclusive`` counts the current row.
    ``nulls_last`` says where ``order`` puts null leads (Spark: first when
    ascending, last when descending). Null partition keys form a partition.
    Output columns ``cum_<name>`` are added; helper columns are dropped.
    """
    part = list(partition)
    names = list(values)
    if n_rows is None and not buckets:
        n_rows = df.count()
    src = df.withColumns({f"_v_{k}": v for k, v in values.items()})
    cells, single = with_cells(src, lead, tie, buckets, rows_per_cell, n_rows=n_rows, nulls_last=nulls_last)
    frame = Window.unboundedPreceding, (0 if inclusive else -1)
    if single:
        w = Window.partitionBy(*part).orderBy(*order).rowsBetween(*frame)
        out = cells.withColumns({f"cum_{k}": F.coalesce(F.sum(f"_v_{k}").over(w), F.lit(0)) for k in names})
    else:
        cell_keys = [*part, "_b1", "_b2"]
        totals = cells.groupBy(*cell_keys).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in names])
        w_cells = Window.partitionBy(*part).orderBy("_b1", "_b2").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(
            *cell_keys, *[F.coalesce(F.sum(f"_t_{k}").over(w_cells), F.lit(0)).alias(f"_o_{k}") for k in names]
        )
        if not part and bucket_count(n_rows, buckets, rows_per_cell) <= _BROADCAST_CELLS:
            # a row a cell: the wide rows needn't be shuffled for the join too
            offsets = F.broadcast(offsets)
        w_in = Window.partitionBy(*cell_keys).orderBy(*order).rowsBetween(*frame)
        out = null_safe_join(cells, offsets, cell_keys).withColumns(
            {f"cum_{k}": F.col(f"_o_{k}") + F.coalesce(F.sum(f"_v_{k}").over(w_in), F.lit(0)) for k in names}
        )
    drop = [c for c in out.columns if c.startswith(("_v_", "_o_", "_t_")) or c in ("_k1", "_k2", "_b1", "_b2")]
    return out.drop(*drop)


def exact_rank(
    df: DataFrame,
    ts: str,
    key: str,
    partition: Sequence[str] = (),
    rank_col: str = "rank",
    buckets: int | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """0-based position by (``ts``, ``key``) ascending, nulls first, optionally per partition."""
    out = prefix_sums(
        df,
        [F.col(ts).asc(), F.col(key).asc()],
        lead=lambda: sort_proxy(df, ts),
        values={"_one": F.lit(1).cast("long")},
        partition=partition,
        tie=lambda: sort_proxy(df, key),
        inclusive=False,
        buckets=buckets,
        n_rows=n_rows,
    )
    return out.withColumnRenamed("cum__one", rank_col)


# ---------------------------------------------------------------- split and folds

TS = "order_purchase_timestamp"
KEY = "order_id"


def split_cut(n: int, test_fraction: float) -> int:
    """First ``int(n * (1 - f))`` rows train, as the reference computes it."""
    return int(n * (1 - test_fraction))


def chronological_split(
    dataset: DataFrame,
    test_fraction: float = 0.2,
    ts: str = TS,
    key: str = KEY,
    buckets: int | None = None,
    materialize_input: bool = False,
    part_rows: int | None = None,
) -> DataFrame:
    """Dataset with ``rank`` and ``is_test`` (W2). Ties on time are ordered by key.

    The split runs several passes over its input: the count, the cut points
    and the rank. With ``materialize_input`` the input is written once to the
    checkpoint folder first, so an expensive input (the order frame) is
    computed once, not per pass. Use it at scale. With ``part_rows`` the ranked
    rows are dealt by rank into parts of about so many rows, so that every time
    window of them lies in all parts, where the ranking leaves it in one or two.
    """
    if materialize_input:
        from ..session import materialize

        dataset = materialize(dataset)
    n = dataset.count()
    cut = split_cut(n, test_fraction)
    ranked = exact_rank(dataset, ts, key, buckets=buckets, n_rows=n)
    if part_rows:
        ranked = ranked.repartition(max(1, -(-n // part_rows)), "rank")
    return ranked.withColumn("is_test", F.col("rank") >= F.lit(cut))


def split_frames(ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return ranked.where(~F.col("is_test")), ranked.where(F.col("is_test"))


def fold_bounds(n_train: int, n_splits: int = 4) -> list[tuple[int, int, int]]:
    """Expanding-window folds as (train_end, test_start, test_end) positions.

    ``test_size = n // (k + 1)``; fold i tests ``[n - (k - i) * t, n - (k - i - 1) * t)``
    and trains on everything before it.
    """
    t = n_train // (n_splits + 1)
    if t == 0:
        raise ValueError(f"Cannot make {n_splits} walk-forward folds from {n_train} training rows")
    out = []
    for i in range(n_splits):
        start = n_train - (n_splits - i) * t
        out.append((start, start, start + t))
    return out


def walk_forward_folds(train_ranked: DataFrame, n_train: int, n_splits: int = 4, rank_col: str = "rank") -> DataFrame:
    """Rows of every fold tagged with ``fold`` and ``role`` (train / test).

    Each row appears in the folds whose window covers it (expanding train),
    built by an ``explode`` over the fold numbers a row belongs to.
    """
    bounds = fold_bounds(n_train, n_splits)
    r = F.col(rank_col)
    tags = []
    for i, (train_end, test_start, test_end) in enumerate(bounds):
        tags.append(F.when(r < train_end, F.struct(F.lit(i).alias("fold"), F.lit("train").alias("role"))))
        tags.append(
            F.when((r >= test_start) & (r < test_end), F.struct(F.lit(i).alias("fold"), F.lit("test").alias("role")))
        )
    arr = F.filter(F.array(*tags), lambda x: x.isNotNull())
    return train_ranked.withColumn("_tag", F.explode(arr)).select("*", "_tag.fold", "_tag.role").drop("_tag")


def stratified_holdout(
    dataset: DataFrame,
    label: str = "is_late",
    key: str = KEY,
    test_fraction: float = 0.2,
    seed: int = 42,
    buckets: int | None = None,
) -> DataFrame:
    """Random stratified split (X3): within each class, rows ordered by
    ``md5(seed || key)``; the first ``int(n_c * (1 - f))`` train.

    md5 text is engine-independent, so the split is reproducible anywhere.
    """
    h = F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))
    src = dataset.withColumn("_h", h)
    ranked = prefix_sums(
        src,
        [F.col("_h").asc(), F.col(key).asc()],
        lead=F.conv(F.substring("_h", 1, 13), 16, 10).cast("double"),
        values={"_one": F.lit(1).cast("long")},
        partition=[label],
        tie=lambda: sort_proxy(src, key),
        inclusive=False,
        buckets=buckets,
    ).withColumnRenamed("cum__one", "_r")
    # Class sizes travel as one map (a scalar subquery), so no row is shuffled
    # by its class; a null label is a class of its own.
    name = F.coalesce(F.col(label).cast("string"), F.lit("null label"))
    sizes = (
        dataset.groupBy(name.alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
        .select(F.map_from_entries(F.collect_list(F.struct("_class", "_n"))).alias("_sizes"))
    )
    with_sizes = attach_one_row(ranked, sizes)
    cut = F.floor(F.element_at("_sizes", name).cast("double") * F.lit(1 - test_fraction))
    return with_sizes.withColumn("is_test", F.col("_r") >= cut).drop("_h", "_r", "_sizes")
