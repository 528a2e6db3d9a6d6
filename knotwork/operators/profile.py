"""Exact statistics of flat tables as chart-ready tables."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
BINS_PER_PASS = 1024
LEAF_ROWS = 10_000
ZERO_BEYOND = 39.0


def _value(column: str) -> Column:
    """The column as a double; not-a-number counts as missing."""
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, _NUMERIC)]


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def drop_null(df: DataFrame, column: str) -> DataFrame:
    return df.na.drop(subset=[column])


def xy_points(df: DataFrame, x: str, y: str) -> DataFrame:
    """Two columns without incomplete rows."""
    return df.select(x, y).na.drop()


def xy_bins(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """Counts on a grid, for scatter data too large to draw point by point."""
    return xy_points(df, x, y).groupBy(
        (F.floor(F.col(x) / x_width) * x_width).alias(x), (F.floor(F.col(y) / y_width) * y_width).alias(y)
    ).agg(F.count("*").alias("n"))


# --- exact quantiles ------------------------------------------------------

SKETCH_ACCURACY = 10_000


def _span_columns(cols: Sequence[str], qs: Sequence[float]) -> list[Column]:
    """Aggregates per column: count, min, max, and sketched values a little below and above each quantile."""
    marks = [min(max(q + side * 2 / SKETCH_ACCURACY, 0.0), 1.0) for q in qs for side in (-1, 1)]
    return [e for c in cols for e in (
        F.count(_value(c)), F.min(_value(c)), F.max(_value(c)), F.percentile_approx(_value(c), marks, SKETCH_ACCURACY),
    )]


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], qs: Sequence[float], spans: dict[str, tuple] | None = None
) -> dict[str, dict[float, float | None]]:
    """Exact, linearly interpolated quantiles.

    The built-in exact percentile gathers every distinct value in one task. Here
    a quantile sketch, taken with the counts, brackets each wanted rank; a second
    scan counts what lies below and within the brackets, and a third reads the
    few values left in them. Where a bracket still holds many rows, further scans
    count the values in 1,024 bins of it and keep the bin with the rank in it.
    Only bin counts and the last few thousand distinct values reach the driver.
    ``spans`` is column -> (count, min, max, sketched values) when the caller has
    them already, see ``_span_columns``.
    """
    if spans is None:
        row = df.agg(*_span_columns(cols, qs)).first()
        spans = {c: tuple(row[4 * i:4 * i + 4]) for i, c in enumerate(cols)}
    state: dict[tuple[str, int], list] = {}
    for c in cols:
        n, least, most, marks = spans[c]
        for i, q in enumerate(qs if n else ()):
            low = math.floor(q * (n - 1))
            for rank in {low, min(low + 1, n - 1)}:
                state.setdefault((c, rank), [marks[2 * i], marks[2 * i + 1], 0, n])
    if brackets := sorted({(c, lo, hi) for (c, _), (lo, hi, _, _) in state.items()}):
        counts = df.agg(*[e for c, lo, hi in brackets for e in (
            F.count_if(_value(c) < lo), F.count_if(_value(c).between(lo, hi)),
        )]).first()
        found = {b: (counts[2 * i], counts[2 * i + 1]) for i, b in enumerate(brackets)}
        for (c, rank), held in state.items():
            below, within = found[c, held[0], held[1]]
            if below <= rank < below + within:
                held[2:] = [below, within]
            else:  # a bracket that missed its rank
                held[:] = [spans[c][1], spans[c][2], 0, spans[c][0]]

    def inside(lo: float, hi: float, c: str) -> Column:
        return _value(c).between(lo, hi)

    def counted(brackets: list[tuple[str, float, float]], width_of) -> dict:
        hits = F.array(*[
            F.when(inside(lo, hi, c), F.struct(
                F.lit(i).alias("i"), width_of(_value(c), lo, hi).alias("bin"), _value(c).alias("v"),
            )) for i, (c, lo, hi) in enumerate(brackets)
        ])
        rows = (
            df.select(F.explode(F.array_compact(hits)).alias("h")).groupBy("h.i", "h.bin")
            .agg(F.count("*").alias("n"), F.min("h.v").alias("lo"), F.max("h.v").alias("hi")).collect()
        )
        grouped: dict = {b: [] for b in brackets}
        for r in rows:
            grouped[brackets[r["i"]]].append((r["lo"], r["hi"], r["n"]))
        return {b: sorted(g) for b, g in grouped.items()}

    def narrow(active: list[tuple[str, int]], width_of) -> None:
        brackets = sorted({(c, state[c, r][0], state[c, r][1]) for c, r in active})
        bins = counted(brackets, width_of)
        for c, r in active:
            lo, hi, below, _ = state[c, r]
            for b_lo, b_hi, n in bins[c, lo, hi]:
                if r < below + n:
                    state[c, r] = [b_lo, b_hi, below, n]
                    break
                below += n

    def equal_bins(v: Column, lo: float, hi: float) -> Column:
        low, high = max(lo, -sys.float_info.max), min(hi, sys.float_info.max)
        if not high / 2 - low / 2 > 0:
            return F.when(v > lo, F.lit(1.0)).otherwise(F.lit(0.0))
        step = (F.greatest(F.least(v, F.lit(high)), F.lit(low)) / 2 - low / 2) / (high / 2 - low / 2)
        return F.least(F.floor(step * BINS_PER_PASS), F.lit(BINS_PER_PASS - 1)).cast("double")

    while wide := [k for k, (lo, hi, _, n) in state.items() if lo < hi and n > LEAF_ROWS]:
        narrow(wide, equal_bins)
    if few := [k for k, (lo, hi, _, _) in state.items() if lo < hi]:
        narrow(few, lambda v, lo, hi: v)

    out: dict[str, dict[float, float | None]] = {}
    for c in cols:
        n = spans[c][0]
        out[c] = dict.fromkeys(qs)
        for q in qs if n else ():
            place = q * (n - 1)
            low = math.floor(place)
            a, b = state[c, low][0], state[c, min(low + 1, n - 1)][0]
            out[c][q] = a if place == low or a == b else a + (b - a) * (place - low)
    return out


# --- summaries ------------------------------------------------------------

def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles and max of every numeric column."""
    cols = list(cols or numeric_columns(df))
    qs = (0.25, 0.5, 0.75)
    moments = [e for c in cols for e in (F.avg(_value(c)), F.stddev_samp(_value(c)))]
    row = df.agg(*_span_columns(cols, qs), *moments).first()
    spans = {c: tuple(row[4 * i:4 * i + 4]) for i, c in enumerate(cols)}
    quartiles = exact_quantiles(df, cols, qs, spans)
    rows = [
        (c, spans[c][0], *row[4 * len(cols) + 2 * i:4 * len(cols) + 2 * i + 2], spans[c][1], *quartiles[c].values(), spans[c][2])
        for i, c in enumerate(cols)
    ]
    return df.sparkSession.createDataFrame(
        rows, "column string, count bigint, mean double, std double, min double, "
              "q25 double, q50 double, q75 double, max double"
    )


def _long_form(wide: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """One wide aggregate row to one row per struct."""
    return wide.select(F.inline(F.array(*entries)))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, not-a-number among them; one pass."""
    real = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    wide = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c) if c in real else F.col(c).isNull()).alias(c) for c in df.columns])
    return _long_form(wide, [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every two numeric columns over rows complete in both.

    Null where a column is constant. Plain sums of the values less the column's
    mean, which a first pass finds; columns without missing values share theirs,
    other pairs have sums of their own.
    """
    cols = list(cols or numeric_columns(df))
    first = df.agg(F.count("*"), *[e for c in cols for e in (F.count(_value(c)), F.avg(_value(c)), F.min(_value(c)), F.max(_value(c)))]).first()
    total = first[0]
    seen = {c: tuple(first[1 + 4 * i:5 + 4 * i]) for i, c in enumerate(cols)}
    shifted = df.select(*[(_value(c) - F.lit(seen[c][1] if seen[c][0] and math.isfinite(seen[c][1]) else 0.0)).alias(f"v{i}") for i, c in enumerate(cols)])
    whole = [seen[c][0] == total for c in cols]
    zero, aggs = F.lit(0.0), [F.lit(0)]
    at: dict[tuple, slice] = {}

    def ask(key: tuple, *sums: Column) -> None:
        at[key] = slice(len(aggs), len(aggs) + len(sums))
        aggs.extend(sums)

    for i in range(len(cols)):
        a = F.col(f"v{i}")
        if whole[i]:
            ask((i,), F.sum(a), F.sum(a * a))
        for j in range(i + 1, len(cols)):
            b = F.col(f"v{j}")
            if whole[i] and whole[j]:
                ask((i, j), F.sum(a * b))
            else:
                x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
                ask((i, j), F.count(x), F.sum(x), F.sum(x * x), F.min(x), F.max(x), F.sum(y), F.sum(y * y), F.min(y), F.max(y), F.sum(a * b))
    row = tuple(shifted.agg(*[F.coalesce(e, zero) for e in aggs]).first()) if cols and total else ()

    def r(n: float, sx: float, sxx: float, sy: float, syy: float, sxy: float) -> float | None:
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        if not (vx > 0 and vy > 0):
            return None if vx == vx and vy == vy else math.nan
        return (sxy - sx * sy / n) / math.sqrt(vx) / math.sqrt(vy)

    def varies(i: int) -> bool:
        return bool(seen[cols[i]][0] > 1 and seen[cols[i]][2] < seen[cols[i]][3])

    out = []
    for i, x in enumerate(cols):
        out.append((x, x, 1.0 if varies(i) else None))
        for j in range(i + 1, len(cols)):
            value = None
            if varies(i) and varies(j):
                if whole[i] and whole[j]:
                    value = r(total, *row[at[i,]], *row[at[j,]], *row[at[i, j]])
                else:
                    n, sx, sxx, x_lo, x_hi, sy, syy, y_lo, y_hi, sxy = row[at[i, j]]
                    value = r(n, sx, sxx, sy, syy, sxy) if n > 1 and x_lo < x_hi and y_lo < y_hi else None
            out += [(x, cols[j], value), (cols[j], x, value)]
    return df.sparkSession.createDataFrame(out, "x string, y string, r double")


# --- distributions --------------------------------------------------------

def _auto_bins(n: int, lo: float, hi: float, iqr: float) -> int:
    """The larger of the Sturges and Freedman-Diaconis bin counts."""
    if n == 0 or hi == lo:
        return 1
    sturges = (hi - lo) / (math.log2(n) + 1)
    fd = 2 * iqr / n ** (1 / 3)
    return max(1, math.ceil((hi - lo) / (min(fd, sturges) if fd > 0 else sturges)))


def _finite(column: str) -> Column:
    v = _value(column)
    return F.when(F.abs(v) < F.lit(math.inf), v)


def histogram(df: DataFrame, column: str, bins: int | str = "auto") -> DataFrame:
    """Counts in equal bins of the finite values, empty ones included; the last bin is closed.

    Infinite values, if there are any, come as bins of their own: -1 for minus
    infinity, the number of bins for plus infinity.
    """
    v, spark = _finite(column), df.sparkSession
    schema = "bin bigint, lo double, hi double, n bigint"
    n, lo, hi, low, high = df.agg(
        F.count(v), F.min(v), F.max(v), F.count_if(_value(column) == -math.inf), F.count_if(_value(column) == math.inf)
    ).first()
    if n == 0:
        bins = 0
    elif bins == "auto":
        finite = df.select(v.alias(column))
        q = exact_quantiles(finite, [column], (0.25, 0.75))[column]
        bins = _auto_bins(n, lo, hi, q[0.75] - q[0.25])
    beyond = spark.createDataFrame([(b, x, x, k) for b, x, k in ((-1, -math.inf, low), (bins, math.inf, high)) if k], schema)
    if n == 0:
        return beyond
    step = (hi - lo) / bins
    place = F.least(F.width_bucket(v, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)) if hi > lo else F.lit(1)
    counts = df.filter(v.isNotNull()).groupBy((place - 1).cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
    edges = spark.range(bins).withColumnRenamed("id", "bin")
    return edges.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * step).alias("lo"), (F.lit(lo) + (F.col("bin") + 1) * step).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    ).unionByName(beyond)


def kde(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian density of the finite values on an even grid from minimum to maximum, bandwidth by Scott's rule.

    A value adds to the grid points within 39 bandwidths only; beyond that its
    term is zero in double precision, so nothing is left out. With many rows the
    bandwidth is small against the grid step and each value meets a few points.
    Sums are combined before the shuffle, which carries one row per grid point
    and task.
    """
    v = _finite(column)
    n, lo, hi, std = df.agg(F.count(v), F.min(v), F.max(v), F.stddev_samp(v)).first()
    if not n or not std:
        return df.sparkSession.createDataFrame([], "point bigint, x double, density double")
    h = std * n ** (-1 / 5)
    step = (hi - lo) / (points - 1)
    values = df.filter(v.isNotNull()).select(v.alias("v"))
    first = F.greatest(F.lit(0), F.floor((F.col("v") - ZERO_BEYOND * h - lo) / step))
    last = F.least(F.lit(points - 1), F.ceil((F.col("v") + ZERO_BEYOND * h - lo) / step))
    spread = values.select("v", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("point"))
    x = F.lit(lo) + F.col("point") * step
    bump = F.exp(-0.5 * F.pow((x - F.col("v")) / h, F.lit(2)))
    scale = 1.0 / (n * h * math.sqrt(2 * math.pi))
    sums = spread.groupBy("point").agg((F.sum(bump) * scale).alias("density"))
    grid = df.sparkSession.range(points).withColumnRenamed("id", "point")
    return grid.join(sums, "point", "left").select("point", x.alias("x"), F.coalesce("density", F.lit(0.0)).alias("density"))


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per category, nulls left out."""
    return drop_null(df, column).groupBy(column).agg(F.count("*").alias("n"))


def outcome_counts(df: DataFrame, flag: Column) -> DataFrame:
    return df.groupBy(flag.alias("outcome")).agg(F.count("*").alias("n"))


def group_mean(df: DataFrame, x: str, y: str) -> DataFrame:
    """Mean of y per x; not-a-number counts as missing."""
    real = isinstance(df.schema[y].dataType, (T.FloatType, T.DoubleType))
    return drop_null(df, x).groupBy(x).agg(F.avg(_value(y) if real else F.col(y)).alias("mean"))


def box_stats(df: DataFrame, column: str) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 IQR) and number of outliers."""
    q = exact_quantiles(df, [column], (0.25, 0.5, 0.75))[column]
    if q[0.5] is None:
        return df.sparkSession.createDataFrame(
            [], "q1 double, median double, q3 double, whisker_lo double, whisker_hi double, outliers bigint"
        )
    reach = 1.5 * (q[0.75] - q[0.25])
    v = _value(column)
    near = v.between(q[0.25] - reach, q[0.75] + reach)
    return df.agg(
        F.min(F.when(near, v)).alias("whisker_lo"), F.max(F.when(near, v)).alias("whisker_hi"),
        F.count_if(~near).alias("outliers"),
    ).select(
        F.lit(q[0.25]).alias("q1"), F.lit(q[0.5]).alias("median"), F.lit(q[0.75]).alias("q3"),
        "whisker_lo", "whisker_hi", "outliers",
    )


# --- sorting --------------------------------------------------------------

def global_sort(df: DataFrame, *cols: str) -> DataFrame:
    """Total order by range shuffle and external sort."""
    return df.orderBy(*cols)


def sorted_arrays(df: DataFrame, column: str) -> DataFrame:
    """Arrays of each row in ascending order."""
    return df.withColumn(column, F.array_sort(column))


def merge_sorted_inputs(a: DataFrame, b: DataFrame, *cols: str) -> DataFrame:
    """Two ordered inputs as one, duplicates kept."""
    return a.unionByName(b).orderBy(*cols)
