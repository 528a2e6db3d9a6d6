"""Partition assignment, specs and their life cycle, as data work."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from knotwork.functions.properties import prop_date, prop_exists, prop_get, prop_set

DEFAULT = "default"


class Range(NamedTuple):
    """Half-open range ``[lo, hi)`` of one label; ``hi=None`` is unbounded."""

    label: str
    name: str
    lo: int | str | None
    hi: int | str | None
    is_default: bool = False


# Bounds of the id ranges and the strict years.
VERTEX_ID_BOUNDS = [(0, 1_000_000), (1_000_000, 2_000_000), (2_000_000, None)]
EDGE_ID_BOUNDS = [(0, 500_000), (500_000, 1_000_000), (1_000_000, None)]
PROPERTY_ID_BOUNDS = [(1, 1000), (1001, 2000)]
STRICT_YEARS = [2023, 2024, 2025]

# Label -> (kind, property).
PARTITION_STRATEGY = {
    "Person": ("date", "created_at"),
    "Employee": ("date", "created_at"),
    "Customer": ("date", "created_at"),
    "Product": ("id", "id"),
    "Company": ("id", "id"),
    "WORKS_AT": ("date", "start_date"),
    "PURCHASED": ("date", "start_date"),
    "LOCATED_IN": ("id", "id"),
    "MANUFACTURED_BY": ("id", "id"),
}


def id_ranges(label: str, bounds: Iterable[tuple[int, int | None]]) -> list[Range]:
    return [Range(label, f"id_{lo}", lo, hi) for lo, hi in bounds]


def year_ranges(label: str, years: Iterable[int], with_default: bool = False) -> list[Range]:
    spec = [Range(label, f"y{y}", f"{y}-01-01", f"{y + 1}-01-01") for y in years]
    return [*spec, Range(label, DEFAULT, None, None, True)] if with_default else spec


def spec_frame(spark: SparkSession, spec: Sequence[Range]) -> DataFrame:
    """The spec as a table, bounds as text."""
    rows = [(r.label, r.name, None if r.lo is None else str(r.lo), None if r.hi is None else str(r.hi), r.is_default)
            for r in spec]
    return spark.createDataFrame(rows, "label string, name string, lo string, hi string, is_default boolean")


# --- assignment -----------------------------------------------------------

def assign_range(value: Column, label: Column, spec: Sequence[Range]) -> Column:
    """Name of the range holding the value, the label's default, or null.

    The spec is table metadata of some tens of ranges, so it is folded into one
    CASE expression: no join, no broadcast, evaluated inside the scan stage.
    """
    placed = F.lit(None).cast("string")
    for r in reversed(spec):
        if r.is_default:
            continue
        inside = (label == r.label) & (value >= F.lit(r.lo))
        if r.hi is not None:
            inside = inside & (value < F.lit(r.hi))
        placed = F.when(inside, F.lit(r.name)).otherwise(placed)
    fallback = F.lit(None).cast("string")
    for r in spec:
        if r.is_default:
            fallback = F.when(label == r.label, F.lit(r.name)).otherwise(fallback)
    return F.coalesce(placed, fallback)


def assign_partition(
    df: DataFrame, value: Column, spec: Sequence[Range], label: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``part``, and rows that no range takes."""
    marked = df.withColumn("part", assign_range(value, F.col("label") if label is None else label, spec))
    return marked.filter(F.col("part").isNotNull()), marked.filter(F.col("part").isNull()).drop("part")


def year_partition(day: Column, as_of: dt.date, back: int = 2, ahead: int = 1) -> Column:
    """``y<year>`` inside the window around ``as_of``, else ``default`` (also for no date)."""
    y = F.year(day)
    window = y.between(as_of.year - back, as_of.year + ahead)
    return F.when(window, F.concat(F.lit("y"), y.cast("string"))).otherwise(F.lit(DEFAULT))


def year_partition_strict(df: DataFrame, day: Column, years: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """Fixed years without a default: other rows are refused."""
    marked = df.withColumn("part", F.when(F.year(day).isin(list(years)), F.concat(F.lit("y"), F.year(day).cast("string"))))
    return marked.filter(F.col("part").isNotNull()), marked.filter(F.col("part").isNull()).drop("part")


def id_range_partition(df: DataFrame, bounds: Sequence[tuple[int, int | None]], key: Column) -> tuple[DataFrame, DataFrame]:
    """Ranges over an integer key for every label alike; a negative key is refused."""
    return assign_partition(df, key, id_ranges(DEFAULT, bounds), label=F.lit(DEFAULT))


def property_id_partition(
    df: DataFrame, bounds: Sequence[tuple[int, int | None]] = tuple(PROPERTY_ID_BOUNDS), key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """Ranges over a property read as an integer; text that is no integer is refused."""
    return id_range_partition(df, bounds, prop_get(F.col("props"), key).try_cast("bigint"))


def hash_partition(df: DataFrame, modulus: int, key: str = "id") -> DataFrame:
    """Even spread by id."""
    return df.withColumn("part", F.concat(F.lit("h"), F.pmod(F.xxhash64(key), F.lit(modulus)).cast("string")))


def fill_missing_date(props: Column, key: str, as_of: dt.date) -> Column:
    """Properties with the date added where the key is absent."""
    return F.when(prop_exists(props, key), props).otherwise(prop_set(props, key, F.lit(as_of.isoformat())))


def union_dated_undated(df: DataFrame, key: str, as_of: dt.date) -> DataFrame:
    """Rows with the date and rows given one, with the resulting date; a single pass."""
    dated = df.withColumn("was_dated", prop_exists(F.col("props"), key)).withColumn(
        "props", fill_missing_date(F.col("props"), key, as_of)
    )
    return dated.withColumn(key, prop_date(F.col("props"), key))


def partition_strategy(spark: SparkSession, catalog: DataFrame) -> DataFrame:
    """How each label in use is partitioned; labels without an entry are ``none``."""
    rows = [(label, kind, column) for label, (kind, column) in PARTITION_STRATEGY.items()]
    table = spark.createDataFrame(rows, "name string, strategy string, column string")
    joined = catalog.select("name").join(table, "name", "left")
    return joined.select("name", F.coalesce("strategy", F.lit("none")).alias("strategy"), "column")


# --- reports --------------------------------------------------------------

def partition_distribution(df: DataFrame, spec: DataFrame | None = None) -> DataFrame:
    """Rows per label and partition, their percentage and the label total; with ``spec`` empty partitions too."""
    counts = df.groupBy("label", "part").agg(F.count("*").alias("n"))
    if spec is not None:
        declared = spec.select("label", F.col("name").alias("part")).distinct()
        counts = counts.join(declared, ["label", "part"], "full").select("label", "part", F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("label"))
    share = F.coalesce(F.round(F.try_divide(F.lit(100.0) * F.col("n"), F.col("total")), 1), F.lit(0.0))
    return counts.withColumn("total", total).select("label", "part", "n", share.alias("pct"), "total")


def share_of_total(df: DataFrame, group: str) -> DataFrame:
    """Fraction of all rows per group."""
    counts = df.groupBy(group).agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n")).scalar()
    return counts.select(group, "n", F.round(F.try_divide(F.col("n").cast("double"), whole), 6).alias("share"))


def partition_rows(df: DataFrame, spec: DataFrame) -> DataFrame:
    """Every partition of the spec with its bounds and row count, empty ones included."""
    counts = df.groupBy("label", F.col("part").alias("name")).agg(F.count("*").alias("n"))
    return spec.join(counts, ["label", "name"], "left").select(
        "label", "name", "lo", "hi", "is_default", F.coalesce("n", F.lit(0)).alias("n")
    )


def partition_info(df: DataFrame, spec: DataFrame) -> DataFrame:
    """Label to the list of its partitions; a list is as long as the label's spec."""
    entry = F.struct("name", "lo", "hi", "is_default", "n")
    return partition_rows(df, spec).groupBy("label").agg(F.sort_array(F.collect_list(entry)).alias("partitions"))


def table_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Rows and bytes per label of a stored graph table, largest first."""
    stored = spark.read.parquet(path)
    files = stored.select("label", "_metadata.file_path", "_metadata.file_size").groupBy(
        "label", "file_path", "file_size"
    ).agg(F.count("*").alias("n"))
    return files.groupBy("label").agg(
        F.sum("n").alias("rows"), F.sum("file_size").alias("bytes"), F.count("*").alias("files")
    ).orderBy(F.desc("bytes"), "label")


# --- life cycle -----------------------------------------------------------

def touched_partitions(spec: Sequence[Range], label: str, lo: object, hi: object) -> list[str]:
    """Partitions of a label that can hold values in ``[lo, hi)``, by the meaning of ``assign_range``.

    Values outside all ranges are in the label's default, so that is named
    whenever the ranges leave a part of ``[lo, hi)`` open.
    """

    def key(value: object) -> object:
        return value.isoformat() if isinstance(value, dt.date) else value

    lo, hi = key(lo), key(hi)
    own = sorted((r for r in spec if r.label == label and not r.is_default), key=lambda r: key(r.lo))
    hit = [r.name for r in own if key(r.lo) < hi and (r.hi is None or key(r.hi) > lo)]
    reach = lo
    for r in own:
        if key(r.lo) <= reach and (r.hi is None or key(r.hi) > reach):
            reach = hi if r.hi is None else key(r.hi)
    return hit + [r.name for r in spec if r.label == label and r.is_default and reach < hi]


def future_partitions(spec: DataFrame, as_of: dt.date, years_ahead: int = 2) -> DataFrame:
    """Year ranges still to be created for the coming years of every label in the spec."""
    years = F.sequence(F.lit(as_of.year + 1), F.lit(as_of.year + years_ahead))
    planned = spec.select("label").distinct().select("label", F.explode(years).alias("year"))
    text = F.col("year").cast("string")
    rows = planned.select(
        "label",
        F.concat(F.lit("y"), text).alias("name"),
        F.concat(text, F.lit("-01-01")).alias("lo"),
        F.concat((F.col("year") + 1).cast("string"), F.lit("-01-01")).alias("hi"),
        F.lit(False).alias("is_default"),
    )
    return rows.join(spec.select("label", "name"), ["label", "name"], "left_anti")


def expired_partitions(names: DataFrame, as_of: dt.date, keep_years: int = 3) -> DataFrame:
    """Status of each ``<table>_y<year>`` name: expired, kept or unparsable; the default is left out.

    Nothing is deleted.
    """
    year = F.regexp_extract("name", r"_?y([^_]*)$", 1).try_cast("int")
    status = (
        F.when(year.isNull(), F.lit("unparsable"))
        .when(year < as_of.year - keep_years, F.lit("expired"))
        .otherwise(F.lit("kept"))
    )
    return names.filter(~F.col("name").endswith(DEFAULT)).select("name", year.alias("year"), status.alias("status"))


def retention_split(df: DataFrame, as_of: dt.date, keep_years: int = 3, part: str = "part") -> tuple[DataFrame, DataFrame]:
    """(kept, archived) rows by partition year; write the archive before anything is dropped."""
    year = F.regexp_extract(part, r"^y(\d{4})$", 1).try_cast("int")
    old = F.coalesce(year < as_of.year - keep_years, F.lit(False))
    return df.filter(~old), df.filter(old)


def range_spec_check(spec: DataFrame) -> DataFrame:
    """Gaps and overlaps of the ranges of a label, as text bounds.

    Bounds are compared as whole numbers if all of a label's are, else as dates
    in ISO form. Each range is held against the farthest end of those that begin
    before it: what lies between is a gap, what lies before that end and before
    its own is an overlap. An open end reaches beyond every other. The window runs
    over spec rows, which are metadata.
    """
    own = Window.partitionBy("label")
    rows = spec.filter(~F.col("is_default")).select("label", "lo", "hi")
    whole = F.bool_and(F.col("lo").try_cast("bigint").isNotNull() & (F.col("hi").isNull() | F.col("hi").try_cast("bigint").isNotNull())).over(own)
    rows = rows.withColumn("whole", whole)

    def typed(bound: str) -> Column:
        day = F.unix_date(F.col(bound).try_cast("date")).cast("bigint")
        return F.when(F.col("whole"), F.col(bound).try_cast("bigint")).otherwise(day)

    endless = F.lit((1 << 63) - 1)
    rows = rows.select("label", "whole", typed("lo").alias("a"), F.coalesce(typed("hi"), endless).alias("b"))
    before = own.orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    pairs = rows.withColumn("reach", F.max("b").over(before)).filter(F.col("reach").isNotNull())
    kind = F.when(F.col("a") < F.col("reach"), F.lit("overlap")).when(F.col("a") > F.col("reach"), F.lit("gap"))
    found = pairs.withColumn("kind", kind).filter(F.col("kind").isNotNull())

    def text(value: Column) -> Column:
        shown = F.when(F.col("whole"), value.cast("string")).otherwise(F.date_from_unix_date(value.cast("int")).cast("string"))
        return F.when(value < endless, shown)

    return found.select(
        "label", "kind", text(F.least("a", "reach")).alias("from"),
        text(F.when(F.col("kind") == "gap", F.col("a")).otherwise(F.least("b", "reach"))).alias("to"),
    )
