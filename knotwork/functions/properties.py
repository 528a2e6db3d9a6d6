"""Property maps kept as canonical JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_INSTANT = (T.TimestampType, T.TimestampNTZType)


def canonical_json(props: Column) -> Column:
    """Sort keys and normalise number spelling, so that equal maps are equal texts."""
    return F.to_json(F.parse_json(props))


def iso_text(ts: Column) -> Column:
    """ISO-8601 text of a timestamp; the fraction is written only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, "SSSSSS")
    return F.when(fraction == "000000", whole).otherwise(F.concat(whole, F.lit("."), fraction))


def _iso_field(name: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, _INSTANT):
        return iso_text(F.col(name))
    if isinstance(dtype, T.DateType):
        return F.col(name).cast("string")
    return F.col(name)


def _object(fields: dict[str, Column], keep_nulls: bool) -> Column:
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    if not fields:
        return F.lit("{}")
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), options)


def _types(df: DataFrame, cols: Sequence[str]) -> dict[str, T.DataType]:
    return {c: df.schema[c].dataType for c in cols}


def props_json(df: DataFrame, cols: Sequence[str], keep_nulls: bool = False) -> Column:
    """Columns to a JSON object; dates become ISO text, nested values are kept."""
    return _object({c: _iso_field(c, t) for c, t in _types(df, cols).items()}, keep_nulls)


def props_typed(df: DataFrame, cols: Sequence[str], keep_nulls: bool = False) -> Column:
    """Numbers and booleans keep their type, dates become ISO text, all else becomes text."""
    fields = {}
    for c, t in _types(df, cols).items():
        plain = isinstance(t, (*_NUMERIC, *_INSTANT, T.DateType, T.BooleanType))
        fields[c] = _iso_field(c, t) if plain else F.col(c).cast("string")
    return _object(fields, keep_nulls)


def props_stringified(df: DataFrame, cols: Sequence[str]) -> Column:
    """Every value as text; booleans are written True / False."""
    fields = {}
    for c, t in _types(df, cols).items():
        text = _iso_field(c, t).cast("string")
        fields[c] = F.initcap(text) if isinstance(t, T.BooleanType) else text
    return _object(fields, keep_nulls=False)


def as_variant_map(props: Column) -> Column:
    """Top-level keys mapped to typed values."""
    return F.from_json(props, "map<string,variant>")


def typed_map(props: Column) -> Column:
    """Top-level keys mapped to typed JSON text, so that 1 and "1" differ."""
    return F.transform_values(as_variant_map(props), lambda _, v: F.to_json(v))


def _is_text(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def _text_of(v: Column) -> Column:
    """Text form: scalars unquoted, nested values as JSON."""
    return F.when(_is_text(v), F.variant_get(v, "$", "string")).otherwise(F.to_json(v))


def stringify_json(props: Column) -> Column:
    """As ``props_stringified`` for properties that are JSON already."""

    def text(_: Column, v: Column) -> Column:
        return F.when(F.schema_of_variant(v) == "BOOLEAN", F.initcap(F.to_json(v))).otherwise(_text_of(v))

    return canonical_json(F.to_json(F.transform_values(as_variant_map(props), text)))


def props_literal_text(props: Column) -> Column:
    """``k: 'v', k2: 3`` with single quotes escaped and numbers and booleans bare."""

    def pair(e: Column) -> Column:
        kind = F.schema_of_variant(e["value"])
        bare = kind.isin("BIGINT", "DOUBLE", "BOOLEAN") | kind.startswith("DECIMAL")
        quoted = F.concat(F.lit("'"), F.replace(_text_of(e["value"]), F.lit("'"), F.lit("\\'")), F.lit("'"))
        return F.concat(e["key"], F.lit(": "), F.when(bare, F.to_json(e["value"])).otherwise(quoted))

    paired = F.transform(F.map_entries(as_variant_map(canonical_json(props))), pair)
    return F.array_join(paired, ", ")


def prop_get(props: Column, key: str) -> Column:
    """Value of one key as text; null when the key is missing or its value is null."""
    return F.get_json_object(props, f"$['{key}']")


def prop_exists(props: Column, key: str) -> Column:
    """True when the key is present, also with a null value."""
    return F.coalesce(F.array_contains(F.json_object_keys(props), key), F.lit(False))


def prop_set(props: Column, key: str, value: Column) -> Column:
    """The map with one key replaced or added."""
    rest = F.map_filter(as_variant_map(props), lambda k, _: k != F.lit(key))
    one = F.from_json(F.to_json(F.create_map(F.lit(key), value)), "map<string,variant>")
    return canonical_json(F.to_json(F.map_concat(rest, one)))


def prop_date(props: Column, key: str) -> Column:
    """Property as a date; null when it is missing or not a date."""
    return prop_get(props, key).try_cast("date")


def format_created_at(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def props_explode(df: DataFrame, key: str, props: str = "props") -> DataFrame:
    """One row per property, flagging the searched key."""
    keep = [c for c in df.columns if c != props]
    exploded = df.select(*keep, F.explode(as_variant_map(F.col(props))).alias("key", "_v"))
    return exploded.select(*keep, "key", _text_of(F.col("_v")).alias("value"), (F.col("key") == key).alias("matched"))


def display_label(props: Column, *keys: str) -> Column:
    """First non-empty of the named properties, else an empty text."""
    keys = keys or ("name", "id")
    return F.coalesce(*[F.nullif(prop_get(props, k), F.lit("")) for k in keys], F.lit(""))


def entry_texts(v: Column) -> list[Column]:
    """``value``, typed JSON text, and ``value_text``, unquoted; text alone is JSON in quotes, so no type is asked for."""
    typed = F.to_json(v)
    text = F.when(typed.startswith('"'), F.variant_get(v, "$", "string")).otherwise(typed)
    return [typed.alias("value"), text.alias("value_text")]


def property_entries(vertices: DataFrame, *keep: str) -> DataFrame:
    """Inverted rows: ``keep`` columns, key, value (typed JSON text), value_text."""
    exploded = vertices.select(*keep, F.explode(as_variant_map(F.col("props"))).alias("key", "_v"))
    return exploded.select(*keep, "key", *entry_texts(F.col("_v")))
