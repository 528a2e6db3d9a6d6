import datetime as dt
import json

from pyspark.sql import functions as F

from knotwork.functions import names as N
from knotwork.functions import properties as P


def one(df):
    return df.first()[0]


def test_columns_to_json(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 6, 1, 12, 30), dt.date(2024, 6, 1), True, None, [1, 2])],
        "quantity int, at timestamp_ntz, date date, main_office boolean, gone string, tags array<int>",
    )
    cols = df.columns
    assert json.loads(one(df.select(P.props_json(df, cols)))) == {
        "at": "2024-06-01T12:30:00", "date": "2024-06-01", "main_office": True, "quantity": 1, "tags": [1, 2]
    }
    assert one(df.select(P.props_stringified(df, ["quantity", "main_office", "date"]))) == (
        '{"date":"2024-06-01","main_office":"True","quantity":"1"}'
    )
    assert one(df.select(P.props_typed(df, ["quantity", "tags"]))) == '{"quantity":1,"tags":"[1, 2]"}'
    assert '"gone":null' in one(df.select(P.props_json(df, cols, keep_nulls=True)))


def test_iso_text_keeps_fraction(spark):
    df = spark.sql("select timestamp_ntz'2024-01-02 03:04:05.25' as ts")
    assert one(df.select(P.iso_text(F.col("ts")))) == "2024-01-02T03:04:05.250000"


def test_json_forms(spark):
    df = spark.createDataFrame([('{"quantity": 1, "name": "O\'Neil", "ok": true, "d": {"z": 1, "a": 2}}',)], "props string")
    assert one(df.select(P.canonical_json(F.col("props")))) == '{"d":{"a":2,"z":1},"name":"O\'Neil","ok":true,"quantity":1}'
    assert one(df.select(P.stringify_json(F.col("props")))) == (
        '{"d":"{\\"a\\":2,\\"z\\":1}","name":"O\'Neil","ok":"True","quantity":"1"}'
    )
    text = one(df.select(P.props_literal_text(F.col("props"))))
    assert text.startswith("d: '") and text.endswith("name: 'O\\'Neil', ok: true, quantity: 1")


def test_key_access(spark):
    df = spark.createDataFrame([('{"a":null,"b":"2024-02-30","c":"2024-02-29","n":1}',)], "props string")
    p = F.col("props")
    row = df.select(
        P.prop_exists(p, "a"), P.prop_exists(p, "x"), P.prop_get(p, "n"), P.prop_date(p, "b"), P.prop_date(p, "c"),
        P.prop_set(p, "n", F.lit(2)), P.prop_set(p, "new", F.lit("v")), P.display_label(p, "a", "c"),
    ).first()
    assert tuple(row)[:5] == (True, False, "1", None, dt.date(2024, 2, 29))
    assert json.loads(row[5])["n"] == 2 and json.loads(row[6])["new"] == "v" and row[7] == "2024-02-29"


def test_exploded_entries_keep_types(spark):
    df = spark.createDataFrame([(7, "T", '{"a":1,"b":"1"}')], "id int, label string, props string")
    rows = {r["key"]: r for r in P.property_entries(df, "label", "id").collect()}
    assert rows["a"]["value"] == "1" and rows["b"]["value"] == '"1"'
    assert rows["a"]["value_text"] == rows["b"]["value_text"] == "1"
    assert {r["key"]: r["matched"] for r in P.props_explode(df, "b").collect()} == {"a": False, "b": True}


def test_names(spark):
    df = spark.createDataFrame([("Jon", "John", "Smith", "Smyth", "J.")], "a string, b string, c string, d string, e string")
    row = df.select(
        N.edit_distance(F.col("a"), F.col("b")), N.same_sound(F.col("c"), F.col("d")),
        N.initial_match(F.col("b"), F.col("e")), N.initial_match(F.col("a"), F.col("b")),
        N.hashed_identifier(F.lit(" A@b "), "s") == N.hashed_identifier(F.lit("a@B"), "s"),
    ).first()
    assert tuple(row) == (1, True, True, False, True)
