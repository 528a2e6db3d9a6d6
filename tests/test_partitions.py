import datetime as dt

import pytest
from pyspark.sql import functions as F

from knotwork.operators import graph as G
from knotwork.operators import partitions as R
from knotwork.sources import writers as W
from knotwork.sources.clustered import ClusteredTable


def test_half_open_ranges(spark):
    ids = spark.createDataFrame([(x,) for x in (-1, 0, 999_999, 1_000_000, 5_000_000, None)], "id bigint")
    placed, refused = R.id_range_partition(ids, R.VERTEX_ID_BOUNDS, F.col("id"))
    assert {r["id"]: r["part"] for r in placed.collect()} == {
        0: "id_0", 999_999: "id_0", 1_000_000: "id_1000000", 5_000_000: "id_2000000"
    }
    assert {r["id"] for r in refused.collect()} == {-1, None}


def test_property_ranges_have_holes(spark):
    rows = spark.createDataFrame([(f'{{"id":"{x}"}}',) for x in (1, 999, 1000, 1001, 2000, "abc")], "props string")
    placed, refused = R.property_id_partition(rows)
    assert sorted(r["part"] for r in placed.collect()) == ["id_1", "id_1", "id_1001"]
    assert refused.count() == 3
    check = R.range_spec_check(R.spec_frame(spark, R.id_ranges("City", R.PROPERTY_ID_BOUNDS))).collect()
    assert [tuple(r) for r in check] == [("City", "gap", "1000", "1001")]
    overlap = R.spec_frame(spark, R.id_ranges("City", [(0, 10), (5, None)]))
    assert [tuple(r)[1:3] for r in R.range_spec_check(overlap).collect()] == [("overlap", "5")]
    nested = R.spec_frame(spark, R.id_ranges("City", [(0, 100), (1, 5), (50, 60)]))
    assert sorted(tuple(r)[1:] for r in R.range_spec_check(nested).collect()) == [("overlap", "1", "5"), ("overlap", "50", "60")]
    dates = R.spec_frame(spark, R.year_ranges("City", [2023, 2025]))
    assert [tuple(r)[1:] for r in R.range_spec_check(dates).collect()] == [("gap", "2024-01-01", "2025-01-01")]


def test_years(spark):
    days = spark.createDataFrame([(dt.date(y, 1, 1),) for y in (2019, 2024, 2027)] + [(None,)], "day date")
    as_of = dt.date(2026, 5, 1)
    assert [r[0] for r in days.select(R.year_partition(F.col("day"), as_of)).collect()] == ["default", "y2024", "y2027", "default"]
    placed, refused = R.year_partition_strict(days, F.col("day"), R.STRICT_YEARS)
    assert placed.count() == 1 and refused.count() == 3
    spec = R.year_ranges("P", [2023, 2024, 2025], with_default=True)
    touched = lambda a, b: R.touched_partitions(spec, "P", dt.date(*a), dt.date(*b))
    assert touched((2023, 5, 1), (2025, 1, 1)) == ["y2023", "y2024"]
    assert touched((2022, 5, 1), (2023, 1, 2)) == ["y2023", "default"] and touched((2025, 5, 1), (2026, 1, 2)) == ["y2025", "default"]
    assert touched((2019, 1, 1), (2020, 1, 1)) == ["default"]
    ids = R.id_ranges("P", [(0, 10), (20, 30), (30, None)])
    assert R.touched_partitions(ids, "P", 5, 25) == ["id_0", "id_20"] and R.touched_partitions(ids, "P", 100, 200) == ["id_30"]


def test_retention(spark):
    as_of = dt.date(2026, 1, 1)
    names = spark.createDataFrame([(f"person_{s}",) for s in ("y2022", "y2023", "default", "yabc")], "name string")
    got = {r["name"]: r["status"] for r in R.expired_partitions(names, as_of).collect()}
    assert got == {"person_y2022": "expired", "person_y2023": "kept", "person_yabc": "unparsable"}
    rows = spark.createDataFrame([("y2022",), ("y2023",), ("default",)], "part string")
    kept, archived = R.retention_split(rows, as_of)
    assert {r[0] for r in archived.collect()} == {"y2022"} and kept.count() == 2
    spec = R.spec_frame(spark, R.year_ranges("Person", [2026, 2027], with_default=True))
    assert [r["name"] for r in R.future_partitions(spec, as_of).collect()] == ["y2028"]


def test_missing_dates_and_reports(spark):
    rows = spark.createDataFrame([("P", 1, '{"created_at":"2024-01-05"}'), ("P", 2, "{}")], "label string, id bigint, props string")
    dated = R.union_dated_undated(rows, "created_at", dt.date(2026, 1, 1))
    assert {r["id"]: str(r["created_at"]) for r in dated.collect()} == {1: "2024-01-05", 2: "2026-01-01"}
    placed = dated.withColumn("part", R.year_partition(F.col("created_at"), dt.date(2026, 1, 1)))
    spec = R.spec_frame(spark, R.year_ranges("P", range(2024, 2028), with_default=True))
    info = R.partition_info(placed, spec).first()["partitions"]
    assert [(p["name"], p["n"]) for p in info] == [("default", 0), ("y2024", 1), ("y2025", 0), ("y2026", 1), ("y2027", 0)]
    assert {r["pct"] for r in R.partition_distribution(placed).collect()} == {50.0}


def test_hash_is_even(spark):
    n = [r["count"] for r in R.hash_partition(spark.range(20_000), 8).groupBy("part").count().collect()]
    assert len(n) == 8 and max(n) < 1.1 * min(n)


def test_write_prune_and_rewrite(spark, tmp_path):
    rows = spark.range(1000).select(
        F.lit("Order").alias("label"), "id", F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("created_at"), F.lit("{}").alias("props")
    )
    dated = rows.withColumn("part", R.year_partition(F.col("created_at"), dt.date(2024, 6, 1)))
    path = str(tmp_path / "graph")
    W.write_partitioned_graph(dated, path, bloom_columns=("id",))
    stored = spark.read.parquet(path)
    spec = R.year_ranges("Order", range(2022, 2026), with_default=True)
    lo, hi = dt.date(2024, 2, 1), dt.date(2024, 3, 1)
    scan = G.range_scan(stored, "Order", "created_at", lo, hi, spec)
    assert scan.count() == 29
    for a, b in (("2021-01-01", "2022-06-01"), ("2021-05-01", "2026-05-01"), ("2025-01-01", "2031-01-01"), ("2030-01-01", "2031-01-01")):
        days = dt.date.fromisoformat(a), dt.date.fromisoformat(b)
        pruned, plain = (G.range_scan(stored, "Order", "created_at", *days, s) for s in (spec, None))
        assert pruned.count() == plain.count()
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(label" in plan and "part#" in plan and "PushedFilters: [IsNotNull(created_at)" in plan
    read = scan.select(F.col("_metadata.file_path")).distinct().collect()
    assert read and all("part=y2024" in r[0] for r in read)
    sizes = R.table_sizes(spark, path).first()
    assert sizes["rows"] == 1000 and sizes["bytes"] > 0
    page = G.table_page(stored, "Order", 3, "y2024").collect()
    assert [r["id"] for r in page] == [365, 366, 367] and page[0]["total"] == 366


def test_clustered_files_are_picked_on_two_keys(spark, tmp_path):
    rows = spark.range(40_000).select(
        "id", (F.xxhash64("id") % 1000).cast("int").alias("size"), F.date_add(F.lit("2020-01-01"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2000)).cast("int")).alias("day"),
    ).withColumn("day", F.when(F.col("id") % 50 != 0, F.col("day")))
    table = ClusteredTable(spark, str(tmp_path / "t"))
    table.write(rows, ["id", "day"], 64)
    assert not [p for p in (tmp_path / "t" / "data").iterdir() if p.is_dir()]
    whole = table.files({})
    days = dt.date(2021, 3, 1), dt.date(2021, 9, 1)
    for wanted in ({"id": (1000, 3500), "day": days}, {"id": (None, 700)}, {"day": (days[0], None)}, {"id": (90_000, None)}, {"day": (None, dt.date(2019, 1, 1))}):
        plain = rows
        for key, (low, high) in wanted.items():
            plain = plain.filter(F.lit(True) if low is None else F.col(key) >= F.lit(low)).filter(F.lit(True) if high is None else F.col(key) < F.lit(high))
        assert sorted(table.scan(wanted).collect()) == sorted(plain.collect())
    assert len(whole) >= 60 and len(table.files({"id": (1000, 3500), "day": days})) <= 8
    assert len(table.files({"id": (1000, 3500)})) <= 20 and len(table.files({"day": days})) <= 20 and table.files({"id": (90_000, None)}) == []
    read = table.scan({"id": (1000, 3500), "day": days}).select("_metadata.file_path").distinct().count()
    assert read <= 8


def test_curve_of_skewed_null_and_few_keys(spark, tmp_path):
    rows = spark.range(2000).select(F.when(F.col("id") > 1500, F.lit(7)).alias("a"), F.lit(None).cast("date").alias("b"), "id")
    table = ClusteredTable(spark, str(tmp_path / "t"))
    table.write(rows, ["a", "b"], 8)
    assert table.scan({"a": (7, 8)}).count() == 499 and table.scan({"b": (dt.date(2020, 1, 1), None)}).count() == 0
    assert table.ranges().agg(F.max("rows")).first()[0] < 1000
    empty = ClusteredTable(spark, str(tmp_path / "e"))
    empty.write(rows.limit(0), ["a", "b"], 8)
    assert empty.scan({"a": (None, 3)}).columns == ["a", "b", "id"] and empty.scan({"a": (None, 3)}).isEmpty()


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    v = spark.range(200).select("id", F.lit("T").alias("label"))
    e = spark.range(400).select((F.col("id") % 200).alias("start_id"), F.lit("E").alias("edge"))
    W.save_bucketed(v, "bucketed_v", "id", 4, str(tmp_path / "v"))
    W.save_bucketed(e, "bucketed_e", "start_id", 4, str(tmp_path / "e"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = spark.table("bucketed_e").join(spark.table("bucketed_v"), F.col("start_id") == F.col("id"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table bucketed_v")
        spark.sql("drop table bucketed_e")


def test_property_index_is_stored_by_label(spark, tmp_path):
    from knotwork.operators.ingest import property_index

    v = spark.createDataFrame([("T", 1, '{"a":1,"b":"x"}'), ("U", 2, '{"a":2}')], "label string, id bigint, props string")
    path = str(tmp_path / "index")
    W.write_property_index(property_index(v), path)
    hits = spark.read.parquet(path).filter("label = 'T' and key = 'a' and value_text = '1'")
    assert [r["id"] for r in hits.collect()] == [1]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(key,a)" in plan and "PartitionFilters: [isnotnull(label" in plan
