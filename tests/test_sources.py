"""Readers, load reports and writers on temporary files."""

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailmeter import schemas
from hailmeter.catalog import queries
from hailmeter.sources import files, reports, tables


def test_declared_scan_matches_names_without_case(spark, tmp_path):
    path = str(tmp_path / "trips")
    spark.createDataFrame([(1, 5)], "PULOCATIONID int, vendorid int").write.parquet(path)
    row = files.scan_trip_files(spark, path, schemas.YELLOW_FILE).first()
    assert (row.PULocationID, row.VendorID, row.fare_amount) == (1, 5, None)


def test_int_and_long_files_read_together(spark, tmp_path):
    path = str(tmp_path / "trips")
    spark.createDataFrame([(1,)], "VendorID int").write.parquet(path)
    spark.createDataFrame([(2,)], "VendorID bigint").write.mode("append").parquet(path)
    scan = files.scan_trip_files(spark, path, schemas.YELLOW_FILE)
    assert sorted(r.VendorID for r in scan.collect()) == [1, 2]


def test_align_fills_casts_and_reorders(spark):
    old = spark.createDataFrame([("3", 1)], "FARE_AMOUNT string, vendorid int")
    new = spark.createDataFrame([(2, 4.5, 0.75)], "VendorID bigint, fare_amount double, extra double")
    rows = files.align_columns_by_name([old, new], schemas.YELLOW_FILE).collect()
    assert [(r.VendorID, r.fare_amount, r.extra) for r in rows] == [(1, 3.0, None), (2, 4.5, 0.75)]


ZONES = 'LocationID,Borough,Zone,service_zone\n1,EWR,"Newark, Airport",EWR\n264,Unknown,N/A,N/A\n'


def test_zone_csv_keeps_na_and_quotes(spark, tmp_path):
    (tmp_path / "zones.csv").write_text(ZONES + "x,bad,row,here\n5,Queens\n")
    rows = files.scan_zone_csv(spark, str(tmp_path / "zones.csv")).collect()
    assert [tuple(r) for r in rows] == [
        (1, "EWR", "Newark, Airport", "EWR"),
        (264, "Unknown", "N/A", "N/A"),
    ]


def test_rejects_survive_any_selection(spark, tmp_path):
    (tmp_path / "a.csv").write_text(ZONES + "x,bad,row,here\n")
    good, bad = files.tolerant_csv(spark, str(tmp_path), schemas.ZONE_FILE)
    assert (good.count(), bad.count()) == (2, 1)
    assert bad.select("line").first()[0] == "x,bad,row,here"


def test_csv_load_history(spark, tmp_path):
    (tmp_path / "a.csv").write_text(ZONES)
    (tmp_path / "b.csv").write_text(ZONES + "x,bad,row,here\n")
    (tmp_path / "c.csv").write_text(ZONES.splitlines()[0] + "\n")
    rows = reports.load_history_csv(spark, str(tmp_path), schemas.ZONE_FILE).collect()
    assert [(r.file_name, r.status, r.row_count, r.row_parsed) for r in rows] == [
        ("a.csv", "LOADED", 2, 2),
        ("b.csv", "PARTIALLY_LOADED", 2, 3),
        ("c.csv", "LOADED", 0, 0),
    ]
    assert rows[1].first_error_message == "x,bad,row,here"


def test_load_history_of_odd_names(spark, make_feed, tmp_path):
    folder = tmp_path / "to load, 100%+"
    folder.mkdir()
    (folder / "a b.csv").write_text(ZONES)
    (folder / "c%d+.csv").write_text(ZONES + "x,bad,row,here\n")
    rows = reports.load_history_csv(spark, str(folder), schemas.ZONE_FILE).collect()
    assert [(r.file_name, r.status, r.row_count, r.row_parsed) for r in rows] == [
        ("a b.csv", "LOADED", 2, 2),
        ("c%d+.csv", "PARTIALLY_LOADED", 2, 3),
    ]
    trips = tmp_path / "par quet"
    make_feed("yellow", {}, {}).coalesce(1).write.parquet(str(trips))
    rows = reports.load_history_parquet(spark, str(trips), schemas.YELLOW_FILE).collect()
    assert [(r.status, r.row_count) for r in rows] == [("LOADED", 2)]


def test_corrupt_parquet_is_skipped_and_reported(spark, make_feed, tmp_path):
    path = tmp_path / "yellow"
    make_feed("yellow", {}, {}).coalesce(1).write.parquet(str(path))
    (path / "broken.parquet").write_bytes(b"PAR1 this is not parquet PAR1")
    scan = files.scan_trip_files(spark, str(path), schemas.YELLOW_FILE, tolerant=True)
    assert scan.count() == 2
    rows = reports.load_history_parquet(spark, str(path), schemas.YELLOW_FILE).collect()
    by_name = {r.file_name == "broken.parquet": r for r in rows}
    assert by_name[True].status == "LOAD_FAILED"
    assert (by_name[False].status, by_name[False].row_count) == ("LOADED", 2)
    with pytest.raises(Exception):
        files.scan_trip_files(spark, str(path), schemas.YELLOW_FILE).collect()


def test_a_broken_folder_of_many_files_is_one_row(spark, sf_dir):
    scene = queries.Scene(spark, sf_dir)
    given = scene.bronze
    scene.bronze = SimpleNamespace(green=given.green, zones=given.zones.repartition(4))
    path = queries._land_with_a_broken_file(scene).replace("*", "broken")
    assert len(spark.read.text(path).inputFiles()) == 4
    history = queries.load_history_parquet(scene).collect()
    assert sorted(r.status for r in history) == ["LOADED", "LOAD_FAILED"]
    assert queries.tolerant_load_parquet(scene).count() == given.green.count()


def test_tolerant_cast(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    good, bad = files.tolerant_cast(
        spark.createDataFrame([("1",), ("x",), (None,)], "n string"), schema
    )
    assert sorted((r.n for r in good.collect()), key=str) == [1, None]
    assert [r.n for r in bad.collect()] == ["x"]


def test_hourly_json(spark, tmp_path):
    arrays = {name: [1.5, None] for name in schemas.HOURLY_ARRAYS}
    arrays["time"] = ["2025-03-09T02:00", "2025-03-09T03:00"]
    arrays["weather_code"] = [61, 50]
    arrays["relative_humidity_2m"] = [40, None]
    (tmp_path / "a.json").write_text(json.dumps({"latitude": 1, "hourly": arrays}, indent=1))
    df = files.flatten_hourly_json(spark, str(tmp_path))
    assert [(f.name, f.dataType) for f in df.schema.fields] == [
        (f.name, f.dataType) for f in schemas.HOURLY_WEATHER.fields
    ]
    rows = df.orderBy("datetime_local").collect()
    assert [str(r.datetime_local) for r in rows] == ["2025-03-09 02:00:00", "2025-03-09 03:00:00"]
    assert [r.weather_description for r in rows] == ["Slight rain", "Unknown"]
    assert rows[1].temperature_f is None


def test_schema_drift(spark):
    df = spark.createDataFrame([(1, None, 2)], "vendorid bigint, FARE_AMOUNT string, surge int")
    rows = {r.column_name: r for r in reports.schema_drift(df, schemas.YELLOW_FILE).collect()}
    assert rows["vendorid"].status == "ok"
    assert (rows["FARE_AMOUNT"].status, rows["FARE_AMOUNT"].non_null_count) == ("type_changed", 0)
    assert rows["surge"].status == "extra"
    assert rows["tip_amount"].status == "missing"


def test_inventory(spark, make_feed, tmp_path):
    path = str(tmp_path / "yellow")
    make_feed("yellow", {}, dict(pickup="2025-05-01 00:00:00")).coalesce(1).write.parquet(path)
    make_feed("yellow", {}).coalesce(1).write.mode("append").parquet(path)
    scan = files.scan_trip_files(spark, path, schemas.YELLOW_FILE)
    units = reports.file_inventory(scan, "tpep_pickup_datetime")
    spans = sorted((r.row_count, r.first_month, r.last_month) for r in units.collect())
    assert spans == [(1, "2025-03", "2025-03"), (2, "2025-03", "2025-05")]
    check = reports.inventory_check(units, expected=2).first()
    assert (check.landed_count, check.as_expected) == (2, True)


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = {r.column_name: r for r in reports.profile_columns(df).collect()}
    assert (rows["b"].column_type, rows["b"].non_null_count, rows["b"].sample_value) == ("string", 1, "x")
    assert (rows["a"].row_count, rows["a"].column_count) == (2, 2)


def test_overwrite_is_idempotent_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    path = str(tmp_path / "t")
    for _ in range(2):
        stored = tables.overwrite_table(df, path, partition_by=["p"], rebalance=True)
    assert sorted(map(tuple, stored.collect())) == [(1, "a"), (2, "b")]
    changed = spark.createDataFrame([(9, "b")], "n int, p string")
    stored = tables.overwrite_table(changed, path, partition_by=["p"], only_touched=True)
    assert sorted(map(tuple, stored.collect())) == [(1, "a"), (9, "b")]


def test_append_casts_to_the_declared_schema(spark, tmp_path):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])
    path = str(tmp_path / "t")
    tables.append_small_frame(spark, [(1, "a")], path, schema)
    loose = spark.createDataFrame([("b", 2)], "s string, n int")
    rows = tables.append_table(loose, path, schema).collect()
    assert sorted(map(tuple, rows)) == [(1, "a"), (2, "b")]


def test_sample_is_repeatable(spark):
    df = spark.range(100).repartition(7)
    assert [r.id for r in reports.sample_rows(df, 3, ["id"]).collect()] == [0, 1, 2]


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.publish_table(spark.range(5), path)
    broken = spark.range(0, 100, 1, 4).selectExpr("CAST(if(id = 90, raise_error('midway'), id) AS BIGINT) AS id")
    with pytest.raises(Exception, match="midway"):
        tables.publish_table(broken, path)
    assert tables.read_published(spark, path).count() == 5
    for n in (6, 7, 8):
        assert tables.publish_table(spark.range(n), path).count() == n
        assert tables.read_published(spark, path).count() == n
    assert len(tables.table_versions(spark, path)) == 2
    with pytest.raises(FileNotFoundError):
        tables.read_published(spark, str(tmp_path / "none"))


def test_a_table_may_be_published_from_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    tables.publish_table(spark.range(5), path)
    more = tables.read_published(spark, path).selectExpr("id + 1 AS id")
    assert tables.publish_table(more, path).agg({"id": "sum"}).first()[0] == 15


def test_observed_write_counts_what_it_writes(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "if(id % 4 = 0, null, id) AS v", "id % 3 AS p")
    metrics = {"rows": F.count(F.lit(1)), "null v": F.count_if(F.col("v").isNull())}
    stored, seen = tables.write_observed(
        df, str(tmp_path / "t"), metrics, partition_by=["p"], rebalance=True
    )
    assert seen == {"rows": 1000, "null v": 250} and stored.count() == 1000


def test_history_of_half_a_parquet_file(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "in"
    folder.mkdir()
    rows = pa.table({"a": pa.array(range(40_000)), "b": pa.array([str(i) for i in range(40_000)])})
    for name in ("good", "half", "torn"):
        pq.write_table(rows, folder / f"{name}.parquet", row_group_size=10_000, compression="snappy")
    whole = (folder / "half.parquet").read_bytes()
    meta = pq.ParquetFile(folder / "half.parquet").metadata
    at = meta.row_group(2).column(0).dictionary_page_offset or meta.row_group(2).column(0).data_page_offset
    (folder / "half.parquet").write_bytes(whole[:at] + b"\xff" * 400 + whole[at + 400 :])
    (folder / "torn.parquet").write_bytes(whole[: len(whole) // 2])
    schema = "a long, b string"
    history = reports.load_history_parquet(
        spark, str(folder), T._parse_datatype_string(schema)
    ).collect()
    found = {r.file_name: r for r in history}
    assert tuple(found["good.parquet"])[1:] == ("LOADED", 40_000, 40_000, None)
    half = found["half.parquet"]
    assert half.status == "PARTIALLY_LOADED" and 0 < half.row_count < half.row_parsed == 40_000
    assert half.first_error_message == f"{40_000 - half.row_count} of 40000 rows unreadable"
    assert tuple(found["torn.parquet"])[1:] == ("LOAD_FAILED", 0, 0, "no readable rows")
