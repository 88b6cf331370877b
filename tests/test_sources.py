import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.operators.layout import publish_table
from curbline.plans import tables
from curbline.session import new_work_dir, shared_dir
from curbline.sources import derived, files, landing, rescue, storage
from curbline.sources import trips as trip_files
from curbline.sources.lake import Lake


def test_audit_checks_size_and_both_marks(spark, tmp_path):
    contents = {
        "good": b"PAR1" + b"x" * 32 + b"PAR1",
        "short": b"PAR1" + b"x" * 3 + b"PAR1",
        "head": b"XXXX" + b"x" * 32 + b"PAR1",
        "tail": b"PAR1" + b"x" * 32 + b"XXXX",
        "empty": b"",
    }
    for name, data in contents.items():
        (tmp_path / f"{name}.parquet").write_bytes(data)
    (tmp_path / "other.csv").write_text("a")
    audit = landing.audit_files(landing.landed_files(spark, str(tmp_path)), minimum_bytes=40)
    status = {r.path.rsplit("/", 1)[1]: r.status for r in audit.collect()}
    assert status.pop("good.parquet") == "valid"
    assert len(status) == 4 and set(status.values()) == {"invalid"}
    summary = {r.status: (r.file_count, r.total_bytes) for r in landing.landing_summary(audit).collect()}
    assert summary == {"valid": (1, 40), "invalid": (4, 91)}


def test_default_minimum_is_ten_megabytes(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"PAR1" + b"x" * 32 + b"PAR1")
    audit = landing.audit_files(landing.landed_files(spark, str(tmp_path)))
    assert [(r.has_marks, r.status) for r in audit.collect()] == [(True, "invalid")]


def test_missing_months(spark):
    landed = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), ("a", 1)], "s string, m int")
    gaps = landing.missing_months(landed, "m", 3, by=["s"])
    assert sorted((r.s, r.month) for r in gaps.collect()) == [("a", 2), ("b", 1), ("b", 3)]
    assert [r.month for r in landing.missing_months(landed, "m", 4).collect()] == [4]
    nothing = landing.missing_months(landed.where("false"), "m", 2)
    assert sorted(r.month for r in nothing.collect()) == [1, 2]
    for count in (0, 13):
        with pytest.raises(ValueError):
            landing.missing_months(landed, "m", count)


def test_rescue_casts_and_keeps_misfits(spark):
    target = T.StructType.fromDDL("a int, b double, c string")
    frame = spark.createDataFrame([("1", "x", 7), ("2", "2.5", None), (None, None, None)], "a string, b string, extra int")
    rows = rescue.rescue(frame, target).collect()
    assert [(r.a, r.b, r.c) for r in rows] == [(1, None, None), (2, 2.5, None), (None, None, None)]
    assert [r._rescued_data for r in rows] == ['{"b":"x","extra":7}', None, None]


def test_new_columns_go_to_the_end(spark):
    known = T.StructType.fromDDL("a int")
    one = spark.createDataFrame([(1, 2.0)], "a int, n double")
    other = spark.createDataFrame([("x", 1, 1)], "a string, n int, m bigint")
    evolved = rescue.evolve(known, [one, other])
    assert evolved.simpleString() == "struct<a:int,m:bigint,n:string>"


def test_saved_schema_versions(spark, tmp_path):
    location = str(tmp_path / "schemas")
    assert rescue.latest_schema(spark, location) is None
    for version, ddl in enumerate(("a int", "a int, b string")):
        rescue.save_schema(spark, location, version, T.StructType.fromDDL(ddl))
    assert rescue.latest_schema(spark, location).names == ["a", "b"]
    assert rescue.latest_schema(spark, location, before=1).names == ["a"]
    assert rescue.latest_schema(spark, location, before=0) is None


def test_zone_file(spark, tmp_path):
    lines = ["LocationID,Borough,Zone,service_zone,longitude,latitude"]
    lines += [f"{i},Queens,Zone {i},Boro Zone,-73.9,40.7" for i in range(1, 264)]
    path = tmp_path / "zones.csv"
    path.write_text("\n".join(lines) + "\n")
    zones = trip_files.read_zones(spark, str(path))
    assert zones.columns == ["location_id", "borough", "zone", "service_zone", "longitude", "latitude"]
    assert zones.count() == 263 and dict(zones.dtypes)["location_id"] == "int"


def test_year_comes_from_the_file_name(spark):
    paths = spark.createDataFrame(
        [("/l/yellow_2024/yellow_tripdata_2024-03.parquet",), ("/l/other.parquet",)], "_source_file string"
    )
    assert [r[0] for r in paths.select(trip_files.source_year()).collect()] == ["2024", ""]


def test_landing_writes_one_folder_per_month(spark, sf_dir, tmp_path):
    path = str(tmp_path / "landing")
    trip_files.land_trips(tables.raw_trips(spark, sf_dir), path)
    read = trip_files.read_trips(spark, path)
    assert read.where(F.col("_source_file").isNull()).count() == 0
    months = read.select(F.date_format("tpep_pickup_datetime", "yyyy-MM").alias("m"), "_source_file")
    assert months.where(~F.col("_source_file").contains(F.col("m"))).count() == 0


def test_work_dirs_are_new_and_shared(spark):
    one, two = new_work_dir(spark, "x"), new_work_dir(spark, "x")
    assert one != two and one.startswith(storage.qualified(spark, shared_dir(spark))) and ":" in one
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_published_tables_carry_their_layer(spark, tmp_path):
    frame = spark.createDataFrame([(1,)], "a int")
    publish_table(frame, "curbline_fares", str(tmp_path / "t"), "gold", "Receipt parts")
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED curbline_fares").collect()}
    assert "quality=gold" in described["Table Properties"]
    assert described["Comment"] == "Receipt parts"
    assert spark.table("curbline_fares").collect()[0].a == 1
    spark.sql("DROP TABLE curbline_fares")


def test_values_that_would_lose_something_are_rescued(spark):
    frame = spark.sql(
        "SELECT 2.7D AS a, timestamp'2025-01-02 03:04:05' AS b, 9007199254740993L AS c, '1.50' AS d, date'2025-01-02' AS E"
        " UNION ALL SELECT 2D, timestamp'2025-01-02 00:00:00', 5L, 'x', date'2025-01-03'"
    )
    target = T.StructType.fromDDL("a int, b date, c double, d double, e timestamp")
    rows = rescue.rescue(frame, target).orderBy("e").collect()
    assert [rows[0][c] for c in "abc"] == [None] * 3 and rows[0].d == 1.5
    assert set(json.loads(rows[0][rescue.RESCUED])) == {"a", "b", "c"}
    assert rows[1].a == 2 and rows[1].c == 5.0 and json.loads(rows[1][rescue.RESCUED]) == {"d": "x"}


def test_uris_are_named_as_arrow_knows_them():
    known = {"s3a://b/k": "s3://b/k", "file:///a/b": "/a/b", "file:/a/b": "/a/b", "/a/b": "/a/b", "hdfs://n/a": "hdfs://n/a"}
    assert {uri: files.arrow_uri(uri) for uri in known} == known


def test_listing_goes_through_all_folders(spark, tmp_path):
    for name in ("a.parquet", "one/b.parquet", "one/two/c.parquet", "one/two/d.csv", "_hidden/e.parquet", ".f.parquet"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * len(name))
    (tmp_path / "empty").mkdir()
    found = {r.path.rsplit("/", 1)[1]: r.bytes for r in landing.landed_files(spark, str(tmp_path)).collect()}
    assert found == {"a.parquet": 9, "b.parquet": 13, "c.parquet": 17}
    assert landing.landed_files(spark, str(tmp_path / "nowhere")).isEmpty()


def test_a_second_look_tells_what_changed(spark, tmp_path):
    lake, zone = Lake(spark, str(tmp_path / "lake")), tmp_path / "zone"
    zone.mkdir()
    for name in ("same", "longer", "gone"):
        (zone / f"{name}.parquet").write_bytes(b"PAR1PAR1")
    look = lambda: {r.path.rsplit("/", 1)[1][:-8]: r.change for r in landing.take_listing(lake, str(zone)).collect()}
    assert set(look().values()) == {"new"}
    (zone / "longer.parquet").write_bytes(b"PAR1--PAR1")
    (zone / "gone.parquet").unlink()
    (zone / "added.parquet").write_bytes(b"")
    assert look() == {"same": "same", "longer": "changed", "gone": "gone", "added": "new"}
    assert look() == {"same": "same", "longer": "same", "added": "same"}


def test_missing_months_come_from_names(spark):
    files = spark.createDataFrame(
        [("s1/yellow_tripdata_2025-01.parquet", 1), ("s1/yellow_tripdata_2025-03/x.parquet", 1), ("s2/yellow_tripdata_2024-02.parquet", 2), ("s2/none.parquet", 2)],
        "path string, s int",
    )
    gaps = sorted((r.s, r.month) for r in landing.missing_files(files, 2025, 3, by=["s"]).collect())
    assert gaps == [(1, 2), (2, 1), (2, 2), (2, 3)]
    assert sorted(r.month for r in landing.missing_files(files, 2025, 3).collect()) == [2]


def test_trips_are_ordered_before_their_columns_are_made(spark, sf_dir):
    seen = []

    def arranged(rows):
        seen.extend(rows.columns)
        return rows.repartitionByRange(3, *derived.TRIP_ORDER)

    ordered = derived.trips(spark, sf_dir, arranged)
    assert len(seen) < len(ordered.columns) / 2
    plain = derived.trips(spark, sf_dir)
    assert ordered.exceptAll(plain).isEmpty() and plain.exceptAll(ordered).isEmpty()
