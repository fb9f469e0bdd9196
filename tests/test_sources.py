import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stockledger import settings
from stockledger.sources import tables as lake
from stockledger.streaming.ingest import ingest_stream, start_ingest
from tests.rows import day, frame


def test_lake_conf_reads_the_usual_variables():
    conf = settings.lake_conf_from_env(
        {"S3_ENDPOINT": "store:9000", "AWS_ACCESS_KEY_ID": "k", "AWS_SECRET_ACCESS_KEY": "s"}
    )
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert all(key.startswith("spark.hadoop.fs.s3a.") for key in conf)


def test_write_read_replace_and_cap(spark, tmp_path):
    lake.write_table(spark.range(10), str(tmp_path), "gold", "t")
    lake.write_table(spark.range(7), str(tmp_path), "gold", "t")
    assert lake.read_table(spark, str(tmp_path), "t", "gold").count() == 7
    assert lake.read_table(spark, str(tmp_path), "t", "gold", limit=3).count() == 3
    with pytest.raises(ValueError):
        lake.table_path(str(tmp_path), "platinum", "t")


def test_landing_fails_whole_when_a_source_is_missing(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/src/a")
    sources = {"a": f"{tmp_path}/src/a", "b": f"{tmp_path}/src/b"}
    with pytest.raises(AnalysisException):
        lake.land_bronze(spark, sources, f"{tmp_path}/lake")
    assert not (tmp_path / "lake").exists()
    landed = lake.land_bronze(spark, sources, f"{tmp_path}/lake", ["a"])
    assert {r.table_name: r.row_count for r in lake.row_counts(landed).collect()} == {"a": 3}


def test_extracts_keep_nulls_and_types_through_csv(spark, tmp_path):
    df = frame(
        spark, "id long, name string, d date, x double, ok boolean",
        [(1, "plain", day("2025-01-01"), 0.1, True), (2, 'with "quotes", commas', None, None, False),
         (3, None, day("1999-12-31"), -1e-9, None)],
    )
    paths = lake.export_table(df, str(tmp_path), "t")
    assert set(paths) == {"parquet", "csv"}
    back = lake.read_csv(spark, paths["csv"], df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_load_by_name_ignores_case_order_and_gaps(spark, tmp_path):
    frame(spark, "ID long, Name string", [(1, "a")]).write.parquet(f"{tmp_path}/1")
    frame(spark, "name string, id int, extra double", [("b", 2, 0.5)]).write.parquet(f"{tmp_path}/2")
    paths = [f"{tmp_path}/1", f"{tmp_path}/2"]
    loaded = lake.load_by_name(spark, paths)
    assert {(r.id, r.name, r.extra) for r in loaded.collect()} == {(1, "a", None), (2, "b", 0.5)}
    again = lake.load_by_name(spark, [*paths, *paths, *paths])
    assert again.count() == 6
    assert again._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    target = frame(spark, "NAME string, id long, missing date", []).schema
    shaped = lake.load_by_name(spark, paths, target)
    assert shaped.schema.simpleString() == target.simpleString()
    assert shaped.count() == 2


def test_files_of_one_folder_may_differ(spark, tmp_path):
    for folder, names in (("narrow first", ("a", "b")), ("wide first", ("b", "a"))):
        there = tmp_path / folder
        there.mkdir()
        rows = {names[0]: [(1, "x")], names[1]: [(2, "y", 0.5)]}
        for name, some in rows.items():
            kind = "id long, name string" + (", extra double" if len(some[0]) == 3 else "")
            frame(spark, kind, some).toPandas().to_parquet(there / f"{name}.parquet", index=False)
        loaded = lake.load_by_name(spark, [str(there)])
        assert {(r.id, r.name, r.extra) for r in loaded.collect()} == {(1, "x", None), (2, "y", 0.5)}
        landed = lake.land_bronze(spark, {"t": str(there)}, f"{tmp_path}/lake {folder}")["t"]
        assert sorted(landed.columns) == ["extra", "id", "name"] and landed.count() == 2


def test_load_table_replaces_and_reports(spark, tmp_path):
    for n in (5, 3):
        spark.range(n).write.mode("overwrite").parquet(f"{tmp_path}/raw")
        report = lake.load_table(spark, [f"{tmp_path}/raw"], str(tmp_path), "bronze", "t")
        assert [tuple(r) for r in report.collect()] == [("t", n)]
    assert lake.read_table(spark, str(tmp_path), "t").count() == 3


def test_private_columns_are_not_published(spark):
    df = frame(spark, "id long, _otp double, demand_weight double", [])
    assert lake.drop_private(df, ["demand_weight"]).columns == ["id"]


def test_views_serve_sql(spark):
    lake.register_views({"some_table": spark.range(4)})
    assert spark.sql("select sum(id) as s from some_table").first().s == 6


def test_shared_dir_is_the_sessions(spark):
    assert settings.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert settings.scratch(spark, "x") != settings.scratch(spark, "x")


def test_stream_takes_each_file_once(spark, tmp_path):
    events = spark.range(100).withColumn("v", F.col("id") * 2)
    places = [f"{tmp_path}/{name}" for name in ("in", "out", "progress")]
    for low, high in ((0, 30), (30, 60), (60, 60), (60, 100)):
        part = events.filter((F.col("id") >= low) & (F.col("id") < high))
        part.repartition(4).write.mode("append").parquet(places[0])
        ingest_stream(spark, *places, events.schema, files_per_batch=3)
        assert spark.read.parquet(places[1]).count() == high
    rows = spark.read.parquet(places[1])
    assert rows.distinct().count() == 100


def test_a_watching_stream_picks_up_later_files(spark, tmp_path):
    places = [f"{tmp_path}/{name}" for name in ("in", "out", "progress")]
    rows = spark.range(10).withColumn("part", F.col("id") % 2)
    rows.write.parquet(places[0])
    query = start_ingest(spark, *places, rows.schema, every="1 second", partition_by=["part"])
    try:
        query.processAllAvailable()
        assert spark.read.parquet(places[1]).count() == 10
        rows.write.mode("append").parquet(places[0])
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(places[1]).filter("part = 1").count() == 10
