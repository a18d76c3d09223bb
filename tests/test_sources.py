import json

import pytest

from holdfast.session import fresh_path, stage
from holdfast.sources import messages, schemas, tables
from pyspark.sql import functions as F


def test_schema_file(tmp_path):
    path = tmp_path / "t.json"
    path.write_text(json.dumps([{"name": "a", "type": "STRING", "mode": "REQUIRED", "description": "key"}, {"name": "b", "type": "FLOAT64"}]))
    got = schemas.struct_type_from_json(str(path))
    assert not got["a"].nullable and got["b"].nullable and got["b"].dataType.typeName() == "double"
    with pytest.raises(ValueError):
        schemas.struct_type([{"name": "a", "type": "GEOGRAPHY"}])


def test_declared_schemas():
    widths = {name: len(schemas.schema_of(ddl)) for name, ddl in schemas.SOURCE_TABLES.items()}
    assert widths == {"demographics": 23, "academic_records": 12, "financial_aid": 10, "enrollment_events": 6}
    assert len(schemas.schema_of(schemas.PREDICTION_LOG)) == 9


def test_parquet_csv_and_absent_tables(spark, tmp_path):
    ddl = {"one": "k string, x double", "two": "k string, x double", "three": "k string"}
    df = spark.createDataFrame([("a", 1.5), ("b", float("nan"))], schemas.schema_of(ddl["one"]))
    tables.write_parquet(df, f"{tmp_path}/one.parquet")
    tables.write_csv(df.where("k = 'a'"), f"{tmp_path}/two.csv")
    found = tables.read_source_tables(spark, str(tmp_path), ddl)
    assert set(found) == {"one", "two"}
    assert sorted(found["one"].collect()) == [("a", 1.5), ("b", None)]
    assert found["two"].collect() == [("a", 1.5)]


def test_table_dispositions(spark, tmp_path):
    spark.sql("create database if not exists holdfast_test")
    name = "holdfast_test.t" + fresh_path(spark, "x")[-8:]
    df = spark.sql("select 'a' as k, date'2024-01-02' as d")
    try:
        assert tables.load_table(df, name) == 1
        assert tables.load_table(df, name, "append") == 2
        with pytest.raises(ValueError):
            tables.load_table(df, name, "empty")
        with pytest.raises(ValueError):
            tables.load_table(df, name, "merge")
        assert tables.load_table(df, name, "truncate") == 1
        assert dict(tables.read_table(spark, name).dtypes)["d"] == "timestamp"
        assert tables.table_info(spark, name).first()["num_rows"] == 1
        tables.write_parquet(df, f"{tmp_path}/src.parquet")
        assert tables.load_tables(spark, str(tmp_path), {"src": name}).collect() == [(name, 1)]
        with pytest.raises(FileNotFoundError):
            tables.load_tables(spark, str(tmp_path), {"gone": name})
        assert tables.run_sql(spark, "select count(*) as n from {t}", t=df).first()["n"] == 1
    finally:
        spark.sql(f"drop table if exists {name}")


def test_clustered_layout_prunes(spark, tmp_path):
    df = spark.range(600).selectExpr("cast(201900 + id as bigint) as term_code", "id % 3 as campus")
    path = f"{tmp_path}/academic"
    tables.write_clustered(df, path, "term_range", tables.range_bucket("term_code", 100), ["campus"])
    back = spark.read.parquet(path)
    assert back.count() == 600 and back.where("term_range = 202000").count() == 100
    assert "PartitionFilters: [isnotnull(term_range" in back.where("term_range = 202000")._jdf.queryExecution().toString()


def test_stage_and_report(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, s string")
    assert stage(df, "first", str(tmp_path)).collect() == [(1, "a")]
    tables.write_json_report(df, f"{tmp_path}/report")
    assert spark.read.json(f"{tmp_path}/report").first()["s"] == "a"


def test_envelope_round_trip(spark):
    df = spark.createDataFrame([("x" * 200, 3)], "reason string, n int")
    sent = df.select(messages.encode(F.struct("reason", "n")).alias("data"))
    back = sent.select(messages.decode(F.col("data"), "reason string, n int").alias("b")).select("b.*")
    assert back.collect() == [("x" * 200, 3)]


def test_bucketed_tables_join_without_a_shuffle(spark, sf):
    from holdfast.plans import storage

    plan = storage.bucketed_lines(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert "Exchange" not in plan
