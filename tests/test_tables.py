"""Schema helpers, table writers and streams."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from govmill.functions import schemas
from govmill.session import shared_folder
from govmill.sources import tables
from govmill.streaming import snapshots

T0 = dt.datetime(2024, 1, 1)


def test_schema_diff(spark):
    df = spark.createDataFrame([], "A int, b string, c double")
    got = schemas.schema_diff(df, T.StructType.fromDDL("a bigint, B string, d date")).collect()
    assert {(r.column, r.issue) for r in got} == {("A", "TYPE MISMATCH"), ("c", "ONLY IN DF"), ("d", "ONLY IN TABLE")}


def test_conform_is_idempotent(spark):
    target = T.StructType.fromDDL("B bigint, a string, x date")
    df = spark.createDataFrame([(1, 2, 3)], "A int, b int, extra int")
    once = schemas.conform_to_schema(df, target)
    assert once.schema == target and [tuple(r) for r in once.collect()] == [(2, "1", None)]
    assert schemas.conform_to_schema(once, target).collect() == once.collect()


def test_exact_columns_and_candidates(spark):
    df = spark.createDataFrame([], "a int, b int")
    assert schemas.assert_exact_columns(df, ["a", "b"]) is df
    with pytest.raises(ValueError):
        schemas.assert_exact_columns(df, ["b", "a"])
    assert schemas.resolve_columns(df, ["x", "b"]) == "b"
    with pytest.raises(ValueError, match="a"):
        schemas.resolve_columns(df, ["x"])


def test_typed_rows_without_rows(spark):
    schema = T.StructType.fromDDL("id string, n int")
    assert schemas.typed_rows(spark, [], schema).schema == schema
    assert [tuple(r) for r in schemas.typed_rows(spark, [{"n": 3}], schema).collect()] == [(None, 3)]


def test_merge_twice_adds_once(spark, inputs):
    table = f"{inputs.database()}.h"
    df = spark.createDataFrame([(T0, 1)], "SnapshotUtc timestamp, n int")
    for _ in range(2):
        tables.merge_insert_only(df, table, ["SnapshotUtc"])
    assert spark.table(table).count() == 1


def test_append_aligns_types(spark, inputs):
    table = f"{inputs.database()}.h"
    tables.append_rows(spark.createDataFrame([(1, "x")], "score int, name string"), table)
    tables.append_rows(spark.createDataFrame([("y", 2, 9)], "NAME string, Score bigint, extra int"), table)
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "x"), (2, "y")]


def test_alert_stream_keeps_state_between_runs(spark):
    folder = shared_folder(spark)
    schema = T.StructType.fromDDL("key string, ts timestamp, total bigint, region string")
    days = [T0 + dt.timedelta(days=i) for i in range(4)]
    parts = [[("a", days[0], 100, "x")], [("a", days[1], 104, "x"), ("a", days[0], 100, "x")], [("a", days[2], 110, "y"), ("b", days[2], 1, None)], [("a", days[3], 50, "y")]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = snapshots.drift_alert_stream(snapshots.snapshot_source(spark, f"{folder}/in", schema), f"{folder}/state", f"{folder}/alerts", f"{folder}/progress")
        stream.awaitTermination()
    got = snapshots.current_alerts(spark, f"{folder}/state", f"{folder}/alerts").collect()
    assert sorted((r.ts, r.kind) for r in got) == [(days[2], "RegionChanged"), (days[2], "spike"), (days[3], "drop")]


def test_ingest_stream_ignores_repeats(spark):
    folder = shared_folder(spark)
    schema = T.StructType.fromDDL("SnapshotUtc timestamp, n int")
    for part in ([(T0, 1)], [(T0, 1), (T0 + dt.timedelta(days=1), 2)], [(T0, 1)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{folder}/in")
        source = snapshots.snapshot_source(spark, f"{folder}/in", schema, files_per_batch=1)
        snapshots.snapshot_ingest_stream(source, f"{folder}/out", f"{folder}/progress", ["SnapshotUtc"], "SnapshotUtc").awaitTermination()
    assert sorted(r.n for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 2]


def test_replacing_a_table_is_safe(spark):
    spark.sql("DROP TABLE IF EXISTS replaced")
    tables.ctas_replace(spark.range(3).toDF("a"), "replaced")
    tables.ctas_replace(spark.table("replaced").selectExpr("a + 10 AS b"), "replaced")
    assert sorted(r.b for r in spark.table("replaced").collect()) == [10, 11, 12]
    with pytest.raises(Exception, match="oops"):
        tables.ctas_replace(spark.range(3).selectExpr("raise_error('oops') AS x"), "replaced")
    assert spark.table("replaced").columns == ["b"] and spark.table("replaced").count() == 3


def test_lost_state_is_an_error(spark, tmp_path):
    schema = T.StructType.fromDDL("a int")
    snapshots._began(spark, f"{tmp_path}/nothing", schema, begins=False)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.schema(schema).parquet(f"{tmp_path}/nothing").collect()
    snapshots._began(spark, f"{tmp_path}/new", schema, begins=True)
    assert spark.read.schema(schema).parquet(f"{tmp_path}/new").count() == 0


def test_merge_keeps_one_row_per_key_however_rows_arrive(spark, inputs):
    data = [(T0, 2), (T0, 1), (None, 3), (None, 4), (T0 + dt.timedelta(days=1), 5)]
    df = spark.createDataFrame(data, "SnapshotUtc timestamp, n int")
    table = f"{inputs.database()}.h"
    for _ in range(2):
        tables.merge_insert_only(df, table, ["SnapshotUtc"])
    assert sorted(r.n for r in spark.table(table).collect()) == [1, 3, 5]
