"""Streams and upkeep in steps against one run over everything."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from govmill.operators import drift, upkeep
from govmill.operators.timeseries import previous_row
from govmill.streaming import snapshots

START = dt.datetime(2024, 1, 1)
SERIES = "key string, ts timestamp, total bigint, region string"


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def keyed(spark, n=300, seed=1):
    rnd = random.Random(seed)
    data = {}
    for i in range(n):
        key = None if rnd.random() < 0.05 else "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(20)}"
        data[key, START + dt.timedelta(hours=i)] = (rnd.choice([None, 0, 10, 11, 50]), rnd.choice([None, "x", "y"]))
    return [(k, t, *v) for (k, t), v in data.items()]


def run_stream(spark, folder, parts, buckets=8):
    for part in parts:
        spark.createDataFrame(part, SERIES).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = snapshots.snapshot_source(spark, f"{folder}/in", spark.createDataFrame([], SERIES).schema)
        snapshots.drift_alert_stream(source, f"{folder}/state", f"{folder}/alerts", f"{folder}/progress", buckets=buckets).awaitTermination()
    return snapshots.current_alerts(spark, f"{folder}/state", f"{folder}/alerts")


def test_tasks_of_an_alert_batch_are_bounded_in_its_own_session(spark, tmp_path, monkeypatch):
    name, seen, judge = "spark.sql.adaptive.advisoryPartitionSizeInBytes", [], snapshots.series_alerts
    before = spark.conf.get(name)
    monkeypatch.setattr(snapshots, "series_alerts", lambda df, share: seen.append(df.sparkSession.conf.get(name)) or judge(df, share))
    run_stream(spark, tmp_path, [keyed(spark, 20)]).count()
    assert seen == ["16m"] and spark.conf.get(name) == before != "16m"


def test_alert_stream_is_the_batch_form_in_any_order(spark, tmp_path):
    data = keyed(spark)
    want = rows(snapshots.series_alerts(spark.createDataFrame(data, SERIES)))
    assert any("GainedRegion" in x for x in want) and any("LostRegion" in x for x in want) and any("spike" in x for x in want)
    random.Random(2).shuffle(data)
    # The last arrival repeats rows of the first one.
    assert rows(run_stream(spark, tmp_path, [data[:100], data[100:220], data[220:] + data[:30]])) == want


def test_a_late_row_is_judged_and_so_is_the_row_after_it(spark, tmp_path):
    def at(h):
        return START + dt.timedelta(hours=h)

    first = [("a", at(0), 100, "x"), ("a", at(2), 200, "y"), ("b", at(0), 1, None)]
    got = run_stream(spark, tmp_path, [first])
    assert {(r.kind, r.prev, r.value) for r in got.collect()} == {("spike", "100", "200"), ("RegionChanged", "x", "y")}
    got = run_stream(spark, tmp_path, [[("a", at(1), 200, None)]])
    assert {(r.kind, r.prev, r.value, r.ts) for r in got.collect()} == {("spike", "100", "200", at(1)), ("LostRegion", "x", None, at(1)), ("GainedRegion", None, "y", at(2))}


def test_only_touched_buckets_are_written(spark, tmp_path):
    data = keyed(spark)
    run_stream(spark, tmp_path, [data, [("hot", START + dt.timedelta(days=90), 7, "z")]])
    first, second = (sorted(p.name for p in (tmp_path / "state/rows" / f"batch={i}").glob("bucket=*")) for i in (0, 1))
    assert len(first) > 3 and len(second) == 1


def test_alert_state_that_is_gone_is_an_error(spark, tmp_path):
    run_stream(spark, tmp_path, [keyed(spark)])
    (tmp_path / "state").rename(tmp_path / "gone")
    with pytest.raises(Exception, match="(?i)path"):
        run_stream(spark, tmp_path, [[("a", START, 1, "x")]])


def test_ingest_reads_only_the_days_of_the_batch(spark, tmp_path):
    schema = "ts timestamp, name string, n int"
    source = [(START + dt.timedelta(hours=7 * i), f"s{i % 3}", i) for i in range(200)] + [(None, "none", 1)]
    folder, key = str(tmp_path), ["ts", "name"]
    for part in (source[:80], source[50:], source[:10] + [(None, "none", 1)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = snapshots.snapshot_source(spark, f"{folder}/in", spark.createDataFrame([], schema).schema, files_per_batch=1)
        snapshots.snapshot_ingest_stream(stream, f"{folder}/history", f"{folder}/progress", key, "ts").awaitTermination()
    assert rows(snapshots.history(spark, f"{folder}/history", spark.createDataFrame([], schema).schema)) == sorted(map(repr, source))
    stored = spark.read.schema(f"{schema}, {snapshots.DAY} date").parquet(f"{folder}/history")
    batch = spark.createDataFrame(source[-5:-1], schema).withColumn(snapshots.DAY, F.col("ts").cast("date"))
    fresh = snapshots.unseen_rows(batch, stored, key)
    assert fresh.count() == 0
    plan = fresh._jdf.queryExecution().toString()
    assert snapshots.DAY in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError):
        snapshots.snapshot_ingest_stream(stream, f"{folder}/h", f"{folder}/p", ["name"], "ts")


def test_deltas_in_steps_are_those_of_one_run(spark, tmp_path):
    data = [(k, t, v) for k, t, v, _ in sorted(keyed(spark), key=lambda r: r[1])]
    schema = "key string, ts timestamp, v bigint"
    whole = spark.createDataFrame(data, schema)
    for keys in (["key"], []):
        got = []
        for i, (a, b) in enumerate([(0, 100), (100, 100), (100, 250), (250, 300)]):
            new = spark.createDataFrame(data[a:b], schema)
            got += rows(upkeep.extend_deltas(new, keys, "ts", ["ts", "v"], folder=f"{tmp_path}/{len(keys)}", run=i))
        assert sorted(got) == rows(previous_row(whole, keys, "ts", ["ts", "v"]))
        # A run that is started again gives and leaves the same.
        again = upkeep.extend_deltas(spark.createDataFrame(data[250:], schema), keys, "ts", ["ts", "v"], folder=f"{tmp_path}/{len(keys)}", run=3)
        assert again.count() == len(data) - 250
        with pytest.raises(upkeep.LateRows):
            upkeep.extend_deltas(spark.createDataFrame(data[:1], schema), keys, "ts", ["ts", "v"], folder=f"{tmp_path}/{len(keys)}", run=4)


def test_rollups_build_only_the_days_that_new_rows_touch(spark, tmp_path):
    data = [(START + dt.timedelta(hours=i % 60), f"p{i}", i) for i in range(300)]
    schema = "SnapshotTS timestamp, DataProductName string, TotalAssets bigint"
    full = "SnapshotTS timestamp, DataProductName string, TotalAssets bigint, d date, run int"
    seen = []
    for i, part in enumerate((data[:150], data[150:299], data[299:])):
        days = upkeep.append_days(spark.createDataFrame(part, schema), f"{tmp_path}/h", "SnapshotTS", "d", i)
        stored = spark.read.schema(full).parquet(f"{tmp_path}/h")
        built = set(tmp_path.glob("t/d=*/*.parquet"))
        upkeep.refresh_days(stored, days, "d", drift.asset_totals_by_snapshot, "SnapUtc", f"{tmp_path}/t")
        seen.append(len(built & set(tmp_path.glob("t/d=*/*.parquet"))))
    assert seen[-1] == 2  # of three days, the two that the last row does not fall into keep their files
    assert rows(upkeep.read_days(spark, f"{tmp_path}/t", "d")) == rows(drift.asset_totals_by_snapshot(spark.createDataFrame(data, schema)))


def test_deltas_in_steps_keep_the_order_of_rows_with_one_time(spark, tmp_path):
    schema = "key string, ts timestamp, v bigint"
    data = [(f"k{i % 2}", START + dt.timedelta(hours=i // 20), (i * 37) % 1000) for i in range(200)]
    for keys in (["key"], []):
        got = []
        for i, (a, b) in enumerate([(0, 60), (60, 120), (120, 200)]):
            new = spark.createDataFrame(data[a:b], schema)
            got += rows(upkeep.extend_deltas(new, keys, "ts", ["ts", "v"], folder=f"{tmp_path}/{len(keys)}", run=i))
        assert sorted(got) == rows(previous_row(spark.createDataFrame(data, schema), keys, "ts", ["ts", "v"]))
