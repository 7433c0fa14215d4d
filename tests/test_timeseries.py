"""Windows in ranges against one long window, and as-of joins against brute force."""

import datetime as dt
import random
import statistics

from pyspark.sql import Window, functions as F

from govmill.operators import drift, timeseries
from govmill.operators.keyed import first_per_key, sample_per_key

START = dt.datetime(2024, 1, 1)


def series(spark, n=600, seed=5):
    """One key holds most rows; some values are null."""
    rnd = random.Random(seed)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(9)}", START + dt.timedelta(seconds=37 * i, microseconds=i),
             None if rnd.random() < 0.05 else rnd.randrange(100)) for i in range(n)]
    return spark.createDataFrame(rows, "key string, ts timestamp, v int")


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_previous_row_matches_lag(spark):
    df = series(spark)
    for keys in ([], ["key"]):
        w = Window.partitionBy(*keys).orderBy("ts")
        want = df.select("*", F.lag("v").over(w).alias("Prevv"), F.lag("ts").over(w).alias("Prevts"))
        for parts in (1, 2, 16, 400):
            assert rows(timeseries.previous_row(df, keys, "ts", ["v", "ts"], parts=parts)) == rows(want)


def test_positions_are_dense(spark):
    df = series(spark)
    want = df.withColumn("position", (F.row_number().over(Window.partitionBy("key").orderBy("ts")) - 1).cast("bigint"))
    assert rows(timeseries.series_position(df, ["key"], "ts", parts=8)) == rows(want)
    alone = df.withColumn("position", (F.row_number().over(Window.orderBy("ts")) - 1).cast("bigint"))
    assert rows(timeseries.series_position(df, [], "ts", parts=50)) == rows(alone)


def brute_asof(left, right, seconds):
    out = []
    for t in left:
        before = [(s, v) for s, v in right if s <= t]
        hit = max(before, default=None)
        near = hit and int(t.timestamp()) - int(hit[0].timestamp()) <= seconds
        out.append((t, hit[1] if near else None))
    return sorted(map(repr, out))


def test_asof_matches_brute_force(spark):
    rnd = random.Random(3)
    left = [START + dt.timedelta(seconds=rnd.randrange(400000), microseconds=rnd.randrange(10**6)) for _ in range(300)]
    right = [(START + dt.timedelta(seconds=s, microseconds=rnd.randrange(10**6)), i) for i, s in enumerate(rnd.sample(range(300000), 40))]
    # Same time on both sides, and gaps of exactly the limit and one second more.
    edge = START + dt.timedelta(days=9, microseconds=900000)
    left += [right[0][0], edge + dt.timedelta(seconds=21600, microseconds=90000), edge + dt.timedelta(seconds=21601)]
    right.append((edge, 99))
    l = spark.createDataFrame([(t,) for t in left], "t timestamp")
    r = spark.createDataFrame(right, "s timestamp, v int")
    want = brute_asof(left, right, 21600)
    for parts in (1, 7, 32, 400):
        assert rows(timeseries.asof_bounded(l, r, "t", "s", ["v"], 21600, parts)) == want
    assert rows(timeseries.asof_rank(l.distinct(), r, "t", "s", ["v"], 21600)) == want


def test_asof_with_no_right_rows(spark):
    l = spark.createDataFrame([(START,)], "t timestamp")
    r = spark.createDataFrame([], "s timestamp, v int")
    assert rows(timeseries.asof_bounded(l, r, "t", "s", ["v"], 60)) == [repr((START, None))]


def test_anomalies_match_one_long_frame(spark):
    rnd = random.Random(8)
    vals = [1000.0 + rnd.randrange(9) for _ in range(200)]
    vals[60], vals[150] = 5000.0, 1.0
    df = spark.createDataFrame([(START + dt.timedelta(hours=i), v) for i, v in enumerate(vals)], "t timestamp, v double")
    got = {r.ts: r for r in timeseries.anomaly_points(df, "t", "v", 0.5, half_frame=3, block=16).collect()}
    assert len(got) == 200
    for i, v in enumerate(vals):
        frame = vals[max(0, i - 3):i + 4]
        mid = statistics.median(frame)
        width = 4 * 1.4826 * statistics.median(abs(x - mid) for x in frame)
        r = got[START + dt.timedelta(hours=i)]
        assert abs(r.expected - mid) < 1e-9 and abs(r.upper - mid - width) < 1e-9 and r.is_anomaly == (abs(v - mid) > width)
    assert got[START + dt.timedelta(hours=60)].is_anomaly and got[START + dt.timedelta(hours=150)].is_anomaly


def test_first_and_sample_per_key(spark):
    df = spark.createDataFrame([(k, i) for k in "ab" for i in range(3000)], "k string, i int")
    assert rows(first_per_key(df, ["k"], [F.desc("i")])) == [repr(("a", 2999)), repr(("b", 2999))]
    for size in (5, 1500):
        for r in sample_per_key(df, "k", ["i"], ["i"], size, "s").collect():
            assert [x.i for x in r.s] == list(range(size))


def test_first_per_key_is_cut_before_the_shuffle(spark):
    plan = first_per_key(series(spark), ["key"], ["ts"])._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_delta_rules(spark):
    d = [START + dt.timedelta(days=i) for i in range(5)]
    h = spark.createDataFrame([(d[0], 0, True), (d[1], 10, True), (d[2], 5, False)], "SnapshotUtc timestamp, TotalAssets int, IsApproximate boolean")
    assert [(r.DeltaAssets, r.DeltaPct) for r in drift.catalog_deltas(h).orderBy("SnapshotUtc").collect()] == [(None, None), (10, None), (-5, -0.5)]
    regions = [None, "x", "y", None, "y"]
    r = spark.createDataFrame([(t, t.date(), "p", "P", x) for t, x in zip(d, regions)],
                              "Snapshots timestamp, SnapshotDate date, DataProductID string, DataProductDisplayName string, ResidencyRegion string")
    deltas = drift.residency_deltas(r)
    assert [x.HasChanged for x in deltas.orderBy("SnapshotUtc").collect()] == [False, False, True, False, False]
    assert [x.kind for x in drift.region_alerts(deltas).orderBy("ts").collect()] == ["GainedRegion", "RegionChanged", "LostRegion", "GainedRegion"]


def test_fan_out_can_push_coverage_past_one(spark):
    t, day = START, START.date()
    residency = spark.createDataFrame([(day, t, "p", "x"), (day, t, "p", "y"), (day, t, "q", "x")],
                                      "SnapshotDate date, Snapshots timestamp, DataProductID string, ResidencyRegion string")
    catalog = spark.createDataFrame([(t, 10, True)], "SnapshotUtc timestamp, TotalAssets int, IsApproximate boolean")
    asset = spark.createDataFrame([(t, "P", 4)], "SnapshotTS timestamp, DataProductName string, TotalAssets int")
    row = drift.kpi_timeline(catalog, asset, residency).collect()[0]
    assert (row.TotalDataProducts, row.ProductsWithResidency, row.ResidencyCoveragePct) == (2, 3, 1.5)


def test_null_keys_and_times_are_kept(spark):
    data = [(None if i % 3 == 0 else "k", None if i == 50 else START + dt.timedelta(seconds=i), i) for i in range(100)]
    df = spark.createDataFrame(data, "key string, ts timestamp, v int")
    w = Window.partitionBy("key").orderBy("ts")
    assert rows(timeseries.previous_row(df, ["key"], "ts", ["v"], parts=8)) == rows(df.withColumn("Prevv", F.lag("v").over(w)))
    want = df.withColumn("position", (F.row_number().over(w) - 1).cast("bigint"))
    assert rows(timeseries.series_position(df, ["key"], "ts", parts=8)) == rows(want)
    assert timeseries.anomaly_points(df, "ts", "v", 0.5).count() == 100
    left = df.select(F.col("ts").alias("t")).withColumn("x", F.lit(1))
    assert timeseries.asof_bounded(left, df.select("ts", "v"), "t", "ts", ["v"], 5).count() == 100


def test_many_partitions_give_the_same_small_plan(spark, inputs):
    """The number of ranges does not show in the plan; 4,000 shuffle partitions give the rows that four give."""
    few = {"residency": rows(drift.residency_deltas(inputs.h_residency)), "catalog": rows(drift.catalog_deltas(inputs.h_catalog)),
           "timeline": rows(drift.kpi_timeline(inputs.h_catalog, inputs.h_asset, inputs.h_residency)),
           "anomalies": rows(timeseries.anomaly_points(inputs.h_catalog, "SnapshotUtc", "TotalAssets", 0.5))}
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (400, 4000):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            many = drift.residency_deltas(inputs.h_residency)
            plan = many._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("\n") < 60 and plan.count("Relation [") <= 2
            assert rows(many) == few["residency"]
            assert rows(drift.catalog_deltas(inputs.h_catalog)) == few["catalog"]
        assert rows(drift.kpi_timeline(inputs.h_catalog, inputs.h_asset, inputs.h_residency)) == few["timeline"]
        assert rows(timeseries.anomaly_points(inputs.h_catalog, "SnapshotUtc", "TotalAssets", 0.5)) == few["anomalies"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def test_a_hot_key_lies_in_many_ranges(spark):
    df = series(spark, n=4000)
    ranged = timeseries.in_ranges(df, ["key", "ts"], 20)
    sizes = [r["count"] for r in ranged.groupBy("_part").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 3 * 4000 / 20
    same = timeseries.in_ranges(spark.range(4000).select(F.lit("k").alias("key"), F.lit(None).cast("timestamp").alias("ts"), "id"), ["key", "ts"], 20)
    assert same.select("_part").distinct().count() >= 15
