"""Streams over snapshot files: history without repeats, and drift alerts.

Both run as batches over whatever files have arrived. A batch that is run again after a failure must
not add rows twice, so every batch compares with what is already stored before it writes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from govmill.functions import fixed_values as V
from govmill.functions.columns import is_true
from govmill.operators.keyed import first_per_key
from govmill.operators.timeseries import previous_row

#: Parts of the alert state: a batch rewrites those that its keys fall into.
BUCKETS = 64
#: What one task of an alert batch takes, in bytes of a shuffle or a file: its sorts were seen to hold up to nine times as much. Spark's own sizes, 64 and 128 MB, make
#: tasks that grow with the input for long. They are set in the session of the stream alone.
TASK_SIZES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m", "spark.sql.files.maxPartitionBytes": "32m"}
DAY = "SnapshotDay"


def snapshot_source(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None,
                    name_filter: str = "*.parquet") -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name_filter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _began(spark: SparkSession, path: str, schema: T.StructType, begins: bool) -> None:
    """Only the batch that ``begins`` may find no folder: lost state is an error, not an empty one."""
    if begins:
        spark.createDataFrame([], schema).write.mode("append").parquet(path)


def history(spark: SparkSession, history_path: str, schema: T.StructType) -> DataFrame:
    """The history that :func:`snapshot_ingest_stream` keeps."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])).parquet(history_path).drop(DAY)


def unseen_rows(batch: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of a batch with day whose key ``stored`` does not have, each key once; reads only the days of the batch.

    The days are a literal list, so the scan of ``stored`` lists and opens the folders of these days alone.
    """
    days = [r[0] for r in batch.select(DAY).distinct().collect()]
    told = [d for d in days if d is not None]
    same_days = F.col(DAY).isin(told) if len(told) == len(days) else F.col(DAY).isin(told) | F.col(DAY).isNull()
    known = stored.filter(same_days).select(*(F.col(k).alias(f"_known_{k}") for k in key)).distinct()
    on = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in key))
    return first_per_key(batch.join(known, on, "left_anti"), list(key), batch.columns)


def snapshot_ingest_stream(source: DataFrame, history_path: str, checkpoint: str, key: Sequence[str], time: str):
    """Append each snapshot key to the history once, however often its file or batch comes.

    The stream form of an insert-only merge; of several rows with one key the first in column order. The history lies in
    one folder per day of ``time``, which is one of the key's columns: a key can only be stored under its own day, and what
    a batch reads does not grow with the history. Keys are compared with nulls equal; rows without time have a folder of their own.
    """
    if time not in key:
        raise ValueError("the time must belong to the key, or a key could lie under another day")
    fields = [*source.schema.fields, T.StructField(DAY, T.DateType())]

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _began(spark, history_path, T.StructType(fields), batch_id == 0)
        dated = batch.withColumn(DAY, F.col(time).cast("date"))
        stored = spark.read.schema(T.StructType(fields)).parquet(history_path)
        unseen_rows(dated, stored, key).write.mode("append").partitionBy(DAY).parquet(history_path)

    return source.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


ALERT_FIELDS = "key string, kind string, prev string, value string, pct double, ts timestamp"
VERSION_FIELDS = "bucket int, version bigint, alerts bigint"


def series_alerts(series: DataFrame, threshold: float = V.SPIKE_THRESHOLD) -> DataFrame:
    """Alerts in rows of (key, ts, total, region): spikes and drops of totals; regions changed, gained and lost."""
    df = previous_row(series.select("key", "ts", "total", "region"), ["key"], "ts", ["ts", "total", "region"])
    pct = F.try_divide((F.col("total") - F.col("Prevtotal")).cast("double"), F.col("Prevtotal").cast("double"))

    def alert(kind, prev: str, value: str, share):
        return F.struct(kind.alias("kind"), F.col(prev).cast("string").alias("prev"),
                        F.col(value).cast("string").alias("value"), share.alias("pct"))

    move = F.when(F.abs(pct) >= threshold, alert(F.when(pct > 0, "spike").otherwise("drop"), "Prevtotal", "total", pct))
    now, before, known = F.col("region"), F.col("Prevregion"), F.col("Prevts").isNotNull()
    moved = (F.when(is_true(now != before), "RegionChanged").when(known & before.isNull() & now.isNotNull(), "GainedRegion")
             .when(known & before.isNotNull() & now.isNull(), "LostRegion"))
    place = F.when(moved.isNotNull(), alert(moved, "Prevregion", "region", F.lit(None).cast("double")))
    return (df.select("key", "ts", F.inline_outer(F.array_compact(F.array(move, place)))).filter("kind IS NOT NULL")
            .select("key", "kind", "prev", "value", "pct", "ts"))


def _versions(spark: SparkSession, state_path: str, batch_id: int) -> dict[int, tuple[int, int]]:
    """Bucket to (batch that wrote it last, its number of alerts); at most BUCKETS rows."""
    rows = spark.read.schema(VERSION_FIELDS).parquet(f"{state_path}/versions/batch={batch_id}").collect()
    return {r.bucket: (r.version, r.alerts) for r in rows}


def drift_alert_stream(source: DataFrame, state_path: str, alert_path: str, checkpoint: str,
                       threshold: float = V.SPIKE_THRESHOLD, buckets: int = BUCKETS):
    """Alerts from a stream of (key, ts, total, region) rows, whatever the order they come in.

    The state is every key's series, in buckets of keys. A batch reads the buckets that its keys fall into, adds its rows and judges
    those buckets anew by event time: a late row gets its alert, and the row after it is compared with it instead of
    the row before. A row whose key and time are stored already is a repeat and changes nothing; of several that come at once
    the first by values stays.

    A bucket is written under the number of the batch; the list of versions, written last, says which ones hold. A batch that
    runs again starts from the list before it and replaces its own output. Read the alerts with :func:`current_alerts`.
    """
    fields = T.StructType([f for f in source.schema.fields if f.name in ("key", "ts", "total", "region")])
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        for name, size in TASK_SIZES.items():
            spark.conf.set(name, size)
        _began(spark, f"{state_path}/versions/batch=-1", T._parse_datatype_string(VERSION_FIELDS), batch_id == 0)
        versions = _versions(spark, state_path, batch_id - 1)
        rows = batch.select(*fields.names, F.lit(1).alias("_new"), bucket.alias("bucket"))
        touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())
        paths = [f"{state_path}/rows/batch={versions[b][0]}/bucket={b}" for b in touched if b in versions]
        if paths:
            old = spark.read.schema(fields).parquet(*paths)
            rows = rows.unionByName(old.select(*fields.names, F.lit(0).alias("_new"), bucket.alias("bucket")))
        if not touched:
            spark.read.parquet(f"{state_path}/versions/batch={batch_id - 1}").write.mode("overwrite").parquet(f"{state_path}/versions/batch={batch_id}")
            return
        series = first_per_key(rows, ["key", "ts"], ["_new", "total", "region"]).drop("_new")
        # Rebalanced: a bucket with a hot key is written, and later read, by several tasks.
        series.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{state_path}/rows/batch={batch_id}")
        written = spark.read.schema(fields).parquet(*(f"{state_path}/rows/batch={batch_id}/bucket={b}" for b in touched))
        alerts = series_alerts(written, threshold).withColumn("bucket", bucket)
        made = f"{alert_path}/batch={batch_id}"
        alerts.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(made)
        counted = spark.read.schema(f"{ALERT_FIELDS}, bucket int").parquet(made).groupBy("bucket").count().collect()
        found = {r["bucket"]: r["count"] for r in counted}
        versions |= {b: (batch_id, found.get(b, 0)) for b in touched}
        (spark.createDataFrame([(b, *v) for b, v in sorted(versions.items())], VERSION_FIELDS).coalesce(1)
         .write.mode("overwrite").parquet(f"{state_path}/versions/batch={batch_id}"))

    return source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_alerts(spark: SparkSession, state_path: str, alert_path: str) -> DataFrame:
    """The alerts that hold after the newest batch: of each bucket those that its last version has."""
    newest = spark.read.schema(f"{VERSION_FIELDS}, batch bigint").parquet(f"{state_path}/versions").agg(F.max("batch")).first()[0]
    versions = _versions(spark, state_path, newest) if newest is not None else {}
    paths = [f"{alert_path}/batch={v}/bucket={b}" for b, (v, alerts) in sorted(versions.items()) if alerts]
    return spark.read.schema(ALERT_FIELDS).parquet(*paths) if paths else spark.createDataFrame([], ALERT_FIELDS)
