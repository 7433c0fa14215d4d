"""Previous-row, as-of and rolling operators that never put a whole series in one task.

Rows are dealt out by range of (keys, time) and stored once with the number of their range. Windows run
inside a range; what a range needs from earlier ones is its *edge*, one row per range, carried forward over the few ranges and
sent to all tasks. A series that holds a third of all rows so lies in many ranges, the plan has the same
size for any number of them, and results are exactly those of one long window.

Spark samples the frame for the bounds of the ranges before it deals the rows out, so a frame that is costly
to compute is best stored first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from govmill.session import stored

ROLLING_BLOCK = 4096
MAD_TO_SIGMA = 1.4826


def tie(df: DataFrame) -> Column:
    """A hash of the row that puts rows with equal keys and times in order."""
    return F.xxhash64(*(f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()))


def in_ranges(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """The rows in ranges of ``order``, stored, with ``_part``, the number of their range, and ``_tie``.

    There are as many ranges as shuffle partitions. ``_tie`` is a hash of the row that makes the order total, so rows
    with equal keys and times, nulls among them, can lie in several ranges; a frame that has the column keeps its own. The number of a range is stored and never
    computed again: later stages and repeated tasks all see the same one.
    """
    spark = df.sparkSession
    ranged = ((df if "_tie" in df.columns else df.withColumn("_tie", tie(df)))
              .repartitionByRange(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), *order, "_tie")
              .withColumn("_part", F.spark_partition_id()))
    return stored(ranged)


def _carry(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows with the edges carried to their range: one row per range, so they are sent to all tasks."""
    return rows.join(F.broadcast(edges), "_part", "left")


def _alike(keys: Sequence[str], other: str) -> Column:
    """Whether the keys in struct ``other`` are those of the row; nulls equal nulls."""
    return reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(other)[k]) for k in keys), F.col(other).isNotNull())


def previous_row(df: DataFrame, keys: Sequence[str], time: str, values: Sequence[str],
                 prefix: str = "Prev", parts: int | None = None) -> DataFrame:
    """Add ``prefix + value``: the values of the row before, per key, in time order.

    ``time`` is unique per key; rows with one key and time follow each other in the order of a hash. With no keys
    the whole frame is one series. A row's predecessor in its range is the row before it if the keys agree; only the first row
    of a range needs the edge, the last row of the nearest range before it that has rows.
    """
    order = [*keys, time, "_tie"]
    ranged = in_ranges(df, [*keys, time], parts)
    held, inside, across = F.struct(*dict.fromkeys([*keys, *values])), Window.partitionBy("_part").orderBy(*order), Window.orderBy("_part")
    local = ranged.withColumn("_local", F.lag(held).over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    edges = ranged.groupBy("_part").agg(F.max_by(held, F.struct(*order)).alias("_edge"))
    edges = edges.select("_part", F.lag("_edge").over(across).alias("_carried"))
    before = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_local"))
    return (_carry(local, edges).withColumn("_before", before)
            .select(*df.columns, *(F.when(_alike(keys, "_before"), F.col("_before")[v]).alias(prefix + v) for v in values)))


def asof_many(left: DataFrame, left_time: str, rights: Sequence[tuple[DataFrame, str, Sequence[str]]],
              seconds: int, parts: int | None = None) -> DataFrame:
    """Every left row with the values of the newest row of each right frame at or before it.

    A right frame comes with its time column and the values wanted from it; its times are unique.
    The gap is counted in whole seconds and may not pass ``seconds``; otherwise the values are null.
    All frames are stacked in time order and the last row of each right frame is carried forward, so
    the work grows with rows, not with pairs of rows, and one shuffle serves all right frames.
    """
    stack = [left.select(F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"))]
    held = [f"_r{i}" for i in range(len(rights))]
    for name, (right, time, values) in zip(held, rights):
        stack.append(right.select(F.col(time).alias("_t"), F.lit(0).alias("_side"),
                                  F.struct(F.col(time).alias("_at"), *values).alias(name)))
    order = ["_t", "_side", "_tie"]
    ranged = in_ranges(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stack), ["_t", "_side"], parts)
    inside = Window.partitionBy("_part").orderBy(*order)
    across = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    edges = ranged.groupBy("_part").agg(*(F.max_by(h, F.when(F.col(h).isNotNull(), F.struct(*order))).alias(h) for h in held))
    edges = edges.select("_part", *(F.last(h, ignorenulls=True).over(across).alias(f"{h}_carried") for h in held))
    local = ranged.withColumns({f"{h}_local": F.last(h, ignorenulls=True).over(inside) for h in held}).filter("_side = 1")
    near = _carry(local, edges).select("_t", "_left", *(F.coalesce(f"{h}_local", f"{h}_carried").alias(h) for h in held))

    def kept(name: str, value: str) -> Column:
        gap = F.unix_seconds(F.col("_t").cast("timestamp")) - F.unix_seconds(F.col(f"{name}._at").cast("timestamp"))
        return F.when(gap <= seconds, F.col(f"{name}.{value}")).alias(value)

    return near.select("_left.*", *(kept(h, v) for h, (_, _, values) in zip(held, rights) for v in values))


def asof_bounded(left: DataFrame, right: DataFrame, left_time: str, right_time: str,
                 values: Sequence[str], seconds: int, parts: int | None = None) -> DataFrame:
    """As-of join with one right frame; see :func:`asof_many`."""
    return asof_many(left, left_time, [(right, right_time, values)], seconds, parts)


def asof_rank(left: DataFrame, right: DataFrame, left_time: str, right_time: str,
              values: Sequence[str], seconds: int) -> DataFrame:
    """The as-of join written as a ranked range join.

    Right rows go to their own and the next bucket of ``seconds``, which turns the range into an
    equal-key join. It forms the pairs inside a bucket, so it is the test twin of
    :func:`asof_bounded` and serves only where a bucket holds few rows.
    """
    def bucket(time: str) -> Column:
        return F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / seconds)

    spread = right.select(F.explode(F.array(bucket(right_time), bucket(right_time) + 1)).alias("_bucket"),
                          F.col(right_time).alias("_at"), *values)
    gap = F.unix_seconds(F.col(left_time).cast("timestamp")) - F.unix_seconds(F.col("_at").cast("timestamp"))
    w = Window.partitionBy(left_time).orderBy(F.desc("_at"))
    pairs = (left.withColumn("_bucket", bucket(left_time)).join(spread, "_bucket")
             .filter((F.col("_at") <= F.col(left_time)) & (gap <= seconds))
             .withColumn("_rank", F.row_number().over(w)).filter("_rank = 1"))
    return left.join(pairs.select(left_time, *values), left_time, "left")


def series_position(df: DataFrame, keys: Sequence[str], time: str, name: str = "position",
                    parts: int | None = None) -> DataFrame:
    """Number the rows of each series from zero in time order.

    A range's edge is its last key with the number of that key's rows up to there; only rows of that key go on in the next range.
    """
    order = [*keys, time, "_tie"]
    ranged = in_ranges(df, [*keys, time], parts)
    local = ranged.withColumn("_row", F.row_number().over(Window.partitionBy("_part", *keys).orderBy(time, "_tie")))
    edges = local.groupBy("_part").agg(F.max_by(F.struct(*keys, "_row"), F.struct(*order)).alias("_last")).select("_part", "_last.*")
    total = F.sum("_row").over(Window.partitionBy(*keys).orderBy("_part"))
    edges = edges.withColumn("_total", total).select(
        "_part", F.lag(F.struct(*keys, "_total")).over(Window.orderBy("_part")).alias("_carried"))
    offset = F.when(_alike(keys, "_carried"), F.col("_carried._total")).otherwise(0)
    return _carry(local, edges).select(*df.columns, (F.col("_row") - 1 + offset).alias(name))


def anomaly_points(df: DataFrame, time: str, value: str, sensitivity: float, half_frame: int = 7,
                   block: int = ROLLING_BLOCK) -> DataFrame:
    """Flag values far from the rolling median of the ``2 * half_frame + 1`` rows around them.

    Distance is measured in median absolute deviations, scaled to match a standard deviation. The
    band is ``1 + 6 * (1 - sensitivity)`` of them wide on each side, so a higher sensitivity flags
    more points. Every row is judged. Rows near a block border are also sent to the block next door,
    so frames are complete and no task gets more than about one block.
    """
    pos = F.pmod("position", F.lit(block))
    home = F.floor(F.col("position") / block)
    copies = F.array_compact(F.array(
        home, F.when((pos < half_frame) & (home > 0), home - 1), F.when(pos >= block - half_frame, home + 1)))
    spread = (series_position(df.select(F.col(time).alias("ts"), F.col(value).cast("double").alias("value")), [], "ts")
              .withColumn("_home", home).withColumn("_block", F.explode(copies)))
    around = Window.partitionBy("_block").orderBy("position").rowsBetween(-half_frame, half_frame)
    deviations = F.transform("_frame", lambda v: F.abs(v - F.col("expected")))
    width = F.lit((1 + 6 * (1 - sensitivity)) * MAD_TO_SIGMA) * _median(deviations)
    return (spread.withColumn("_frame", F.collect_list("value").over(around)).filter("_block = _home")
            .withColumn("expected", _median(F.col("_frame"))).withColumn("_width", width)
            .select("ts", "value", "expected", (F.col("expected") - F.col("_width")).alias("lower"),
                    (F.col("expected") + F.col("_width")).alias("upper"),
                    F.coalesce(F.abs(F.col("value") - F.col("expected")) > F.col("_width"), F.lit(False))
                    .alias("is_anomaly")))


def _median(values: Column) -> Column:
    ordered, n = F.array_sort(values), F.size(values)
    middle = F.try_element_at(ordered, F.floor((n + 1) / 2).cast("int")) + F.try_element_at(
        ordered, F.floor((n + 2) / 2).cast("int"))
    return F.when(n > 0, middle / 2)
