"""Spark helpers of this subpackage: cutting lineage, checked broadcasts, connected components, runs of a sorted stream."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. A local session that leaves it unset, as in tests, gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame, last_use: bool = False) -> DataFrame:
    """The rows of `df`, stored in the shared folder: a lost executor takes none of them along.

    With `last_use` the frame is given up before the collectors run, so that its shuffle files can go now and not at the next cut.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    done = df.checkpoint(eager=True)
    if last_use:
        del df
    _collect(done.sparkSession)
    return done


def stored(df: DataFrame) -> DataFrame:
    """The rows of `df` as parquet files in the shared folder, for small frames that are read again and again.

    A scan packs many small files into one task; a checkpoint is read by as many tasks as wrote it, and the driver keeps a record of every task.
    Neither the partitions nor the order of rows stay.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _collect(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _collect(spark: SparkSession) -> None:
    """What was behind a cut is no longer reachable: let Spark remove its shuffle files now, not when memory runs low."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    give_back()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give this package to the executors' Python, once per application, as --py-files does."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        name = Path(tempfile.mkdtemp(prefix="package-")) / "govmill.zip"
        with zipfile.ZipFile(name, "w") as out:
            for file in sorted((root / "govmill").rglob("*.py")):
                out.write(file, file.relative_to(root))
        context.addPyFile(str(name))
        _SHIPPED.add(context.applicationId)
    return spark


def give_back() -> None:
    """Return what a task has freed to the system: its worker lives on and would keep it through the stages that follow."""
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether `df` has at most so many rows; stops counting beyond."""
    return df.limit(rows + 1).count() <= rows


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in edges (a, b): label is the smallest node that can be reached.

    Rounds of two steps: every node sends the smallest of its neighbours to the larger ones, then to the smaller ones,
    until all edges point at the smallest node of their component. Each round is two aggregations with map-side minima and
    two joins that Spark can split, so a node with very many edges does not pile up in one task. The number of rounds
    grows with the logarithm of the longest path; no round runs once all edges are such stars.
    """
    pairs = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    while not stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = pairs.join(least.select(F.col("a").alias("b"), "m"), "b").select("a", F.col("m").alias("b")).distinct()
        large = stored(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        star = small.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = stored(star.unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct())
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def stars(pairs: DataFrame) -> bool:
    """Whether different pairs (a, b), a > b, make stars: each a has one b, and no b is an a. Then b is the smallest node of its component."""
    ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        pairs.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    found = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not found.where("up > 1 or (up = 1 and down = 1)").limit(1).count()


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of a sorted stream of batches, also those that go on in the next batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        bound = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(bound[:-1], bound[1:], strict=True):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """The same runs many at a time: batches that end where a run ends, and the bounds of the runs in each."""
    held: pa.Table | None = None
    for batch in _and_end(batches):
        if batch is not None and batch.num_rows:
            held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held is not None else pa.Table.from_batches([batch])
        if held is None:
            continue
        part = held.combine_chunks().to_batches()[0]
        new = np.zeros(part.num_rows, bool)
        for k in keys:
            c = part.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= c[1:] != c[:-1]
        bound = [0, *np.flatnonzero(new).tolist()]
        if batch is None:
            yield part, [*bound, part.num_rows]
        elif len(bound) > 1:
            done = bound[-1]
            yield pa.Table.from_batches([part.slice(0, done)]).combine_chunks().to_batches()[0], bound
            held = pa.Table.from_batches([part.slice(done)])


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None
