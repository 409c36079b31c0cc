"""A table read as a stream, a stream run to the end of its input, and scoring by a user's function."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.sources.scratch import new_path

FILES = 4  # of a micro-batch, each a task's


def as_stream(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """``name`` as a stream of its files."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")


def batches_of(rows: DataFrame, size: int = 1_000_000, least: int = 4) -> int:
    """How many micro-batches of about ``size`` rows ``rows`` make, so that what a task holds doesn't grow with the table."""
    return max(least, -(-rows.count() // size))


def _files(spark: SparkSession, path: str):
    """The store of ``path`` and what it says of each part written there, in order of the parts' numbers."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [(f.getPath().getName(), f) for f in store.listStatus(folder)]
    return store, [f for name, f in sorted(((n, f) for n, f in found if n.startswith("part-")), key=lambda x: (len(x[0]), x[0]))]


def stamped(spark: SparkSession, path: str) -> bool:
    """Give the parts of ``path`` times of writing a second apart, in order of their numbers; whether the store has kept them."""
    store, files = _files(spark, path)
    last = max((f.getModificationTime() for f in files), default=0)
    try:
        for k, f in enumerate(files):
            store.setTimes(f.getPath(), last - 1000 * (len(files) - k), -1)
    except Py4JJavaError:  # a store without such a call
        return False
    kept = [f.getModificationTime() for f in _files(spark, path)[1]]
    return all(a < b for a, b in zip(kept, kept[1:], strict=False))


def in_order(rows: DataFrame, order: str, batches: int, name: str) -> DataFrame:
    """``rows`` as a stream of about ``batches`` micro-batches in ``order``: ranges of it, a file each, written side by side and read a few at a time.

    A stream takes files by their time of writing, which is set by their number; where a store doesn't keep it, they are copied one after the other.
    """
    spark = rows.sparkSession
    path = new_path(spark, name)
    rows.repartitionByRange(batches * FILES, order).write.option("maxRecordsPerFile", 0).parquet(path)
    files = _files(spark, path)[1]
    if not stamped(spark, path):
        path = new_path(spark, f"{name}-copies")
        for f in files:
            spark.read.schema(rows.schema).parquet(f.getPath().toString()).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", -(-len(files) // batches)).parquet(path)


@contextmanager
def stores_at_most(spark: SparkSession, n: int | None):
    """Streams that are started herein have state in ``n`` partitions at most."""
    key = "spark.sql.shuffle.partitions"
    was = spark.conf.get(key)
    if n:
        spark.conf.set(key, str(min(int(was), n)))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def drain(stream: DataFrame, name: str, stores: int | None = None) -> DataFrame:
    """All that ``stream`` gives for what its source holds now, written and read back.

    ``stores``: in how many partitions its state is at most. Each commits a store in each micro-batch, with rows or without, so many
    micro-batches of bounded size want no more than run at once (``at_once``).
    """
    spark = stream.sparkSession
    path = new_path(spark, name)
    with stores_at_most(spark, stores):
        job = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", new_path(spark, f"{name}-state")).trigger(availableNow=True).start(path)
    job.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def at_once(spark: SparkSession) -> int:
    """How many tasks run at once."""
    return spark.sparkContext.defaultParallelism


def score_stream(frames: DataFrame, infer: Callable, schema: str, payload: str = "image") -> DataFrame:
    """``infer(batch)`` over Arrow-backed batches of frames without a null ``payload``; batch or stream alike, in the order of each partition."""
    return frames.where(f"{payload} is not null").mapInPandas(lambda batches: (infer(b) for b in batches), schema)


def first_delivery(events: DataFrame, keys: list[str], ts: str, lateness: str) -> DataFrame:
    """Events once for each key: a repetition that comes within ``lateness`` of its first is dropped, and the state of older keys with it."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)
