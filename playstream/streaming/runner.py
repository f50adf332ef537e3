"""Starting stream queries (IO-07, IO-08, S-08) and feeding file sources.

Every query gets a checkpoint location (mandatory here, optional in the
reference) under the shared ``spark.checkpoint.dir`` unless one is given, so
a restarted driver resumes from committed offsets and state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import materialize, scratch_path
from .sources import news_values


def start(df: DataFrame, sink: str = "console", mode: str = "update",
          checkpoint: str | None = None, query_name: str | None = None,
          available_now: bool = False, processing_time: str | None = None,
          top: int = 10, truncate: bool = False, path: str | None = None,
          foreach_batch=None) -> StreamingQuery:
    """Start a streaming query.

    ``sink``: ``console`` (first ``top`` rows, untruncated, as the reference
    prints), ``memory`` (table named ``query_name``), a file format such as
    ``parquet`` (``path`` required; append mode), or ``foreach_batch`` with a
    ``(df, epoch_id)`` function. ``mode``: complete / update / append.
    """
    spark = df.sparkSession
    ckpt = checkpoint or scratch_path(spark, f"stream-{query_name or sink}")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    if sink == "console":
        w = w.format("console").option("numRows", top).option("truncate", truncate)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
    return w.start()


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for a stream. A stateful query keeps the number of
    state partitions it starts with and commits state in each of them on every
    micro-batch, so this session uses the cluster's parallelism
    (``state_partitions`` to override); the caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return own


class Collected:
    """What a stream puts out, as a table under the shared checkpoint folder:
    in complete mode the last result, else the rows of all micro-batches. A
    batch that is retried overwrites its own files, so it is in the table
    once, also if the query is stopped and started again on its checkpoint.
    ``top`` keeps the first rows of each batch by ``order``, as a console
    shows them; ``epochs`` adds the micro-batch as a column ``epoch``."""

    def __init__(self, spark: SparkSession, name: str, mode: str, top: int | None = None, order: list | None = None, epochs: bool = False):
        self.spark, self.name, self.mode, self.top, self.order, self.epochs = spark, name, mode, top, order, epochs
        self.out, self.schema, self.dropped = scratch_path(spark, f"stream-out-{name}"), None, 0
        self.checkpoint = scratch_path(spark, f"stream-{name}")

    def _write(self, batch: DataFrame, epoch: int) -> None:
        if self.top is not None:
            batch = batch.orderBy(*self.order).limit(self.top)
        if self.epochs:
            batch = batch.withColumn("epoch", F.lit(epoch).cast("long"))
        batch.write.mode("overwrite").parquet(f"{self.out}/{'latest' if self.mode == 'complete' else epoch}")
        self.schema = batch.schema

    def run(self, df: DataFrame, checkpoint: str | None = None) -> Collected:
        """Start the query, process everything available now, and stop."""
        q = start(df, mode=self.mode, query_name=self.name, available_now=True, checkpoint=checkpoint or self.checkpoint, foreach_batch=self._write)
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(str(q.exception()))
        self.dropped += sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators)
        return self

    def table(self, df: DataFrame) -> DataFrame:
        if self.schema is None:
            return self.spark.createDataFrame([], df.schema)
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.out)


def run_to_table(df: DataFrame, name: str, mode: str, checkpoint: str | None = None, **how) -> DataFrame:
    """Process everything available now and return what the stream put out
    (see ``Collected``)."""
    return Collected(df.sparkSession, name, mode, **how).run(df, checkpoint).table(df)


def run_counted(df: DataFrame, name: str, mode: str, **how) -> tuple[DataFrame, int]:
    """``run_to_table``, and how many rows the state operators dropped behind
    the watermark. They count rows after the partial aggregation, so fewer than
    the events that were dropped."""
    ran = Collected(df.sparkSession, name, mode, **how).run(df)
    return ran.table(df), ran.dropped


def run_restarted(make: Callable[[], DataFrame], arrivals: list[Callable[[], None]], name: str, mode: str, **how) -> DataFrame:
    """IO-08: for each of ``arrivals`` (which brings new data to the source)
    a query of its own is started on one checkpoint, processes what is there
    and is stopped. Each makes the stream anew, as a restarted driver does, and
    goes on from the committed offsets and state."""
    arrivals[0]()
    df = make()
    ran = Collected(df.sparkSession, name, mode, **how).run(df)
    for arrive in arrivals[1:]:
        arrive()
        df = make()
        ran.run(df)
    return ran.table(df)


_TOPICS: dict[tuple[str, str, int], tuple[str, int]] = {}
#: Rows that a file of the topic has on average, at least.
ROWS_PER_FILE = 50


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB (off-heap, spills to local disk and
    is snapshotted to the checkpoint) instead of the JVM-heap map: for
    large key spaces such as complete-mode windows or dedup state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def event_topic(spark: SparkSession, sf_dir: str, n_slices: int = 6) -> tuple[str, int]:
    """The event files for ``sf_dir`` and how many of them make a time slice,
    written once per application and shared by every stream query (as
    consumers share one topic; each keeps its own checkpoint and offsets)."""
    key = (spark.sparkContext.applicationId, sf_dir, n_slices)
    if key not in _TOPICS:
        _TOPICS[key] = write_event_files(spark, sf_dir, n_slices)
    return _TOPICS[key]


def write_event_files(spark: SparkSession, sf_dir: str, n_slices: int = 6, path: str | None = None,
                      values: DataFrame | None = None) -> tuple[str, int]:
    """Write the event topic payload as JSON lines in ``n_slices`` appends of
    event time slices, each of the same number of files, which is returned
    with the path: a reader of that many files per trigger sees the slices in
    order. Many tasks write a slice; events without a readable time are in
    the first one. ``values(value, timestamp)`` defaults to those of ``sf_dir``."""
    path = path or scratch_path(spark, "news-topic")
    values = news_values(spark, sf_dir) if values is None else values
    return path, write_slices(spark, numbered_values(spark, values, n_slices), path)


def numbered_values(spark: SparkSession, values: DataFrame, n_slices: int) -> DataFrame:
    """``value, slice``: which of ``n_slices`` slices of event time, of about
    equally many events, each of ``values(value, timestamp)`` is in."""
    # derived once; the cut points and every slice read the written values
    timed = materialize(values.withColumn("_t", F.unix_timestamp(F.try_to_timestamp("timestamp"))), "news-values")
    # n_slices - 1 cut points: a small driver-side list by construction
    bounds = timed.agg(F.percentile_approx("_t", [i / n_slices for i in range(1, n_slices)], 10000).alias("b")).first()["b"] or []
    number = sum((F.coalesce((F.col("_t") >= b).cast("int"), F.lit(0)) for b in bounds), F.lit(0))
    return timed.select("value", number.alias("slice"))


def write_slices(spark: SparkSession, numbered: DataFrame, path: str, files: int | None = None, only: Callable[[int], bool] | None = None) -> int:
    """Appends ``numbered(value, slice int)`` to the feed at ``path`` slice by
    slice, each as the same number of files, which is returned. ``files`` fixes
    that number, ``only`` chooses slices: a feed may be written in parts."""
    sliced = scratch_path(spark, "news-slices")
    numbered.write.partitionBy("slice").parquet(sliced)
    rows = spark.read.schema("value string, slice int").parquet(sliced)
    sizes = {r["slice"]: r["count"] for r in rows.groupBy("slice").count().collect()}  # one row a slice
    files = files or max(1, min(spark.sparkContext.defaultParallelism, min(sizes.values(), default=0) // ROWS_PER_FILE))
    for i in sorted(i for i in sizes if only is None or only(i)):
        one = rows.where(F.col("slice") == i).select("value", F.pmod(F.xxhash64("value"), F.lit(files)).alias("part"))
        # a folder for each part: exactly one file for it, whatever task writes it
        one.repartition(files, "part").write.mode("append").partitionBy("part").text(path)
    return files
