"""Contiguous row index and chunk numbers (PR-01, PR-02).

A global ``row_number() over (order by k)`` moves every row into one task.
Here the rows are range-partitioned on the key instead, sorted inside each
partition and numbered locally (``monotonically_increasing_id`` =
partition << 33 | position), then shifted by the row count of all earlier
partitions. The count table has one row per partition (at most the
configured partition count), so broadcasting it is bounded whatever the data
size.

The numbered rows are written once as a parquet table under the shared
``spark.checkpoint.dir`` and read back: the counting side and the numbering
side must see the same partitions, and range bounds come from sampling, which
two separately planned branches would not repeat identically. The write also
cuts the lineage, so a lost executor never renumbers rows.

The key must be a total order (unique): ties would make the local numbering
depend on the arrival order of rows, so a repeated key is an error.

A stored table needs no key: its rows are numbered as they are stored, by the
place of each row in its file and the sizes of the files before, without a
shuffle or a write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_LOCAL_BITS = 33


def _ranged(df: DataFrame, keys: list[str], num_partitions: int | None, count_keys: bool = False) -> DataFrame:
    """Range-partition, sort within partitions, tag ``_rid``/``_pid``; written
    once to shared storage and read back. With ``count_keys`` each row also
    has ``_same``, the number of rows of its key: equal keys are in one range,
    already sorted, so the window adds neither an exchange nor a sort.

    Without ``num_partitions`` the exchange is sized by adaptive execution:
    it starts from the configured partition count and coalesces adjacent
    ranges to the advisory partition size, which keeps them in key order.
    The partition ids that the numbering uses are fixed by the write, so the
    count side and the numbering side read the same ones."""
    # Range bounds come from a sampling job over the input: written first,
    # the sampler and the exchange both read the table instead of each
    # recomputing the input's lineage (windows, aggregates).
    src = materialize(df, "range-input")
    ranged = (src.repartitionByRange(num_partitions, *keys) if num_partitions
              else src.repartitionByRange(*keys))
    numbered = ranged.sortWithinPartitions(*keys)
    if count_keys:
        numbered = numbered.withColumn("_same", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    numbered = numbered.withColumn("_rid", F.monotonically_increasing_id())
    return materialize(numbered, "ranged").withColumn("_pid", F.shiftright("_rid", _LOCAL_BITS))


#: Files up to which their offsets are sent to all executors.
BROADCAST_FILES = 500_000


def _storage_index(df: DataFrame, base: int, name: str) -> DataFrame:
    """Files in the order of their paths, rows as they stand in them."""
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = placed.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))  # one row per file
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")), "offsets")
    side = F.broadcast(offsets) if offsets.count() <= BROADCAST_FILES else offsets
    return (placed.join(side, "_file").withColumn(name, F.col("_off") + F.col("_row") + F.lit(base))
                  .drop("_file", "_row", "_off"))


def with_index(df: DataFrame, order_by: list[str] | str | None = None, base: int = 0,
               name: str = "index", num_partitions: int | None = None) -> DataFrame:
    """PR-01: add ``name`` = base, base+1, .. in ``order_by`` order (a unique
    key, else ``ValueError``), or without a key in storage order, for which
    ``df`` must be the scan of a parquet table. ``num_partitions`` fixes the
    range partition count; by default adaptive execution sizes it."""
    if order_by is None:
        return _storage_index(df, base, name)
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    tagged = _ranged(df, keys, num_partitions, count_keys=True)
    if not tagged.where("_same > 1").isEmpty():  # a pushed-down filter
        raise ValueError(f"rows cannot be numbered by {keys}: a key is repeated")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_rid") - F.shiftleft(F.col("_pid"), _LOCAL_BITS)
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_off") + local + F.lit(base))
                  .drop("_rid", "_pid", "_off", "_same"))


def with_running_sum(df: DataFrame, order_by: list[str] | str, cols: list[str],
                     num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums ``<col>_cum`` of ``cols`` in key order, without
    a single-task window: local sums per range partition (a window over one
    partition's rows) plus the broadcast totals of all earlier partitions.
    The key must be unique (e.g. the output of a group-by on it)."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    tagged = _ranged(df, keys, num_partitions)
    local_w = Window.partitionBy("_pid").orderBy("_rid").rowsBetween(
        Window.unboundedPreceding, 0)
    local = tagged.select("*", *[F.sum(c).over(local_w).alias(f"_l_{c}") for c in cols])
    totals = tagged.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[
        F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in cols])
    out = local.join(F.broadcast(offsets), "_pid").withColumns({
        f"{c}_cum": F.col(f"_o_{c}") + F.col(f"_l_{c}") for c in cols})
    return out.drop("_rid", "_pid", *[f"_l_{c}" for c in cols], *[f"_o_{c}" for c in cols])


def chunk_number(index: Column | str = "index", size: int = 500) -> Column:
    """PR-02: ``floor(index / size)``."""
    idx = F.col(index) if isinstance(index, str) else index
    return F.call_function("div", idx, F.lit(size))


def with_chunk(df: DataFrame, order_by: list[str] | str | None = None, size: int = 500,
               base: int = 0, name: str = "chunk_number") -> DataFrame:
    return (with_index(df, order_by, base=base)
            .withColumn(name, chunk_number("index", size)))
