"""Session construction and shared-storage helpers.

Library code never creates a session on its own; callers pass one in.
``build_session`` is a convenience for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings every job wants regardless of scale: adaptive execution (runtime
# coalescing, skew-join splitting, broadcast conversion of small aggregates),
# UTC so event-time windows match the SQL oracle, and no web UI.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "playstream",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as is; if it
    is unset there, this is an error (a machine-local folder would not be
    visible to other executors). Only a local-mode session (tests) without
    the setting gets a fallback folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = fallback or os.path.join(
            tempfile.gettempdir(), f"playstream-ckpt-{uuid.uuid4().hex[:8]}"
        )
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    for made in _SCOPES[-1:]:
        made.append(path)
    return path


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Deletes at its end the scratch tables that were made within it; what
    reads them must be done by then."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for path in made:
            _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and
    return it read back: cuts the lineage before iterative or many-times
    reused work (model fitting, repeated scalar subqueries), so that work
    reads the table instead of recomputing its inputs, and a lost executor
    re-reads files instead of replaying the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Rows of a few numbers up to which a table is sent to all executors (tens of MB).
BROADCAST_ROWS = 2_000_000


def small_side(df, rows: int = BROADCAST_ROWS):
    """A side of a join, given as a written table of few narrow columns: marked
    for broadcast if it is counted to be small, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's folder under the checkpoint folder (the
    tables ``materialize`` and ``scratch_path`` created). Call it when the
    results that read them are no longer needed, e.g. at the end of a job."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        return
    _delete(spark, current)
    # forget the event topic files written for this application
    from .streaming import runner
    app = sc.applicationId
    for key in [k for k in runner._TOPICS if k[0] == app]:
        del runner._TOPICS[key]
