"""News-event sources (IO-05, IO-06, PR-13) and the event fixture.

The reference consumes JSON values from a Kafka topic. ``events_source``
reads any streaming source that yields a ``value`` column (Kafka when its
package is on the classpath; text/JSON files here), ``decode_events`` parses
it with a fixed schema, and ``news_events`` derives the same seven fields
from the given ``events`` and ``nation`` tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import read_table

NEWS_FIELDS = ("user_id", "article_id", "timestamp", "category", "location",
               "device_type", "session_id")
NEWS_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in NEWS_FIELDS])

# Fixed values of the event derivation (see FIXTURES.md).
DEVICES = ("mobile", "desktop", "tablet")
N_NATIONS = 25


def news_events(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Seven string fields per event, as the reference's topic carries them,
    after the columns of ``events`` to ``keep``.
    ``nation`` is a dimension; the planner broadcasts it only if its
    measured size is under the broadcast threshold, else it sort-merges."""
    ev = read_table(spark, sf_dir, "events")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    device = F.element_at(F.array(*[F.lit(d) for d in DEVICES]),
                          (F.col("event_id") % 3 + 1).cast("int"))
    out = ev.join(nation, (ev.user_id % N_NATIONS) == nation.n_nationkey, "left").select(
        *keep, F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("a"), F.get_json_object("props", "$.k")).alias("article_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(F.col("event_type") == "purchase", F.lit("finance"))
         .otherwise(F.col("event_type")).alias("category"),
        F.col("n_name").alias("location"),
        device.alias("device_type"),
        F.concat_ws("-", F.col("user_id").cast("string"),
                    F.date_format("ts", "yyyyMMdd")).alias("session_id"),
    )
    return out


def news_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a ``value`` column of JSON text (a topic's payload)."""
    ev = news_events(spark, sf_dir)
    return ev.select(F.to_json(F.struct(*NEWS_FIELDS)).alias("value"), "timestamp")


def events_source(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                  schema: T.StructType | None = None, **options) -> DataFrame:
    """IO-05: a streaming frame with a ``value`` column.

    Kafka: ``events_source(spark, "kafka", **{"kafka.bootstrap.servers": ..,
    "subscribe": "news_events", "startingOffsets": "earliest"})``.
    Files: ``events_source(spark, "text", path, maxFilesPerTrigger=1)``. They
    take ``startingOffsets`` as well: ``earliest`` (the default), ``latest``
    (what comes after this call) or a time as ``end_of_feed`` gives it, from
    after which files are read. Hand in the time itself if the query is to be
    restarted on its checkpoint: ``latest`` would move on.
    """
    start = None if fmt == "kafka" else options.pop("startingOffsets", "earliest")
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(path) if path else reader.load()
    if start in (None, "earliest"):
        return df
    after = end_of_feed(spark, path) if start == "latest" else start
    return df.where(F.col("_metadata.file_modification_time") > F.lit(after).cast("timestamp")) if after else df


def end_of_feed(spark: SparkSession, path: str) -> str | None:
    """The time of the newest file of a feed (UTC), null if it has none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    newest = files.select(F.date_format(F.to_utc_timestamp(F.max("modificationTime"), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).first()[0]
    return newest


def decode_events(df: DataFrame, schema: T.StructType = NEWS_SCHEMA) -> DataFrame:
    """IO-06: ``CAST(value AS STRING)`` -> ``from_json`` -> fields. A
    malformed value gives a row of nulls, not an error."""
    return (df.select(F.from_json(F.col("value").cast("string"), schema).alias("data"))
              .select("data.*"))


def with_event_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """PR-13: event time from the string field; unparsable -> null."""
    return df.withColumn("event_time", F.try_to_timestamp(F.col(col)))
