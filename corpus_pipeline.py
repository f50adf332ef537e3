"""The training-data pipeline: each stage applies one operator of
``playstream.llm`` to all that the stage before it kept.

All stages but the last return the columns of ``documents``. Rows without an
id or text pass through every filter that has nothing to hold against them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.llm.common import materialize, read_table, row_key, small_side

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier rejects go (score below 0.3)."""
    from playstream.llm.quality import learn, score_documents
    model = learn(docs, read_table(spark, sf_dir, "labels"))
    return score_documents(docs.select(*COLUMNS), model).where("predicted = 1").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (word 5-shingles, similarity 0.8 or
    more, reached over links) the document of the smallest id stays (of equal
    ids that of the smaller text hash), once if its row is repeated. Texts are
    told apart by a hash of id and text, so an id may name several; rows
    without an id stay."""
    from playstream.llm.near_dedup import near_duplicates
    hashed = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))
    keyed = docs.select(*COLUMNS, hashed.alias("row"))
    near = materialize(near_duplicates(keyed.select(F.col("row").alias("doc_id"), "text"), percent=80, bands=28, rows=5).where("doc_id is not null")
                       .groupBy(F.col("doc_id").alias("row")).agg(F.min("component_id").alias("component"), F.count("*").alias("n")), "stage-near")
    several = materialize(near.groupBy("component").agg(F.count("*").alias("rows")).where("rows > 1").select("component"), "stage-groups")
    grouped = near.join(small_side(several), "component").select("row", "component")
    named = materialize(grouped.join(keyed.select("row", "doc_id"), "row").distinct(), "stage-named")
    first = named.groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    removed = materialize(named.join(first, "component").where(F.col("row") != F.col("first.row")).select("row"), "stage-removed")
    repeated = small_side(materialize(near.where("n > 1").select("row"), "stage-repeated"))
    left = keyed.join(small_side(removed), "row", "left_anti")
    once = left.join(repeated, "row", "left_semi").dropDuplicates(["row"])
    return left.join(repeated, "row", "left_anti").unionByName(once).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of ten words of a benchmark item go."""
    from playstream.llm.decontaminate import decontaminate
    told = decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    hit = materialize(told.where("contaminated").select("key").distinct(), "stage-hit")
    keyed = docs.select(*COLUMNS, row_key("doc_id", "text").alias("key"))
    return keyed.join(small_side(hit, 500_000), "key", "left_anti").select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; no document goes."""
    from playstream.llm.secrets import learn, redact
    out = redact(docs.select(*COLUMNS), learn(docs))
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.withColumn("n_chars", size).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens, with the ids of each piece."""
    from playstream.llm.packing import pack
    return pack(docs, remember=50_000)  # the stages before have filled the executors' memory


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing),
]

#: The classifiers and the tokenizer have no SQL form; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is written and
    read again before the next one."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
