"""Benchmark decontamination by a prefix-filtered set join, in DataFrame
expressions only.

The words of an item are cut into windows of ``window`` words, a window into
its shingles. One pass over the documents keeps the places at which shingles
of the benchmark occur. Their counts order the shingles by rarity; a window
is contained only where its rarest shingle stands, so that shingle is its
prefix and the only one that is joined for candidates. A candidate's place
follows from the shingle's place in the window; the document's length bounds
it. The shingles that cover the window are then looked up at their exact
places, which compares every word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, row_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, once A-Z are lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Distinct benchmark shingles up to which they are sent to all executors;
#: more are joined by a shuffle.
BROADCAST_SHINGLES = 1_000_000


def words(text: str) -> Column:
    """The words of a text column; null has none."""
    lowered = F.translate(F.col(text).cast("string"), UPPER, LOWER)
    return F.coalesce(F.array_remove(F.split(lowered, BETWEEN), ""), F.array().cast("array<string>"))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``(wid, item, w, n)``: each window of each item, ``wid`` being equal
    for windows of equal words. Items without words have none."""
    w = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words("text").alias("w")).where(F.size("w") > 0)
    start = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    cut = w.select("item", F.explode(F.transform(start, lambda i: F.slice("w", i, window))).alias("w"))
    return cut.select(F.array_join("w", " ").alias("wid"), "item", "w", F.size("w").alias("n")).distinct()


def occurrences(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every occurrence of an item window in a document.

    Returns ``(counts, found, windows)``: ``counts(key, doc_id, n_words)`` per
    row of ``docs(doc_id, text, ...)``, ``key`` being equal for equal rows;
    ``found(key, start, n, wid)`` with 0-based word places; and
    ``windows(wid, item)``. A null text has no words. Items of fewer words
    than ``window`` are one window, those without words none."""
    wins = materialize(item_windows(items, window), "decon-window")
    each = wins.select("wid", "w", "n").dropDuplicates(["wid"]).withColumn("k", F.least(F.lit(shingle), "n"))
    each = materialize(each.select("wid", "n", "k", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("n") - F.col("k")),
        lambda o: F.struct(o.alias("o"), F.array_join(F.slice("w", o + 1, F.col("k")), " ").alias("s")))).alias("x"))
        .select("wid", "n", "k", "x.o", "x.s"), "decon-each")
    sizes = sorted(r.k for r in each.select("k").distinct().collect())  # at most ``shingle`` values
    known = each.select("s").distinct()
    if known.count() <= BROADCAST_SHINGLES:
        known = F.broadcast(known)

    read = docs.select(row_key("doc_id", "text").alias("key"), F.col("doc_id"), words("text").alias("w"))
    counts = read.select("key", "doc_id", F.size("w").cast("long").alias("n_words"))
    names = [f"w{i}" for i in range(shingle)]
    shifted = F.arrays_zip(*[F.slice("w", i + 1, F.greatest(F.size("w"), F.lit(1))).alias(c) for i, c in enumerate(names)])
    placed = read.select("key", F.size("w").alias("n_words"), F.posexplode(shifted).alias("pos", "z")).select("key", "n_words", "pos", "z.*")
    # a shingle that would pass the end of the text is null and joins nothing
    cut = [F.when(F.col(names[k - 1]).isNotNull(), F.concat_ws(" ", *names[:k])) for k in sizes]
    s = cut[0] if len(cut) == 1 else F.explode(F.array(*cut)) if cut else F.lit(None).cast("string")
    hits = materialize(placed.select("key", "n_words", "pos", s.alias("s")).join(known, "s"), "decon-hit")

    rarity = hits.groupBy("s").agg(F.count("*").alias("freq"))
    part = materialize(each.join(rarity, "s", "left"), "decon-part")
    # a window with a shingle that stands nowhere stands nowhere
    prefix = materialize(
        part.groupBy("wid", "n", "k").agg(F.min(F.struct("freq", "s", "o")).alias("p"), F.min(F.col("freq").isNotNull()).alias("all"))
        .where("all").select("wid", "n", "k", "p.s", "p.o"), "decon-prefix")
    candidates = (hits.join(prefix, "s").withColumn("start", F.col("pos") - F.col("o"))
                  .where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
                  .select("key", "start", "wid", "n").distinct())
    # shingles at every k-th place and the last one cover all words of a window
    cover = materialize(part.where((F.col("o") % F.col("k") == 0) | (F.col("o") == F.col("n") - F.col("k")))
                        .select("wid", "o", "s", F.count("*").over(Window.partitionBy("wid")).alias("need")), "decon-cover")
    looked = candidates.join(cover, "wid").select("key", "start", "wid", "n", "o", "s", "need", (F.col("start") + F.col("o")).alias("pos"))
    found = (looked.join(hits.select("key", "pos", "s"), ["key", "pos", "s"])
             .groupBy("key", "start", "wid", "n", "need").agg(F.count_distinct("o").alias("got"))
             .where("got = need").select("key", "start", "n", "wid"))
    return counts, materialize(found, "decon-found"), wins.select("wid", "item")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (words inside an
    occurrence of a window of ``items(item_id, text)``), ``items`` (sorted ids
    as strings; a null id is the string null), ``contaminated``, and ``key``.

    Defined cases: null and wordless texts have 0 words and no hit; equal rows
    get equal results; null ids are kept as they are; columns beyond the two
    are ignored; without items nothing is hit."""
    counts, found, windows = occurrences(docs, items, window)
    before = Window.partitionBy("key").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    new = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(before), F.col("start"))))
    hit = found.select("key", new.alias("new")).groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))
    named = found.select("key", "wid").distinct().join(windows, "wid").groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = counts.join(hit, "key", "left").join(named, "key", "left")
    return out.select("key", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
