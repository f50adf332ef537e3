"""Repeated passages: near-duplicate paragraphs by MinHash banding, over whole
texts.

Two kinds of paragraphs are banded. Lines, whose copies may differ: bands are
tuned for recall (the fewest hash functions that miss a pair at the threshold
with at most the given probability), colliding lines are compared on their
exact shingle sets, and clusters are the components of the confirmed links. And
paragraphs that begin wherever their content says, for what is repeated inside
lines or over line ends (``passages``): equal ones share their only band,
their surroundings are compared word by word and extended to the full run.
Of each cluster the passage of the smallest document and place stays.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.session import scratch_path, scratch_scope

from .common import materialize, small_side, tidy, together, utf8
from .near_dedup import _WORD_C, MinHash, _mix, clustered
from .passages import TOGETHER, flat_words, repeated_passages

#: Shingles whose minima are computed at once.
PART = 1 << 14
_KEY = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


def tuned_bands(percent: int, miss: float) -> tuple[int, int]:
    """``(bands, rows)`` with the fewest hash functions for which a pair of
    this similarity shares no band with probability ``miss`` at most. Single
    minima would let every common shingle collide, so a band has 3 rows at
    least."""
    s = percent / 100
    ways = [(ceil(log(miss) / log(1 - s ** r)), r) for r in range(3, 13)] if s < 1 else [(1, 3)]
    return min(ways, key=lambda w: w[0] * w[1])


def _number(doc_id: int, text_hash: int, start: int) -> int:
    """A number for a line, the same wherever it is computed."""
    return struct.unpack("<q", xxhash.xxh3_64_digest(struct.pack("<qqq", doc_id, text_hash, start))[::-1])[0]


def _signed(min_words: int, size: int, bands: int, rows: int):
    """Signatures of the lines of whole texts. The words of many texts are
    hashed together, the shingles of many lines reduced together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mh = MinHash(bands, rows)
        for batch in batches:
            out, sets, first = [], [], 0
            ids, hashes = (batch.column(c).to_numpy() for c in ("doc_id", "text_hash"))
            for part in together(batch.column("text").to_pylist(), TOGETHER, 10_000):
                w, _, line, head = flat_words(part)
                sizes = np.bincount(line)
                bounds = np.cumsum(sizes) - sizes  # of lines
                of = np.searchsorted(head, np.arange(len(sizes)), side="right") - 1
                start = bounds[np.minimum(head, len(sizes) - 1)][of] if len(sizes) else bounds  # of each line's text
                long = np.flatnonzero(sizes >= min_words)
                if len(long):
                    acc = np.full(len(w) - size + 1, np.uint64(size), dtype=np.uint64)
                    for i in range(size):
                        acc += w[i:len(acc) + i] * _WORD_C[i]
                    s = _mix(acc)
                    for some in _parts(long, sizes):
                        at, n = bounds[some], sizes[some] - size + 1
                        sigs = _minima(mh, s, at, n)
                        keys = _mix((sigs.reshape(len(some), bands, rows).astype(np.uint64) * mh.c).sum(axis=2, dtype=np.uint64) + mh.salt).view(np.int64)
                        sets += _sets(s, at, n)
                        out.append((first + of[some], (at - start[some]).astype(np.int32), sizes[some].astype(np.int32), sigs, keys))
                first += len(part)
            if out:
                of, place, words, sigs, keys = map(np.concatenate, zip(*out))
                numbers = list(map(_number, ids[of].tolist(), hashes[of].tolist(), place.tolist()))
                ends = np.arange(len(of) + 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(numbers, pa.int64()), pa.array(ids[of]), pa.array(hashes[of]), pa.array(place), pa.array(words),
                    pa.array([k for k, _ in sets], pa.int64()), pa.array([key for _, key in sets], pa.string()),
                    pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(ends * (4 * bands * rows)), pa.py_buffer(sigs.tobytes())]),
                    pa.ListArray.from_arrays(pa.array(ends * bands), pa.array(keys.ravel()))],
                    names=["id", "doc_id", "text_hash", "start_word", "n_words", "n_shingles", "set_key", "sig", "bands"])
    return tidy(run)


def _parts(lines: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Lines in runs of about ``PART`` words, or one that is longer."""
    upto = np.cumsum(sizes[lines])
    at = 0
    while at < len(lines):
        end = max(int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PART, side="right")), at + 1)
        yield lines[at:end]
        at = end


def _minima(mh: MinHash, s: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The signature of each run of ``n`` shingles from ``at``, a row each."""
    if len(at) == 1:
        return mh.signature(s[at[0]:at[0] + n[0]])[None]
    lo, hi = at[0], at[-1] + n[-1]
    x = (s[lo:hi] >> np.uint64(32)).astype(np.uint32)
    ends = np.stack([at, at + n], axis=1).ravel()[:-1] - lo  # every second piece lies between runs
    return np.minimum.reduceat(mh.a * x + mh.b, ends, axis=1)[:, ::2].T


def _sets(s: np.ndarray, at: np.ndarray, n: np.ndarray) -> list[tuple[int, str]]:
    """Size and key of the set of each run of shingles: two sums of mixed
    values, 128 bits, equal for equal sets."""
    starts = np.cumsum(n) - n
    of = np.repeat(np.arange(len(n)), n)
    v = s[np.repeat(at - starts, n) + np.arange(len(of))]
    told = _mix(v + of.astype(np.uint64) * _KEY[0])  # equal values of a run stand together, wherever that is
    order = np.argsort(told)
    told = told[order]
    new = np.ones(len(v), dtype=bool)
    new[order[1:]] = told[1:] != told[:-1]
    sums = np.stack([np.add.reduceat(np.where(new, _mix(v * c), np.uint64(0)), starts) for c in _KEY], axis=1)
    digits = sums.astype(">u8").tobytes().hex()
    return [(k, digits[32 * i:32 * i + 32]) for i, k in enumerate(np.add.reduceat(new, starts, dtype=np.int64).tolist())]


def _texts(min_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text_hash, text in zip(pdf["doc_id"].tolist(), pdf["text_hash"].tolist(), pdf["text"]):
                at = 0
                for line in text.split("\n"):
                    n = len(utf8(line).split())
                    if n >= min_words:
                        out.append((_number(doc_id, text_hash, at), line))
                    at += n
            yield pd.DataFrame(out, columns=["doc_id", "text"])
    return tidy(run)


def similar_lines(docs: DataFrame, min_words: int, percent: int, shingle_words: int, miss: float) -> DataFrame:
    """Lines of ``docs(doc_id, text_hash, text)`` that have a near copy."""
    if min_words < shingle_words:
        raise ValueError("a line must hold a shingle")
    bands, rows = tuned_bands(percent, miss)
    signed = materialize(docs.mapInArrow(
        _signed(min_words, shingle_words, bands, rows),
        "id long, doc_id long, text_hash long, start_word int, n_words int, n_shingles long, set_key string, sig binary, bands array<long>"), "line")
    near = clustered(signed.select(F.col("id").alias("doc_id"), "n_shingles", "set_key", "sig", "bands"),
                     docs.mapInPandas(_texts(min_words), "doc_id long, text string"), shingle_words, percent, bands, rows)
    near = materialize(near.select(F.col("doc_id").alias("id"), "component_id").distinct(), "line-near")
    several = materialize(near.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id"), "line-cluster")
    at = ["doc_id", "text_hash", "start_word"]
    placed = materialize(near.join(small_side(several), "component_id").join(signed.select("id", *at, "n_words").distinct(), "id"), "line-placed")
    first = materialize(placed.groupBy("component_id").agg(F.min(F.struct(*at)).alias("f")), "line-first")
    return placed.join(small_side(first), "component_id").select(
        *at, "n_words", F.col("f.doc_id").alias("first_doc_id"), F.col("f.text_hash").alias("first_text_hash"), F.col("f.start_word").alias("first_word"),
        (F.struct(*at) == F.col("f")).alias("kept"))


def repeated_paragraphs(docs: DataFrame, passage_words: int = 50, line_words: int = 40, percent: int = 80, shingle_words: int = 5, miss: float = 1e-4) -> DataFrame:
    """One row per passage of ``docs(doc_id, text, ...)`` that stands, or
    nearly stands, at another place of any document, its own included.

    ``kind`` is ``passage`` for a longest run of at least ``passage_words``
    words that stands again verbatim but for the case of A-Z and white space,
    wherever it begins (see ``passages.repeated_passages``), and ``line`` for a
    line of at least ``line_words`` words whose shingle set is at least
    ``percent`` % similar to that of another, or linked to one over others. A
    repeated line may be in both. ``doc_id``, ``text_hash`` (xxhash64 of the
    text, for ids with several texts), ``start_word`` (from 0, in the words of
    the whole text), ``n_words``; ``first_doc_id``, ``first_text_hash``,
    ``first_word``: the first place of its cluster; ``kept``: it is that one.

    Words, windows and lines are told apart by 64-bit hashes. Defined cases:
    null, empty, blank and short texts have no passage; rows without an id are
    passed over; rows that repeat an id and its text are one document, texts
    that share an id are documents of their own; without repeats the result is
    empty. Ids and lengths are free."""
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    columns = ["kind", "doc_id", "text_hash", "start_word", "n_words", "first_doc_id", "first_text_hash", "first_word", "kept"]
    paths = [scratch_path(spark, "repeat"), scratch_path(spark, "repeat")]
    with scratch_scope(spark):  # what the one kind wrote goes before the other begins
        repeated_passages(read, passage_words).select(F.lit("passage").alias("kind"), *columns[1:]).write.parquet(paths[0])
    with scratch_scope(spark):
        hashed = read.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
        similar_lines(hashed, line_words, percent, shingle_words, miss).select(F.lit("line").alias("kind"), *columns[1:]).write.parquet(paths[1])
    return spark.read.parquet(*paths)


_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        texts = []
        for text, starts, sizes in zip(pdf["_text"], pdf["_starts"], pdf["_sizes"]):
            data = utf8(text)
            words = [m.span() for m in _WORD.finditer(data)]
            out, at = [], 0
            for s, n in sorted(zip(starts, sizes)):
                lo, hi = words[s][0], words[s + n - 1][1]
                out.append(data[at:max(at, lo)])
                at = max(at, hi)
            texts.append((b"".join(out) + data[at:]).decode("utf-8", "surrogatepass"))
        yield pdf[["_id", "_hash"]].assign(_new=texts)


def without_repeats(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the passages that ``found`` (of
    ``repeated_paragraphs``) does not keep; white space around them stays.
    Other texts, and nulls, stay as they are."""
    gone = materialize(found.where(~F.col("kept")).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.collect_list(F.struct("start_word", "n_words")).alias("_p")).select("_id", "_hash", F.col("_p.start_word").alias("_starts"), F.col("_p.n_words").alias("_sizes")), "repeat-gone")
    keyed = docs.withColumns({"_id": F.col("doc_id").cast("long"), "_hash": F.xxhash64(F.col("text").cast("string"))})
    cut = keyed.select("_id", "_hash", F.col("text").alias("_text")).dropDuplicates(["_id", "_hash"]).join(gone, ["_id", "_hash"]).mapInPandas(
        tidy(_cut), "_id long, _hash long, _new string")
    return keyed.join(materialize(cut, "repeat-cut"), ["_id", "_hash"], "left").withColumn("text", F.coalesce("_new", "text")).select(*docs.columns)
