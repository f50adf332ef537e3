"""Verbatim passages for ``paragraph_dedup``: paragraphs of a third of a
passage's length anywhere in a text, inside lines and over line ends, banded by MinHash
and extended to the whole run of words that stands again elsewhere.

1. Paragraphs begin where their content says: each passage-long window of
   words chooses the paragraph of the least hash in it, so equal windows choose
   the same one, and a passage that stands twice shares a chosen paragraph.
2. A paragraph's bucket is its band: the minima of a few universal hash
   functions over its five-word shingles. Equal paragraphs always share it, so
   one band is the tuned number for them.
3. Of paragraphs that collide, the passage-long windows that chose them are
   compared whole, every word of them, by 64-bit hashes. They travel with their
   bucket, a row for all windows of a paragraph; equal windows are named by
   their first place, so no pairs are listed. The windows of a bucket with very
   many places are rows of their own in partial aggregates, so that no task
   holds them all.
4. Repeated windows that follow each other are joined to runs.

Nothing is sampled or capped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, small_side, tidy, together, utf8, whole_groups
from .near_dedup import _mix

_RNG = np.random.RandomState(20240911)
#: Bytes that are hashed at once, unless a word is longer.
PIECE = 1 << 19
_GAP = re.compile(rb"[\x20\x09-\x0d]")
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_PLACE = _RNG.randint(0, 2**63 - 1, size=4096, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
#: Places of a bucket that one task groups, in about 100 MB; beyond them they
#: are aggregated.
GROUP = 50_000
#: Words of a shingle, and minima of a band.
SHINGLE, MINIMA = 5, 3
_TOP = np.uint64(2**64 - 1)
#: Odd multipliers by salt, for each doubling of a hashed length and each part added.
_C = _RNG.randint(0, 2**63 - 1, size=(2, 64), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of ``data`` and the
    bytes at which they begin: sums of the bytes times multipliers by their
    place in the word, mixed with its length."""
    hashes, starts, lo = [], [], 0
    while lo < len(data):
        end = _GAP.search(data, min(lo + PIECE, len(data)))  # pieces end between words
        hi = end.start() if end else len(data)
        x = np.frombuffer(data, dtype=np.uint8, count=hi - lo, offset=lo)
        word = _IN_WORD[x]
        edge = np.diff(np.concatenate([[False], word, [False]]).view(np.int8))
        begin = np.flatnonzero(edge == 1)
        if len(begin):
            size = np.flatnonzero(edge == -1) - begin
            first = np.cumsum(size) - size
            place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
            times = _PLACE[place & 4095]
            if size.max() > 4096:
                times = times * (_mix((place >> 12).astype(np.uint64)) | np.uint64(1))
            value = (x[word].astype(np.uint64) + np.uint64(1)) * times
            hashes.append(_mix(np.add.reduceat(value, first) + size.astype(np.uint64) * _C[0, 60]))
            starts.append(begin + lo)
        lo = hi
    none = np.empty(0, dtype=np.int64)
    return np.concatenate(hashes or [none.astype(np.uint64)]), np.concatenate(starts or [none])


def flat_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of several texts, A-Z in lower case, one after the other:
    their hashes; where each text begins and the last one ends, in words; the
    line that each word stands in, numbered over all texts; and the first line
    of each text."""
    parts = [utf8(t).lower() for t in texts]
    data = b"\n".join(parts)
    w, starts = hash_words(data)
    at = np.cumsum([0, *(len(p) + 1 for p in parts)])
    ends = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10)
    return w, np.searchsorted(starts, at), np.searchsorted(ends, starts), np.searchsorted(ends, at[:-1])


def _hashes(w: np.ndarray, size: int, salt: int) -> np.ndarray:
    """The hash of the ``size`` words from each place: those of 1, 2, 4, ..
    words are joined from halves, and these to the size."""
    n, at, out, part, length, bit = len(w) - size + 1, 0, None, w, 1, 0
    while True:
        if size & length:
            piece = part[at:at + n]
            out = piece * _C[salt, 32] if out is None else out * _C[salt, 33 + bit] + piece
            at += length
        if 2 * length > size:
            return _mix(out + np.uint64(size))
        part = part[:-length] * _C[salt, bit] + part[length:]
        length, bit = 2 * length, bit + 1


def _sliding(x: np.ndarray, size: int, op) -> np.ndarray:
    """``op`` over each ``size`` values in a row, by doubling."""
    done = 1
    while done < size:
        step = min(done, size - done)
        x, done = op(x[:len(x) - step], x[step:]), done + step
    return x


def paragraph(min_words: int) -> int:
    """Words of a content-defined paragraph."""
    return max(min_words // 3, 1)


def _buckets(w: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The band of the paragraphs of ``k`` words from the places ``at``."""
    size = min(SHINGLE, k)
    s = _hashes(w, size, 0)[at[:, None] + np.arange(k - size + 1)]
    out = np.zeros(len(at), dtype=np.uint64)
    for i in range(MINIMA):
        out += _mix(s * _C[1, 40 + i]).min(axis=1) * _C[1, 50 + i]
    return _mix(out)


def _within(bounds: np.ndarray, size: int) -> np.ndarray:
    """Which runs of ``size`` words lie in one text."""
    ends = np.repeat(bounds[1:], np.diff(bounds))
    n = max(len(ends) - size + 1, 0)
    return np.arange(n) + size <= ends[:n]


def marked(w: np.ndarray, bounds: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """``(places, buckets)`` of the paragraphs that a window of one of the
    texts chooses."""
    k = paragraph(min_words)
    if len(w) < min_words:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    own, n = _within(bounds, k), min_words - k + 1
    x = np.where(own, _hashes(w, k, 0), _TOP)
    low = np.where(_within(bounds, min_words), _sliding(x, n, np.minimum), np.uint64(0))
    # the largest minimum of the windows that hold a place; 0 stands beyond the ends
    pad = np.zeros(n - 1, dtype=np.uint64)
    top = _sliding(np.concatenate([pad, low, pad]), n, np.maximum)
    at = np.flatnonzero((top == x) & own)
    return at, _buckets(w, at, k)


def _first_least(x: np.ndarray, size: int) -> np.ndarray:
    """The place of the first minimum of each ``size`` values in a row."""
    at, done = np.arange(len(x)), 1
    while done < size:
        step = min(done, size - done)
        lower = x[step:] < x[:-step]
        x, at, done = np.where(lower, x[step:], x[:-step]), np.where(lower, at[step:], at[:-step]), done + step
    return at


_ID = "doc_id long, text_hash long, "
#: Characters of the texts whose words are hashed together.
TOGETHER = 1 << 17


def _marks(min_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            first, rows = 0, []
            ids, keys = pdf["doc_id"].to_numpy(), pdf["text_hash"].to_numpy()
            for part in together(pdf["text"].tolist(), TOGETHER, 10_000):
                w, bounds, _, _ = flat_words(part)
                at, x = marked(w, bounds, min_words)
                of = np.searchsorted(bounds, at, side="right") - 1
                rows.append((ids[first + of], keys[first + of], (at - bounds[of]).astype(np.int32), x.view(np.int64)))
                first += len(part)
            cols = [np.concatenate(c) for c in zip(*rows)] if rows else [[]] * 4
            yield pd.DataFrame(dict(zip(("doc_id", "text_hash", "place", "mark"), cols)))
    return tidy(run)


def _windows(min_words: int):
    """Per paragraph whose bucket stands again, the hashes of the windows that
    chose it: they begin at ``place`` and after, ``before`` words or less
    before the paragraph."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = paragraph(min_words)
        for batch in batches:
            texts, places = batch.column("text").to_pylist(), batch.column("places")
            ids, keys = (batch.column(c).to_numpy() for c in ("doc_id", "text_hash"))
            ends, spots = places.offsets.to_numpy(), places.values.to_numpy()
            first = 0
            for part in together(texts, TOGETHER, 10_000):
                w, bounds, _, _ = flat_words(part)
                lo, hi = ends[first], ends[first + len(part)]
                of = np.repeat(np.arange(len(part)), np.diff(ends[first:first + len(part) + 1]))
                at = np.sort(bounds[of] + spots[lo:hi])
                of = np.searchsorted(bounds, at, side="right") - 1
                x = np.where(_within(bounds, k), _hashes(w, k, 0), _TOP)
                own = np.flatnonzero(_within(bounds, min_words))
                least, win = _first_least(x, min_words - k + 1)[own], _hashes(w, min_words, 1)
                a, b = np.searchsorted(least, at, side="left"), np.searchsorted(least, at, side="right")  # first minima never go back
                some = a < b
                at, of, start, n = at[some], of[some], own[a[some]], (b - a)[some]
                upto = np.cumsum(n)
                each = np.repeat(start - (upto - n), n) + np.arange(len(n) and upto[-1])
                offsets = np.concatenate([[0], 8 * upto]).astype(np.int32)
                wins = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(win[each].tobytes())])
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[first + of]), pa.array(keys[first + of]), pa.array((start - bounds[of]).astype(np.int32)), pa.array((at - start).astype(np.int32)),
                    pa.array(_buckets(w, at, k).view(np.int64)), wins], names=["doc_id", "text_hash", "place", "before", "mark", "wins"])
                first += len(part)
    return tidy(run)


def _each(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of the rows: row, number in the row, hash."""
    n = pdf["wins"].map(len).to_numpy() // 8
    row = np.repeat(np.arange(len(pdf)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n), np.frombuffer(b"".join(pdf["wins"]), dtype=np.int64)


def _exploded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        if len(pdf):
            row, i, win = _each(pdf)
            c = {k: pdf[k].to_numpy()[row] for k in ("doc_id", "text_hash", "place", "before", "mark")}
            yield pd.DataFrame({**c, "place": (c["place"] + i).astype(np.int32), "before": (c["before"] - i).astype(np.int32), "win": win})


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of whole groups of a mark, the stretches of repeated windows with their first places."""
    for g, starts in whole_groups(batches, ["mark"]):
        g = g.assign(of=np.repeat(np.arange(len(starts)), np.diff([*starts, len(g)])), spot=g["place"] + g["before"])
        g = g.sort_values(["of", "doc_id", "text_hash", "spot"], ignore_index=True)
        row, i, win = _each(g)
        before = g["before"].to_numpy()[row] - i
        of = g["of"].to_numpy()[row]
        order = np.lexsort((row, win, before, of))
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.any([v[order][1:] != v[order][:-1] for v in (of, before, win)], axis=0)
        head = np.flatnonzero(new)
        n = np.diff([*head, len(order)])
        first, times = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
        first[order], times[order] = np.repeat(row[order][head], n), np.repeat(n, n)
        cut = np.ones(len(order), dtype=bool)
        cut[1:] = (row[1:] != row[:-1]) | (first[1:] != first[:-1]) | ((times[1:] > 1) != (times[:-1] > 1))
        head = np.flatnonzero(cut)
        n = np.diff([*head, len(order)])
        head, n = head[times[head] > 1], n[times[head] > 1]
        r, f, spot = row[head], first[head], g["spot"].to_numpy()
        ids, keys = g["doc_id"].to_numpy(), g["text_hash"].to_numpy()
        yield pd.DataFrame({"doc_id": ids[r], "text_hash": keys[r], "place": spot[r] - before[head], "n": n,
                            "first_doc_id": ids[f], "first_text_hash": keys[f], "first_place": spot[f] - before[head]})


def _runs(min_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g, starts in whole_groups(batches, ["doc_id", "text_hash"]):
            end, new = (g["place"] + g["n"]).to_numpy(), np.zeros(len(g), dtype=bool)
            new[starts] = True
            new[1:] |= g["place"].to_numpy()[1:] != end[:-1]
            for c in ("first_doc_id", "first_text_hash", "kept"):
                v = g[c].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            head = np.flatnonzero(new)
            out = g.iloc[head].rename(columns={"place": "start_word", "first_place": "first_word"})
            yield out.assign(n_words=np.add.reduceat(g["n"].to_numpy(), head) + min_words - 1).drop(columns="n")
    return tidy(run)


def repeated_passages(docs: DataFrame, min_words: int = 50, group: int = GROUP) -> DataFrame:
    """One row per verbatim passage of ``docs(doc_id, text, ...)``: a longest
    run of words of which each ``min_words`` in a row also stand, but for the
    case of A-Z and the kind of white space, at another place of any document,
    its own included. ``doc_id``, ``text_hash`` (xxhash64 of the text, for ids
    with several texts), ``start_word`` (from 0), ``n_words``;
    ``first_doc_id``, ``first_text_hash``, ``first_word``: where the run's
    first ``min_words`` words first stand, by id, hash and place; ``kept``: the
    run stands nowhere before. Passages end where the document of the first
    place, or ``kept``, changes; passages that follow each other overlap by
    less than ``min_words`` words.

    Words and windows are told apart by 64-bit hashes. Defined cases: null,
    empty and shorter texts have no passage; rows without an id are passed
    over; rows that repeat an id and its text are one document, and texts that
    share an id are documents of their own; without repeats the result is
    empty. Ids and lengths are free."""
    keys = ["doc_id", "text_hash"]
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read = read.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    marks = materialize(read.mapInPandas(_marks(min_words), _ID + "place int, mark long"), "passage-mark")
    spot = F.xxhash64("doc_id", "text_hash", "place")
    again = materialize(marks.groupBy("mark").agg(F.min(spot).alias("a"), F.max(spot).alias("b"), F.count("*").alias("n")).where("a <> b").select("mark", "n"), "passage-again")
    # written before it is grouped, so that a mark that holds many of the rows is split by the skew join
    hit = materialize(marks.join(small_side(again.select("mark")), "mark").select("doc_id", "text_hash", "place"), "passage-hit")
    places = materialize(hit.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places")), "passage-places")
    wanted = small_side(places.select("doc_id", "text_hash"))
    texts = read.join(wanted, keys, "left_semi").dropDuplicates(keys)
    windows = materialize(
        texts.join(places, keys).select(*keys, "text", "places")
        .mapInArrow(_windows(min_words), _ID + "place int, before int, mark long, wins binary"), "passage-window")
    hot = small_side(again.where(F.col("n") > group).select("mark"))
    first = "first_doc_id long, first_text_hash long, first_place int"
    few = windows.join(hot, "mark", "left_anti").repartition("mark").sortWithinPartitions("mark")
    few = few.select(*keys, "place", "before", "mark", "wins").mapInPandas(tidy(_stretches), _ID + "place int, n int, " + first)
    many = materialize(windows.join(hot, "mark", "left_semi").select(*keys, "place", "before", "mark", "wins")
                       .mapInPandas(tidy(_exploded), _ID + "place int, before int, mark long, win long"), "passage-many")
    at, same = F.struct(*keys, "place"), ["mark", "before", "win"]
    firsts = materialize(many.groupBy(*same).agg(F.min(at).alias("f"), F.max(at).alias("l")).where("f <> l").select(
        *same, F.col("f.doc_id").alias("first_doc_id"), F.col("f.text_hash").alias("first_text_hash"), F.col("f.place").alias("first_place")), "passage-first")
    many = many.join(small_side(firsts), same).select(*keys, "place", F.lit(1).alias("n"), "first_doc_id", "first_text_hash", "first_place")
    told = few.unionByName(many).withColumn("kept", (F.col("doc_id") == F.col("first_doc_id")) & (F.col("text_hash") == F.col("first_text_hash"))
                                            & (F.col("place") == F.col("first_place")))
    return (told.repartition(*keys).sortWithinPartitions(*keys, "place")
            .mapInPandas(_runs(min_words), _ID + "start_word int, n_words int, first_doc_id long, first_text_hash long, first_word int, kept boolean"))
