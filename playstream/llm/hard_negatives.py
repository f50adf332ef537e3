"""Hard negatives of embeddings by slot-decomposed selection.

The upper limits of an anchor's positives cut the scores into disjoint slots.
Each task keeps the best few negatives of every slot of every anchor, whatever
number of rows it reads; these are merged by a shuffle, and a suffix merge from
the lowest slot upwards answers all windows of the anchor, however much they
overlap.

Anchors meet all rows in blocks: a block of anchors of a fixed size in bytes is
sent to all executors, and one pass over the rows serves it. Vectors are never
shuffled, and a task's output grows with the anchors of a block, not with rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Best, give_back, grouped, materialize, small_side

#: Bytes of the anchors that one pass serves; what is sent to executors at once.
ANCHOR_BYTES = 32 << 20
#: Rows and anchors of which all scores are held at once.
SIDE = 1024
#: Scores beyond saturate, so that a hundred times a score is a 64-bit integer.
LIMIT = (2**63 - 1) // 100
_NONE = -2**62  # a place that no score has taken


def _scaled(scale: int):
    """Components as integers, held as doubles; rows that take no part go."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep, vecs, dims = [], [], []
            for label, e in zip(pdf["label"], pdf["embedding"]):
                v = None if e is None or label is None else np.asarray(e, dtype="<f8")
                ok = v is not None and v.ndim == 1 and bool(np.isfinite(v).all())  # a null component is a NaN here
                keep.append(ok)
                if ok:
                    with np.errstate(over="ignore"):
                        vecs.append(np.nan_to_num(np.floor(v * scale)).tobytes())
                    dims.append(len(v))
            yield pdf.loc[keep, ["vec_id", "label"]].assign(dim=dims, vec=vecs)
    return run


def prepared(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows that take part, written; one row of each vec_id."""
    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null")
    rows = materialize(read.mapInPandas(_scaled(scale), "vec_id long, label string, dim int, vec binary"), "neg-rows")
    repeated = materialize(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "neg-repeated")
    if repeated.isEmpty():
        return rows
    least = rows.join(small_side(repeated), "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "dim", "vec")).alias("x"))
    return materialize(rows.join(small_side(repeated), "vec_id", "left_anti").unionByName(least.select("vec_id", "x.*")), "neg-once")


def _matrix(vecs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), dtype="<f8").reshape(len(vecs), dim)


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two matrices of integers."""
    if not x.size or not y.size:
        return np.zeros((len(x), len(y)))
    if float(np.abs(x).max()) * float(np.abs(y).max()) * x.shape[1] < 2**53:
        return x @ y.T  # doubles hold every partial sum
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(x) @ whole(y).T, -LIMIT, LIMIT).astype(np.int64)


class Anchors:
    """A block of anchors of one length, by label."""

    def __init__(self, pdf: pd.DataFrame, dim: int):
        pdf = pdf.sort_values(["label", "vec_id"], ignore_index=True)
        self.ids, self.vecs = pdf["vec_id"].to_numpy(np.int64), _matrix(pdf["vec"], dim)
        self.code = {label: i for i, label in enumerate(pdf["label"].unique())}
        self.labels = pdf["label"].map(self.code).to_numpy(np.int64)
        self.top: np.ndarray = np.empty(0)  # upper limits of its slots, descending
        self.low: np.ndarray = np.empty(0)  # least score that any window takes


def _meetings(pdf: pd.DataFrame, blocks: dict[int, Anchors]):
    """Blocks of anchors with a bounded number of rows of their length."""
    for dim, part in pdf.groupby("dim"):
        if dim in blocks:
            a = blocks[dim]
            labels = part["label"].map(a.code).fillna(-1).to_numpy(np.int64)
            vecs, ids = _matrix(part["vec"], dim), part["vec_id"].to_numpy(np.int64)
            for s in range(0, len(ids), SIDE):
                yield a, vecs[s:s + SIDE], ids[s:s + SIDE], labels[s:s + SIDE]


def _rows(blocks: dict[int, Anchors], best: dict[int, Best], per: int) -> Iterator[pd.DataFrame]:
    for dim, a in blocks.items():
        place, score, ident = best[dim].told()
        yield pd.DataFrame({"anchor_id": a.ids[place // per], "slot": (place % per).astype(np.int32), "score": score, "id": ident})


def _positives(shared, k: int):
    """The best rows of each anchor's label that a task reads."""
    def run(batches):
        blocks = shared.value
        best = {dim: Best(len(a.ids), k) for dim, a in blocks.items()}
        for pdf in batches:
            for a, vecs, ids, labels in _meetings(pdf, blocks):
                b = best[a.vecs.shape[1]]
                for code in np.unique(labels[labels >= 0]):
                    of, (lo, hi) = labels == code, np.searchsorted(a.labels, [code, code + 1])
                    rows = ids[of]
                    for s in range(lo, hi, SIDE):
                        at = np.arange(s, min(s + SIDE, hi))
                        score = inner(a.vecs[at], vecs[of])
                        ok = b.could(at[:, None], score, rows) & (rows != a.ids[at][:, None])
                        i, j = np.nonzero(ok)
                        b.add(at[i], score[i, j], rows[j])
        yield from _rows(blocks, best, 1)
        give_back()
    return run


def _negatives(shared, k: int):
    """The best rows of other labels in each slot of each anchor."""
    def run(batches):
        blocks = shared.value
        best = {dim: Best(a.top.size, k) for dim, a in blocks.items()}
        for pdf in batches:
            for a, vecs, ids, labels in _meetings(pdf, blocks):
                b, slots = best[a.vecs.shape[1]], a.top.shape[1]
                for s in range(0, len(a.ids), SIDE):
                    score = inner(a.vecs[s:s + SIDE], vecs)
                    i, j = np.nonzero((score <= a.top[s:s + SIDE, :1]) & (score >= a.low[s:s + SIDE, None]) & (labels != a.labels[s:s + SIDE, None]))
                    got, i = score[i, j].astype(np.int64), i + s
                    place = i * slots + (a.top[i] >= got[:, None]).sum(axis=1) - 1
                    ok = b.could(place, got, ids[j])
                    b.add(place[ok], got[ok], ids[j][ok])
        yield from _rows(blocks, best, next((a.top.shape[1] for a in blocks.values()), 1))
        give_back()
    return run


def _limits(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the greatest score in a positive's window."""
    return -((-low * score) // 100), (high * score) // 100


def _with_slots(blocks: dict[int, Anchors], positives: pd.DataFrame, k: int, low: int, high: int) -> dict[int, Anchors]:
    scores: dict[int, list[int]] = {}
    for anchor, score in zip(positives["anchor_id"].tolist(), positives["score"].tolist()):
        scores.setdefault(anchor, []).append(score)
    for a in blocks.values():
        a.top, a.low = np.full((len(a.ids), k), _NONE, dtype=np.int64), np.full(len(a.ids), 2**62, dtype=np.int64)
        for i, anchor in enumerate(a.ids.tolist()):
            open_ = [(lo, hi) for lo, hi in (_limits(s, low, high) for s in scores.get(anchor, ())) if lo <= hi]
            if open_:
                tops = sorted({hi for _, hi in open_}, reverse=True)
                a.top[i, :len(tops)], a.low[i] = tops, min(lo for lo, _ in open_)
    return blocks


def _answers(k: int, low: int, high: int):
    """Suffix merge: from the lowest slot upwards the best ``k`` at or below
    each upper limit; of these a window takes those it reaches down to."""
    def run(batches):
        out = []
        for rows in grouped(batches, ["anchor_id"]):
            anchor = int(rows["anchor_id"].iloc[0])
            at, slots = [], {}
            for slot, score, ident in zip(rows["slot"].tolist(), rows["score"].tolist(), rows["id"].tolist()):
                at.append((score, ident)) if slot < 0 else slots.setdefault(slot, []).append((-score, ident))
            tops = sorted({hi for lo, hi in (_limits(s, low, high) for s, _ in at) if lo <= hi}, reverse=True)
            suffix: list[tuple[int, int]] = []
            best = {}
            for slot in range(len(tops) - 1, -1, -1):
                suffix = sorted([*suffix, *slots.get(slot, ())])[:k]
                best[tops[slot]] = suffix
            for score, positive in at:
                least, most = _limits(score, low, high)
                if least <= most:
                    out += [(anchor, positive, rank + 1, ident, score, -s) for rank, (s, ident) in enumerate(best[most]) if -s >= least]
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=COLUMNS)
                out = []
        yield pd.DataFrame(out, columns=COLUMNS)
    return run


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _merged(partial: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95, scale: int = 256, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """For each anchor (a row of ``vectors(vec_id, embedding, label, ...)`` for
    which ``is_anchor``, a condition on vec_id and label, is true) and each of
    its ``positives`` best other rows of the same label: the best ``negatives``
    rows of other labels whose score is at least ``low`` and at most ``high``
    per cent of the positive's. A score is the integer inner product of the
    components ``floor(scale * x)``; higher ones come first, ties by smaller id.

    Defined cases: rows without an id, label or vector, or with a null or
    non-finite component, take no part; of rows that share an id, that with
    the least label and vector stays, so repeated rows count once; only vectors
    of one length are compared; a positive with a negative score has no window;
    scores beyond 9.2e16 saturate; further columns are ignored; empty tables
    give empty ones."""
    spark, sc = vectors.sparkSession, vectors.sparkSession.sparkContext
    rows = prepared(vectors, scale)
    chosen = rows.where(is_anchor)
    n, most = chosen.agg(F.count("*"), F.max(F.length("vec"))).first()
    found = [spark.createDataFrame([], SCHEMA)]
    if n:
        parts = math.ceil(n * (most + 64) / anchor_bytes)
        chosen = materialize(chosen.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts))).repartition("part"), "neg-anchors")
        for part in range(parts):
            pdf = chosen.where(F.col("part") == part).toPandas()
            blocks = {int(dim): Anchors(of, int(dim)) for dim, of in pdf.groupby("dim")}
            if blocks:
                found.append(_pass(rows, sc, blocks, positives, negatives, low, high))
    out = found[0]
    for df in found[1:]:
        out = out.unionAll(df)
    return out


def _pass(rows: DataFrame, sc, blocks: dict[int, Anchors], positives: int, negatives: int, low: int, high: int) -> DataFrame:
    schema = "anchor_id long, slot int, score long, id long"
    sent = sc.broadcast(blocks)
    near = materialize(_merged(rows.mapInPandas(_positives(sent, positives), schema), positives), "neg-positives")
    limits = near.select("anchor_id", "score").toPandas()  # a few rows for each anchor of the block
    slotted = sc.broadcast(_with_slots(blocks, limits, positives, low, high))
    hard = _merged(rows.mapInPandas(_negatives(slotted, negatives), schema), negatives)
    both = hard.unionByName(near.withColumn("slot", F.lit(-1))).repartition("anchor_id").sortWithinPartitions("anchor_id")
    out = materialize(both.mapInPandas(_answers(negatives, low, high), SCHEMA), "neg-found")
    sent.destroy(), slotted.destroy()
    return out
