"""Ranked lexical search by two trees.

Items and documents are vectors over the terms of the items: an item holds the
weights of its terms, a document the impact of each term it contains. Both are
put into hierarchies whose nodes hold the maximum of each coordinate. The
product of two nodes' maxima bounds the score of every pair below them; where
it stays under the weakest k-th score of the node's items, the whole batch of
pairs is skipped. What remains is scored exactly.

Documents are read once for their vectors over the items' terms, and these once
for the search; each task keeps the best documents of each item, and the tasks'
lists are merged. Items are sent to tasks in blocks of a fixed size of text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Best, materialize, tidy, utf8

#: Bytes of item texts that one pass serves.
ITEM_BYTES = 1 << 20
#: Items of a leaf; documents of a leaf, and nodes of one level that make one of the next.
ITEM_LEAF, DOC_LEAF, FAN = 8, 16, 4
#: Cells of the matrix of documents that a task holds at once.
CELLS = 1 << 23

# A-Z to lower case, all of ASCII but digits and letters to a space; other
# characters are more than one byte long, none of which is ASCII
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8, only A-Z lower-cased; null has none."""
    return utf8(text).translate(_BYTES).split() if text else []


# -- vectors of documents

def _vectors(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = shared.value
        for batch in batches:
            n, ends, cols, tfs = [], [0], [], []
            for text in batch.column("text").to_pylist():
                words = terms(text)
                n.append(len(words))
                for word, tf in Counter(words).items():
                    if (col := columns.get(word)) is not None:
                        cols.append(col)
                        tfs.append(tf)
                ends.append(len(cols))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(cols, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], names=["doc_id", "n", "cols", "tfs"])
    return tidy(run)


# -- the two trees

@dataclass
class ItemNode:
    """Items ``lo`` to ``hi`` of the block, the columns that any of them
    holds and the greatest weights there; at a leaf also the items' own."""
    lo: int
    hi: int
    cols: np.ndarray
    most: np.ndarray
    own: np.ndarray | None
    parts: list[ItemNode]


def item_tree(items: list[np.ndarray], weights: np.ndarray) -> tuple[ItemNode, list[int]]:
    """A tree over items, given by their columns, and the order in which it
    holds them: a node is halved by the term that halves its items best."""
    order: list[int] = []

    def grow(some: list[int]) -> ItemNode:
        lo = len(order)
        cols = np.unique(np.concatenate([items[i] for i in some]))
        if len(some) <= ITEM_LEAF:
            order.extend(some)
            own = np.stack([np.where(np.isin(cols, items[i]), weights[cols], 0.0) for i in some], axis=1)
            return ItemNode(lo, len(order), cols, own.max(axis=1), own, [])
        held = np.bincount(np.concatenate([items[i] for i in some]), minlength=len(weights))
        term = int(np.argmin(np.abs(held - len(some) / 2)))
        ranked = sorted(some, key=lambda i: term not in items[i])  # those with the term first
        parts = [grow(ranked[:len(some) // 2]), grow(ranked[len(some) // 2:])]
        return ItemNode(lo, len(order), cols, weights[cols], None, parts)

    return grow(list(range(len(items)))), order


def doc_tree(impacts: np.ndarray) -> list[np.ndarray]:
    """Greatest impacts of the nodes of each level, the coarsest first."""
    levels = [np.maximum.reduceat(impacts, np.arange(0, len(impacts), DOC_LEAF), axis=0)]
    while len(levels[0]) > 1:
        levels.insert(0, np.maximum.reduceat(levels[0], np.arange(0, len(levels[0]), FAN), axis=0))
    return levels


class Search:
    """The best documents of a block's items, over any number of chunks."""

    def __init__(self, root: ItemNode, k: int):
        self.root, self.best = root, Best(root.hi, k)
        self.scored = self.met = 0  # pairs

    def chunk(self, impacts: np.ndarray, ids: np.ndarray) -> None:
        self.impacts, self.ids, self.levels = impacts, ids, doc_tree(impacts)
        self.met += len(ids) * self.root.hi
        self._meet(self.root, 0, np.arange(len(self.levels[0])))

    def _weakest(self, node: ItemNode) -> int:
        return max(int(self.best.score[node.lo:node.hi, -1].min()), 1)

    def _meet(self, node: ItemNode, level: int, docs: np.ndarray) -> None:
        """Bounds of an item node and doc nodes of a level; what they don't
        exclude meets one step further down, in items and documents."""
        bound = self.levels[level][np.ix_(docs, node.cols)] @ node.most
        keep = bound >= self._weakest(node)
        docs, bound = docs[keep], bound[keep]
        if not len(docs):
            return
        if level + 1 < len(self.levels):
            below = (docs[:, None] * FAN + np.arange(FAN)).ravel()
            below = below[below < len(self.levels[level + 1])]
            for part in node.parts or [node]:
                self._meet(part, level + 1, below)
        elif node.parts:
            for part in node.parts:
                self._meet(part, level, docs)
        else:
            self._score(node, docs[np.argsort(-bound, kind="stable")], -np.sort(-bound, kind="stable"))

    def _score(self, node: ItemNode, docs: np.ndarray, bound: np.ndarray) -> None:
        for s in range(0, len(docs), DOC_LEAF):  # the most promising first
            near = docs[s:s + DOC_LEAF][bound[s:s + DOC_LEAF] >= self._weakest(node)]
            if not len(near):
                return
            at = (near[:, None] * DOC_LEAF + np.arange(DOC_LEAF)).ravel()
            at = at[at < len(self.ids)]
            score = self.impacts[np.ix_(at, node.cols)].astype(np.float64) @ node.own  # whole numbers below 2**53
            self.scored += score.size
            i, j = np.nonzero(score > 0)
            got, place, ids = score[i, j].astype(np.int64), j + node.lo, self.ids[at[i]]
            ok = self.best.could(place, got, ids)
            self.best.add(place[ok], got[ok], ids[ok])


def _impacts(n: np.ndarray, of: np.ndarray, tfs: np.ndarray, total: int, length: int) -> np.ndarray:
    m = np.array([50 + 50 * int(x) * total // length for x in n], dtype=np.int64)
    return (1_000_000_000 * tfs) // (1000 * tfs + 20 * m[of])


def _found(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, names, weights, total, length = shared.value
        search = Search(root, k)
        step = max(64, min(4096, CELLS // len(weights)))
        for batch in batches:
            ids, n = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("n").to_numpy()
            ends = batch.column("cols").offsets.to_numpy()
            cols, tfs = (batch.column(c).values.to_numpy() for c in ("cols", "tfs"))
            for s in range(0, len(ids), step):
                e = min(s + step, len(ids))
                of = np.repeat(np.arange(e - s), np.diff(ends[s:e + 1]))
                at = cols[ends[s]:ends[e]]
                impact = _impacts(n[s:e], of, tfs[ends[s]:ends[e]].astype(np.int64), total, length)
                dense = np.zeros((e - s, len(weights)), dtype=np.float32)  # impacts are below 10**6
                dense[of, at] = impact
                # documents that share their weightiest term are neighbours
                first = np.argmax(dense * weights.astype(np.float32), axis=1)
                order = np.lexsort((n[s:e], first))
                search.chunk(dense[order], ids[s:e][order])
        place, score, ident = search.best.told()
        yield pa.RecordBatch.from_arrays([pa.array([names[p] for p in place.tolist()], pa.string()), pa.array(ident, pa.int64()), pa.array(score, pa.int64())],
                                         names=["item", "doc_id", "score"])
    return tidy(run)


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``k`` best documents of ``docs(doc_id, text, ...)`` with a score
    above 0 for each item of ``items(item_id, text, ...)``: ``item_id, rank``
    (from 1)``, doc_id, score``, equal scores by ascending doc_id.

    Terms are runs of digits, letters and characters beyond ASCII; only A-Z are
    lower-cased. With N documents that have terms, L terms in all, n terms in
    the document, df documents that hold a term and tf places where it stands
    there, the score sums ``w * ((10**9 * tf) div (1000 * tf + 20 * m))`` over
    the item's distinct terms, ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``
    and ``m = 50 + (50 * n * N) div L``.

    Defined cases: a null text has no terms, and an item without terms no
    documents; rows without an item_id are no items, and rows that share one
    are one item with the terms of all; documents without an id count in the
    statistics but are not ranked; repeated documents are ranked each; further
    columns are ignored; empty tables give empty ones."""
    spark = docs.sparkSession
    kind = dict(items.dtypes)["item_id"]
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).where("item is not null and text is not null")
    n, size = asked.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    parts = math.ceil(((size or 0) + 64 * n) / item_bytes)
    asked = asked.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)))
    for part in range(parts):
        held: dict[str, set[bytes]] = {}
        for row in asked.where(F.col("part") == part).select("item", "text").toLocalIterator():  # a block of bounded size
            held.setdefault(row.item, set()).update(terms(row.text))
        held = {item: of for item, of in sorted(held.items()) if of}
        if held:
            out = out.unionAll(_pass(read, held, k).select(F.col("item").cast(kind).alias("item_id"), "rank", "doc_id", "score"))
    return out


def _pass(read: DataFrame, held: dict[str, set[bytes]], k: int) -> DataFrame:
    sc = read.sparkSession.sparkContext
    columns = {term: i for i, term in enumerate(sorted(set().union(*held.values())))}
    sent = sc.broadcast(columns)
    vectors = materialize(read.mapInArrow(_vectors(sent), "doc_id long, n long, cols array<int>, tfs array<int>"), "search-vectors")
    total, length = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.full(len(columns), np.floor(1000 * math.log(2 * total + 2)))
    for row in vectors.select(F.explode("cols").alias("col")).groupBy("col").count().toLocalIterator():  # one row per term of the block
        weights[row["col"]] = math.floor(1000 * math.log((2 * total + 2) / (2 * row["count"] + 1)))
    root, order = item_tree([np.array(sorted(columns[t] for t in of)) for of in held.values()], weights)
    names = list(held)
    tree = sc.broadcast((root, [names[i] for i in order], weights, total, length))
    found = vectors.where("doc_id is not null and size(cols) > 0").mapInArrow(_found(tree, k), "item string, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    out = materialize(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "search-found")
    sent.destroy(), tree.destroy()
    return out
