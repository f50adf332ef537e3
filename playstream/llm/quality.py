"""Quality of documents by a linear-chain conditional random field over lines.

Each line is described by its own shape and by the shapes of the lines next
to it. The chain is trained on documents with a quality label, whose lines
all carry it; a document's score is the mean of its lines' marginal
probabilities of being good, weighted by their lengths.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chain import fit, marginals
from .common import is_text, tidy, together, utf8

#: Labelled documents that are fitted on, the longest text among them, and all
#: their lines.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_LINES = 3000, 200_000, 300_000
#: Documents scored together, their characters unless one is longer, and the
#: lines whose features are held at once.
BLOCK_DOCS, BLOCK_CHARS, BLOCK_LINES = 512, 8 << 20, 50_000
_CLASS = np.full(256, 1, dtype=np.uint8)  # 1: letters beyond ASCII
for _chars, _k in ((b"abcdefghijklmnopqrstuvwxyz", 2), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 3), (b"0123456789", 4),
                   (b" \t\r\n\x0b\x0c", 5), (b".,;:?'\"-()", 6), (b"!", 7), (b"|", 8)):
    _CLASS[list(_chars)] = _k
_CLASS[[b for b in range(128) if _CLASS[b] == 1]] = 9  # other ASCII marks
N_RAW = 17


@dataclass
class Model:
    """Weights over the standardised features, and the moves between states."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    moves: np.ndarray


def _lines(texts: list[str]) -> tuple[list[str], list[int], np.ndarray]:
    """The lines of all texts, how often each stands in its text, and lines per
    text. A text without any character is one empty line."""
    lines, seen, counts = [], [], []
    for text in texts:
        own = text.split("\n")
        counts.append(len(own))
        times = Counter(own)
        seen += map(times.__getitem__, own)
        lines += own
    return lines, seen, np.array(counts, dtype=np.int64)


def _raw(lines: list[str], times: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Each line's own features, and its weight."""
    rows = []
    for line, k in zip(lines, times):
        words = line.split()
        rows.append((len(words), len(set(words)), sum(map(eq, words, words[1:])), k))
    data = np.frombuffer(utf8("\n".join(lines)) + b"\n", dtype=np.uint8)
    kind = _CLASS[data]
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = (ends - starts).astype(np.float64)
    per = {k: np.add.reduceat((kind == k).astype(np.int64), starts).astype(np.float64) for k in (1, 2, 3, 4, 6, 7, 8, 9)}
    n, uniq, same, seen = np.array(rows, dtype=np.float64).T
    some = np.maximum(size, 1)
    words = np.maximum(n, 1)
    letters = per[1] + per[2] + per[3]
    raw = np.stack([
        np.log1p(size), np.log1p(n), letters / words / 8, letters / some, per[3] / np.maximum(per[2] + per[3], 1),
        per[4] / some, per[6] / some, per[7] / words, per[8] / words, per[9] / words, 1 - uniq / words, same / words,
        (seen > 1).astype(float), np.log(seen), (n == 0).astype(float), (n < 4).astype(float), (per[9] > 0.5 * n).astype(float)], axis=1)
    return raw, size + 1


def _blocks(texts: list[str], step: int) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Lines per text; and for every ``step`` lines their features (its own,
    those of the line before and the line after, whether it is the first or the
    last one) and their weights."""
    lines, times, counts = _lines(texts)
    first = np.zeros(len(lines), dtype=bool)
    first[np.concatenate([[0], np.cumsum(counts)[:-1]])] = True
    last = np.roll(first, -1)

    def each():
        for a in range(0, len(lines), step):
            b = min(a + step, len(lines))
            lo, hi = max(a - 1, 0), min(b + 1, len(lines))  # with the lines next to them
            raw, size = _raw(lines[lo:hi], times[lo:hi])
            own = slice(a - lo, b - lo)
            before, after = np.roll(raw, 1, axis=0)[own], np.roll(raw, -1, axis=0)[own]
            before[first[a:b]], after[last[a:b]] = 0, 0
            yield np.concatenate([raw[own], before, after, first[a:b, None], last[a:b, None]], axis=1), size[own]
    return counts, each()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line, lines per text, and the weight of each line."""
    counts, blocks = _blocks(texts, BLOCK_LINES)
    x, size = zip(*blocks)
    return np.concatenate(x), counts, np.concatenate(size)


def train(x: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> Model:
    """``labels``: 0 or 1 for each document, of ``counts`` lines each."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    weights, moves = fit(z, np.repeat(labels, counts).astype(np.int64), counts, 2)
    return Model(mean, scale, weights, moves)


def score(model: Model | None, texts: list[str]) -> np.ndarray:
    """Probability-weighted share of good lines; 0.5 without a model."""
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    counts, blocks = _blocks(texts, BLOCK_LINES)
    told = [(np.concatenate([(x - model.mean) / model.scale, np.ones((len(x), 1))], axis=1) @ model.weights, size) for x, size in blocks]
    scores, size = (np.concatenate(part) for part in zip(*told))
    good = marginals(scores, model.moves, counts)[0][:, 1]
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return np.clip(np.add.reduceat(good * size, starts) / np.add.reduceat(size, starts), 0.0, 1.0)


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for label, text in zip(pdf["quality"], pdf["text"]):
            x, _, _ = line_features([text if is_text(text) else ""])
            yield pd.DataFrame({"quality": [int(label)], "x": [x.astype("<f4").tobytes()]})


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
          sample_lines: int = SAMPLE_LINES) -> Model | None:
    """Fit on at most ``sample_docs`` labelled documents that are not held out,
    those of the smallest hashed ids, with texts of at most ``sample_chars``
    characters, as long as they have ``sample_lines`` lines together. Ids
    labelled twice count as bad if one label is 0; of texts that share an id
    that of the smallest hash is read; null labels and ids are passed over. None
    if not both labels occur."""
    told = (labels.where("doc_id is not null and quality in (0, 1)").where(~held_out())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    one = (read.join(F.broadcast(told), "doc_id").where(F.coalesce(F.length("text"), F.lit(0)) <= sample_chars)
           .groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text"), F.col("text"))).alias("t")).select("doc_id", "quality", "t.text"))
    upto = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # of the sample's rows
    some = one.withColumn("lines", F.sum(F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1))).over(upto)).where(F.col("lines") <= sample_lines)
    rows = some.select("doc_id", "quality", "text").mapInPandas(_features, "quality int, x binary").collect()
    rows.sort(key=lambda r: (r.quality, bytes(r.x)))  # the order of rows does not change the fit
    y = np.array([r.quality for r in rows], dtype=np.int64)
    if len(set(y.tolist())) < 2:
        return None
    width = 3 * N_RAW + 2
    each = [np.frombuffer(r.x, dtype="<f4").reshape(-1, width) for r in rows]
    return train(np.concatenate(each).astype(np.float64), y, np.array([len(e) for e in each], dtype=np.int64))


def score_documents(docs: DataFrame, model: Model | None, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher is better) and ``predicted`` (1
    if the score is at least ``threshold``) after its own columns, which must
    have ``text``; columns of these two names are replaced. A null text is
    scored as an empty one; without a model every score is 0.5."""
    from pyspark.sql.types import DoubleType

    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            texts = [t if is_text(t) else "" for t in texts]
            parts = [score(model, part) for part in together(texts, BLOCK_CHARS, BLOCK_DOCS)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    scored = docs.withColumn("score", F.pandas_udf(tidy(run), DoubleType())(F.col("text").cast("string")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
