"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors of cosine c are at distance sqrt(2 - 2c), so the threshold gives
an epsilon. Vectors are projected on their leading principal directions
(fitted on all of them, and never longer than the vectors are), sorted by the
epsilon cells of these coordinates, label by label, and cut into a few
large blocks of consecutive vectors. Two blocks meet only if their boxes are within epsilon;
in a meeting the two intervals are halved again and again, and halves that
are provably distant are skipped, before vectors are compared. Equal vectors
are one row from the start, and a meeting gives counts and a spanning set of
links, so a dense group costs no list of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grouped, id_text, ids_of, materialize, small_side
from .components import connected_components

#: Vectors of a block at least and at most, blocks of a label between these
#: bounds, and vectors of an interval that is compared as a whole. A vector is
#: sent to the blocks that its own one meets, so to ``BLOCKS`` and a few for the
#: ends of partitions, as long as a label has no more than ``BLOCKS`` times
#: ``LARGEST`` vectors.
BLOCK, LARGEST, BLOCKS, LEAF = 4096, 32_768, 16, 128
#: Leading principal directions.
DIRECTIONS = 6


def _prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keys, vecs, dims = [], [], []
        for label, e in zip(pdf["label"], pdf["embedding"]):
            v = None if e is None or label is None else np.asarray(e, dtype="<f8")
            # a null component is a NaN here
            ok = v is not None and v.ndim == 1 and len(v) > 0 and np.isfinite(v).all() and bool(np.any(v))
            raw = v.tobytes() if ok else None
            keys.append(xxhash.xxh3_128_hexdigest(raw + label.encode()) if ok else None)
            vecs.append(raw)
            dims.append(len(v) if ok else 0)
        yield pd.DataFrame({"vec_id": pd.array(ids_of(pdf["vec_id"]), dtype="Int64"), "label": pdf["label"], "key": keys, "dim": dims, "vec": vecs})


def _vectors(raw, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype="<f8").reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so that neither tiny nor huge components overflow their squares
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _units(dim: int):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"unit": list(_unit(_vectors(pdf["vec"], dim)))})
    return run


def _cells(directions: np.ndarray, eps: float):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                at = _unit(_vectors(pdf["vec"], len(directions))) @ directions
                yield pdf.assign(cell=list(np.floor(at / eps).astype(np.int32)), at=list(at))
    return run


def _blocks(batches):
    """Numbers the blocks of a sorted partition; a block has one label."""
    base, block, last, n = TaskContext.get().partitionId() << 32, -1, None, 0
    for pdf in batches:
        out = []
        for label, size in zip(pdf["label"], pdf["size"].tolist()):
            if label != last or n == size:
                block, last, n = block + 1, label, 0
            n += 1
            out.append(base + block)
        yield pdf.drop(columns=["cell", "size"]).assign(block=out)


def close_pairs(x: np.ndarray, y: np.ndarray, ax: np.ndarray, ay: np.ndarray, eps: float, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``x`` and ``y`` (unit vectors in grid order, with their
    leading coordinates) of the pairs of at least this cosine."""
    found, todo = [], [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        p, q = ax[a:b], ay[c:d]
        gap = np.maximum(0, np.maximum(p.min(axis=0) - q.max(axis=0), q.min(axis=0) - p.max(axis=0)))
        if gap @ gap > (eps * (1 + 1e-9)) ** 2:
            continue
        if b - a <= LEAF and d - c <= LEAF:
            i, j = np.nonzero(x[a:b] @ y[c:d].T >= cosine)
            found.append((i + a, j + c))
        elif b - a >= d - c:
            m = (a + b) // 2
            todo += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            todo += [(a, b, c, m), (a, b, m, d)]
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _meet(dim: int, eps: float, cosine: float):
    """Of each pair of blocks: how many vectors each class links with there,
    and links that join all it joins."""
    def run(batches):
        for g in grouped(batches, ["a", "b"]):
            left = g["left"].to_numpy()
            own = bool(g["a"].iloc[0] == g["b"].iloc[0])
            x, at = _unit(_vectors(g["vec"], dim)), np.stack(g["at"].to_list())
            ids, n = g["id"].to_numpy(), g["n"].to_numpy()
            u = np.flatnonzero(left)
            v = u if own else np.flatnonzero(~left)
            # the order of the rows of a block in its group is not kept by the shuffle
            u = u[np.lexsort((ids[u], *np.floor(at[u] / eps).T[::-1]))]
            v = v[np.lexsort((ids[v], *np.floor(at[v] / eps).T[::-1]))]
            i, j = close_pairs(x[u], x[v], at[u], at[v], eps, cosine)
            i, j = u[i], v[j]
            if own:
                i, j = i[i != j], j[i != j]
            if not len(i):
                continue
            links = np.zeros(len(g), dtype=np.int64)
            np.add.at(links, i, n[j])
            if not own:
                np.add.at(links, j, n[i])
            part = np.arange(len(g))

            def find(k):
                while part[k] != k:
                    part[k] = k = part[part[k]]
                return k

            to = ids.copy()
            for s, t in zip(i.tolist(), j.tolist()):
                s, t = find(s), find(t)
                if s != t:
                    if ids[s] > ids[t]:
                        s, t = t, s
                    part[t] = s
            for k in np.flatnonzero(links):
                to[k] = ids[find(k)]
            hit = links > 0
            yield pd.DataFrame({"u": ids[hit], "v": to[hit], "links": links[hit]})
    return run


def _linked(classes: DataFrame, dim: int, cosine: float, block: int) -> DataFrame:
    """``(u, v, links)`` over the classes of one dimension."""
    eps = (2 - 2 * cosine) ** 0.5
    k = min(DIRECTIONS, dim)
    own = classes.where(F.col("dim") == dim)
    directions = np.eye(dim)[:, :k]
    if own.limit(2).count() == 2:
        units = own.select("vec").mapInPandas(_units(dim), "unit array<double>").select(array_to_vector("unit").alias("unit"))
        directions = PCA(k=k, inputCol="unit", outputCol="pc").fit(units).pc.toArray()
    cells = own.select("id", "label", "n", "vec").mapInPandas(
        _cells(directions, eps), "id long, label string, n long, vec binary, cell array<int>, at array<double>")
    order = ["label", "cell", "id"]
    cells = materialize(cells, "ego-cell")
    size = F.least(F.lit(max(LARGEST, block)), F.greatest(F.lit(block), F.ceil(F.count("*") / BLOCKS))).cast("int")
    sizes = materialize(cells.groupBy("label").agg(size.alias("size")), "ego-size")
    rows = materialize(
        cells.join(small_side(sizes), "label").repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInPandas(_blocks, "id long, label string, n long, vec binary, at array<double>, block long"), "ego-block")
    box = materialize(rows.groupBy("label", "block").agg(
        *[f(F.col("at")[i]).alias(f"{name}{i}") for i in range(k) for name, f in (("lo", F.min), ("hi", F.max))]), "ego-box")
    # blocks within epsilon share a cell of the first coordinate or have adjacent ones
    first, last = F.floor(F.col("lo0") / eps), F.floor(F.col("hi0") / eps)
    a = box.withColumn("band", F.explode(F.sequence(first, last))).withColumnsRenamed({c: f"a_{c}" for c in box.columns if c != "label"})
    b = box.withColumn("band", F.explode(F.sequence(first - 1, last + 1))).withColumnsRenamed({c: f"b_{c}" for c in box.columns if c != "label"})
    gap = sum((F.greatest(F.lit(0.0), F.col(f"a_lo{i}") - F.col(f"b_hi{i}"), F.col(f"b_lo{i}") - F.col(f"a_hi{i}")) ** 2 for i in range(k)), F.lit(0.0))
    pairs = materialize(
        a.join(b, ["label", "band"]).where((F.col("a_block") <= F.col("b_block")) & (gap <= (eps * (1 + 1e-9)) ** 2))
        .select(F.col("a_block").alias("a"), F.col("b_block").alias("b")).distinct(), "ego-pair")
    sides = pairs.select("a", "b", F.col("a").alias("block"), F.lit(True).alias("left")).unionAll(
        pairs.where("a <> b").select("a", "b", F.col("b").alias("block"), F.lit(False).alias("left")))
    return (rows.select("block", "id", "n", "vec", "at").join(sides, "block")
            .repartition("a", "b").sortWithinPartitions("a", "b")
            .mapInPandas(_meet(dim, eps, cosine), "u long, v long, links long"))


def near_embeddings(vectors: DataFrame, cosine: float = 0.98, block: int = BLOCK) -> DataFrame:
    """Per row of ``vectors(vec_id, embedding, label, ...)``: ``vec_id``,
    ``n_links`` (other rows of the same label whose cosine in double precision
    is at least ``cosine``), ``component_id`` (the smallest vec_id reachable
    over links, itself included) and ``kept``.

    Defined cases: rows without an id, label or vector, and vectors that are
    empty, zero or hold a null or non-finite component, link with nothing and
    are kept, a row without an id with a null component; only vectors of one
    length are compared; repeated rows are rows of their own and link with
    each other; further columns are ignored."""
    read = vectors.select(id_text("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                          F.when(F.col("vec_id").isNotNull(), F.col("label").cast("string")).alias("label"))
    ready = materialize(read.mapInPandas(_prepare, "vec_id long, label string, key string, dim int, vec binary"), "ego")
    # a number of its own for each class, as one vec_id may name several vectors
    classes = materialize(ready.where("key is not null").groupBy("key", "label", "dim").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("n"), F.min("vec").alias("vec"))
        .withColumn("id", F.monotonically_increasing_id()), "ego-class")
    found = classes.select(F.col("id").alias("u"), F.col("id").alias("v"), F.lit(0).cast("long").alias("links")).limit(0)
    for dim in sorted(r.dim for r in classes.select("dim").distinct().collect()):  # lengths of vectors, one as a rule
        found = found.unionAll(_linked(classes, dim, cosine, block))
    found = materialize(found, "ego-link")
    comp = materialize(connected_components(found.select("u", "v")).join(classes.select("id", "low"), "id"), "ego-comp")
    least = materialize(comp.groupBy("component").agg(F.min("low").alias("least")), "ego-least")
    comp = comp.join(least, "component").select("id", "least")
    sums = found.groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links"))
    told = materialize(classes.select("key", "id", "low", "n").join(sums, "id", "left").join(comp, "id", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("least", "low").alias("component_id")), "ego-told")
    out = ready.select("vec_id", "key").join(told, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
