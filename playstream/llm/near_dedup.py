"""MinHash near-duplicate detection over word shingles.

1. Each text becomes its set of distinct word shingles (64-bit hashes). Many
   universal hash minima make its signature; equal sets form one class, so a
   text that is copied a million times is one row from there on.
2. Bands of the signature are the bucket keys. In every bucket the member
   with the smallest id is the centre; members are paired with it (a star, so
   pairs stay linear), checked on signatures, then on full sets.
3. Components of these links. A bucket whose members now lie in more than one
   component still may hide links: its members outside the component that has
   most of them meet all members in blocks of bounded size. Blocks are as large
   as a task holds with ease, so that few rows are repeated for them. Signatures
   select who has a possible partner there; the selected ones are compared on
   full sets where their signatures allow it, and a block yields links only
   between parts that it had not joined yet.
4. Components of all links, by alternating large-star and small-star.

Nothing is sampled or capped: a link that the bands bring together is always
confirmed or refuted on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, ids_of, is_text, kept, materialize, small_side, tidy, together, utf8, whole_groups
from .components import connected_components

#: Words remembered by a worker; more only cost a hash each.
CACHE_WORDS = 100_000
#: Members of one side of a block, and the bytes of their full sets.
BLOCK, BLOCK_BYTES = 1024, 16 << 20
_RNG = np.random.RandomState(20240607)
_WORD_C = _RNG.randint(0, 2**63 - 1, size=64, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    """Hashes of words, computed once per word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


def shingle_set(text, size: int, cache: dict) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of the words
    ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a shorter text is one
    shingle, one without words none."""
    if not is_text(text):
        return np.empty(0, dtype=np.uint64)
    words = utf8(text).lower().split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=n)
    k = min(size, n)
    acc = np.full(n - k + 1, np.uint64(k), dtype=np.uint64)
    for i in range(k):
        acc += w[i:n - k + 1 + i] * _WORD_C[i]
    return np.unique(_mix(acc))


class MinHash:
    """``bands * rows`` multiply-add hash functions over 32-bit words."""

    def __init__(self, bands: int, rows: int):
        rng = np.random.RandomState(7)
        self.bands, self.rows = bands, rows
        n = bands * rows
        self.a = (rng.randint(0, 2**31, size=n, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.randint(0, 2**32, size=n, dtype=np.int64).astype(np.uint32)[:, None]
        self.c = rng.randint(0, 2**63 - 1, size=(bands, rows), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = _mix(np.arange(1, bands + 1, dtype=np.uint64))

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        best = np.full(len(self.a), 0xFFFFFFFF, dtype=np.uint32)
        for i in range(0, len(x), 1024):
            np.minimum(best, (self.a * x[None, i:i + 1024] + self.b).min(axis=1), out=best)
        return best

    def keys(self, sig: np.ndarray) -> np.ndarray:
        s = sig.reshape(self.bands, self.rows).astype(np.uint64)
        return _mix((s * self.c).sum(axis=1, dtype=np.uint64) + self.salt).view(np.int64)


def _signed(size: int, bands: int, rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mh, cache = MinHash(bands, rows), kept("near_dedup", _Words)
        for pdf in batches:
            n, key, sigs, keys = [], [], [], []
            for text in pdf["text"]:
                s = shingle_set(text, size, cache)
                n.append(len(s))
                key.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                sig = mh.signature(s) if len(s) else None
                sigs.append(None if sig is None else sig.tobytes())
                keys.append(None if sig is None else mh.keys(sig))
            yield pd.DataFrame({"doc_id": pd.array(ids_of(pdf["doc_id"]), dtype="Int64"), "n_shingles": n, "set_key": key, "sig": sigs, "bands": keys})
    return tidy(run)


def _full_sets(size: int):
    """The shingle sets of texts as in ``shingle_set``, by another hash of the
    words: those of many texts are hashed together."""
    def run(batches):
        from .passages import TOGETHER, flat_words
        for pdf in batches:
            hashes = []
            for part in together([t if is_text(t) else "" for t in pdf["text"]], TOGETHER, 10_000):
                w, bounds, _, _ = flat_words(part)
                k = np.minimum(np.diff(bounds), size)  # a shorter text is one shingle
                n = np.where(k > 0, np.diff(bounds) - k + 1, 0)
                ends = np.cumsum(n)
                at = np.repeat(bounds[:-1] - (ends - n), n) + np.arange(ends[-1])
                k = np.repeat(k, n)
                acc = k.astype(np.uint64)
                for i in range(size):
                    acc += np.where(i < k, w[np.minimum(at + i, len(w) - 1)] * _WORD_C[i], np.uint64(0))
                hashes += [np.unique(s).tobytes() for s in np.split(_mix(acc), ends[:-1])]
            yield pd.DataFrame({"id": pdf["id"], "hashes": hashes})
    return tidy(run)


def _agree(percent_bound: float):
    """Keep pairs whose signatures agree on at least this share of minima."""
    def run(batches):
        for pdf in batches:
            if len(pdf):
                a = np.frombuffer(b"".join(pdf["sig_a"]), dtype=np.uint32).reshape(len(pdf), -1)
                b = np.frombuffer(b"".join(pdf["sig_b"]), dtype=np.uint32).reshape(len(pdf), -1)
                yield pdf.loc[(a == b).mean(axis=1) >= percent_bound, ["u", "v"]]
    return tidy(run)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct hashes."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    c = np.concatenate([a, b])
    c.sort()
    both = np.count_nonzero(c[1:] == c[:-1])
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent: int):
    def run(batches):
        for pdf in batches:
            ok = [similar(np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64), percent)
                  for a, b in zip(pdf["hashes_a"], pdf["hashes_b"])]
            yield pdf.loc[np.array(ok, dtype=bool), ["u", "v"]]
    return tidy(run)


#: Pairs of signatures that are compared at once.
PAIRS = 20_000


def _pairs(g: pd.DataFrame, starts: np.ndarray, bound: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows ``(p, q)`` of the blocks of a frame: the rest and its possible
    partners in another component, by block, p and q. In a block the rows of
    the rest come after the rows of all members."""
    rest, comp = g["rest"].to_numpy(), g["comp"].to_numpy()
    sig = np.frombuffer(b"".join(g["sig"]), dtype=np.uint32).reshape(len(g), -1)
    of = np.repeat(np.arange(len(starts)), np.diff([*starts, len(g)]))
    others = np.bincount(of[~rest], minlength=len(starts))
    left = np.flatnonzero(rest)
    n = others[of[left]]  # partners of each row of the rest
    ends = np.cumsum(n)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        k = np.arange(lo, min(lo + PAIRS, int(ends[-1])))
        row = np.searchsorted(ends, k, side="right")
        p = left[row]
        q = starts[of[p]] + k - (ends - n)[row]
        apart = comp[p] != comp[q]
        p, q = p[apart], q[apart]
        near = (sig[p] == sig[q]).mean(axis=1) >= bound
        yield p[near], q[near]


def _possible(bound: float):
    """Of each block, the members with a possible partner in another component."""
    def run(batches):
        for g, starts in whole_groups(batches, ["bucket", "i", "j"]):
            keep = np.zeros(len(g), dtype=bool)
            for p, q in _pairs(g, starts, bound):
                keep[p] = keep[q] = True
            if keep.any():
                yield g.loc[keep, ["bucket", "i", "j", "id", "comp", "rest", "sig"]]
    return tidy(run)


def _joined(percent: int, bound: float):
    """Links of a block on full sets, as long as they join two of its parts;
    only pairs whose signatures agree on enough minima are looked at."""
    def run(batches):
        for g, starts in whole_groups(batches, ["bucket", "i", "j"]):
            ids, comp, out, block = g["id"].to_numpy(), g["comp"].to_numpy(), [], -1
            hashes, part = g["hashes"].tolist(), {}

            def find(c):
                while part.setdefault(c, c) != c:
                    part[c] = c = part[part[c]]
                return c

            for p, q in _pairs(g, starts, bound):
                of = np.searchsorted(starts, p, side="right").tolist()
                for r, o, b, c, d in zip(p.tolist(), q.tolist(), of, comp[p].tolist(), comp[q].tolist()):
                    if b != block:
                        block = b
                        part.clear()
                    x, y = find(c), find(d)
                    if x != y and similar(np.frombuffer(hashes[r], dtype=np.uint64), np.frombuffer(hashes[o], dtype=np.uint64), percent):
                        part[max(x, y)] = min(x, y)
                        out.append((ids[r], ids[o]))
            if out:
                yield pd.DataFrame(out, columns=["u", "v"])
    return tidy(run)


def _sets_of(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("id").alias("u"), F.col("hashes").alias("hashes_a"))
    b = sets.select(F.col("id").alias("v"), F.col("hashes").alias("hashes_b"))
    return a.join(small_side(pairs), "u").join(b, "v")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80,
                    bands: int = 26, rows: int = 6, slack: float = 4.0) -> DataFrame:
    """Return one row per row of ``docs(doc_id, text, ...)``: ``doc_id``,
    ``n_shingles``, ``component_id`` (the smallest doc_id reachable over links
    of Jaccard similarity >= ``percent`` / 100, itself included), ``kept``.

    26 bands of 6 minima miss a pair of similarity 0.85 with probability
    (1 - 0.85 ** 6) ** 26 = 5e-6 and one of 0.9 with 2e-9; the signature check
    lets through whatever lies less than ``slack`` standard errors below the
    threshold. Defined cases: a null, empty or blank text has no shingle and
    is its own component; rows with a null id have a null component and are
    kept (they cannot be named); equal rows get equal results; further
    columns are ignored; an empty table gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(docs.select(id_text("doc_id"), "text").mapInPandas(
        _signed(shingle_words, bands, rows),
        "doc_id long, n_shingles long, set_key string, sig binary, bands array<long>"), "minhash")
    return clustered(signed, docs, shingle_words, percent, bands, rows, slack)


def clustered(signed: DataFrame, docs: DataFrame, shingle_words: int, percent: int, bands: int, rows: int, slack: float = 4.0) -> DataFrame:
    """``near_duplicates`` from written signatures ``signed(doc_id, n_shingles,
    set_key, sig, bands)`` of ``docs(doc_id, text)``."""
    bound = percent / 100 - slack * (percent / 100 * (1 - percent / 100) / (bands * rows)) ** 0.5
    named = signed.where("doc_id is not null and set_key is not null")
    classes = materialize(named.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")), "minhash-class")
    # of a class only one row goes on; rows that share an id and differ in text are rows of their own classes
    copies = materialize(named.select("doc_id", "set_key").join(classes.where("n > 1"), "set_key")
                         .where("doc_id <> id").select("doc_id", "set_key"), "minhash-copy")
    reps = (named.join(small_side(copies, 500_000), ["doc_id", "set_key"], "left_anti")
            .select(F.col("doc_id").alias("id"), "n_shingles", "sig", "bands"))
    rows_ = reps.select("id", "n_shingles", F.explode("bands").alias("bucket"))
    # written before it is joined, so that a bucket that holds much of the rows is split by the skew join
    stars = materialize(rows_.groupBy("bucket").agg(F.min("id").alias("centre"), F.count("*").alias("n"))
                        .where("n > 1"), "minhash-star")
    members = materialize(rows_.join(stars, "bucket"), "minhash-bucket")

    wanted = small_side(materialize(members.select("id").distinct(), "minhash-member"))
    sets = materialize(
        docs.withColumnRenamed("doc_id", "id").join(wanted, "id")
        .mapInPandas(_full_sets(shingle_words), "id long, hashes binary")
        .dropDuplicates(["id", "hashes"]), "minhash-set")
    sig = materialize(reps.join(wanted, "id").select("id", "sig"), "minhash-sig")
    star = materialize(members.where("id <> centre").select(F.col("id").alias("u"), F.col("centre").alias("v")).distinct(), "minhash-pair")
    close = materialize(
        sig.select(F.col("id").alias("u"), F.col("sig").alias("sig_a")).join(small_side(star), "u")
        .join(sig.select(F.col("id").alias("v"), F.col("sig").alias("sig_b")), "v")
        .mapInPandas(_agree(bound), "u long, v long"), "minhash-close")
    links = materialize(_sets_of(close, sets).mapInPandas(_confirm(percent), "u long, v long"), "minhash-link")
    found = materialize(connected_components(links), "minhash-comp")

    more = _rest_links(members, found, sig, sets, bound, percent)
    final = connected_components(links.unionAll(more))
    final = final.select(F.col("id"), F.col("component"))
    return (signed.select("doc_id", "n_shingles", "set_key")
            .join(classes.drop("n"), "set_key", "left").join(final, "id", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNull(), None)
                    .otherwise(F.coalesce("component", "id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _rest_links(members, found, sig, sets, bound, percent) -> DataFrame:
    """Links that the stars did not test and that join two components: in each
    bucket all members outside its largest component against all members."""
    m = materialize(members.join(found.select("id", F.col("component").alias("c")), "id", "left")
                    .select("bucket", "id", F.coalesce("c", "id").alias("comp"), "n_shingles"), "minhash-rest")
    parts = m.groupBy("bucket", "comp").agg(F.count("*").alias("k"), F.sum("n_shingles").alias("w"))
    split = materialize(
        parts.groupBy("bucket").agg(F.sum("k").alias("n"), F.sum("w").alias("w"), F.max(F.struct("k", "comp", "w")).alias("most"))
        .where(F.col("n") > F.col("most.k")), "minhash-split")

    def sides(rows: Column, shingles: Column) -> Column:
        return F.ceil(F.greatest(rows / BLOCK, 8 * shingles / BLOCK_BYTES)).cast("int")

    m = m.join(split, "bucket").select(
        "bucket", "id", "comp", (F.col("comp") != F.col("most.comp")).alias("rest"),
        sides(F.col("n") - F.col("most.k"), F.col("w") - F.col("most.w")).alias("kr"), sides(F.col("n"), F.col("w")).alias("kn"))
    spread = F.xxhash64("id")
    own_i, own_j = F.pmod(spread, F.col("kr")).cast("int"), F.pmod(spread, F.col("kn")).cast("int")
    as_rest = (m.where("rest").select("bucket", own_i.alias("i"), F.explode(F.sequence(F.lit(0), F.col("kn") - 1)).alias("j"), "id", "comp", F.lit(True).alias("rest")))
    as_all = m.select("bucket", F.explode(F.sequence(F.lit(0), F.col("kr") - 1)).alias("i"), own_j.alias("j"), "id", "comp", F.lit(False).alias("rest"))
    block = as_rest.unionAll(as_all)
    keys = ["bucket", "i", "j"]
    possible = materialize(
        block.join(sig, "id").repartition(*keys).sortWithinPartitions(*keys, "rest")
        .mapInPandas(_possible(bound), "bucket long, i int, j int, id long, comp long, rest boolean, sig binary"), "minhash-possible")
    return materialize(
        possible.join(sets, "id").repartition(*keys).sortWithinPartitions(*keys, "rest")
        .mapInPandas(_joined(percent, bound), "u long, v long"), "minhash-more")
