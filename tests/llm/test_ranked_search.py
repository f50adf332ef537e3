import math
import re
from collections import Counter

import numpy as np

from playstream.llm import ranked_search as R

from .oracle import assert_matches_sql

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = ["the", "of", "Año", "x1", "été", "ß", "ΑΒΓ", "zeta", "q", "漢字", "w2", "and", "in", "rare", "more", "z z"]


def told(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=50):
    bags = [(i, Counter(told(t)), len(told(t))) for i, t in docs]
    total, length = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(told(t))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, bag, n in bags:
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * (50 + 50 * n * total // length))) for t in terms if t in bag)
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, item string, score int").repartition(4)
    b = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id long, text string, doc_id string, n int")
    return sorted(tuple(r) for r in R.ranked(d, b, **kw).collect())


def made(seed, n_docs, n_items):
    rng = np.random.RandomState(seed)
    def text(n):
        return " ".join(rng.choice(WORDS + [f"v{i}" for i in range(300)], n, p=[0.03] * 16 + [0.52 / 300] * 300).tolist())
    return [(int(i), text(rng.randint(0, 90))) for i in rng.permutation(n_docs)], [(i, text(rng.randint(1, 30))) for i in range(n_items)]


def test_query_matches_sql(spark):
    assert_matches_sql(spark, "op13_ranked_search")


def test_matches_brute_force(spark):
    docs, items = made(1, 700, 60)
    want = brute(docs, items)
    assert len(want) == 3000
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, item_bytes=900) == want  # many blocks of items
    assert run(spark, docs, items, k=3) == brute(docs, items, 3)


def test_groups_of_copies_tie_by_id(spark):
    docs, items = made(2, 60, 5)
    docs += [(1000 + i, items[0][1]) for i in range(400)] + [(5000 - i, docs[0][1]) for i in range(300)]
    assert run(spark, docs, items) == brute(docs, items)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "--- ..."), (4, "The CAT"), (4, "The CAT"), (None, "the cat the cat"), (5, "É é cat"), (6, "a " * 200_000 + "cat"), (-9, "ÇÇ x"), (8, "cat_cat-CAT")]
    items = [(1, "cat é"), (1, "cat é"), (2, None), (3, "..."), (None, "cat"), (4, "unseen"), (5, "the"), (5, "x a"), (6, "çç ÇÇ")]
    want = brute(docs, items)
    assert want and run(spark, docs, items) == want
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, docs[:3], items) == []


def test_batches_are_pruned_exactly():
    rng = np.random.RandomState(3)
    n, v = 3000, 400
    impacts = np.zeros((n, v), dtype=np.float32)
    for i in range(n):  # documents of twenty topics
        cols = (i % 20) * 20 + rng.choice(20, 6, replace=False)
        impacts[i, cols] = rng.randint(1, 900_000, 6)
    impacts = impacts[np.argsort(np.arange(n) % 20, kind="stable")]
    items = [np.sort(t * 20 + rng.choice(20, 5, replace=False)) for t in range(20) for _ in range(3)]
    weights = rng.randint(1, 9000, v).astype(float)
    root, order = R.item_tree(items, weights)
    assert sorted(order) == list(range(60))
    search = R.Search(root, 5)
    ids = rng.permutation(n).astype(np.int64)
    for s in range(0, n, 1000):
        search.chunk(impacts[s:s + 1000], ids[s:s + 1000])
    place, score, ident = search.best.told()
    exact = impacts.astype(float) @ np.stack([np.where(np.isin(np.arange(v), items[i]), weights, 0) for i in order], axis=1)
    want = [(j, -int(s), int(i)) for j in range(60) for s, i in sorted(zip(-exact[:, j], ids))[:5]]
    assert list(zip(place.tolist(), score.tolist(), ident.tolist())) == [(j, -s if s < 0 else s, i) for j, s, i in want]
    assert search.scored < 0.2 * search.met
