import random

import numpy as np
import pytest

from playstream.llm import paragraph_dedup as P
from playstream.llm.near_dedup import MinHash
from playstream.llm.paragraph_dedup import repeated_paragraphs, tuned_bands, without_repeats
from playstream.llm.queries import QUERIES

from .test_near_dedup import brute, edited
from .test_passages import check

SF001 = "/root/testdata/sf0.001"


def lines_of(docs, min_words):
    out = []
    for d, t in dict(docs).items():
        if t and d is not None:
            at = 0
            for line in t.split("\n"):
                n = len(line.encode("utf-8", "surrogatepass").split())
                if n >= min_words:
                    out.append(((d, at), line, n))
                at += n
    return out


def expected(docs, min_words, percent=80):
    """Clusters of more than one line, from all pairs."""
    places = lines_of(docs, min_words)
    comp = {p: c for p, (_, c) in brute([x[:2] for x in places], percent).items()}
    size = {}
    for c in comp.values():
        size[c] = size.get(c, 0) + 1
    return sorted((p, n, c := comp[p], p == c) for p, _, n in places if size[comp[p]] > 1)


def found(rows):
    return sorted(((r.doc_id, r.start_word), r.n_words, (r.first_doc_id, r.first_word), r.kept) for r in rows if r.kind == "line")


def test_bands_are_tuned():
    for percent in (50, 80, 95):
        bands, rows = tuned_bands(percent, 1e-4)
        assert (1 - (percent / 100) ** rows) ** bands <= 1e-4 < (1 - (percent / 100) ** rows) ** (bands - 1)


def test_lines_together():
    rng, mh = np.random.RandomState(1), MinHash(4, 3)
    s = rng.randint(0, 400, 500).astype(np.uint64) * np.uint64(2**55 + 1)
    for some in ([(0, 7), (7, 30), (40, 41), (60, 499)], [(0, 7)], [(490, 495), (496, 500)], [(3, 9), (3, 9)][:1] + [(9, 12)]):
        at, n = np.array([a for a, _ in some]), np.array([b - a for a, b in some])
        assert np.array_equal(P._minima(mh, s, at, n), np.stack([mh.signature(s[a:b]) for a, b in some]))
        assert [k for k, _ in P._sets(s, at, n)] == [len(np.unique(s[a:b])) for a, b in some]
    (_, a), (_, b), (_, c) = P._sets(np.array([5, 6, 5, 6, 6, 5, 5, 7], dtype=np.uint64), np.array([0, 3, 5]), np.array([3, 3, 3]))
    assert a == b != c


def test_query_matches_brute_force(spark):
    """Every repeated window of 50 words is told, and every near-duplicate line."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows = QUERIES["op2_paragraph_minhash"](spark, SF001).collect()
    assert found(rows) == expected(docs, 40)
    check(docs, [r for r in rows if r.kind == "passage"], 50)


def test_planted_passages_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(P, "PART", 50)
    rng = random.Random(8)
    words = lambda n: ["w%d" % rng.randrange(9000) for _ in range(n)]
    passages = [words(60) for _ in range(3)]
    docs = []
    for i in range(60):
        lines = [" ".join(words(rng.randrange(1, 80))) for _ in range(rng.randrange(4))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), edited(rng, passages[i % 9 // 3], rng.randrange(3)))
        docs.append((i * (1 << 50) - (1 << 60), "\n".join(lines)))
    docs += [(7, None), (8, ""), (9, " \n \n"), (None, " ".join(passages[0])), (10, " ".join(passages[1]) + "\n" + " ".join(passages[1])), (12, "a b c " * 20_000), (13, "\n".join(" ".join(passages[2])
             for _ in range(2)) + "\nx" * 30_000)]
    df = spark.createDataFrame([(*d, 1) for d in docs + docs[-1:]], "doc_id long, text string, component_id int").repartition(3)
    got = repeated_paragraphs(df, line_words=20)
    rows = got.collect()
    assert found(rows) == expected(docs, 20)
    check(docs, [r for r in rows if r.kind == "passage"], 50)
    left = {r.doc_id: r.text for r in without_repeats(df, got).collect()}
    for d, t in docs:
        gone = {r.start_word + j for r in rows if r.doc_id == d and not r.kept for j in range(r.n_words)}
        assert (left[d] or "").split() == [w for j, w in enumerate((t or "").split()) if j not in gone or d is None]
        assert gone or left[d] == t
    assert repeated_paragraphs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repeated_paragraphs(df, line_words=3)
