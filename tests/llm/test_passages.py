import random
from collections import defaultdict

import pytest

from playstream.llm import passages as P
from playstream.llm.passages import repeated_passages


def covered(docs, size):
    """``(doc_id, place)`` of all words of windows that stand at two places."""
    seen = defaultdict(set)
    words = {(d, t): t.encode("utf-8", "surrogatepass").lower().split() for d, t in docs if d is not None and t is not None}
    for key, w in words.items():
        for i in range(len(w) - size + 1):
            seen[tuple(w[i:i + size])].add((key, i))
    return {(key[0], i + j) for at in seen.values() if len(at) > 1 for key, i in at for j in range(size)}, seen, words


def told(rows):
    return {(r.doc_id, r.start_word + j) for r in rows for j in range(r.n_words)}


def check(docs, rows, size):
    want, seen, words = covered(docs, size)
    assert told(rows) == want
    texts = {d: w for (d, _), w in words.items()}
    for r in rows:
        w, f = texts[r.doc_id], texts[r.first_doc_id]
        win = tuple(w[r.start_word:r.start_word + size])
        first = min((key[0], i) for key, i in seen[win])
        assert first == (r.first_doc_id, r.first_word) and win == tuple(f[r.first_word:r.first_word + size])
        assert r.kept == (first == (r.doc_id, r.start_word))


def test_word_hashes(monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abü漢\x1f\x85\xa0", k=rng.choice([1, 2, 3, 9, 40]))) for _ in range(300)] + ["x" * n for n in (4096, 4097, 9000)]
    texts = ["".join(w + rng.choice([" ", "\n", "\t ", "\r\n", "\x0b"]) for w in rng.choices(words, k=n)) for n in (0, 1, 30, 400, 0, 200)] + ["\n\n", "A b", "\na B"]
    want = [w for t in texts for w in t.encode().lower().split()]
    for piece in (1 << 19, 64, 1):
        monkeypatch.setattr(P, "PIECE", piece)
        w, bounds, line, head = P.flat_words(texts)
        assert len(w) == len(want) == bounds[-1]
        assert len(set(zip(want, w.tolist()))) == len(set(want)) == len(set(w.tolist()))
        assert [bounds[i + 1] - bounds[i] for i in range(len(texts))] == [len(t.encode().split()) for t in texts]
        per = {}
        for k in line.tolist():
            per[k] = per.get(k, 0) + 1
        for t, h in zip(texts, head.tolist()):
            for i, text_line in enumerate(t.encode().split(b"\n")):
                assert per.get(h + i, 0) == len(text_line.split())


@pytest.mark.parametrize("size", [8, 50, 130])
def test_passages_inside_lines_and_over_line_ends(spark, size):
    rng = random.Random(size)
    words = lambda n: ["w%d" % rng.randrange(9000) for _ in range(n)]
    passages = [words(size + 2 * i) for i in range(5)]
    docs = []
    for i in range(60):
        parts = words(rng.randrange(0, 90))
        if i % 4 < 2:  # in the middle of a longer line, or cut by line ends
            parts += passages[i % 5] + words(rng.randrange(0, 90))
        space = " " if i % 2 else None
        docs.append((i * (1 << 55) - (1 << 60), "".join(w + (space or rng.choice([" ", " ", "\n", "\t "])) for w in parts)))
    docs += [(7, None), (8, ""), (9, " \n"), (None, " ".join(passages[0])), (11, " ".join(words(size - 1))), (12, "a b c " * 3000), (13, ("X " * size).strip())]
    df = spark.createDataFrame([(*d, 1) for d in docs + docs[-3:] + docs[:4]], "doc_id long, text string, start_word int").repartition(3)
    rows = repeated_passages(df, size).collect()
    check(docs, rows, size)
    assert sorted(rows) == sorted(repeated_passages(df, size, group=5).collect())
    assert len({r.doc_id for r in rows if r.doc_id not in (12, 13)}) >= 25
    assert repeated_passages(df.limit(0), size).count() == 0


def test_texts_that_share_an_id_are_documents(spark):
    passage = " ".join("p%d" % i for i in range(60))
    rows = repeated_passages(spark.createDataFrame([(1, "x " + passage), (1, passage + " y")], "doc_id long, text string")).collect()
    assert [r.n_words for r in rows] == [60, 60] and sorted(r.kept for r in rows) == [False, True]
    assert repeated_passages(spark.createDataFrame([(1, passage), (1, passage)], "doc_id long, text string")).count() == 0
