import itertools
import random

import numpy as np
import pandas as pd

from playstream.llm import near_dedup
from playstream.llm.components import connected_components
from playstream.llm.near_dedup import near_duplicates
from playstream.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, k=5):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lower(text or "")).split(" ") if w]
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(docs, percent):
    """{doc_id: (size of the set, smallest reachable id)} from all pairs."""
    sets = {d: shingles(t) for d, t in docs}
    comp = {d: d for d in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            i, j = find(a), find(b)
            comp[max(i, j)] = min(i, j)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = "w%d" % rng.randrange(10**6)
    return " ".join(out)


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_groups_of_loose_copies_match_brute_force(spark):
    rng = random.Random(3)
    docs, n = [], 0
    for size, copies, edits in ((150, 120, 4), (60, 40, 1), (300, 30, 9), (7, 12, 1), (3, 6, 0)):
        base = ["b%d" % rng.randrange(5000) for _ in range(size)]
        for _ in range(copies):
            docs.append((n, edited(rng, base, rng.randrange(edits + 1))))
            n += 1
    docs += [(n + i, " ".join("x%d" % rng.randrange(10**6) for _ in range(rng.randrange(1, 90)))) for i in range(60)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for percent in (80, 85):
        assert result(near_duplicates(df, percent=percent)) == brute(docs, percent)


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    from playstream.llm import near_dedup
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rng = random.Random(5)
    base = ["b%d" % i for i in range(120)]
    docs = [(i, edited(rng, base, rng.randrange(7))) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(near_duplicates(df, percent=85)) == brute(docs, 85)


def test_rest_of_a_bucket_is_what_its_largest_component_leaves(spark, monkeypatch):
    from playstream.llm import near_dedup
    seen, real = spark.sparkContext.accumulator(0), near_dedup._possible

    def counted(bound):
        run = real(bound)

        def each(batches):
            for b in batches:
                seen.add(len(b))
                yield b
        return lambda batches: run(each(batches))

    monkeypatch.setattr(near_dedup, "_possible", counted)
    n = 600  # row 0, the centre, is not linked yet; it has the set of row 5
    members = spark.createDataFrame([(1, i, 2, 0, n) for i in range(n)], "bucket long, id long, n_shingles long, centre long, n long")
    found = spark.createDataFrame([(i, 1) for i in range(1, n)], "id long, component long")
    hashes = {i: (2 * i + 10).to_bytes(8, "little") + (2 * i + 11).to_bytes(8, "little") for i in range(n)}
    hashes[0] = hashes[5]
    sets = spark.createDataFrame([(i, h) for i, h in hashes.items()], "id long, hashes binary")
    sig = spark.createDataFrame([(i, h * 2) for i, h in hashes.items()], "id long, sig binary")
    assert [tuple(r) for r in near_dedup._rest_links(members, found, sig, sets, 0.9, 80).collect()] == [(0, 5)]
    assert seen.value == n + 1  # 3,597 before


def test_edge_cases(spark):
    docs = [(1, None, 9), (2, "", 9), (3, " \t\n", 9), (4, "One two", 9), (5, "one TWO\n", 9), (6, "É two", 9),
            (7, "é two", 9), (8, "a " * 30000, 9), (9, "a " * 20000, 9), (None, "one two", 9), (10, "x", 9), (10, "x", 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, sig int").withColumn("bucket", df_lit())
    rows = near_duplicates(df).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert len(rows) == 12
    assert [got[i] for i in (1, 2, 3)] == [(0, 1, True), (0, 2, True), (0, 3, True)]
    assert got[4] == (1, 4, True) and got[5] == (1, 4, False)
    assert got[6][1] == 6 and got[7][1] == 7
    assert got[8] == (1, 8, True) and got[9] == (1, 8, False)
    assert got[None] == (1, None, True) and got[10] == (1, 10, True)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0


def df_lit():
    from pyspark.sql import functions as F
    return F.lit("clash")


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 400)] + [(5, 5), (None, 3)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(300, 400)}}


def test_query_matches_brute_force(spark):
    rows = QUERIES["op4_minhash_near_dedup"](spark, SF001).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_large_ids_beside_null_ones(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = [(2**62 + 1, a), (2**62 + 3, a), (None, a), (2**62 + 5, b), (-(2**62) - 7, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.component_id, r.kept) for r in near_duplicates(df).collect()}
    assert got == {2**62 + 1: (2**62 + 1, True), 2**62 + 3: (2**62 + 1, False), None: (None, True), 2**62 + 5: (2**62 + 5, True), -(2**62) - 7: (-(2**62) - 7, True)}


def test_full_sets_are_made_together(monkeypatch):
    """The sets of many texts are made at once, no word is hashed by itself."""
    rng = np.random.RandomState(3)
    texts = ["", " \n", None, "A b", "a b c d e", "é ü\x0bé", *(" ".join(rng.choice(list("abcdABÜ"), n)) for n in rng.randint(1, 60, 40)), "x " * 70_000]
    want = [near_dedup.shingle_set(t, 5, near_dedup._Words()) for t in texts]
    monkeypatch.setattr(near_dedup, "xxhash", None)
    got = pd.concat(near_dedup._full_sets(5)(iter([pd.DataFrame({"id": range(len(texts)), "text": texts})])))
    sets = [np.frombuffer(h, dtype=np.uint64) for h in got["hashes"]]
    assert got["id"].tolist() == list(range(len(texts)))
    for a, x in zip(want, sets):
        assert [len(np.intersect1d(a, b)) for b in want] == [len(np.intersect1d(x, y)) for y in sets]


def test_blocks_of_a_frame_are_joined_apart():
    """Blocks that arrive together link only what lies in one of them, and no
    more than joins their parts."""
    sets = {i: np.arange(100 * (i // 10), 100 * (i // 10) + 90, dtype=np.uint64) for i in range(30)}
    rows = []
    for bucket, ids in ((1, [0, 1, 2, 10]), (2, [1, 3, 20, 21]), (3, [5])):
        for rest in (False, True):
            rows += [(bucket, 0, 0, i, i, rest, np.full(8, i // 10, dtype=np.uint32).tobytes(), sets[i].tobytes()) for i in ids]
    g = pd.DataFrame(rows, columns=["bucket", "i", "j", "id", "comp", "rest", "sig", "hashes"])
    for at in (1, 5, 9, len(g)):
        got = pd.concat(near_dedup._joined(85, 0.5)(iter([g[:at], g[at:]])))
        assert sorted(map(tuple, got[["v", "u"]].values.tolist())) == [(1, 0), (2, 0), (3, 1), (21, 20)]
