import random
import re

from playstream.llm.decontaminate import decontaminate

from .oracle import assert_matches_sql


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    out = []
    for d, t in docs:
        w, hit, got = words(t), set(), set()
        for i, text in items:
            x = words(text)
            n = min(window, len(x))
            for s in range(len(x) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == x[s:s + n]:
                        hit |= set(range(p, p + n))
                        got.add("null" if i is None else str(i))
        out.append((d, len(w), len(hit), tuple(sorted(got)), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items, extra=False):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    if extra:
        from pyspark.sql import functions as F
        d, b = d.withColumn("key", F.lit(1)).withColumn("wid", F.lit(2)), b.withColumn("n", F.lit("x"))
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated)
                   for r in decontaminate(d, b).collect()), key=repr)


def test_query_matches_sql(spark):
    assert_matches_sql(spark, "op1_decontamination")


def test_random_texts_match_brute_force(spark):
    rng = random.Random(1)
    item = [[rng.choice("a b c the of and".split()) + rng.choice(["", "1", "é"]) for _ in range(rng.randrange(0, 30))] for _ in range(12)]
    item[0], item[1], item[2] = ["a"], ["the", "of"], ["x", "y", "z", "z"]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            x = rng.choice(item)
            s = rng.randrange(len(x) + 1)
            parts += x[s:s + rng.randrange(1, 25)] + [rng.choice(["q", "the", "of", "a"])]
        docs.append((i, rng.choice([" ", ", ", "-\n"]).join(parts).upper() if i % 3 else " ".join(parts)))
    items = [(i, " ".join(x)) for i, x in enumerate(item)] + [(3, " ".join(item[4]))]
    assert run(spark, docs, items) == brute(docs, items)


def test_edge_cases(spark):
    base = " ".join("w%d" % i for i in range(14))
    docs = [(1, None), (2, ""), (3, base), (3, base), (None, base), (4, "!!! ..."), (5, (base + " ") * 3000), (6, "W0 w1"), (7, "É é")]
    items = [(1, base), (2, None), (3, ""), (None, base), (4, "É é"), (9, "zz")]
    assert run(spark, docs, items, extra=True) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []
    assert run(spark, docs, [(1, None)]) == brute(docs, [(1, None)])


def test_plan_is_native(spark):
    d = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = decontaminate(d, b)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if x in plan]
