import corpus_pipeline as P
from playstream.llm import quality, secrets
from playstream.sources.tables import read_table

from . import test_decontaminate, test_near_dedup, test_packing

SF001 = "/root/testdata/sf0.001"


def rows(df):
    return sorted(((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()), key=repr)


def test_stages_against_brute_force(spark):
    docs = read_table(spark, SF001, "documents")
    before = rows(docs)
    model = quality.learn(docs, read_table(spark, SF001, "labels"))
    score = dict(zip([r[0] for r in before], quality.score(model, [r[1] for r in before])))
    df = P.quality(spark, docs, SF001)
    want = [r for r in before if score[r[0]] >= 0.3]
    assert rows(df) == want and 0 < len(want) < len(before)

    df = P.materialize(df, "test")
    comp = test_near_dedup.brute([(r[0], r[1]) for r in want], 80)
    df = P.near_dedup(spark, df, SF001)
    want = [r for r in want if comp[r[0]][1] == r[0]]
    assert rows(df) == want

    df = P.materialize(df, "test")
    items = [(r.item_id, r.text) for r in read_table(spark, SF001, "benchmark").collect()]
    hit = {d: bad for d, _, _, _, bad in test_decontaminate.brute([(r[0], r[1]) for r in want], items)}
    df = P.decontamination(spark, df, SF001)
    want = [r for r in want if not hit[r[0]]]
    assert rows(df) == want

    df = P.materialize(df, "test")
    tagger = secrets.Tagger(secrets.learn(df))
    found = secrets.all_spans(tagger, [r[1] for r in want])
    df = P.secrets(spark, df, SF001)
    got = rows(df)
    assert [r[0] for r in got] == [r[0] for r in want]
    for new, old, spans in zip(got, want, found):
        assert new[4] == len(new[1]) and (new[1] == old[1]) == (not spans) and new[2:4] == old[2:4]
        assert not any(old[1][s:e] in new[1] for s, e, k in spans if k in (1, 2))

    packed = P.packing(spark, P.materialize(df, "test"), SF001).collect()
    test_packing.assert_packed(packed, [(r[0], r[1]) for r in got])


def test_run_applies_all_stages(spark):
    out = P.run(spark, SF001)
    assert {"doc_id", "start", "length", "sequence_id", "offset", "ids"} <= set(out.columns) and out.count() > 0


def test_only_copies_go_when_an_id_names_several_texts(spark):
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "abc"]
    docs = [(1, texts[0]), (2, texts[0] + " more"), (2, texts[1]), (5, texts[2]), (5, texts[2] + " end"), (5, texts[0]), (7, texts[1]), (None, texts[0]), (2, texts[1])]
    df = spark.createDataFrame([(*d, "en", "s", 1) for d in docs], "doc_id long, text string, lang string, source string, n_chars int").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in P.near_dedup(spark, df, SF001).collect()), key=repr)
    assert [r for r in got if r[0] != 5] == sorted([(1, texts[0]), (2, texts[1]), (None, texts[0])], key=repr)
    assert [r[1][:10] for r in got if r[0] == 5] == [texts[2][:10]]


def test_edge_cases(spark, tmp_path):
    base = " ".join("w%d" % i for i in range(30))
    docs = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, base, None, None, 9), (3, base, None, None, 9), (4, base, "en", "b", 9), (None, base, "en", "b", 9), (5, "x " * 30000, "en", "c", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table, ids in ((docs, [None, 1, 2, 3, 5]), ([], [])):
        df = spark.createDataFrame([(*d, "x") for d in table], schema + ", key string")
        for _, stage in P.STAGES[:-1]:
            df = P.materialize(stage(spark, df, str(tmp_path)), "test")
            assert df.columns == list(P.COLUMNS)
        assert sorted((r.doc_id for r in df.collect()), key=repr) == sorted(ids, key=repr)
        assert {r.doc_id for r in P.packing(spark, df, str(tmp_path)).collect()} == set(ids)
