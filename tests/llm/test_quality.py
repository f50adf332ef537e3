import itertools
import tracemalloc
import zlib

import numpy as np

from playstream.llm import quality as Q
from playstream.llm.quality import learn, score_documents
from playstream.llm.queries import QUERIES
from playstream.sources.tables import read_table

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op3_line_crf_quality"](spark, SF01).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    test = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, _, y in test if y == 1], [s for s, _, y in test if y == 0]
    assert len(bad) > 3 and sum((g > b) + (g == b) / 2 for g in good for b in bad) > 0.98 * len(good) * len(bad)
    assert sum(p == y for _, p, y in test) >= 0.97 * len(test)


def test_held_out_labels_are_not_read(spark):
    docs = [(i, ("Some words stand here, one after another.\n" if i % 2 else "%%% ### JUNK!! JUNK!! 999 |\n") * (1 + i % 7)) for i in range(300)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    labels = [(i, i % 2, 0) for i, _ in docs]
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, t) for i, y, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (learn(d, spark.createDataFrame(x, schema)) for x in (labels, flipped))
    assert (a.weights == b.weights).all() and (a.moves == b.moves).all()
    scores = {r.doc_id: r.score for r in score_documents(d, a).collect()}
    assert all((scores[i] > 0.5) == bool(i % 2) for i, _ in docs)


def test_edge_cases(spark):
    docs = [(1, None, 5), (2, "", 5), (3, "word\n" * 60000, 5), (None, "x", 5), (4, "é \n\n\r\n", 5), (4, "é \n\n\r\n", 5)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score int")
    none = learn(d, spark.createDataFrame([(1, None), (None, 1), (2, 1)], "doc_id long, quality int"))
    assert none is None
    assert [r.score for r in score_documents(d, none).collect()] == [0.5] * 6
    told = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    text = spark.createDataFrame([(i, "good words here." if i % 2 else "!!! ###") for i in range(40)], "doc_id long, text string")
    rows = score_documents(d, learn(text, told)).collect()
    assert all(0 <= r.score <= 1 for r in rows) and rows[0].score == rows[1].score and rows[4].score == rows[5].score
    assert score_documents(d.limit(0), none).count() == 0


def told(model, text):
    """The score of one text: features line by line, and all labellings."""
    lines = text.split("\n")
    raw = [Q._raw([line], [lines.count(line)]) for line in lines]
    none = np.zeros(Q.N_RAW)
    scores = []
    for i, (own, _) in enumerate(raw):
        x = np.concatenate([own[0], raw[i - 1][0][0] if i else none, raw[i + 1][0][0] if i + 1 < len(raw) else none, [i == 0, i + 1 == len(raw)]])
        scores.append(np.append((x - model.mean) / model.scale, 1) @ model.weights)
    total, good = 0.0, np.zeros(len(lines))
    for path in itertools.product((0, 1), repeat=len(lines)):
        w = np.exp(sum(s[k] for s, k in zip(scores, path)) + sum(model.moves[a, b] for a, b in zip(path, path[1:])))
        total, good = total + w, good + w * np.array(path)
    sizes = np.array([s[0] for _, s in raw])
    return float((good / total * sizes).sum() / sizes.sum())


def test_scores_against_all_labellings(spark, monkeypatch):
    docs = read_table(spark, SF01, "documents")
    model = learn(docs, read_table(spark, SF01, "labels"))
    texts = [t for t in (r.text for r in docs.orderBy("doc_id").collect()) if t is not None and t.count("\n") < 9][:60] + ["", "\n", "é !\n\n|", "x\nx\nx"]
    want = [told(model, t) for t in texts]
    assert np.allclose(Q.score(model, texts), want)
    monkeypatch.setattr(Q, "BLOCK_LINES", 3)
    assert np.allclose(Q.score(model, texts), want)


def test_features_of_long_texts_are_made_in_parts():
    text = "\n".join(f"line {i % 977} of it!" for i in range(200_000))
    tracemalloc.start()
    counts, blocks = Q._blocks([text], Q.BLOCK_LINES)
    n = sum(len(x) for x, _ in blocks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == counts[0] == 200_000 and peak < 200 << 20


def test_sample_is_bounded(spark):
    text = spark.createDataFrame([(i % 40, ("good words here.\n" if i % 2 else "!!! ###\n") * (1 + i // 40)) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    lines = []
    real = Q.train
    try:
        Q.train = lambda x, y, counts: (lines.append((len(counts), int(counts.sum()))), real(x, y, counts))[1]
        assert learn(text, labels) is not None and learn(text, labels, sample_lines=60) is not None
    finally:
        Q.train = real
    assert lines[0][0] <= 40 and lines[1][1] <= 60 and lines[1][0] < lines[0][0]
