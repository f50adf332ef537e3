import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from playstream.llm import token_counts as T
from playstream.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"
VOCABULARY = T.Vocabulary()


def brute(text):
    """Viterbi on every pre-token by itself, from its end to its start."""
    v, total, n = VOCABULARY, 0, 0
    for word in re.findall(r" ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+| ?\w", " " + " ".join((text or "").split())):
        word, n = word.replace(" ", "▁"), n + 1
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            size = len(word[end - 1].encode("utf-8", "surrogatepass"))
            ways = [(best[-1][0] + size * v.byte, -(best[-1][1] + size))]
            ways += [(best[s][0] + v.scores[word[s:end]], -(best[s][1] + 1)) for s in range(end) if word[s:end] in v.scores]
            score, tokens = max(ways)
            best.append((score, -tokens))
        total += best[-1][1]
    return total, n


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("thean ingoé_1.\n漢😀Ñ"), max_size=40), max_size=5))
def test_counts_are_those_of_single_words(texts):
    assert T.trie().counts(texts) == [brute(t) for t in texts]


def test_shared_prefixes_are_scored_once():
    trie = T.Trie(VOCABULARY)
    trie.counts(["there therefore then"])
    assert len(trie.score) == 1 + len({("▁" + w)[:k] for w in ("there", "therefore", "then") for k in range(1, len(w) + 2)})


def test_full_caches_change_no_count(monkeypatch):
    texts = ["one two three four", "two three five", "six seven one"] * 3
    want = [brute(t) for t in texts]
    monkeypatch.setattr(T, "MAX_NODES", 5)
    trie = T.Trie(VOCABULARY)
    assert [trie.counts([t])[0] for t in texts] == want


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = QUERIES["op7_trie_token_counts"](spark, SF001).collect()
    assert {r.doc_id: (r.n_tokens, r.n_words) for r in rows} == {d: brute(t) for d, t in docs.items()}


def test_edge_cases(spark):
    docs = [(1, None, 1), (2, "", 1), (3, " \n", 1), (None, "a b", 1), (4, "x" * 2_000, 1), (5, "word " * 5_000, 1), (5, "word " * 5_000, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_words int").selectExpr("*", "1 as _count_")
    rows = T.token_counts(df).collect()
    got = {r.doc_id: (r.n_tokens, r.n_words) for r in rows}
    assert len(rows) == 7 and got[1] == got[2] == got[3] == (0, 0)
    assert all(got[d] == brute(t) for d, t, _ in docs)
    assert T.token_counts(df.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet=st.sampled_from("thean ingoé漢😀Ñ▁"), max_size=60))
def test_long_words_are_counted_alone(word):
    assert T.trie().alone("▁" + word) == T.Trie(VOCABULARY).insert("▁" + word)


def test_nodes_are_bounded_inside_a_text(monkeypatch):
    monkeypatch.setattr(T, "MAX_NODES", 3000)
    monkeypatch.setattr(T, "LONGEST", 90)
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(1, 120))) for _ in range(400))
    trie, most = T.Trie(VOCABULARY), [0]
    insert = trie.insert

    def noted(word):
        out = insert(word)
        most[0] = max(most[0], len(trie.score))
        return out

    trie.insert = noted
    assert trie.counts([text]) == [brute(text)]
    assert 2000 < most[0] <= 3001


def test_letters_without_a_space():
    trie, began = T.Trie(VOCABULARY), time.perf_counter()
    n, words = trie.counts(["thereand" * 125_000])[0]
    assert words == 1 and 0 < n < 1_000_000 and len(trie.score) == 1
    assert time.perf_counter() - began < 60
