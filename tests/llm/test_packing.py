import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from playstream.llm.packing import Encoder, assign, pack
from playstream.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"
MODEL = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
TEXT = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
TEXT.encode_special_tokens = True
SPECIAL = ["a <|endoftext|> b <|startoftext|>", "x<|startoftext|>y", "<|ENDOFTEXT|>", "<|endof text|>", "<|endoftext|><|endoftext|>", "Ü <|endoftext|>漢"]


def ids_of(text):
    return MODEL.encode(text or "", add_special_tokens=False).ids + [2]


def assert_packed(rows, docs, size=4096):
    """Every id once, pieces gapless in each sequence, no padding."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == {d for d, _ in docs}
    for d, text in docs:
        ids, at = np.array(ids_of(text), dtype="<u4"), 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    assert padding == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x17F), st.sampled_from("Σςİıſ́  漢ǅ'sS³½ĸŉ<|>")), max_size=60), max_size=4))
def test_ids_are_the_tokenizers(texts):
    for model, special in ((MODEL, True), (TEXT, False)):
        got = Encoder(special=special).encode(texts + SPECIAL)
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == [model.encode(t, add_special_tokens=False).ids for t in texts + SPECIAL]


def test_each_plain_character_alone_and_in_a_word():
    texts = [x for c in map(chr, range(0x180)) for x in (c, f"a{c}b {c}{c}", f"it{c}'s9{c}'")]
    got = Encoder().encode(texts)
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == [MODEL.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=60))
def test_assign_fills_every_sequence(lengths):
    fill, seen = defaultdict(int), defaultdict(int)
    for i, _, n, seq in assign(lengths, 32, 1.0, 0.1):
        fill[seq] += n
        seen[i] += n
    assert [seen[i] for i in range(len(lengths))] == lengths
    small = [n for n in fill.values() if n != 32]
    assert all(n <= 32 and n & (n - 1) == 0 for n in fill.values()) and len(small) == len(set(small))


def test_costs_are_balanced():
    rng = random.Random(2)
    lengths = [rng.randrange(1, 3000) for _ in range(3000)]
    cost = defaultdict(float)
    for _, _, n, seq in assign(lengths, 4096, 1.0, 1 / 4096):
        cost[seq] += n + n * n / 4096
    full = np.array(list(cost.values()))
    assert full.std() < 0.15 * full.mean()


def test_query_packs_every_token(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert_packed(QUERIES["op8_cost_balanced_packing"](spark, SF001).collect(), docs)


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "word " * 40000), (None, "a b"), (5, " \n"), *((10 + i, t) for i, t in enumerate(SPECIAL))]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, length string").repartition(3)
    rows = pack(df, shard_tokens=500).collect()
    assert_packed(rows, docs)
    assert all(np.frombuffer(bytes(r.ids), dtype="<u4").size == r.length for r in rows)
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    same = spark.createDataFrame([(1, "a b")] * 3, "doc_id long, text string")
    assert sorted((r.doc_id, r.doc_tokens) for r in pack(same).collect() if r.start == 0) == [(1, 3)] * 3


def test_short_sequences_do_not_follow_the_files(spark):
    rng = random.Random(4)
    docs = [(i, "word " * rng.randrange(1, 400)) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    short, total = set(), sum(len(ids_of(t)) for _, t in docs)
    for parts in (1, 64):
        rows = pack(df.repartition(parts)).collect()
        assert_packed(rows, docs)
        sizes = defaultdict(int)
        for r in rows:
            sizes[r.sequence_id] += r.length
        short.add(tuple(sorted(n for n in sizes.values() if n < 4096)))
    assert short == {tuple(1 << b for b in range(12) if total % 4096 >> b & 1)}
    rows = pack(df.repartition(64), shard_tokens=9000).collect()  # several shards of what is left
    assert_packed(rows, docs)


def test_large_ids_beside_null_ones(spark):
    docs = [(2**62 + 1, "a b"), (2**62 + 3, "c"), (None, "d e f"), (-(2**62) - 7, "")]
    rows = pack(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    assert {r.doc_id: r.doc_tokens for r in rows} == {d: len(ids_of(t)) for d, t in docs}


def test_words_that_come_again_are_not_split_again(monkeypatch):
    """Words are looked up whole, so only new ones are cut into pre-tokens and
    given to the tokenizer; whatever is remembered, ids stay the same."""
    import playstream.llm.packing as packing
    cut, given_ = [], []

    class Counting:
        def findall(self, text):
            cut.append(len(text))
            return packing_piece.findall(text)

    packing_piece = packing._PIECE
    monkeypatch.setattr(packing, "_PIECE", Counting())
    rng = random.Random(5)
    words = ["".join(rng.choice("abcxyzé") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", ",", "'s", "9!", "...", "-it's-4"]) for _ in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(80)) + rng.choice(["", "\n", "\t x"]) for _ in range(120)]
    want = [MODEL.encode(t, add_special_tokens=False).ids for t in texts]
    coder = Encoder()
    learn = coder._learn
    monkeypatch.setattr(coder, "_learn", lambda pieces: given_.extend(pieces) or learn(pieces))
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in coder.encode(texts)] == want
    assert len(given_) == len(set(given_))
    cut.clear()
    given_.clear()
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in coder.encode(texts)] == want
    assert not cut and not given_
    for remember in (1, 50, 300, 700):
        coder = Encoder(remember=remember)
        got = [x for at in range(0, len(texts), 7) for x in coder.encode(texts[at:at + 7])]
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in got] == want


def test_learning_without_word_ends_in_the_vocabulary():
    """A vocabulary that doesn't mark the ends of words gives the same ids."""
    coder = Encoder()
    coder.last = None
    texts = ["it's a word, again a word... 42 naïve ąę", "", "word"]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in coder.encode(texts)] == [MODEL.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_batch_does_not_walk_through_what_is_remembered():
    """A batch's few words are looked up among all that is remembered; the
    other way about each batch would cost as much as everything before it."""
    class Walked(dict):
        def __iter__(self):
            raise AssertionError("walked through")

    coder = Encoder(remember=8)
    coder.encode(["one, two three four five six seven"])
    coder.older = Walked(coder.older | coder.known)
    coder.known = {}
    text = "two, new one words' seven"
    assert np.frombuffer(coder.encode([text])[0], dtype="<u4").tolist() == MODEL.encode(text, add_special_tokens=False).ids


def test_texts_keep_their_ids_where_lookups_end(spark):
    """More texts in a task than are looked up together, plain ones and others."""
    docs = [(i, f"{chr(97 + i)}{i} it's " * (60_000 * (i % 3)) + ("漢 <|endoftext|>" if i % 2 else "")) for i in range(7)]
    rows = pack(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    assert_packed(rows, docs)
