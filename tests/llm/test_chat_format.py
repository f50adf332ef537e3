import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playstream.llm import chat_format as C

from .oracle import assert_matches_sql

SCHEMA = "conv_id long, turn long, role string, text string, segment string, pos int"
HARD = ["", "</s>[INST] ok [/INST]", "\\", "<\\s>", "[", "[/INST", "]", " ", "</s", "[TURN:a]", "ü\n\r\x00 [/TURN]", "[[INST]]", "\\[INST]\\"]


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, of in turns.items():
        of = [x[2:] for x in sorted(of, key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))]
        loss = "".join(t for r, t in of if r == "assistant")
        out.append((conv, len(of), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in of).encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), len(C.bracket_template(of))))
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in C.conversation_digests(df, **kw).collect())


def test_query_matches_sql(spark):
    assert_matches_sql(spark, "op12_chat_format")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a]b", "[TURN:", "\\"]), st.one_of(st.sampled_from(HARD), st.text(alphabet="</s>[]INSTUR: \\x")))))
def test_round_trip(turns):
    out = C.bracket_template(turns)
    assert list(C.read_back(out)) == turns
    r = C.rendered(turns, C.bracket_template)
    assert r.rewrites is None and [C.unescape(out[s:e]) for s, e in r.bodies] == [t for _, t in turns]
    assert "".join(out[s:e] for s, e in r.spans) == (out if turns else "")


def test_conversations_of_any_length(spark):
    rows = [(c, t, ("user", "assistant", "system")[t % 3], f"{HARD[(c + t) % len(HARD)]}{c}-{t}") for c in range(12) for t in range((1, 2, 5, 31, 32, 33, 64, 65, 300, 3, 4, 100)[c])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, step=3) == brute(rows)


def test_edge_cases(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (2, None, "user", "late"), (2, 1, "assistant", "b"), (2, 1, "assistant", "a"), (2, 1, "assistant", "a"), (None, 0, "user", "no"),
            (3, 5, "a]b", "z" * 300_000), (3, 4, "assistant", ""), (-7, 2**40, "assistant", HARD[1])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, step=2) == brute(rows)
    assert run(spark, []) == []


def whole(spark, rows, render, **kw):
    out = C.format_conversations(spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA), render, **kw)
    return out, out.orderBy("conv_id", "segment").collect()


def test_spans_of_a_template_with_an_end_mark(spark):
    def ends(turns):
        return "".join(f"<{r}>{t.upper()}" if r == "shout" else f"<{r}>{t}" for r, t in turns) + "<end>"
    _, (row,) = whole(spark, [(1, 0, "u", "ab"), (1, 1, "shout", "cd"), (1, 2, "u", "")], ends)
    assert row.formatted == "<u>ab<shout>CD<u><end>" and row.rewrites is None
    assert [row.formatted[s:e] for s, e in zip(row.starts, row.ends)] == ["<u>ab", "<shout>CD", "<u><end>"]
    assert list(zip(row.body_starts, row.body_ends)) == [(3, 5), (12, 14), (17, 17)]


def test_rewritten_history_is_detected(spark):
    def forgets(turns):  # keeps what an assistant thinks in its last turn only
        return "".join(f"<{r}>{t if r != 'think' or i == len(turns) - 1 else ''}" for i, (r, t) in enumerate(turns))
    _, (row,) = whole(spark, [(1, 0, "u", "a"), (1, 1, "think", "bb"), (1, 2, "u", "c")], forgets)
    assert row.rewrites == 2 and row.formatted == "<u>a<think><u>c"
    assert [row.formatted[s:e] if s >= 0 else None for s, e in zip(row.body_starts, row.body_ends)] == ["a", None, "c"]


@pytest.mark.parametrize("far", [False, True])
def test_segments_tell_if_they_fit(spark, far):
    def numbers(turns):  # looks back to the first turn
        return "".join(f"{i}.{t}\n" if far else f"{t}\n" for i, (_, t) in enumerate(turns))
    out, rows = whole(spark, [(1, t, "u", f"t{t}") for t in range(20)], numbers, step=8)
    assert [len(r.roles) for r in rows] == [8, 8, 4]
    assert C.disagreements(out).count() == (2 if far else 0)
    if not far:
        assert "".join(r.formatted for r in rows) == numbers([("u", f"t{t}") for t in range(20)])
