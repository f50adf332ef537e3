"""Chat formatting by incremental black-box rendering.

A template is any function from a list of ``(role, text)`` turns to a string;
nothing else is known of it. The successive prefixes of a conversation are
rendered, and consecutive outputs are compared: what a longer output adds is
the span of its last turn, and a template that changes what it has said of
earlier turns is detected as one that rewrites history. Where a text stands in
its span is found by rendering the prefix once more with a mark in its place.

A conversation of more than ``STEP`` turns is cut into segments of as many
turns, which are rendered apart after the last turns of the segment before, so
that one conversation may hold any part of the table. The turn on which two
segments overlap is rendered by both, and tells if they agree.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.operators.index import with_index

from .common import materialize, small_side, tidy, utf8, whole_groups

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Turns of a segment, and turns before it that are rendered with it.
STEP, CONTEXT = 32, 2


# -- a template that escapes its control strings

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[TURN:", "[/TURN]")
_FORMS = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
_ROLE = re.compile(r"\[TURN:((?:\\.|[^\\\]])*)\]", re.S)


def escape(text: str) -> str:
    """No control string occurs in the result; ``unescape`` gives ``text``."""
    text = text.replace("\\", "\\\\")
    for c in CONTROLS:
        text = text.replace(c, c[0] + "\\" + c[1:])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def bracket_template(turns: list[Turn]) -> str:
    """Users in ``[INST]`` brackets, assistants up to ``</s>``, other roles by
    name; control strings inside texts and roles are escaped."""
    out = ["<s>"]
    for role, text in turns:
        opening, closing = _FORMS.get(role) or (f"[TURN:{escape(role).replace(']', chr(92) + ']')}]", "[/TURN]")
        out += (opening, escape(text), closing)
    return "".join(out)


def read_back(formatted: str) -> Iterator[Turn]:
    """The turns that ``bracket_template`` was given, from its output or from
    any run of whole turns of it."""
    at = 3 if formatted.startswith("<s>") else 0
    while at < len(formatted):
        role = "user" if formatted.startswith("[INST] ", at) else "assistant"
        if named := _ROLE.match(formatted, at):
            role, start, closing = unescape(named[1]), named.end(), "[/TURN]"
        else:
            start, closing = at + len(_FORMS[role][0]), _FORMS[role][1]
        end = formatted.index(closing, start)
        yield role, unescape(formatted[start:end])
        at = end + len(closing)


# -- black-box rendering

class Rendered(NamedTuple):
    """``text`` is the output; ``spans`` are the turns' places in it and
    ``bodies`` those of their texts, -1 where the output does not hold them;
    ``rewrites`` is the first turn at which earlier ones were changed."""
    text: str
    spans: list[tuple[int, int]]
    bodies: list[tuple[int, int]]
    rewrites: int | None


def _mark(turns: list[Turn]) -> str:
    """A string that no turn holds."""
    return next(m for m in (chr(0xE000 + i) * 3 for i in range(6400)) if not any(m[0] in r or m[0] in t for r, t in turns))


def _body(output: str, turns: list[Turn], i: int, mark: str, render: Template) -> tuple[int, int]:
    """Where the text of turn ``i`` stands in the output of ``turns``."""
    probe = render([*turns[:i], (turns[i][0], mark), *turns[i + 1:]])
    start = probe.find(mark)
    after = len(probe) - start - len(mark)
    if start < 0 or len(output) < start + after or output[:start] != probe[:start] or not output.endswith(probe[start + len(mark):]):
        return -1, -1
    return start, len(output) - after


def rendered(turns: list[Turn], render: Template) -> Rendered:
    """Renders the prefixes of ``turns`` one after the other. What follows the
    last text may change (an end mark after the last turn); if anything
    before it does, history is rewritten, and the texts are looked for in the
    last output alone, turns having the spans of their texts."""
    mark, before = _mark(turns), ""
    spans: list[tuple[int, int]] = []
    bodies: list[tuple[int, int]] = []
    for k in range(1, len(turns) + 1):
        output = render(turns[:k])
        start = len(before)
        if not output.startswith(before):
            start, last = len(os.path.commonprefix([before, output])), max([e for _, e in bodies] + [s for s, _ in spans])
            if start < last:
                whole = render(turns)
                found = [_body(whole, turns, i, mark, render) for i in range(len(turns))]
                return Rendered(whole, found, found, k - 1)
            # an end mark may begin as the next turn does: it stands at both ends
            start = min(start, max(last, len(before) - len(os.path.commonprefix([before[::-1], output[::-1]]))))
            spans[-1] = (spans[-1][0], start)
        spans.append((start, len(output)))
        bodies.append(_body(output, turns[:k], k - 1, mark, render))
        before = output
    return Rendered(before, spans, bodies, None)


# -- over a table

#: Characters of formatted text that a task holds before it hands them on.
HELD = 4 << 20
COLUMNS = ["conv_id", "segment", "formatted", "roles", "starts", "ends", "body_starts", "body_ends", "rewrites", "opening", "closing"]
SCHEMA = ("conv_id long, segment long, formatted string, roles array<string>, starts array<long>, ends array<long>, "
          "body_starts array<long>, body_ends array<long>, rewrites long, opening string, closing string")


def _segments(render: Template):
    """Rows of whole segments, in order, to one row each. ``opening`` and
    ``closing`` are the digests of the last turn before the segment and of its
    own last one, as rendered here."""
    def one(conv: int, segment: int, turns: list[Turn], skip: int) -> tuple:
        r = rendered(turns, render)
        base = r.spans[skip][0] if skip else 0
        pieces = [hashlib.md5(utf8(r.text[s:e])).hexdigest() if s >= 0 else "" for s, e in (r.spans[skip - 1], r.spans[-1])]
        (starts, ends), (body_starts, body_ends) = (zip(*((s - base, e - base) if s >= 0 else (-1, -1) for s, e in of[skip:])) for of in (r.spans, r.bodies))
        return (conv, segment, r.text[base:], [x for x, _ in turns[skip:]], starts, ends, body_starts, body_ends,
                None if r.rewrites is None else max(r.rewrites - skip, 0), pieces[0] if skip else None, pieces[1])

    def frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=COLUMNS).astype({"rewrites": "Int64"})

    def run(batches):
        out, held = [], 0
        for rows, starts in whole_groups(batches, ["conv_id", "segment"]):
            conv, segment, context, role, text = (rows[c].tolist() for c in ("conv_id", "segment", "context", "role", "text"))
            for s, e in zip(starts, [*starts[1:], len(rows)]):
                skip = sum(context[s:e])
                if skip == e - s:  # the end of the last segment
                    continue
                out.append(one(conv[s], segment[s], list(zip(role[s:e], text[s:e])), skip))
                held += len(out[-1][2])
                if held > HELD:
                    yield frame(out)
                    out, held = [], 0
        yield frame(out)
    return tidy(run)


def _short_and_long(conversations: DataFrame, render: Template, step: int) -> tuple[DataFrame, DataFrame | None]:
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id is not null")
    long_ids = materialize(turns.groupBy("conv_id").count().where(F.col("count") > step).select("conv_id"), "chat-long")
    some = not long_ids.isEmpty()
    zero, no = F.lit(0).cast("long").alias("segment"), F.lit(False).alias("context")
    short = turns.join(small_side(long_ids), "conv_id", "left_anti") if some else turns
    short = short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", zero, no, "role", "text")
    if not some:
        return short.mapInPandas(_segments(render), SCHEMA), None
    # rows are numbered by ranges, so that a conversation of any length is spread over tasks
    rows = turns.join(small_side(long_ids), "conv_id", "left_semi").withColumn("row", F.monotonically_increasing_id())
    numbered = materialize(with_index(materialize(rows, "chat-rows"), ["conv_id", "turn", "role", "text", "row"], name="at"), "chat-numbered")
    first = materialize(numbered.groupBy("conv_id").agg(F.min("at").alias("first")), "chat-first")
    placed = numbered.join(small_side(first), "conv_id").withColumn("pos", F.col("at") - F.col("first"))
    own = placed.withColumn("segment", F.floor(F.col("pos") / step)).withColumn("context", F.lit(False))
    ahead = own.where(F.col("pos") % step >= step - CONTEXT).withColumn("segment", F.col("segment") + 1).withColumn("context", F.lit(True))
    cut = own.unionByName(ahead).repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "pos")
    return short.mapInPandas(_segments(render), SCHEMA), cut.select("conv_id", "segment", "context", "role", "text").mapInPandas(_segments(render), SCHEMA)


def format_conversations(conversations: DataFrame, render: Template = bracket_template, step: int = STEP) -> DataFrame:
    """Each conversation of ``conversations(conv_id, turn, role, text, ...)``
    as ``render`` writes it, one row per segment of at most ``step`` turns:
    ``conv_id``, ``segment``, ``formatted`` (a conversation is its segments,
    joined in order), and per turn of the segment its role, its span and that
    of its text in ``formatted`` (in code points; -1 where the output does not
    hold it); ``rewrites`` is the place in the segment of the first turn that
    changed earlier ones, else null; ``opening`` and ``closing`` are digests of
    the turn before the segment and of its last turn, see ``disagreements``.

    Defined cases: null roles and texts are empty; turns are ordered by turn
    (nulls first), role and text, so ties and repeated rows are turns of their
    own; rows without a conv_id belong to no conversation; further columns are
    ignored; an empty table gives an empty table."""
    short, long_ = _short_and_long(conversations, render, step)
    return short if long_ is None else short.unionAll(long_)


def disagreements(formatted: DataFrame) -> DataFrame:
    """``(conv_id, segment)`` of segments that render the turn before them
    otherwise than the segment before did: the template looks further back
    than a segment's context, and the conversation's parts don't fit."""
    before = formatted.select("conv_id", (F.col("segment") + 1).alias("segment"), "closing")
    after = formatted.where("segment > 0").select("conv_id", "segment", "opening")
    return after.join(before, ["conv_id", "segment"]).where("opening <> closing").select("conv_id", "segment")


def _digests(loss_role: str):
    """One row per conversation from its segments, which follow each other; of
    a conversation only hashes and sums are held."""
    def run(batches):
        state, last, out = None, None, []

        def told():
            n, said, chars, learnt, size = state
            return last, n, said.hexdigest(), chars, learnt.hexdigest(), size

        for pdf in batches:
            for conv, text, roles, starts, ends in zip(pdf["conv_id"].tolist(), pdf["formatted"], pdf["roles"], pdf["body_starts"], pdf["body_ends"]):
                if state is None or conv != last:
                    if state:
                        out.append(told())
                    state, last = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], conv
                for role, said in read_back(text):
                    state[0] += 1
                    state[1].update(utf8(f"{role}\n{said}\n"))
                for role, s, e in zip(roles, starts, ends):
                    if role == loss_role and s >= 0:
                        learnt = unescape(text[s:e])
                        state[2] += len(learnt)
                        state[3].update(utf8(learnt))
                state[4] += len(text)
            yield pd.DataFrame(out, columns=DIGESTS)
            out = []
        if state:
            yield pd.DataFrame([told()], columns=DIGESTS)
    return tidy(run)


DIGESTS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def conversation_digests(conversations: DataFrame, step: int = STEP, loss_role: str = "assistant") -> DataFrame:
    """Formats conversations and reads them back: per conversation the number
    and the SHA-256 of its turns (role and text, each ended by a line break),
    the characters and SHA-256 of the texts under the loss mask (those of
    ``loss_role``), and the length of the whole. Cases as above."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    short, long_ = _short_and_long(conversations, bracket_template, step)
    out = short.mapInPandas(_digests(loss_role), schema)
    if long_ is None:
        return out
    in_order = long_.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return out.unionAll(in_order.mapInPandas(_digests(loss_role), schema))
