"""Secret scan: fixed patterns, and a linear-chain conditional random field
that tags white-space tokens as secret begin, inside or outside.

A token's features are its own shape, the shapes and words of its neighbours,
and features of its file. Tokens fall into a few hundred shape classes, so a
class is looked up once per distinct word and all scores of a text are sums
of table rows. Viterbi decodes exactly, but only where it has to: a token
whose score for outside exceeds its others by more than moves can ever make
up for is outside on every best path, so such tokens cut the text into short
sequences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chain import fit, viterbi
from .common import is_text, kept, tidy

# Fixed patterns; of a kind, matches are leftmost and do not overlap.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more: the same matches as [0-9a-f]+ with that length
KINDS = ("assign", "access", "hex", "model")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

OUT, BEGIN, INSIDE = 0, 1, 2
#: Sampled documents and the longest text among them; lines that are fitted on.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_LINES = 2000, 100_000, 1500
#: Longer lines are not fitted on.
LINE_CHARS = 600
#: Words whose class a worker remembers.
CACHE_WORDS = 100_000
#: Texts scored together.
BLOCK_DOCS = 256
_TOKEN = re.compile(r"\S+")
_EDGE = "\"'`()[]{}<>,;:.!?*#%&$|=+~^"
_NAMED = re.compile(r"(?i)pass(word|wd|phrase)?|secret|token|api_?-?key|credential|private_?key|access_?key|bearer|auth")
_PREFIX = re.compile(r"(AKIA|ASIA|gh[opsu]_|github_pat_|glpat-|sk[-_]|pk_|rk_|xox[abpr]-|AIza|eyJ|ya29\.|npm_|hf_|SG\.)")
_HEX, _KEYLIKE = re.compile("[0-9a-fA-F]+"), re.compile(r"[A-Za-z0-9+/_.=~!@#$%^&*-]+")
_PERSONAL = re.compile(r"[^@\s]+@[^@\s]+\.[a-z]+|https?:.*|www\..*|\+?[\d(][\d()./:\x20-]*", re.I)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind)`` of the fixed patterns, kinds as in ``KINDS``."""
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def shape(word: str) -> tuple[int, ...]:
    """The discrete features of a token by itself."""
    core = word.strip(_EDGE)
    value = core.rpartition("=")[2].strip(_EDGE) if "=" in core else core
    n = len(value)
    if value.isalpha():
        kind = switches = personal = 0
    else:
        digits, letters = sum(map(str.isdigit, value)), sum(map(str.isalpha, value))
        switches = len(re.findall(r"\d(?=[^\W\d])|[^\W\d](?=\d)", value))
        personal = int(bool(_PERSONAL.fullmatch(core)))
        kind = (1 if digits == n else 2 if _HEX.fullmatch(value) else 3 if digits and letters and _KEYLIKE.fullmatch(value) else 4)
    named = word if n < 8 else core[:max(0, len(core) - n)] or (value if kind == 0 else "")
    return (
        sum(n >= k for k in (1, 4, 8, 16, 24, 40)),
        kind,
        min(switches, 6) // 2,
        int(value != value.lower()) + 2 * int(value != value.upper()),
        int(bool(_NAMED.search(named))),
        int(word[:1] in "\"'`" and core[:1] != word[:1]),
        int(word.endswith((":", "=", "=>"))),
        int(bool(_PREFIX.match(value))),
        personal,
        int("=" in core),
    )


_SIZES = (7, 5, 4, 4, 2, 2, 2, 2, 2, 2)
#: One column for each value of a feature, then two products that matter.
WIDTH = sum(_SIZES) + 2
N_FILE = 4


def _columns(s: tuple[int, ...]) -> np.ndarray:
    out, at = np.zeros(WIDTH), 0
    for v, size in zip(s, _SIZES):
        out[at + v] = 1
        at += size
    out[at] = float(s[1] in (2, 3) and s[0] >= 4 and s[2] >= 1)
    out[at + 1] = float(s[1] in (2, 3) and s[0] >= 3 and not s[8])
    return out


class Shapes(dict):
    """Class numbers of words, and the table of the classes' columns."""

    def __init__(self):
        super().__init__()
        self.classes: dict[tuple, int] = {}
        self.rows: list[np.ndarray] = []
        self("")  # class 0 stands beyond the ends of a text

    def __call__(self, word: str) -> int:
        s = shape(word)
        k = self.classes.setdefault(s, len(self.rows))
        if k == len(self.rows):
            self.rows.append(_columns(s))
        return k

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        k = self[word] = self(word)
        return k


def file_features(classes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Of a text: its length, and its shares of numbers, of mixed tokens and of secret names."""
    n, kinds = len(classes), _SIZES[0]
    counts = np.bincount(classes, minlength=len(table))
    shares = counts @ table[:, [kinds + 1, kinds + 3, sum(_SIZES[:4]) + 1]] / max(n, 1)
    return np.concatenate([[min(np.log1p(n), 10) / 10], np.sqrt(shares)])


@dataclass
class Model:
    """Score rows per column: of the token, the one before, the one before
    that, the one after; of the file; a constant; and the moves."""
    own: np.ndarray
    before: np.ndarray
    before2: np.ndarray
    after: np.ndarray
    file: np.ndarray
    moves: np.ndarray

    def margin(self) -> float:
        """More than moves can add to a token that is not outside."""
        m = self.moves
        into = (m[:, None, 1:] - m[:, None, :1]).max()
        out = (m[1:, :] - m[:1, :]).max()
        return float(max(into, 0) + max(out, 0)) + 1e-9


def _features(classes: np.ndarray, table: np.ndarray, file: np.ndarray) -> np.ndarray:
    pad = np.concatenate([[0, 0], classes, [0]])
    x = [table[pad[2:-1]], table[pad[1:-2]], table[pad[:-3]], table[pad[3:]], np.repeat(file[None], len(classes), axis=0)]
    return np.concatenate([*x, np.ones((len(classes), 1))], axis=1)


def tagged_line(line: str, secrets: list[tuple[int, int]]) -> tuple[list[str], list[int]]:
    """Tokens of a line and their tags for secrets at ``(start, end)``."""
    words, tags, last = [], [], None
    for m in _TOKEN.finditer(line):
        hit = next((s for s in secrets if s[0] < m.end() and m.start() < s[1]), None)
        words.append(m[0])
        tags.append(OUT if hit is None else INSIDE if hit == last else BEGIN)
        last = hit
    return words, tags


def made_lines() -> list[tuple[list[str], list[int]]]:
    """A fixed set of labelled lines: secrets of many forms where they are
    usually written, and tokens that look alike and are none."""
    rng = np.random.RandomState(11)
    alnum, hexa, b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    draw = lambda chars, n: "".join(rng.choice(list(chars), n))
    words = "the of and to in server connect with value then use set call our new file into page see note der und la que".split()
    some = lambda a, b: " ".join(rng.choice(words, rng.randint(a, b + 1)))
    out = []
    for i in range(500):
        value = [draw(alnum, rng.randint(20, 41)), draw(hexa, rng.randint(24, 65)), "ghp_" + draw(alnum, 36), "AKIA" + draw(alnum[:26] + alnum[52:], 16),
                 "sk_live_" + draw(alnum, 24), "xoxb-" + draw("0123456789", 11) + "-" + draw(alnum, 24), "eyJ" + draw(alnum, 30) + "." + draw(alnum, 40),
                 draw(b64, 40) + "==", draw(alnum, rng.randint(9, 15)) + draw("!@#$%", 1) + draw("0123456789", 3)][i % 9]
        name = ["password", "api_key", "token", "secret", "access_key", "Authorization: Bearer", "client_secret", "passwd", "auth", "credentials"][rng.randint(10)]
        if i % 10 == 7:  # a key cut in two by white space
            left, right = value[:len(value) // 2], value[len(value) // 2:]
            value = f"{left} {right}"
        mark = ["=", ":", " = ", ": ", " ", " is "][rng.randint(6)]
        quote = ["", "", '"', "'"][rng.randint(4)]
        head = f"{some(0, 8)} {name}{mark}{quote}".lstrip()
        line = f"{head}{value}{quote} {some(0, 8)}"
        out.append(tagged_line(line, [(len(head), len(head) + len(value))]))
    for i in range(700):
        plain = [draw("0123456789", rng.randint(3, 17)), f"{draw('0123456789', 3)}-{draw('0123456789', 4)}", f"{draw(alnum[26:52], 6)}.{rng.randint(99)}@mail{rng.randint(9)}.example.com",
                 f"https://{draw(alnum[26:52], 8)}.example.org/{draw(alnum[26:52], 5)}/{rng.randint(999)}?page={rng.randint(9)}", f"20{rng.randint(10, 30)}-0{rng.randint(1, 9)}-1{rng.randint(9)}",
                 draw(alnum[26:52], rng.randint(16, 40)), f"v{rng.randint(9)}.{rng.randint(20)}.{rng.randint(20)}", draw(alnum[:26], rng.randint(3, 20)) + "!!", f"{draw('abcdef', rng.randint(5, 12))}",
                 f"src/{draw(alnum[26:52], 8)}/{draw(alnum[26:52], 6)}{rng.randint(9)}.py", f"{draw(alnum[26:52], 5)}{rng.randint(99)}", f"{draw(alnum[26:52], 7)}%%%", f"{draw(alnum[26:52], 5)}|"][i % 13]
        lead = ["", "token", "password", "see the secret", "", "id =", "key:", ""][rng.randint(8)]
        out.append(tagged_line(f"{some(0, 6)} {lead} {plain} {some(0, 6)}", []))
    return out


def train(lines: list[tuple[list[str], list[int]]]) -> Model:
    shapes = Shapes()
    classes = [np.array([shapes[w] for w in words], dtype=np.int64) for words, _ in lines if words]
    tags = [np.array(t, dtype=np.int64) for words, t in lines if words]
    table = np.stack(shapes.rows)
    x = np.concatenate([_features(c, table, file_features(c, table)) for c in classes])
    w, moves = fit(x, np.concatenate(tags), np.array([len(c) for c in classes]), 3, steps=100)
    parts = np.split(w, [WIDTH, 2 * WIDTH, 3 * WIDTH, 4 * WIDTH])
    return Model(*parts, moves)


class Tagger:
    """Applies a model; remembers the classes of words."""

    def __init__(self, model: Model):
        self.model, self.shapes, self.margin = model, kept("secrets", Shapes), model.margin()  # classes do not depend on a model
        self.known = 0

    def _tables(self) -> None:
        if self.known != len(self.shapes.rows):
            self.table = np.stack(self.shapes.rows)
            m = self.model
            self.rows = [self.table @ w for w in (m.own, m.before, m.before2, m.after)]
            self.known = len(self.shapes.rows)

    def tags(self, texts: list[str]) -> list[np.ndarray]:
        """Tags of the tokens of each text, from one Viterbi pass over all
        stretches between tokens that are surely outside."""
        if not texts:
            return []
        get, words = self.shapes.__getitem__, [t.split() for t in texts]
        classes = [np.fromiter(map(get, w), dtype=np.int64, count=len(w)) for w in words]
        self._tables()
        # two places beyond the ends stand before each text and after the last
        n = np.array([len(c) + 2 for c in classes])
        gap = np.zeros(2, dtype=np.int64)
        flat = np.concatenate([x for c in classes for x in (gap, c)] + [gap])
        file = np.stack([np.concatenate([file_features(c, self.table), [1.0]]) for c in classes]) @ self.model.file
        doc = np.repeat(np.arange(len(classes)), n)
        sure = np.full(len(doc), np.inf, dtype=np.float32)
        for k in (BEGIN, INSIDE):
            lead = [(r[:, 0] - r[:, k]).astype(np.float32) for r in self.rows]
            d = (file[:, 0] - file[:, k]).astype(np.float32)[doc]
            d += lead[0][flat[:-2]]
            d[1:] += lead[1][flat[:-3]]
            d[2:] += lead[2][flat[:-4]]
            d += lead[3][flat[1:-1]]
            np.minimum(sure, d, out=sure)
        starts = np.cumsum(n) - n
        sure[starts] = sure[starts + 1] = np.inf
        at = np.flatnonzero(sure < self.margin + 1e-3)  # for the rounding of 32 bits
        tags = np.zeros(len(doc) + 2, dtype=np.int8)
        if len(at):
            # each stretch with the sure token before and after it
            runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)
            first = starts + 2
            lo = np.array([max(r[0] - 1, first[doc[r[0]]]) for r in runs])
            hi = np.array([min(r[-1] + 2, starts[doc[r[0]]] + n[doc[r[0]]]) for r in runs])
            p = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)])
            own, before, before2, after = self.rows
            e = own[flat[p]] + before[flat[p - 1]] + before2[flat[p - 2]] + after[flat[p + 1]] + file[doc[p]]
            got = viterbi(e, self.model.moves, hi - lo)
            np.maximum.at(tags, p, got)
        return [tags[s + 2:s + m] for s, m in zip(starts, n)]

    def spans(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """``(start, end)`` of the tagged secrets, without quotes and marks at
        their ends; a name that is written to the value is not part of it."""
        found = []
        for text, tags in zip(texts, self.tags(texts)):
            own: list[tuple[int, int]] = []
            if tags.any():
                for m, tag, last in zip(_TOKEN.finditer(text), tags, np.concatenate([[0], tags[:-1]])):
                    if tag == OUT:
                        continue
                    core = m[0].strip(_EDGE)
                    value = core.rpartition("=")[2].strip(_EDGE) if "=" in core else core
                    s = m.start() + m[0].find(value)
                    if not value:
                        continue
                    if tag == INSIDE and last != OUT and own:
                        own[-1] = (own[-1][0], s + len(value))
                    else:
                        own.append((s, s + len(value)))
            found.append(own)
        return found


def all_spans(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Base spans, and the model's that lie in none of them, by start and kind:
    where a secret goes on beyond a pattern's match, both are spans."""
    out = []
    for text, more in zip(texts, tagger.spans(texts)):
        base = base_spans(text)
        new = [(s, e, 3) for s, e in more if not any(b[0] <= s and e <= b[1] for b in base)]
        out.append(sorted(base + new, key=lambda s: (s[0], s[2])))
    return out


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, sample_lines: int = SAMPLE_LINES) -> Model:
    """Fit on the made lines and on at most ``sample_lines`` lines of at most
    ``sample_docs`` documents (those of the smallest hashed ids, with texts of
    at most ``sample_chars`` characters, lines of at most ``LINE_CHARS``), labelled by the fixed patterns; lines
    with a secret come first."""
    ids = docs.where("doc_id is not null").select(F.col("doc_id").alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    read = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    rows = read.join(F.broadcast(ids), "id").where(F.length("text") <= sample_chars)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lines = [line for text in pdf["text"] if is_text(text) for line in text.split("\n") if len(line) <= LINE_CHARS]
            found = [base_spans(line) for line in lines]
            yield pd.DataFrame({"plain": np.array([not f for f in found], dtype=np.int32), "line": pd.Series(lines, dtype=object)})

    lines = (rows.select("text").mapInPandas(cut, "plain int, line string").distinct()
             .orderBy("plain", F.xxhash64("line"), "line").limit(sample_lines).collect())
    told = []
    for r in lines:
        secrets = []
        for s, e, kind in base_spans(r.line):
            if kind == 0:
                s = e - len(ASSIGN.match(r.line[s:e])[2])
            secrets.append((s, e))
        told.append(tagged_line(r.line, sorted(set(secrets))))
    return train(made_lines() + told)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``found`` after its own: an array of ``(start,
    end, kind)`` in code points, end exclusive, by start and then kind in the
    order of ``KINDS``. A null or empty text has none; a column of this name
    is replaced."""
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tagger = Tagger(model)
        for texts in series:
            texts = [t if is_text(t) else "" for t in texts]
            rows = []
            for i in range(0, len(texts), BLOCK_DOCS):
                for spans in all_spans(tagger, texts[i:i + BLOCK_DOCS]):
                    rows.append(",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans))
            yield pd.Series(rows, dtype=object)

    told = docs.withColumn("found", F.pandas_udf(tidy(run), "string")(F.col("text").cast("string")))
    spans = F.filter(F.split("found", ","), lambda x: x != "")
    return told.withColumn("found", F.transform(spans, lambda x: F.struct(
        F.split(x, ":")[1].cast("int").alias("start"), F.split(x, ":")[2].cast("int").alias("end"), F.split(x, ":")[0].alias("kind"))))


def redact(docs: DataFrame, model: Model, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each stretch of overlapping spans in ``text`` replaced by
    ``mark``; texts without a secret, and nulls, stay as they are."""
    def run(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tagger = Tagger(model)
        for texts in series:
            plain = [t if is_text(t) else "" for t in texts]
            out = list(texts)
            for i in range(0, len(plain), BLOCK_DOCS):
                for j, spans in enumerate(all_spans(tagger, plain[i:i + BLOCK_DOCS]), i):
                    if spans:
                        parts, end = [], 0
                        for s, e, _ in spans:
                            if s >= end:
                                parts += [plain[j][end:s], mark]
                            end = max(end, e)
                        out[j] = "".join([*parts, plain[j][end:]])
            yield pd.Series(out, dtype=object)

    return docs.withColumn("text", F.pandas_udf(tidy(run), "string")(F.col("text").cast("string")))
