"""Token counts under a unigram vocabulary, with a trie of pre-tokens.

A pre-token's best segmentation is the one of the highest sum of piece
scores. The forward score of a prefix does not depend on what follows, so the
distinct pre-tokens of a batch go into a trie and each node's score is
computed once, however many pre-tokens share that prefix; a terminal node
stores the count of tokens. A document's count is the sum over its pre-tokens.
The trie is kept by a worker and starts anew beyond a number of nodes, which
costs time and changes no count; a run of more characters than words have is
scored by itself, with no more than the scores of its last characters held.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import is_text, kept, tidy, together

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
#: Pre-tokens: letters, digits or other marks, with the space before them.
_PIECE = re.compile(r" ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+| ?\w")
#: Trie nodes, and pre-tokens, kept by a worker.
MAX_NODES, MAX_WORDS = 900_000, 500_000
#: Characters of the longest pre-token that goes into the trie.
LONGEST = 1000
#: Characters of the texts that are counted together, unless one is longer.
TOGETHER = 2 << 20


class Vocabulary:
    """Pieces of a sentencepiece file with unigram scores. The file orders
    pieces by merging rank; the score is the log probability of a Zipf law
    over the ranks. A character that no piece covers costs one byte token for
    each of its UTF-8 bytes, each as unlikely as the last rank."""

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
        plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        total = log(sum(1 / (r + 1) for r in range(len(plain))))
        self.scores = {model.id_to_piece(i): -log(r + 1) - total for r, i in enumerate(plain)}
        self.byte = -log(len(plain) + 1) - total
        self.longest = max(map(len, self.scores), default=1)


class Trie:
    """Nodes are prefixes: a node's children by character, its best score and
    the tokens on the best path to it. Of equal scores the one with fewer
    tokens counts."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.fell()

    def fell(self) -> None:
        """Start the nodes anew; the counts of words stay."""
        self.next: dict[int, int] = {}  # by node and character
        self.score, self.tokens = [0.0], [0]

    def insert(self, word: str) -> int:
        """Tokens of the best segmentation; scores only nodes that are new."""
        path, node, v = [0], 0, self.vocabulary
        for end, ch in enumerate(word, 1):
            edge = node * 0x110000 + ord(ch)
            child = self.next.get(edge)
            if child is None:
                n = len(ch.encode("utf-8", "surrogatepass"))
                best, count = self.score[node] + n * v.byte, self.tokens[node] + n
                for start in range(max(0, end - v.longest), end):
                    s = v.scores.get(word[start:end])
                    if s is not None:
                        s += self.score[path[start]]
                        t = self.tokens[path[start]] + 1
                        if s > best or (s == best and t < count):
                            best, count = s, t
                child = self.next[edge] = len(self.score)
                self.score.append(best)
                self.tokens.append(count)
            node = child
            path.append(node)
        return self.tokens[node]

    def alone(self, word: str) -> int:
        """The count of a long pre-token, without nodes."""
        v = self.vocabulary
        held = deque([(0.0, 0)], maxlen=v.longest)  # score and tokens of the last prefixes
        for end, ch in enumerate(word, 1):
            n = len(ch.encode("utf-8", "surrogatepass"))
            best, count = held[-1][0] + n * v.byte, held[-1][1] + n
            start = end - len(held)
            for s, t in held:
                more = v.scores.get(word[start:end])
                start += 1
                if more is not None:
                    more += s
                    if more > best or (more == best and t + 1 < count):
                        best, count = more, t + 1
            held.append((best, count))
        return held[-1][1]

    def counts(self, texts: list[str]) -> list[tuple[int, int]]:
        """Tokens and pre-tokens of each text."""
        split = [_PIECE.findall(" " + " ".join(t.split())) for t in texts]
        if len(self.words) > MAX_WORDS:
            self.clear()
        for word in set().union(*split).difference(self.words):
            if len(word) > LONGEST:
                self.words[word] = self.alone(word.replace(" ", SPACE))
                continue
            if len(self.score) + len(word) > MAX_NODES:
                self.fell()
            self.words[word] = self.insert(word.replace(" ", SPACE))  # the terminal's count
        get = self.words.__getitem__
        return [(sum(map(get, w)), len(w)) for w in split]


def trie(path: str | None = None) -> Trie:
    """The worker's trie of a vocabulary."""
    return kept(("token_counts", path), lambda: Trie(Vocabulary(path)))


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``n_words`` after its own columns (those
    of these names are replaced). Pre-tokens are runs of letters, of
    digits or of other marks, with a mark for white space before them. ``vocabulary`` is the path
    of a sentencepiece file, the public 32k pieces by default. Null, empty and
    blank texts have 0 of both; equal rows get equal counts."""
    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = trie(vocabulary)
        for texts in series:
            texts = [t if is_text(t) else "" for t in texts]
            rows = [r for part in together(texts, TOGETHER) for r in own.counts(part)]
            yield pd.DataFrame(np.array(rows, dtype=np.int64).reshape(-1, 2), columns=["n_tokens", "n_words"])

    kind = StructType([StructField("n_tokens", LongType()), StructField("n_words", LongType())])
    told = docs.drop("n_tokens", "n_words").withColumn("_count", F.pandas_udf(tidy(run), kind)(F.col("text").cast("string")))
    return told.select(*[c for c in told.columns if c != "_count"], "_count.n_tokens", "_count.n_words")
