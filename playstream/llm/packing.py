"""Cost-balanced packing of tokenised documents into fixed-length sequences.

Tasks tokenise their rows and pack them in shards of about ``shard_tokens``
tokens; no text is shuffled and a task holds one shard. In a shard, documents
longer than a sequence first give whole sequences. The rest go, in descending
length, to the sequence of lowest estimated cost (linear plus quadratic in the
lengths of its pieces, as attention stays inside a document) that still has
room; those that fit nowhere are cut over what room is left.

A shard fills full sequences only. What is left of all shards, less than a
sequence each, is gathered into shards of the same size and packed the same
way; of these the last tokens, less than a sequence again, go to sequences
whose lengths are powers of two. So short sequences follow from the tokens,
not from the files that they were read from.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, ids_of, is_text, kept, materialize, tidy, together

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: A worker remembers up to twice as many words and pre-tokens; fewer only cost time.
REMEMBER = 800_000
#: Characters of the texts whose words are looked up together.
TOGETHER = 1 << 21
#: Texts of these characters only are split here (the tokenizer's rule for
#: them, and neither its NFC form nor case mapping depends on neighbours);
#: others are given to the tokenizer as they are.
_PLAIN = r"\t\n\r\x20-\x7E\xA1-\xAC\xAE-įĲ-ž"
_OTHER = re.compile(f"[^{_PLAIN}]")
_PLAIN_ASCII = bytes([9, 10, 13, *range(0x20, 0x7F)])
_LETTER = r"a-z\xAA\xB5\xBA\xDF-\xF6\xF8-ſ"
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9\xB2\xB3\xB9\xBC-\xBE]|[^\s{_LETTER}0-9\xB2\xB3\xB9\xBC-\xBE]+")


def _for_pieces(model):
    """The tokenizer without what pre-tokens of plain texts have behind them,
    normal form and the cut; both have one vocabulary in memory."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split, WhitespaceSplit
    steps, chars = model.pre_tokenizer, "".join(c for c in map(chr, range(0x21, 0x180)) if not _OTHER.match(c)).lower()
    if not isinstance(steps, Sequence) or [type(s) for s in steps] != [Split, ByteLevel] or model.normalizer and model.normalizer.normalize_str(chars) != chars:
        return model
    own = Tokenizer(model.model)
    own.pre_tokenizer = Sequence([WhitespaceSplit(), steps[1]])
    return own


class Encoder:
    """Token ids of texts as little-endian 32-bit words, remembering the ids
    of words and of their pre-tokens: they do not depend on what stands around."""

    def __init__(self, path: str | None = None, remember: int = REMEMBER, special: bool = True):
        import public_tokenizers
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        self.model.encode_special_tokens = not special
        self.pieces = _for_pieces(self.model)
        added = self.model.get_added_tokens_decoder().values() if special else ()
        #: texts with these strings, as they are or in lower case, go to the tokenizer whole
        self.added = [t.content for t in added]
        self.folded = [t.content.lower() for t in added if t.normalized]
        #: of each id, whether it ends a pre-token; none if the vocabulary doesn't tell
        suffix = getattr(self.model.model, "end_of_word_suffix", None)
        names = self.model.get_vocab(with_added_tokens=False) if suffix else {}
        self.last = np.zeros(max([self.model.get_vocab_size(), *(i + 1 for i in names.values())]), dtype=bool) if suffix else None
        if suffix:
            self.last[[i for t, i in names.items() if t.endswith(suffix)]] = True
        self.remember = remember
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        """Ids of pre-tokens, all in one text: one pre-token for each of them."""
        if not pieces:
            return
        text = " ".join(pieces)
        if self.last is not None:
            ids = np.asarray(self.pieces.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = [0, *(np.flatnonzero(self.last[ids]) + 1).tolist()]
        if self.last is None or len(ends) != len(pieces) + 1:  # a last symbol that is not in the vocabulary
            e = self.pieces.encode(text, add_special_tokens=False)
            ids, of = np.asarray(e.ids, dtype="<u4"), np.asarray(e.word_ids)
            ends = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        data, ends = ids.tobytes(), [4 * n for n in ends]
        self.known.update(zip(pieces, [data[s:t] for s, t in zip(ends, ends[1:])]))

    def _lowered(self, text: str) -> str | None:
        """A text in lower case; none if the tokenizer must have it whole."""
        if any(a in text for a in self.added) or (text.encode().translate(None, _PLAIN_ASCII) if text.isascii() else _OTHER.search(text)):
            return None
        lower = text.lower()
        return None if any(a in lower for a in self.folded) else lower

    def _meet(self, words: list[str]) -> None:
        """Have the ids of new words among the known ones."""
        before = self.older
        fresh = [w for w in words if w not in before]
        mixed = [w for w in fresh if not w.isalpha()]  # letters alone are one pre-token
        cuts = list(map(_PIECE.findall, mixed))
        pieces = {*filter(str.isalpha, fresh), *itertools.chain.from_iterable(cuts)}
        if len(self.known) + len(words) + len(pieces) > self.remember:  # what is in use comes back from the older ones
            self.known, self.older = {}, self.known
        # the few are looked up among the many: an intersection of sets would walk through all that is remembered
        for source, some in ((before, words), (self.older, pieces)):
            self.known.update([(w, x) for w, x in zip(some, map(source.get, some)) if x is not None])
        self._learn([p for p in pieces if p not in self.known])
        get = self.known.__getitem__
        self.known.update(zip(mixed, [get(c[0]) if len(c) == 1 else b"".join(map(get, c)) for c in cuts]))

    def _ids(self, words: list[str]) -> list[bytes]:
        found = list(map(self.known.get, words))
        new = [w for w, x in zip(words, found) if x is None]
        if not new:
            return found
        self._meet(new)
        get = self.known.__getitem__
        return [get(w) if x is None else x for w, x in zip(words, found)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each distinct word of these texts, between white space, which no
        pre-token crosses, is looked up once; Arrow puts their ids in place."""
        lowered = [self._lowered(t) for t in texts]
        words = pc.ascii_split_whitespace(pa.array([t or "" for t in lowered], pa.string()))
        coded = words.values.dictionary_encode()
        placed = pa.array(self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        _, offsets, data = placed.buffers()
        data = memoryview(data) if data else b""
        at = np.frombuffer(offsets, dtype=np.int64)[words.offsets.to_numpy()].tolist() if len(placed) else [0] * (len(texts) + 1)
        return [np.asarray(self.model.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() if low is None else bytes(data[s:e])
                for t, low, s, e in zip(texts, lowered, at, at[1:])]


def assign(lengths: list[int], size: int, linear: float, quadratic: float, short: bool = True) -> list[tuple[int, int, int, int]]:
    """Pieces ``(document, start, length, sequence)`` that hold each token of
    documents of these lengths once and fill every sequence exactly. Without
    ``short`` sequences what would be in them has the sequence -1."""
    out, rest, seq = [], [], 0
    for i, n in enumerate(lengths):
        for s in range(0, n - size + 1, size):
            out.append((i, s, size, seq))
            seq += 1
        if n % size:
            rest.append((n % size, i, n - n % size))
    total = sum(n for n, _, _ in rest)
    room = [size] * (total // size) + [1 << b for b in range(size.bit_length() - 1, -1, -1) if short and (total % size) >> b & 1]
    room, cost = np.array(room, dtype=np.int64), np.zeros(len(room))
    cut = []
    for n, i, s in sorted(rest, key=lambda x: (-x[0], x[1])):
        fits = np.flatnonzero(room >= n)
        if len(fits):
            j = fits[np.argmin(cost[fits])]
            room[j] -= n
            cost[j] += linear * n + quadratic * n * n
            out.append((i, s, n, seq + int(j)))
        else:
            cut.append((n, i, s))
    for n, i, s in cut:
        while n:
            j = int(np.argmax(room)) if len(room) else -1
            if j < 0 or not room[j]:
                out.append((i, s, n, -1))
                break
            part = min(n, int(room[j]))
            room[j] -= part
            out.append((i, s, part, seq + j))
            s, n = s + part, n - part
    return out


class _Shard:
    """Documents, or pieces of them, that are packed together."""

    def __init__(self, pack, base: int, with_ids: bool, short: bool):
        self.pack, self.base, self.with_ids, self.short = pack, base, with_ids, short
        self.ids, self.docs, self.held = [], [], 0

    def add(self, doc_id: int | None, ids: bytes, start: int, tokens: int) -> None:
        self.ids.append(ids)
        self.docs.append((doc_id, start, tokens))
        self.held += len(ids) // 4

    def flush(self) -> pd.DataFrame:
        rows, used = [], {}
        for i, at, n, seq in self.pack([len(x) // 4 for x in self.ids], short=self.short):
            part, (doc_id, start, tokens) = self.ids[i][4 * at:4 * (at + n)], self.docs[i]
            offset = used.get(seq, 0)
            if seq >= 0:
                used[seq] = offset + n
            rows.append((doc_id, start + at, n, zlib.crc32(part), tokens, self.base + seq if seq >= 0 else None, offset, part if self.with_ids or seq < 0 else None))
        self.base, self.ids, self.docs, self.held = self.base + len(used), [], [], 0
        out = dict(zip(COLUMNS, zip(*rows)))
        return pd.DataFrame(out | {c: pd.array(out[c], dtype="Int64") for c in ("doc_id", "sequence_id")})


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
#: Sequences of the second step are numbered from here.
SECOND = 1 << 62


def _packer(pack, shard_tokens: int, path: str | None, with_ids: bool, remember: int, special: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, end = kept(("packing", path, remember, special), lambda: Encoder(path, remember, special)), np.array([END_ID], dtype="<u4").tobytes()
        shard = _Shard(pack, TaskContext.get().partitionId() << 32, with_ids, short=False)

        for pdf in batches:
            texts = [t if is_text(t) else "" for t in pdf["text"]]
            names = ids_of(pdf["doc_id"])
            at = 0
            for part in together(texts, TOGETHER, len(texts)):
                for name, x in zip(names[at:at + len(part)], coder.encode(part)):
                    shard.add(name, x + end, 0, len(x) // 4 + 1)
                    if shard.held >= shard_tokens:
                        yield shard.flush()
                at += len(part)
        if shard.ids:
            yield shard.flush()
    return tidy(run)


def _rest(pack, with_ids: bool):
    """Packs the pieces of a partition, which are one shard."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = _Shard(pack, SECOND + (TaskContext.get().partitionId() << 32), with_ids, short=True)
        for pdf in batches:
            for doc_id, start, tokens, ids in zip(ids_of(pdf["doc_id"]), pdf["start"].tolist(), pdf["doc_tokens"].tolist(), pdf["ids"]):
                shard.add(doc_id, ids, start, tokens)
        if shard.ids:
            yield shard.flush()
    return tidy(run)


def pack(docs: DataFrame, size: int = 4096, shard_tokens: int = 1 << 20, linear: float = 1.0,
         quadratic: float = 1 / 4096, vocabulary: str | None = None, with_ids: bool = True, remember: int = REMEMBER,
         special: bool = True) -> DataFrame:
    """Return one row per piece: ``doc_id``, ``start`` (ids of its document
    before it), ``length``, ``ids_crc32`` (of its ids as little-endian
    unsigned 32-bit words), ``doc_tokens``, ``sequence_id``, ``offset`` in the
    sequence and, if ``with_ids``, the ids as such words in ``ids``.

    ``vocabulary`` is the path of a tokenizers file, the public 49k word BPE
    by default; each document ends with id 2. With ``special`` the strings of
    the vocabulary's added tokens become these tokens, as in a plain call of the
    tokenizer; without, they are text like any other. A worker remembers the ids
    of up to twice ``remember`` words and pre-tokens, which changes no result. A sequence
    holds ``size`` ids (a power of two) or, at most once for each power and
    shard of what is left over, a smaller power of two; none is padded. Defined
    cases: a null or empty text is the end id alone; rows with equal or null ids
    are documents of their own; further columns are ignored; an empty table
    gives no piece."""
    fill = functools.partial(assign, size=size, linear=linear, quadratic=quadratic)
    read = docs.select(id_text("doc_id"), F.col("text").cast("string").alias("text"))
    first = materialize(read.mapInPandas(_packer(fill, shard_tokens, vocabulary, with_ids, remember, special), SCHEMA), "packed")
    left = first.where("sequence_id is null").select(id_text("doc_id"), "start", "doc_tokens", "ids", "length", "ids_crc32")
    shards = math.ceil((left.agg(F.sum("length")).first()[0] or 0) / shard_tokens) or 1
    second = left.repartition(shards, F.xxhash64("doc_id", "start", "ids_crc32")).sortWithinPartitions("doc_id", "start", "ids_crc32").mapInPandas(_rest(fill, with_ids), SCHEMA)
    out = first.where("sequence_id is not null").unionByName(second)
    return out if with_ids else out.drop("ids")
