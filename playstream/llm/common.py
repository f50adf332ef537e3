"""Helpers shared by the operators: row keys, grouped streams, typed hashing."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.session import BROADCAST_ROWS, materialize, small_side  # noqa: F401
from playstream.sources.tables import read_table

__all__ = ["Best", "materialize", "read_table", "row_key", "small_side", "kept", "tidy", "grouped", "utf8", "is_text"]


def row_key(id_col: str, text_col: str) -> Column:
    """A never-null key of a row: its id and the MD5 of its text. Rows that
    repeat share it; rows with one id and different texts do not."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                       F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit("null")))


def id_text(name: str) -> Column:
    """An id column on its way to pandas, which would make doubles of integers
    that stand beside nulls."""
    return F.col(name).cast("long").cast("string").alias(name)


def ids_of(column: pd.Series) -> list[int | None]:
    """The integers of a column that was sent as ``id_text``."""
    return [int(v) if isinstance(v, str) else None for v in column]


def is_text(value) -> bool:
    """False for the nulls of pandas columns."""
    return isinstance(value, str)


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


_KEPT: dict[object, object] = {}


def kept(name: object, make: Callable[[], object]):
    """What a worker remembers from task to task, by name. Only the last
    operator's is kept, so that the stages of a pipeline don't add up."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def give_back() -> None:
    """Return to the system what the batches of a task have held; allocators
    keep it otherwise, and idle workers share the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def together(texts: list[str], chars: int, most: int = 256) -> Iterator[list[str]]:
    """Runs of at most ``most`` texts of about ``chars`` characters, or one
    that is longer: what a task works on at once."""
    part, held = [], 0
    for text in texts:
        if part and (held + len(text) > chars or len(part) == most):
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text)
    if part:
        yield part


def tidy(run):
    """A function over a task's batches that gives memory back at its end."""
    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        give_back()
    return wrapped


def _starts(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where the runs of equal keys begin."""
    new = np.zeros(len(frame), dtype=bool)
    new[:1] = True
    for k in keys:
        v = frame[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames of whole groups, and where the groups begin, from a partition
    sorted by ``keys``: the last group of a batch waits for the next one."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        starts = _starts(batch, keys)
        if held and all(held[-1][k].iloc[-1] == batch[k].iloc[0] for k in keys) and len(starts) == 1:
            held.append(batch)
            continue
        frame = pd.concat([*held, batch.iloc[:starts[-1]]], ignore_index=True) if held else batch.iloc[:starts[-1]]
        held = [batch.iloc[starts[-1]:]]
        if len(frame):
            yield frame, _starts(frame, keys)
    if held:
        frame = pd.concat(held, ignore_index=True)
        yield frame, _starts(frame, keys)


def grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a partition sorted by ``keys``, one by one."""
    for frame, starts in whole_groups(batches, keys):
        for s, e in zip(starts, [*starts[1:], len(frame)]):
            yield frame.iloc[s:e]


_NO_SCORE = -2**62


class Best:
    """The best ``k`` (score, id) of each of ``n`` places, whole numbers;
    higher scores first, ties by smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), _NO_SCORE, dtype=np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, dtype=np.int64)

    def could(self, place, score, ident) -> np.ndarray:
        """Which of these would be among the best."""
        last, last_id = self.score[place, -1], self.id[place, -1]
        return (score > last) | ((score == last) & (ident < last_id))

    def add(self, place: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(place):
            return
        touched = np.unique(place)
        place = np.concatenate([place, np.repeat(touched, self.k)])
        score = np.concatenate([score.astype(np.int64), self.score[touched].ravel()])
        ident = np.concatenate([ident, self.id[touched].ravel()])
        order = np.lexsort((ident, -score, place))
        place, score, ident = place[order], score[order], ident[order]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        top = rank < self.k
        self.score[place[top], rank[top]], self.id[place[top], rank[top]] = score[top], ident[top]

    def told(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, scores and ids that were kept."""
        place, rank = np.nonzero(self.score > _NO_SCORE)
        return place, self.score[place, rank], self.id[place, rank]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")
