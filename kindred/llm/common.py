"""Shared pieces of the text operators."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handed to an encoder in groups of about so many characters.
GROUP_CHARS = 1_000_000
#: Entries that each of a memo's two generations holds.
MEMO_ENTRIES = 200_000


def narrowed(df: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """Only the named columns, cast, so that further or clashing columns of the input do no harm."""
    return df.select(*(F.col(f"`{source}`").cast(kind).alias(name) for name, (source, kind) in columns.items()))


def held_out(doc_id: Column | str) -> Column:
    """True for the third of the documents that no classifier learns from."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def smallest_hashes(df: DataFrame, n: int, *key: str) -> DataFrame:
    """n rows (all, if fewer) by the hash of their key. Rows are thinned by a bound on the hash first, so that tasks hand on
    a few times n rows in all and not n each; should chance leave fewer than n, all rows are sorted."""
    spread = 1 << 30
    order = F.pmod(F.xxhash64(*key), F.lit(spread))
    total = df.count()
    if total > 4 * n:
        thin = df.where(order < spread * 4 * n // total)
        if thin.count() >= n:
            df = thin
    return df.orderBy(order, *key).limit(n)


def read_bytes(path: str) -> bytes:
    """A vocabulary file, read where the driver runs; its size is that of one file."""
    with open(path, "rb") as file:
        return file.read()


def broadcast_bytes(spark: SparkSession, path: str):
    """A vocabulary file (a few MB) for the executors, which need no copy of it on their disks."""
    return spark.sparkContext.broadcast(read_bytes(path))


class Memo:
    """Results by key in two generations: a full one becomes the old one, and what is used moves on. Memory is bounded
    whatever the number of distinct keys."""

    def __init__(self, compute: Callable[[list], Iterable], entries: int = MEMO_ENTRIES):
        self.compute, self.entries = compute, entries
        self.new: dict = {}
        self.old: dict = {}

    def ready(self, keys: Iterable[Hashable]) -> Callable:
        """A lookup that holds all these keys."""
        if len(self.new) >= self.entries:
            self.new, self.old = {}, self.new
        missing = set(keys) - self.new.keys()
        known = missing & self.old.keys()
        for key in known:
            self.new[key] = self.old[key]
        todo = list(missing - known)
        if todo:
            self.new.update(zip(todo, self.compute(todo), strict=True))
        return self.new.__getitem__

    def values(self, keys: list) -> list:
        """The results of all these keys, looked up in a table of their own, which is small enough to stay near. The work goes
        with the keys, not with what the memo holds."""
        if len(self.new) >= self.entries:
            self.new, self.old = {}, self.new
        own, new, old, todo = dict.fromkeys(keys), self.new, self.old, []
        for key in own:
            if key not in new:
                if key in old:
                    new[key] = old[key]
                else:
                    todo.append(key)
        if todo:
            new.update(zip(todo, self.compute(todo), strict=True))
        own = dict(zip(own, map(new.__getitem__, own), strict=True))
        return list(map(own.__getitem__, keys))


_ENGINES: dict = {}


def engine(key: Hashable, make: Callable):
    """One object per worker process and key, kept over tasks (memos stay warm)."""
    if key not in _ENGINES:
        if len(_ENGINES) > 8:
            _ENGINES.clear()
        _ENGINES[key] = make()
    return _ENGINES[key]


def groups(texts: list, limit: int = GROUP_CHARS) -> Iterator[range]:
    """Consecutive index ranges of about limit characters each."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= limit:
            yield range(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield range(start, len(texts))
