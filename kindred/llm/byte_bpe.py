"""Byte-level BPE encoding and decoding from a rank file, by a two-tier lookup.

First tier: a minimal perfect hash from a vocabulary's byte strings to their ranks, one probe and one comparison, for
whole pre-tokens. Second tier: a heap of adjacent pairs over linked bytes, lowest rank first and leftmost among equals.

A null text counts as empty and has no ids; special strings are ordinary text. An empty table gives an empty result.
Texts of any length are cut only between a non-space and a white space, where no pre-token goes on.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import Memo, engine, groups, narrowed, read_bytes

#: White space as the tokenizer's pattern language has it (Unicode White_Space); Python's \s has four more characters.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SEGMENT = regex.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_RUN = regex.compile(f"[{SPACE}] | [{SPACE}]")
SLICE = 4_000_000


def parse_ranks(file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file.splitlines() if line.strip())}


class PerfectHash:
    """Minimal perfect hash by displacement: keys fall into buckets, and each bucket, largest first, gets the first seed
    that sends its keys to free slots. Buckets of one key name their slot directly."""

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.buckets = max(1, n // 4)
        self.shift = [0] * self.buckets
        slots: list[bytes | None] = [None] * n
        by_bucket: dict[int, list[bytes]] = {}
        for key in keys:
            by_bucket.setdefault(xxhash.xxh3_64_intdigest(key) % self.buckets, []).append(key)
        order = sorted(by_bucket.items(), key=lambda item: -len(item[1]))
        for bucket, members in order:
            if len(members) == 1:
                break
            seed = 1
            while True:
                spots = [xxhash.xxh3_64_intdigest(key, seed) % n for key in members]
                if len(set(spots)) == len(spots) and all(slots[s] is None for s in spots):
                    break
                seed += 1
            self.shift[bucket] = seed
            for spot, key in zip(spots, members, strict=True):
                slots[spot] = key
        free = (i for i, key in enumerate(slots) if key is None)
        for bucket, members in order:
            if len(members) == 1:
                spot = next(free)
                self.shift[bucket] = -spot - 1
                slots[spot] = members[0]
        self.slots = slots

    def slot(self, key: bytes) -> int:
        """The key's place, or -1 for a string that isn't a key."""
        if not self.n:
            return -1
        shift = self.shift[xxhash.xxh3_64_intdigest(key) % self.buckets]
        spot = -shift - 1 if shift < 0 else xxhash.xxh3_64_intdigest(key, shift) % self.n
        return spot if self.slots[spot] == key else -1


def merge_heap(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of a pre-token's symbols. Symbols are byte spans, linked by their ends and by the starts before them."""
    n = len(piece)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, start, stop = heappop(heap)
        middle = ends[start]
        if not 0 < middle < n or ends[middle] != stop:
            continue
        ends[start], ends[middle] = stop, 0
        if stop < n:
            before[stop] = start
            further = ends[stop]
            if (rank := ranks.get(piece[start:further])) is not None:
                heappush(heap, (rank, start, further))
        if start and (rank := ranks.get(piece[before[start] : stop])) is not None:
            heappush(heap, (rank, before[start], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return out


class ByteCodec:
    """encode and decode of a rank file and a pre-token pattern."""

    def __init__(self, file: bytes, pattern: str):
        self.ranks = parse_ranks(file)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.hash = PerfectHash(list(self.ranks))
        self.rank_of_slot = [self.ranks[key] for key in self.hash.slots]
        # \s and \S in the pattern's own sense, wherever Python's library differs
        self.pattern = regex.compile(pattern.replace("[^\\s", f"[^{SPACE}").replace("\\S", f"[^{SPACE}]").replace("\\s", f"[{SPACE}]"))
        self.pieces = Memo(lambda words: [self.piece(word) for word in words])
        self.segments = Memo(self.segment_rows)

    def piece(self, word: str) -> list[int]:
        raw = word.encode()
        slot = self.hash.slot(raw)
        return [self.rank_of_slot[slot]] if slot >= 0 else merge_heap(raw, self.ranks)

    def encode(self, text: str) -> list[int]:
        words = self.pattern.findall(text)
        get = self.pieces.ready(words)
        return [i for word in words for i in get(word)]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def segment_rows(self, segments: list[str]) -> list[tuple[bytes, bytes]]:
        """Of each segment the ids as decimal text and the bytes they decode to."""
        words = [self.pattern.findall(s) for s in segments]
        get = self.pieces.ready(word for own in words for word in own)
        rows = []
        for own in words:
            ids = [i for word in own for i in get(word)]
            rows.append((" ".join(map(str, ids)).encode(), self.decode(ids)))
        return rows

    @staticmethod
    def split(text: str) -> list[str]:
        """Segments between which no pre-token goes on: white space and what follows it."""
        if "\0" in text or _RUN.search(text) or text[:1] == " ":
            return _SEGMENT.findall(text)
        return text.replace(" ", "\0 ").split("\0")

    @classmethod
    def slices(cls, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > SLICE:
            cut = regex.compile(f"[^{SPACE}][{SPACE}]").search(text, start + SLICE)
            if not cut:
                break
            yield text[start : cut.start() + 1]
            start = cut.start() + 1
        yield text[start:]

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Of each text: the number of ids, SHA-256 of the ids in decimal, SHA-256 of the decoded bytes."""
        split = [self.split(t) if t and len(t) <= SLICE else [] for t in texts]
        get = self.segments.ready(s for own in split for s in own)
        out = []
        for text, own in zip(texts, split, strict=True):
            ids_hash, raw_hash, n = hashlib.sha256(), hashlib.sha256(), 0
            if text and not own:
                for part in self.slices(text):
                    parts = self.split(part)
                    rows = list(map(self.segments.ready(parts), parts))
                    ids = b" ".join([row[0] for row in rows])
                    ids_hash.update((b" " if n else b"") + ids)
                    raw_hash.update(b"".join([row[1] for row in rows]))
                    n += ids.count(b" ") + 1
                get = self.segments.ready(s for other in split for s in other)
            elif own:
                rows = list(map(get, own))
                ids = b" ".join([row[0] for row in rows])
                ids_hash.update(ids)
                raw_hash.update(b"".join([row[1] for row in rows]))
                n = ids.count(b" ") + 1
            out.append((n, ids_hash.hexdigest(), raw_hash.hexdigest()))
        return out


def _codec(shared, pattern):
    return engine(("byte-bpe", hashlib.sha256(shared.value).hexdigest(), pattern), lambda: ByteCodec(shared.value, pattern))


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """df with an array of ids for each text (an empty array for null and empty texts)."""
    shared = df.sparkSession.sparkContext.broadcast(read_bytes(ranks_path))

    @F.pandas_udf("array<int>")
    def ids(texts):
        import pandas as pd

        codec = _codec(shared, pattern)
        return pd.Series([np.array(codec.encode(t or ""), np.int32) for t in texts])

    return df.withColumn(out_col, ids(F.col(f"`{text_col}`")))


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", out_col: str = "bytes") -> DataFrame:
    """df with the bytes that each array of ids stands for (null arrays: empty)."""
    shared = df.sparkSession.sparkContext.broadcast(read_bytes(ranks_path))

    @F.pandas_udf("binary")
    def raw(arrays):
        import pandas as pd

        codec = _codec(shared, pattern)
        return pd.Series([b"" if a is None else codec.decode(a) for a in arrays])

    return df.withColumn(out_col, raw(F.col(f"`{ids_col}`")))


def code_digests(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes each text, keeping digests only."""
    shared = df.sparkSession.sparkContext.broadcast(read_bytes(ranks_path))

    def run(batches):
        codec = _codec(shared, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = [row for part in groups(texts) for row in codec.digests([texts[i] or "" for i in part])]
            n, ids, raw = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return narrowed(df, **{id_col: (id_col, "long"), "text": (text_col, "string")}).mapInArrow(run, f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string")
