"""Best-fit packing by minimum bin slack.

Texts become token pieces; a bin (sequence) holds pieces up to a fixed number of tokens. Which pieces fit together
depends on their lengths alone, so the search runs over the table of counts by length: at most `capacity` rows,
however many pieces there are. Per bin a bitset subset-sum program over the lengths still there finds the fullest
feasible combination; it is taken out as often as the counts allow. The plan says for each length which ranks go
where, and every piece looks its place up by its rank among the pieces of its length. Ranks come from counts by task,
so no length, however common, gathers in one task.

A null text counts as empty; every document, an empty one too, ends with one separator id. Repeated rows are packed as
often as they come. An empty table gives an empty result. Pieces of equal lengths rank by task and order in the task.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import os
import re
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import MEMO_ENTRIES, Memo, engine, groups, narrowed, read_bytes
from kindred.session import scratch, settled

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
#: A longer text is cut at white space into slices of about so many bytes.
SLICE = 4_000_000


# The tokenizer's pre-tokens, for words of ASCII and Latin letters that have no composed or special form.
_PLAIN = re.compile("[!-~\u00c0-\u012f\u0131-\u017f]*")
_PLAIN_TEXT = re.compile("[\t-\r -~\u00c0-\u012f\u0131-\u017f]*")
_PRE_TOKEN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017f]+")
#: The pre-tokens that are no letters, begun by a set so that the search runs over letters fast.
_BETWEEN = re.compile("([^\t-\r a-z\u00df-\u00f6\u00f8-\u017f](?:(?<=')(?:[stmd]|re|ve|ll)|(?<=[0-9])|[^\t-\r a-z0-9\u00df-\u00f6\u00f8-\u017f]*))")
#: Texts go to the encoder in groups of about so many characters, so that many new words are merged in step.
TOGETHER = 4_000_000


class StepMerges:
    """Byte-pair merges of many pre-tokens in step: those of one length form a matrix, and each step merges the pair of
    lowest rank, leftmost among equals, in every row that still has one."""

    def __init__(self, merges: np.ndarray, first: np.ndarray, last: np.ndarray):
        """merges: (left id, right id, merged id) by rank; first, last: ids of a byte inside and at the end of a word."""
        keys = merges[:, 0] << 32 | merges[:, 1]
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.merged = keys[self.order], merges[:, 2]
        self.first, self.last, self.none = first, last, len(keys)

    @classmethod
    def of(cls, spec: dict) -> StepMerges | None:
        """From a tokenizer's description, if it is a byte-level BPE with a suffix at word ends and nothing else."""
        model, pre = spec["model"], json.dumps(spec.get("pre_tokenizer") or {})
        suffix = model.get("end_of_word_suffix")
        if model.get("type") != "BPE" or not suffix or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges") or "ByteLevel" not in pre:
            return None
        vocabulary = model["vocab"]
        # a byte's character: itself where printable, else the next one from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = iter(range(256, 512))
        names = [chr(b) if b in shown else chr(next(rest)) for b in range(256)]
        try:
            rows = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
            first, last = [vocabulary[c] for c in names], [vocabulary[c + suffix] for c in names]
        except (KeyError, ValueError):
            return None
        return cls(np.array(rows, np.int64), np.array(first, np.int64), np.array(last, np.int64))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], self.none)

    def encode(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for n, rows in by_length.items():
            raw = np.frombuffer(b"".join([words[i] for i in rows]), np.uint8).reshape(len(rows), n)
            ids = self.first[raw]
            ids[:, -1] = self.last[raw[:, -1]]
            rows, ranks = np.array(rows), self.ranks(ids[:, :-1], ids[:, 1:])
            while True:
                width = ids.shape[1]
                best = ranks.argmin(1) if width > 1 else None
                done = ranks.min(1) == self.none if width > 1 else np.ones(len(ids), bool)
                if done.any():
                    flat = ids[done].astype("<u4").tobytes()
                    for k, i in enumerate(rows[done].tolist()):
                        out[i] = flat[4 * width * k : 4 * width * (k + 1)]
                    if done.all():
                        break
                    ids, ranks, rows, best = ids[~done], ranks[~done], rows[~done], best[~done]
                each = np.arange(len(ids))
                ids[each, best] = self.merged[ranks[each, best]]
                keep = np.ones(ids.shape, bool)
                keep[each, best + 1] = False
                ids, ranks = ids[keep].reshape(len(ids), width - 1), ranks[keep[:, 1:]].reshape(len(ids), width - 2)
                for at in (best - 1, best):
                    own = np.flatnonzero((at >= 0) & (at < width - 2))
                    ranks[own, at[own]] = self.ranks(ids[own, at[own]], ids[own, at[own] + 1])
        return out


class WordIds:
    """Little-endian ids of a tokenizer whose pre-tokens never go past white space, with a memo of words.

    Words are cut at ASCII white space only; whatever else the tokenizer does stays within them. Plain words share a
    memo of their lower-case pre-tokens, so that punctuation and capitals don't make a new word of a known one.
    """

    def __init__(self, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model.decode())
        self.memo, self.pre_tokens = Memo(self.encode), Memo(lambda words: self.library([w.encode() for w in words]), 2 * MEMO_ENTRIES)
        merges = StepMerges.of(json.loads(model))
        probe = "It's “Ünïted”—l'ÉTÉ's 42%%% naïve,don't!! a ab ababababab strawberry"
        parts = [p for w in probe.split() for p in (_PRE_TOKEN.findall(w.lower()) if _PLAIN.fullmatch(w) else [w])]
        parts = [p.encode() for p in parts]
        self.plain = b"".join(self.library(parts)) == self.library([probe.encode()])[0]
        if merges and self.plain and merges.encode([p for p in parts if p.isascii()]) == self.library([p for p in parts if p.isascii()]):
            self.pre_tokens.compute = lambda words: merges.encode([w.encode() for w in words])

    def library(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [struct.pack(f"<{len(e)}I", *e.ids) for e in found]

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of new words: plain ones by their pre-tokens, all others by the library as they are."""
        parts: list[list[str]] = []
        odd: dict[int, bytes] = {}
        for raw in words:
            if self.plain and raw.isalpha():
                parts.append([raw.decode().lower()])
            elif self.plain and raw[:-1].isalpha() and raw[-1:].isascii() and not raw[-1:].isalnum():
                parts.append([raw[:-1].decode().lower(), raw[-1:].decode()])
            # "<|" may begin a special token, which the library finds before anything else
            elif self.plain and b"<|" not in raw and _PLAIN.fullmatch(word := raw.decode()):
                parts.append(_PRE_TOKEN.findall(word.lower()))
            else:
                odd[len(parts)] = raw
                parts.append([])
        get = self.pre_tokens.ready(p for own in parts for p in own)
        out = [b"".join(map(get, own)) for own in parts]
        for i, ids in zip(odd, self.library(list(odd.values())), strict=True):
            out[i] = ids
        return out

    def cut(self, text: str) -> list[str] | None:
        """The pre-tokens of a plain text; None for others, whose words are looked at one by one. A text with "<|" in it is
        none, as special tokens are found before anything else."""
        if not self.plain or "<|" in text or not _PLAIN_TEXT.fullmatch(text):
            return None
        return " ".join(_BETWEEN.split(text.lower())).split()

    def ids(self, texts: list[str]) -> list[bytes]:
        plain = [self.cut(t) if len(t) <= SLICE else None for t in texts]
        found, at = self.pre_tokens.values(list(chain.from_iterable(p for p in plain if p))), 0
        raw = [t.encode() if own is None else b"" for t, own in zip(texts, plain, strict=True)]
        split = [b.split() if len(b) <= SLICE else [] for b in raw]
        get, out = self.memo.ready(word for words in split for word in words), []
        for own, b, words in zip(plain, raw, split, strict=True):
            if own is not None:
                out.append(b"".join(found[at : at + len(own)]))
                at += len(own)
            else:
                out.append(b"".join(map(get, words)) if len(b) <= SLICE else b"".join(self.long(b)))
        return out

    def long(self, raw: bytes):
        start = 0
        while start < len(raw):
            stop = min(start + SLICE, len(raw))
            while stop < len(raw) and raw[stop] not in b" \t\n\r\x0b\x0c":
                stop += 1
            words = raw[start:stop].split()
            yield b"".join(map(self.memo.ready(words), words))
            start = stop


def token_pieces(df: DataFrame, tokenizer_path: str, capacity: int, separator: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Every document's pieces: documents longer than capacity are cut there, others are one piece. task and nth number
    the pieces of one length within a task. with_ids adds the ids themselves (little-endian 32-bit)."""
    shared = df.sparkSession.sparkContext.broadcast(read_bytes(tokenizer_path))
    end, step = struct.pack("<I", separator), 4 * capacity

    def cut(batches):
        words = engine(("word-ids", hashlib.sha256(shared.value).hexdigest()), lambda: WordIds(shared.value))
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows, kept = [], []
            for part in groups(texts, TOGETHER):
                for i, ids in zip(part, words.ids([texts[i] or "" for i in part]), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), step)):
                        piece = ids[at : at + step]
                        n = len(piece) // 4
                        nth = seen[n] = seen.get(n, -1) + 1
                        rows.append((docs[i], k, at // 4, n, zlib.crc32(piece), task, nth))
                        if with_ids:
                            kept.append(piece)
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"] + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] + [pa.array(kept, pa.binary())] * with_ids, names)

    return narrowed(df, doc_id=(id_col, "long"), text=(text_col, "string")).mapInArrow(cut, PIECE_SCHEMA + ", ids binary" * with_ids)


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """The lengths of the fullest combination within room. Reachable sums are the bits of an integer; one is kept for
    each length, to walk back. Larger lengths come first: a smaller one is taken only for a sum that needs it."""
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for n in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        steps.append((n, reach))
        left, k = min(counts[n], room // n), 1
        while left:
            k = min(k, left)
            reach |= reach << n * k & mask
            left -= k
            k *= 2
        if reach >> room & 1:
            break  # full without the smaller ones, which later bins need
    total, chosen = reach.bit_length() - 1, []
    for n, before in reversed(steps):
        while not before >> total & 1:
            chosen.append(n)
            total -= n
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(lengths in a bin with their multiplicities, number of such bins), over all pieces. Every bin begins with the
    longest length left; the rest of it is the fullest combination of the others."""
    left = {n: c for n, c in counts.items() if c}
    out = []
    while left:
        first = max(left)
        left[first] -= 1
        rest = fullest(left, capacity - first)
        left[first] += 1
        own: dict[int, int] = {}
        for n in (first, *rest):
            own[n] = own.get(n, 0) + 1
        times = min(left[n] // c for n, c in own.items())
        for n, c in own.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
        out.append((own, times))
    return out


def slots(bins: list[tuple[dict[int, int], int]]) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """By length: (first rank, first bin, number in each bin, bins, offset in the bin), in the order of the ranks."""
    out: dict[int, list] = {}
    taken: dict[int, int] = {}
    base = 0
    for own, times in bins:
        offset = 0
        for n, c in sorted(own.items(), reverse=True):
            out.setdefault(n, []).append((taken.get(n, 0), base, c, times, offset))
            taken[n] = taken.get(n, 0) + c * times
            offset += n * c
        base += times
    return out


def packed(pieces: DataFrame, capacity: int) -> DataFrame:
    """Settled pieces (columns length, task, nth and any others) with their sequence_id and offset."""
    spark = pieces.sparkSession
    # at most `capacity` lengths for each task; a window over a length has one row for each task
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    per_task = settled(per_task, "packing-counts")
    counts = {row["length"]: row["n"] for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(counts, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        lengths, ranks = length.to_numpy(), rank.to_numpy()
        sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        order = np.argsort(lengths, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else ():
            n = int(lengths[rows[0]])
            first, base, each, _, at = np.array(shared.value[n], np.int64).T
            k = np.searchsorted(first, ranks[rows], side="right") - 1
            inner = ranks[rows] - first[k]
            sequence[rows], offset[rows] = base[k] + inner // each[k], at[k] + inner % each[k] * n
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = pieces.join(bases, ["length", "task"]).withColumn("at", place("length", F.col("nth") + F.col("base")))
    return placed.select(*pieces.columns, "at.sequence_id", "at.offset")


def lookup(table: dict, length: int, rank: int) -> tuple[int, int]:
    """One piece's (sequence, offset), as packed() has it; for tests and single lookups."""
    rows = table[length]
    first, base, each, _, at = rows[bisect.bisect_right([r[0] for r in rows], rank) - 1]
    return base + (rank - first) // each, at + (rank - first) % each * length


def pack(df: DataFrame, tokenizer_path: str, capacity: int = 2048, separator: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most capacity tokens."""
    pieces = token_pieces(df, tokenizer_path, capacity, separator, id_col, text_col, with_ids)
    path = scratch(df.sparkSession, "pieces")
    pieces.write.parquet(path)
    pieces = df.sparkSession.read.schema(PIECE_SCHEMA + ", ids binary" * with_ids).parquet(path)
    return packed(pieces, capacity).drop("task", "nth")
