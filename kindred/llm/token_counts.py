"""Token counts with a digest cache.

Counts are kept under (content digest, tokenizer digest), the content normalised as the tokenizer gets it: a null text is
empty. A run joins the digests of its texts to the stored counts, encodes each distinct text that has none once, appends the
new counts, and reads all its counts from the cache. It goes batch by batch, so copies in later batches are hits.

A null text counts as the empty text, which has 0 tokens. Equal texts share one count. An empty table gives an empty
result. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import Memo, engine, groups, narrowed, read_bytes
from kindred.session import exists, lean_write, scratch

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long, run string"
#: Batches of a run.
BATCHES = 4
_SEGMENT = re.compile(" +[^ ]+| +$")
#: A longer text is handed on in slices of about so many characters.
SLICE = 4_000_000


class PieceCounter:
    """Counts pieces of a sentencepiece model, with a memo of words.

    Where the model neither rewrites texts nor has a piece that goes on past a space, a text's pieces are those of its
    words, each with the spaces before it. Other models get whole texts.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        probe = "a  b\n№ ﬁx\té é 　c"
        kept = "".join(sp.encode(probe, out_type=str)).replace("<0x0A>", "\n").replace("<0x09>", "\t")
        kept = re.sub("(?:<0x[0-9A-F]{2}>)+", lambda m: bytes(int(x, 16) for x in re.findall("<0x(..)>", m[0])).decode(), kept)
        self.by_word = kept == "▁" + probe.replace(" ", "▁") and not any(re.search("[^▁]▁", p) for p in pieces)
        self.lone = len(sp.encode("a ")) - len(sp.encode("a"))
        self.memo = Memo(self.encode)

    def encode(self, words: list[str]) -> list[int]:
        return [len(ids) if word else self.lone for word, ids in zip(words, self.sp.encode(words, num_threads=1), strict=True)]

    @staticmethod
    def words(text: str) -> list[str]:
        """Each word with the spaces before it but the first, which the model adds to what it is given."""
        if "  " in text or text[:1] == " " or text[-1:] == " ":
            return [m[1:] for m in _SEGMENT.findall(" " + text)]
        return text.split(" ")

    def slices(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > SLICE:
            cut = text.find(" ", start + SLICE)
            while cut > 0 and text[cut - 1] == " ":
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield text[start:cut]
            start = cut + 1
        yield text[start:]

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return [len(ids) for ids in self.sp.encode(texts, num_threads=1)]
        if sum(map(len, texts)) > 2 * SLICE:
            return [sum(self.slice_count(s) for s in self.slices(t)) if t else 0 for t in texts]
        split = [self.words(text) if text else [] for text in texts]
        get = self.memo.ready(word for words in split for word in words)
        return [sum(map(get, words)) for words in split]

    def slice_count(self, text: str) -> int:
        words = self.words(text)
        return sum(map(self.memo.ready(words), words))


def tokenizer_digest(model: bytes) -> str:
    import sentencepiece

    return hashlib.sha256(model + f"sentencepiece {sentencepiece.__version__}".encode()).hexdigest()


def stored(spark, cache: str) -> DataFrame:
    """The cache, empty where nothing was stored yet."""
    if exists(spark, cache):
        return spark.read.schema(CACHE_SCHEMA).parquet(cache)
    return spark.createDataFrame([], CACHE_SCHEMA)


def count_tokens(df: DataFrame, model_path: str, cache: str, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """(id, n_bytes, n_tokens, cached: known before this run) of every row, all counts read from the cache.

    Rows come in batches by the hash of their id. Each batch looks its digests up, encodes what is missing and appends that,
    so later batches find what earlier ones counted; a run that ended early goes on from what it stored."""
    spark = df.sparkSession
    model, run = read_bytes(model_path), uuid.uuid4().hex
    key, shared = tokenizer_digest(model), spark.sparkContext.broadcast(model)

    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))

    def known() -> DataFrame:
        rows = stored(spark, cache).where(F.col("tokenizer_digest") == key)
        return rows.groupBy(F.col("content_digest").alias("digest")).agg(F.max("n_tokens").alias("n_tokens"), F.min(F.col("run") == run).alias("fresh"))

    def encode(found):
        counter = engine(key, lambda: PieceCounter(shared.value))
        for batch in found:
            texts, counts = batch.column(1).to_pylist(), []
            for part in groups(texts):
                counts += counter.counts([texts[i] for i in part])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["content_digest", "n_tokens"])

    for part in range(batches):
        own = docs.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == part)
        # one text for each digest leaves a task at most, so copies don't travel; the join keeps the aggregate's partitioning
        missing = own.groupBy("digest").agg(F.first("text").alias("text")).join(known().select("digest"), "digest", "left_anti")
        counted = missing.select("digest", "text").mapInArrow(encode, "content_digest binary, n_tokens long")
        lean_write(counted.select("content_digest", F.lit(key).alias("tokenizer_digest"), "n_tokens", F.lit(run).alias("run")), cache)
    sized = docs.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return sized.join(known(), "digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (~F.col("fresh")).alias("cached"))


def op7(spark, docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """The contract's columns. Starts from an empty cache, so that a run's figures hold the whole work."""
    counted = count_tokens(narrowed(docs, doc_id=("doc_id", "long"), text=("text", "string")), model_path, scratch(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
