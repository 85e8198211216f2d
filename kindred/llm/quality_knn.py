"""Quality classifier by nearest-neighbour voting in a latent semantic space.

Terms are byte trigrams, hashed to TERMS columns, and a few terms for how repetitive a text is. A bounded sample of labelled documents gives the term weights,
the latent space (the leading right singular vectors of the weighted term-document matrix) and the labelled vectors; all
of that has a fixed size and is broadcast. Every document's vector is compared with all labelled vectors by blocked
matrix products (exact cosines), and its nearest neighbours vote with their similarity as weight.

Null and empty texts have no terms; they get the sample's share of label 1. Ties among neighbours go to the earlier
labelled vector. Repeated rows get equal scores. Without a labelled document every score is 0.5. Of several labels for
one document the mean counts (1 from 0.5). Only the id and the text are read.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import held_out, narrowed

#: Hashed terms, latent dimensions, neighbours that vote.
TERMS, DIMENSIONS, NEIGHBOURS = 2048, 64, 15
#: Terms for repetitiveness, and their weight against the trigrams'.
REPETITION, REPETITION_WEIGHT = 24, 0.5
#: Labelled documents of each class that are learned from: the smallest hashes of their ids. A bound on the model, not on
#: what is scored.
SAMPLE_PER_CLASS = 1500
#: Documents in a block of the matrix products.
BLOCK = 256


def term_counts(texts: list[str]) -> np.ndarray:
    """Documents by terms: counts of the hashed byte trigrams of the whole texts."""
    out = np.zeros((len(texts), TERMS), np.float32)
    for i, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), np.uint8)
        for at in range(0, max(len(raw) - 2, 0), 1 << 22):  # long texts in pieces
            b = raw[at : at + (1 << 22) + 2].astype(np.uint32)
            out[i] += np.bincount(((b[:-2] * 961 + b[1:-1]) * 31 + b[2:]) * np.uint32(2654435761) >> np.uint32(32 - TERMS.bit_length() + 1), minlength=TERMS)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def repetition(counts: np.ndarray) -> np.ndarray:
    """A term for how varied a text's trigrams are: one of REPETITION half-bit steps of their entropy, none for texts of
    under 64 trigrams."""
    total = counts.sum(1, keepdims=True)
    share = counts / np.maximum(total, 1)
    bits = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
    return (np.minimum(bits * 2, REPETITION - 1).astype(int)[:, None] == np.arange(REPETITION)) * (total >= 64)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of the weighted terms and, beside them, of the repetition terms."""
    return unit(np.hstack([unit(np.log1p(counts) * idf), REPETITION_WEIGHT * repetition(counts)]).astype(np.float32))


def leading(gram: np.ndarray, k: int) -> np.ndarray:
    """The leading k eigenvectors, by subspace iteration from a fixed start."""
    q = np.linalg.qr(np.random.default_rng(7).standard_normal((len(gram), min(len(gram), 2 * k))))[0]
    for _ in range(8):
        q = np.linalg.qr(gram @ q)[0]
    values, inner = np.linalg.eigh(q.T @ gram @ q)
    return q @ inner[:, ::-1][:, :k]


class Model:
    """The latent space and the labelled vectors in it."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, prior: float | None = None):
        """prior: the share of label 1 among all labelled rows, to which the votes of a balanced sample are weighted."""
        own = float(labels.mean()) if len(labels) else 0.5
        self.prior = own if prior is None else prior
        self.votes = np.where(labels > 0, self.prior / own if own > 0 else 1, (1 - self.prior) / (1 - own) if own < 1 else 1).astype(np.float32)
        self.labels = labels.astype(np.float32)
        seen = (counts > 0).sum(0)
        self.idf = (np.log((1 + len(labels)) / (1 + seen)) + 1).astype(np.float32)
        x = weighted(counts, self.idf)
        self.basis = leading(x.T @ x, DIMENSIONS).astype(np.float32)
        self.vectors = self.project(x)

    def project(self, x: np.ndarray) -> np.ndarray:
        return unit(x @ self.basis).astype(np.float32)

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return out
        for at in range(0, len(texts), BLOCK):
            x = weighted(term_counts(texts[at : at + BLOCK]), self.idf)
            z = self.project(x)
            cosines = z @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.clip(np.take_along_axis(cosines, near, 1), 0, None) ** 4 * self.votes[near]
            total = weight.sum(1)
            vote = (weight * self.labels[near]).sum(1) / np.where(total > 0, total, 1)
            out[at : at + BLOCK] = np.where(total > 0, vote, self.prior)
        return out


def learnable(labels: DataFrame, label_col: str) -> DataFrame:
    """(doc_id, label 0 or 1) of the labelled documents that may be learned from."""
    marked = narrowed(labels, doc_id=("doc_id", "long"), label=(label_col, "double")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    return marked.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int) -> DataFrame:
    """(doc_id, label, text) of the bounded sample: of each class the smallest hashes among rows that may be learned from."""
    marked = learnable(labels, label_col)
    chosen = [marked.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])
    # 2 x per_class rows of two numbers: a fixed size
    return narrowed(docs, doc_id=("doc_id", "long"), text=("text", "string")).join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> Model:
    def rows(batches):
        for batch in batches:
            ids, marks, texts = (batch.column(i).to_pylist() for i in range(3))
            for at in range(0, len(texts), BLOCK):
                counts = np.minimum(term_counts([t or "" for t in texts[at : at + BLOCK]]), 65535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + BLOCK], pa.int64()), pa.array(marks[at : at + BLOCK], pa.int32()), pa.array([zlib.compress(c.tobytes(), 1) for c in counts], pa.binary())], ["doc_id", "label", "counts"])

    # a document counts once, by its smallest text, so that the sample's size is bounded
    found = {r["doc_id"]: (r["label"], r["counts"]) for r in training_rows(docs, labels, label_col, per_class).groupBy("doc_id", "label").agg(F.min("text").alias("text")).mapInArrow(rows, "doc_id long, label int, counts binary").collect()}
    order = sorted(found)
    counts = np.array([np.frombuffer(zlib.decompress(found[i][1]), np.uint16) for i in order], np.float32).reshape(-1, TERMS)
    prior = learnable(labels, label_col).agg(F.avg("label")).first()[0]
    return Model(counts, np.array([found[i][0] for i in order], np.float32), prior)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    shared = df.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches):
        own = pickle.loads(shared.value)
        for batch in batches:
            scores = own.scores([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [id_col, "score"])

    return narrowed(df, **{id_col: (id_col, "long"), "text": (text_col, "string")}).mapInArrow(run, f"`{id_col}` long, score double")


def kept(df: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """df without the rows that score below the threshold; all columns as they were."""
    shared = df.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    @F.pandas_udf("double")
    def of(texts):
        import pandas as pd

        return pd.Series(pickle.loads(shared.value).scores([t or "" for t in texts]))

    return df.where(of(F.col(f"`{text_col}`").cast("string")) >= threshold)


def op2(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
