"""Exact top-k by inner product over a pivot-distance index.

Inner product search is turned into distance search: with one more component every vector gets the largest norm, and then
the nearest vectors are those of the highest inner products. Vectors are keyed by (nearest pivot, distance to it) and
stored range-partitioned and sorted by that key: each pivot's annuli lie next to one another in blocks, and equal keys,
however many, spread over blocks by id.

Queries go through the index in batches of a bounded size, near ones together, one batch after the other. A batch's first
thresholds come from the sample; the triangle inequality then gives the annuli of each pivot that can hold an answer, and
only those are read (a filter on the sorted columns, so Parquet leaves the others out). A task walks its blocks from the
annuli nearest to a query outwards and passes over those in which no query can improve on its k-th score. How much that
saves depends on the vectors: where distances hardly differ, as between random directions, nothing can be left out.

Scores are exact: products of floats where every sum is below 2**53, of 64-bit integers below 2**63. Vectors so long that a
score could go beyond that (a squared norm above 2**62) are kept out of the index and multiplied as whole numbers of any
size; a score that a long can't hold is returned as the nearest long, its rank is that of the true one.

Null vectors and those with null or non-finite components (also after scaling) take no part. Shorter vectors count as filled
up with zeros. A vector is never its own answer; further rows of its id are not either. An id of several rows is one answer,
by its best score, and one query, by its largest vector in the order of components. Ties go to the smaller id. Without
vectors the result is empty. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import discarded, settled

#: Vectors that pivots and first thresholds are taken from, and pivots.
SAMPLE, PIVOTS = 2048, 48
#: Vectors in a block of the index, and queries in a batch: so many, or fewer if their components would be more than that.
BLOCK, BATCH, BATCH_COMPONENTS = 1024, 8192, 1 << 21
#: The largest squared norm in the index: inner products of such vectors fit in a long.
NORM2 = 2.0**62

#: A score below all others (its negative is one too) and the id of an empty place.
LOW, NONE = -(2**63) + 1, 2**63 - 1

INDEX_SCHEMA = "vec_id long, x array<double>, pivot int, distance double"
FOUND_SCHEMA = "query_id long, vec_id long, score long, over int, exact binary"


def quantised(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(vec_id, x) of the rows that take part: floor(scale * component) of each, a whole number as a double."""
    doubles = F.transform(F.col(f"`{vector_col}`").cast("array<double>"), lambda c: c * F.lit(float(scale)))
    # NaN and infinities fail the comparison
    fit = F.forall("v", lambda c: F.coalesce((F.abs(c) <= F.lit(1.7976931348623157e308)) & ~F.isnan(c), F.lit(False)))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), doubles.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fit)
    # from 2**52 on a double is whole
    return rows.select("vec_id", F.transform("v", lambda c: F.when(F.abs(c) < 2.0**52, F.floor(c).cast("double")).otherwise(c)).alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy().astype(np.float64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out[rows, np.arange(len(flat)) - np.repeat(starts, sizes)] = flat
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of vectors of the index. No sum exceeds the product of the norms, which says whether floats
    are exact; if not, 64-bit integers are."""
    if not len(a) or not len(b) or np.sqrt((a * a).sum(1).max() * (b * b).sum(1).max()) < 2.0**52:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Pivots:
    """Pivots in the space with one more component, and the sample that first thresholds come from."""

    def __init__(self, sample_ids: np.ndarray, sample: np.ndarray, norm2: float, width: int, count: int = PIVOTS):
        self.norm2, self.width = norm2, width
        self.sample_ids, self.sample = sample_ids, sample
        lifted = self.lift(sample)
        # farthest-first, from the first sample vector
        chosen, far = [], np.full(len(lifted), np.inf)
        for _ in range(min(count, len(lifted))):
            at = int(far.argmax()) if chosen else 0
            if chosen and far[at] <= 0:
                break
            chosen.append(at)
            far = np.minimum(far, ((lifted - lifted[at]) ** 2).sum(1))
        pivots = lifted[chosen]
        for _ in range(4):  # towards the means of what is nearest
            near = self._distances(lifted, pivots).argmin(1)
            pivots = np.array([lifted[near == p].mean(0) if (near == p).any() else pivots[p] for p in range(len(pivots))])
        self.pivots = pivots

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(self.norm2 - (x * x).sum(1), 0))[:, None]])

    @staticmethod
    def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0))

    def of_vectors(self, x: np.ndarray) -> np.ndarray:
        return self._distances(self.lift(x), self.pivots)

    def of_queries(self, x: np.ndarray) -> np.ndarray:
        return self._distances(np.hstack([x, np.zeros((len(x), 1))]), self.pivots)

    def reach(self, queries: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance that vectors of at least this score are within, with room for rounding."""
        far2 = (queries * queries).sum(1) + self.norm2 - 2 * score
        return np.sqrt(np.maximum(far2, 0)) + 1e-6 * np.sqrt(self.norm2 + 1) + 1e-6


def once(ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id of a block once, with its best score for each query."""
    order = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) != 0]))
    if len(starts) >= len(ids):
        return ids, scores
    return ids[order][starts], np.maximum.reduceat(scores[:, order], starts, axis=1)


class Best:
    """The k best (score, smaller id first) for each query so far."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.scores = np.full((len(ids), k), LOW)
        self.found = np.full((len(ids), k), NONE)
        self.floor = np.full(len(ids), -np.inf)

    def offer(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores of some queries against a block."""
        ids, scores = once(ids, scores)
        own = ids[None] == self.ids[rows][:, None]
        scores = np.where(own, LOW, scores)
        k = min(self.k, scores.shape[1])
        # the block's k-th score, and all that ties with it
        cut = -np.partition(-scores, k - 1, axis=1)[:, k - 1] if k else None
        for i, row in enumerate(rows):
            at = np.flatnonzero((scores[i] >= max(cut[i], self.scores[row, -1])) & ~own[i])
            if not len(at):
                continue
            s, f = np.concatenate([self.scores[row], scores[i, at]]), np.concatenate([self.found[row], ids[at]])
            order = np.lexsort((f, -s))
            s, f = s[order], f[order]
            # an id of other blocks counts once, by its best score
            fresh = f == NONE
            fresh[np.unique(f, return_index=True)[1]] = True
            s, f = s[fresh], f[fresh]
            self.scores[row], self.found[row] = s[: self.k], f[: self.k]
            if self.found[row, -1] != NONE:
                self.floor[row] = max(self.floor[row], self.scores[row, -1])

    def rows(self):
        real = self.found != NONE
        return np.repeat(self.ids, real.sum(1)), self.found[real], self.scores[real]


def build(vectors: DataFrame, width: int, norm2: float) -> tuple[DataFrame, Pivots]:
    """The settled index of all vectors, and its pivots, from a bounded sample (the smallest hashes of the ids)."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    pivots = Pivots(np.array([r["vec_id"] for r in sample]), _stacked(sample, width), norm2, width)
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def key(batches):
        own = shared.value
        for batch in batches:
            away = own.of_vectors(matrix(batch.column(1), own.width))
            near = away.argmin(1) if len(away) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near.astype(np.int32)), pa.array(away[np.arange(len(near)), near])], ["vec_id", "x", "pivot", "distance"])

    keyed = settled(vectors.mapInArrow(key, INDEX_SCHEMA), "keyed-vectors")
    index = settled(keyed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id"), "vector-index")
    discarded(keyed)
    return index, pivots


def _stacked(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row["x"])] = row["x"]
    return out


def _blocks(batches, width: int):
    """(ids, vectors, pivot, inner and outer distance) of the sorted rows, a pivot and at most BLOCK rows to each."""
    for batch in batches:
        ids, x = batch.column(0).to_numpy(), matrix(batch.column(1), width)
        pivot, distance = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(np.diff(pivot)) + 1, [len(ids)]])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            for at in range(a, b, BLOCK):
                to = min(b, at + BLOCK)
                yield ids[at:to], x[at:to], int(pivot[at]), float(distance[at:to].min()), float(distance[at:to].max())


def annuli(pivots: Pivots, queries: np.ndarray, to_pivots: np.ndarray, floor: np.ndarray):
    """The distances to each pivot that an answer to some query can have, as a condition on the index, and as rows (pivot,
    least, most)."""
    reach = pivots.reach(queries, np.where(np.isfinite(floor), floor, -1e300))[:, None]
    least, most = (to_pivots - reach).min(0), (to_pivots + reach).max(0)
    condition = F.lit(False)
    for p, (a, b) in enumerate(zip(least.tolist(), most.tolist(), strict=True)):
        condition |= (F.col("pivot") == p) & F.col("distance").between(a, b)
    return condition, list(zip(range(len(least)), least.tolist(), most.tolist(), strict=True))


def search(index: DataFrame, pivots: Pivots, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Settled rows of FOUND_SCHEMA: the k best of each task for each query of one batch."""
    to_pivots = pivots.of_queries(queries)
    first = Best(query_ids, k)
    for at in range(0, len(pivots.sample), BLOCK):
        ids = pivots.sample_ids[at : at + BLOCK]
        first.offer(np.arange(len(query_ids)), ids, exact_products(queries, pivots.sample[at : at + BLOCK]))
    shared = index.sparkSession.sparkContext.broadcast((pivots, query_ids, queries, to_pivots, first.floor))

    def run(batches):
        own, ids, vectors, away, floor = shared.value
        best = Best(ids, k)
        best.floor = floor.copy()
        for held in _grouped(_blocks(batches, own.width)):
            least = np.array([np.maximum(np.maximum(away[:, p] - outer, inner - away[:, p]), 0) for _, _, p, inner, outer in held])
            for b in least.min(1).argsort():  # the annuli nearest to some query first
                block_ids, x, *_ = held[b]
                open_ = np.flatnonzero(least[b] <= own.reach(vectors, np.where(np.isfinite(best.floor), best.floor, -1e300)))
                for part in np.array_split(open_, max(1, -(-len(open_) // 1024))):
                    if len(part):
                        best.offer(part, block_ids, exact_products(vectors[part], x))
        a, b, c = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(np.zeros(len(a), np.int32)), pa.nulls(len(a), pa.binary())], ["query_id", "vec_id", "score", "over", "exact"])

    near, _ = annuli(pivots, queries, to_pivots, first.floor)
    found = settled(index.where(near).select("vec_id", "x", "pivot", "distance").mapInArrow(run, FOUND_SCHEMA), "found")
    shared.destroy()
    return found


def long_products(vectors: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int, width: int) -> DataFrame:
    """Settled rows of FOUND_SCHEMA from products of whole numbers of any size, for vectors that the index can't hold."""
    shared = vectors.sparkSession.sparkContext.broadcast((query_ids, [[int(c) for c in q] for q in queries]))

    def run(batches):
        ids, own = shared.value
        best: list[dict[int, int]] = [{} for _ in own]
        for batch in batches:
            block = [[int(c) for c in x] for x in matrix(batch.column(1), width)]
            for q, x, found in zip(ids.tolist(), own, best, strict=True):
                for i, y in zip(batch.column(0).to_pylist(), block, strict=True):
                    if i != q:
                        score = sum(map(int.__mul__, x, y))
                        found[i] = max(found.get(i, score), score)
                if len(found) > k:
                    top = sorted(found.items(), key=lambda item: (-item[1], item[0]))[:k]
                    found.clear()
                    found.update(top)
        rows = [(q, i, max(-(2**63), min(2**63 - 1, s)), (s >= 2**63) - (s < -(2**63)), (s + 2**2200).to_bytes(280, "big")) for q, found in zip(ids.tolist(), best, strict=True) for i, s in found.items()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 5, kinds, strict=True)], ["query_id", "vec_id", "score", "over", "exact"])

    found = settled(vectors.select("vec_id", "x").mapInArrow(run, FOUND_SCHEMA), "found")
    shared.destroy()
    return found


def _batches(queries: DataFrame, size: int):
    """Batches of about size queries at most, as (ids, rows): those of near pivots together, a pivot of many split by hash.
    queries: (vec_id, x, pivot). One batch is in memory at a time."""
    counts = sorted((r["pivot"], r["n"]) for r in queries.groupBy("pivot").agg(F.count("*").alias("n")).collect())
    plan, open_, room = [], [], 0
    for pivot, n in counts:
        if n > size:
            parts = -(-n // size)
            plan += [((F.col("pivot") == pivot) & (F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part)) for part in range(parts)]
        elif n <= room:
            open_[-1].append(pivot)
            room -= n
        else:
            open_.append([pivot])
            room = size - n
    for condition in plan + [F.col("pivot").isin(own) for own in open_]:
        rows = queries.where(condition).collect()
        if rows:
            yield np.array([r["vec_id"] for r in rows]), rows


def _grouped(blocks, size: int = 64):
    """Blocks in groups of a bounded size, within which the order of the walk is chosen."""
    held = []
    for block in blocks:
        held.append(block)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def top_k(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of `vectors` (see quantised) that is_query, a column, marks."""
    spark = vectors.sparkSession
    norm2 = F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c)
    vectors = settled(vectors.withColumn("norm2", norm2), "vectors")
    fits = F.col("norm2") <= NORM2
    shape = vectors.agg(F.max(F.size("x")).alias("width"), F.max(F.when(fits, F.col("norm2"))).alias("norm2"), F.count("*").alias("n"), F.count(F.when(~fits, 1)).alias("long")).first()
    found = []
    if shape["n"]:
        width = shape["width"]
        size = max(1, min(BATCH, BATCH_COMPONENTS // max(width, 1)))
        queries = settled(vectors.where(is_query).groupBy("vec_id").agg(F.max("x").alias("x"), F.lit(0).alias("pivot")), "queries")
        if shape["norm2"] is not None:
            inside = vectors.where(fits)
            index, pivots = build(inside.select("vec_id", "x"), width, shape["norm2"])
            for ids, rows in _batches(_keyed(queries, pivots, norm2), size):
                found.append(search(index, pivots, ids, _stacked(rows, width), k))
        if shape["long"]:
            queries = queries.withColumn("fits", norm2 <= NORM2)
            for ids, rows in _batches(queries, size):
                found.append(long_products(vectors.where(~fits), ids, _stacked(rows, width), k, width))
            for ids, rows in _batches(queries.where("not fits"), size):
                found.append(long_products(vectors.where(fits), ids, _stacked(rows, width), k, width))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    results = found[0]
    for more in found[1:]:
        results = results.unionByName(more)
    best = [F.desc(c) for c in ("over", "order", "exact")]
    order = Window.partitionBy("query_id").orderBy(*best, "vec_id")
    # an id's rows may come from several tasks; one exchange serves the aggregate and the window. Beyond the longs the whole
    # score decides, within them the long
    results = results.select("query_id", "vec_id", F.struct("over", F.when(F.col("over") == 0, F.col("score")).alias("order"), F.when(F.col("over") != 0, F.col("exact")).alias("exact"), "score").alias("s"))
    distinct = results.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("s").alias("s")).select("query_id", "vec_id", "s.*")
    ranked = distinct.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _keyed(queries: DataFrame, pivots: Pivots, norm2) -> DataFrame:
    """Settled queries of the index with their nearest pivots."""
    shared = queries.sparkSession.sparkContext.broadcast(pivots)

    def key(batches):
        for batch in batches:
            away = shared.value.of_queries(matrix(batch.column(1), shared.value.width))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(away.argmin(1).astype(np.int32) if len(away) else np.empty(0, np.int32))], ["vec_id", "x", "pivot"])

    return settled(queries.where(norm2 <= NORM2).select("vec_id", "x").mapInArrow(key, "vec_id long, x array<double>, pivot int"), "keyed-queries")


def op4(embeddings: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    return top_k(quantised(embeddings), F.col("vec_id") % every == 0, k)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), e AS (SELECT vec_id, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM v),
s AS (
  SELECT q.vec_id AS query_id, o.vec_id AS vec_id, CAST(sum(q.c * o.c) AS BIGINT) AS score
  FROM e q JOIN e o ON q.i = o.i AND q.vec_id <> o.vec_id
  WHERE q.vec_id % 20 = 0 GROUP BY 1, 2
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
