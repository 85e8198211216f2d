"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence matrix.

Rows of the matrix are the distinct sets of word 5-shingles; columns are ordered from rare to common, one order for all
rows. The product runs block by block:

* the leading block of each row holds the columns that any partner must share with it (a size-derived bound: the first
  |x| - ceil(t |x|) + 1 columns, or fewer on the side that is not larger); it is multiplied by a join on the column, which
  accumulates overlap counts of candidate pairs; columns that hold the same rows are one, of that weight,
* pairs are discarded where the sizes, or the overlap so far and what is left of both rows, cannot reach the threshold,
* the rest is multiplied for the pairs that are left, in tiles of rows by rows: columns go block by block, overlaps add up
  over the blocks, and a pair goes as soon as what is left of both rows is too little. What remains has exact overlaps.

Groups of copies take no quadratic work: equal sets are one row (a node) from the start. Crowded columns come in rounds: each
pairs its rows with one of them only, the one in most columns, and linked rows become one component. The last round pairs
what is left in columns that still hold several components, and only rows of different components that share enough
leading columns with other rows at all.

A row whose id is null, and a text without words, links with nothing. A null text counts as one without words. Shingles
are compared by 64-bit digests. Rows that share an id are one document: all its texts' links count. Only the id and the
text are read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import narrowed
from kindred.session import discarded, settled

SHINGLE = 5
#: Two documents link when OVER * overlap >= UNDER * union.
UNDER, OVER = 80, 100
#: Sets of a bounded sample from which common columns are told: its size and the sets a column has to be in. The order of
#: columns decides speed only; links are the same with any order.
SAMPLE_SETS, COMMON_SETS, COMMON_COLUMNS = 20_000, 8, 200_000
#: Bits of the filter that picks documents by their ids' hashes, and bytes of one of Spark's bitmaps.
SIEVE_BITS, BITMAP_BYTES = 1 << 24, 4096
#: Rows from which on a column is crowded, and rounds that pair crowded columns' rows with one of them only; meetings with
#: other rows in crowded columns from which on it is worth while to look at all the columns of a row.
CROWD, STARS, MEETINGS = 16, 1, 1024
#: Where a leading block ends that holds common columns: behind all others.
MIXED = 2**63 - 1
#: Parts of the columns in which entries are dealt out.
HALVES = 2
#: Parts in which tiles are multiplied, rows on each side of a tile, and blocks of columns.
PARTS, TILE, BLOCKS = 4, 256, 4
#: Pairs that are worth a part.
FEW = 20_000
#: Rows with texts or packed sets that Python gets at a time.
WIDE_BATCH = 1000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Words of more bytes are digested on their own.
_WIDE = 64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_digests(text: str) -> np.ndarray:
    """64-bit digests of the text's words, A-Z in lower case: the polynomial of a word's bytes, all words in step."""
    raw = _FOLD[np.frombuffer(text.encode(), np.uint8)]
    word = np.zeros(len(raw) + 2, bool)
    np.logical_not(_SPACE[raw], out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    out = np.zeros(len(starts), np.uint64)
    order = np.argsort(-lengths)
    first, sizes = starts[order], lengths[order]
    for k in range(min(_WIDE, int(sizes[0]) if len(sizes) else 0)):
        m = len(sizes) - int(np.searchsorted(sizes[::-1], k, side="right"))
        out[:m] = out[:m] * _BASE + (raw[first[:m] + k] + np.uint64(1))
    for i in range(int((sizes > _WIDE).sum())):
        out[i] = xxhash.xxh3_64_intdigest(raw[first[i] : first[i] + sizes[i]].tobytes())
    back = np.empty_like(out)
    back[order] = _mixed(out)
    return back


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted digests of the distinct shingles; one of the whole sequence for texts of fewer words."""
    words = word_digests(text or "")
    if not len(words):
        return words
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    out = words[:n]
    for k in range(1, width):
        out = _mixed(out) * _BASE + words[k : n + k]
    return np.unique(_mixed(out + np.uint64(width)))


def probe_length(n: int) -> int:
    """Leading columns of which any partner shares one."""
    return n - -(-UNDER * n // OVER) + 1


def index_length(n: int) -> int:
    """Leading columns of which a partner that is not smaller shares one."""
    return n - -(-2 * UNDER * n // (OVER + UNDER)) + 1


def common_columns(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(columns, sets of the sample that hold them) of the most common columns, sorted by column: a bounded table."""
    total = max(docs.count(), 1)
    share = max(1, round(1_000_000 * min(1.0, SAMPLE_SETS / total)))

    def columns(batches):
        for batch in batches:
            found = [shingle_set(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64))], ["column"])

    sample = docs.where(F.pmod(F.xxhash64("doc"), F.lit(1_000_000)) < share).select("text")
    counted = sample.mapInArrow(columns, "column long").groupBy("column").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON_SETS)
    rows = counted.orderBy(F.desc("n"), "column").limit(COMMON_COLUMNS).collect()
    found = np.array([(r["column"], r["n"]) for r in rows], np.int64).reshape(-1, 2)
    columns_, counts = found[:, 0].view(np.uint64) if len(found) else np.empty(0, np.uint64), found[:, 1]
    columns_ = np.ascontiguousarray(columns_)
    order = np.argsort(columns_)
    return columns_[order], counts[order]


def leading_block(own: np.ndarray, common: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """(the row's leading columns in the order of all rows, how many of them are not common)."""
    p = probe_length(len(own))
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        hit = common[at] == own
        if hit.any():
            rare = own[~hit]
            if len(rare) < p:
                order = np.lexsort((own[hit], counts[at[hit]]))
                return np.concatenate([rare, own[hit][order]])[:p], len(rare)
            return rare[:p], p
    return own[:p], p


ROW_SCHEMA = "doc long, n int, digest binary, lead binary, n_rare int, cut long"
ENTRY_SCHEMA = "column long, node long, n int, at int"
ENTRY = ("column", "node", "n", "at", "inside")


def incidence(docs: DataFrame, common: np.ndarray, counts: np.ndarray) -> DataFrame:
    """A row for each document: the size and digest of its set, its leading block, packed, and where that ends in the order
    of the columns (MIXED where it holds common columns)."""
    shared = docs.sparkSession.sparkContext.broadcast((common, counts))

    def run(batches):
        columns, n_sets = shared.value
        for batch in batches:
            sizes, digests, leads, rare, cuts = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                own = shingle_set(text)
                lead, n_rare = leading_block(own, columns, n_sets) if len(own) else (own, 0)
                sizes.append(len(own))
                digests.append(xxhash.xxh3_128_digest(own.tobytes()))
                leads.append(lead.tobytes())
                rare.append(n_rare)
                cuts.append(int(lead[-1]) - 2**63 if len(lead) and n_rare == len(lead) else MIXED)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(leads, pa.binary()), pa.array(rare, pa.int32()), pa.array(cuts, pa.int64())], ["doc", "n", "digest", "lead", "n_rare", "cut"])

    return docs.select("doc", "text").mapInArrow(run, ROW_SCHEMA)


def classes_of(rows: DataFrame) -> tuple[DataFrame, int]:
    """(node, doc: its smallest id, cut) of each distinct set, and the salt that makes nodes of digests: the first one under
    which no two digests share a node."""
    salt = 0
    while True:
        found = rows.select(F.xxhash64("digest", F.lit(salt)).alias("node"), "digest", "doc", "cut").groupBy("node").agg(F.min("doc").alias("doc"), F.min("cut").alias("cut"), F.min("digest").alias("low"), F.max("digest").alias("high"))
        found = settled(found.select("node", "doc", "cut", (F.col("low") != F.col("high")).alias("shared")), "classes")
        if found.where("shared").isEmpty():
            return found.select("node", "doc", "cut"), salt
        discarded(found)
        salt += 1


def entries(rows: DataFrame, rare: bool, part: int = 0, parts: int = 1) -> DataFrame:
    """The leading blocks' entries (node, n, lead, n_rare), those of rare or of common columns, or a part of the columns. A
    task gives equal sets once."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            nodes, sizes, leads, n_rare = (batch.column(i).to_pylist() for i in range(4))
            blocks, own, lengths, at = [], [], [], []
            for node, n, lead, k in zip(nodes, sizes, leads, n_rare, strict=True):
                if node in seen:
                    continue
                seen.add(node)
                columns = np.frombuffer(lead, np.int64)
                columns, base = (columns[:k], 0) if rare else (columns[k:], k)
                place = np.flatnonzero(columns % parts == part).astype(np.int32)
                blocks.append(columns[place])
                own.append((node, n))
                lengths.append(len(place))
                at.append(place + np.int32(base))
            if blocks:
                ids = np.array(own, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(blocks)), pa.array(np.repeat(ids[:, 0], lengths)), pa.array(np.repeat(ids[:, 1], lengths).astype(np.int32)), pa.array(np.concatenate(at))], ["column", "node", "n", "at"])

    return rows.select("node", "n", "lead", "n_rare").mapInArrow(run, ENTRY_SCHEMA)


def partners(column: np.ndarray, n: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a column's row has another one there whose size allows a link, and whether the index rule allows the pair
    too. Columns are whole."""
    if not len(column):
        return np.zeros(0, bool), np.zeros(0, bool)
    group = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]])).astype(np.int64) << 32
    index = at < n - -(-2 * UNDER * n // (OVER + UNDER)) + 1
    sizes, indexed = np.sort(group + n), np.sort((group + n)[index])
    low, high = group + -(-UNDER * n // OVER), group + OVER * n // UNDER
    smaller = np.searchsorted(indexed, group + n, side="right") - np.searchsorted(indexed, low, side="left") - index
    larger = np.searchsorted(sizes, high, side="right") - np.searchsorted(sizes, group + n, side="left") - 1
    near = np.searchsorted(sizes, high, side="right") - np.searchsorted(sizes, low, side="left") - 1
    return near > 0, (smaller > 0) | (index & (larger > 0))


def shared_only(sorted_entries: DataFrame) -> DataFrame:
    """Distinct entries that have a row of like size in their column, and whether they can make a pair there, from
    partitions that hold columns whole and in the order of (column, node)."""

    def run(batches):
        held = None
        for batch in batches:
            block = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)])
            if held is not None:
                block = np.concatenate([held, block], axis=1)
            if not block.shape[1]:
                continue
            # copies of a set come from several tasks
            again = np.zeros(block.shape[1], bool)
            again[1:] = (block[0, 1:] == block[0, :-1]) & (block[1, 1:] == block[1, :-1])
            block = block[:, ~again]
            # the last column may go on in the next batch
            stop = int(np.searchsorted(block[0], block[0, -1], side="left"))
            held = block[:, stop:]
            yield of(block[:, :stop])
        if held is not None:
            yield of(held)

    def of(block):
        column = block[0]
        same = np.zeros(len(column) + 1, bool)
        same[1:-1] = column[1:] == column[:-1]
        block = block[:, same[1:] | same[:-1]]
        near, able = partners(*block[[0, 2, 3]])
        block = block[:, near]
        return pa.RecordBatch.from_arrays([pa.array(block[0]), pa.array(block[1]), pa.array(block[2].astype(np.int32)), pa.array(block[3].astype(np.int32)), pa.array(able[near])], ["column", "node", "n", "at", "able"])

    return sorted_entries.mapInArrow(run, ENTRY_SCHEMA + ", able boolean")


def merged(entries: DataFrame) -> DataFrame:
    """Settled entries with equal columns as one: those that hold the same rows. at is the place of the first of them in a
    row, inside how many of them the row's index block holds. Columns whose rows' hashes agree by chance make a column of
    all their rows, which adds pairs but takes none away."""
    rows = F.count("*").alias("rows")
    alike = entries.groupBy("column").agg(F.bit_xor(F.xxhash64("node")).alias("key"), rows).where("rows > 1").select("column", F.xxhash64("key", "rows").alias("alike"))
    within = F.when(F.col("at") < _index("n"), 1).otherwise(0)
    found = entries.join(alike, "column").groupBy(F.col("alike").alias("column"), "node").agg(F.first("n").alias("n"), F.min("at").alias("at"), F.sum(within).cast("int").alias("inside"))
    return settled(found, "merged")


def _index(n: str):
    """index_length of a column of sizes."""
    return F.col(n) - F.ceil(F.lit(2 * UNDER) * F.col(n) / (OVER + UNDER)) + 1


def _likely(pairs: DataFrame) -> DataFrame:
    """(x, y, home: the head, rows it meets) of the pairs (x, y, and of each n, at and inside of a column) that sizes and index rule allow, x the one that
    is not larger. Overlaps add up by pair: what the index block of x holds of y. Of the pairs of one y that may reach the
    threshold only that of the largest overlap so far stays, for rounds that needn't be complete."""
    swap = (F.col("nx") > F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") > F.col("y")))

    def pick(a: str, b: str):
        return F.when(swap, F.col(b)).otherwise(F.col(a))

    turned = pairs.select(F.col("y").alias("own"), F.col("x").alias("head"), pick("x", "y").alias("x"), pick("y", "x").alias("y"), pick("nx", "ny").cast("long").alias("nx"), pick("ny", "nx").cast("long").alias("ny"), pick("ay", "ax").alias("ay"), pick("ix", "iy").alias("ix"))
    turned = turned.where((OVER * F.col("nx") >= UNDER * F.col("ny")) & (F.col("ix") > 0))
    counted = turned.groupBy("x", "y", "nx", "ny").agg(F.min("own").alias("own"), F.min("head").alias("head"), F.sum("ix").alias("overlap"), F.min("ay").alias("ay"))
    able = counted.where((OVER + UNDER) * F.least(F.col("overlap") + F.col("nx") - _index("nx"), F.col("ny") - F.col("ay")) >= UNDER * (F.col("nx") + F.col("ny")))
    best = able.groupBy("own").agg(F.max(F.struct("overlap", "x", "y", "head")).alias("_p")).select("_p.x", "_p.y", F.col("_p.head").alias("home")).dropDuplicates(["x", "y"])
    return best.join(best.groupBy("home").agg(F.count("*").alias("rows")), "home")


def sieve(wanted: DataFrame, key: str) -> np.ndarray:
    """A bit for each hash of a wanted key: a filter of a fixed size, however many there are."""
    spot = F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS))
    bits = wanted.select(F.bitmap_bucket_number(spot).alias("bucket"), F.bitmap_bit_position(spot).alias("bit"))
    rows = bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = np.zeros((SIEVE_BITS // (8 * BITMAP_BYTES) + 2, BITMAP_BYTES), np.uint8)
    for row in rows:
        out[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    return out


def _sifted(rows: DataFrame, wanted: DataFrame, key: str, schema: str, made) -> DataFrame:
    """made(a batch) of the rows (key, ...) whose key is wanted. A filter of fixed size picks them where they are read, so
    that nothing else travels; a few others may come along."""
    shared = rows.sparkSession.sparkContext.broadcast(sieve(wanted, key))
    spot = F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS))
    names = rows.columns

    def run(batches):
        bits = shared.value
        for batch in batches:
            bucket, bit = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield made(batch.filter(pa.array(bits[bucket, bit >> 3] >> (bit & 7) & 1 == 1)).select(names))

    return rows.select(F.bitmap_bucket_number(spot).alias("_bucket"), F.bitmap_bit_position(spot).alias("_bit"), *names).mapInArrow(run, schema)


def packed_sets(docs: DataFrame, wanted: DataFrame, salt: int) -> DataFrame:
    """Settled (node, set) of the wanted (doc), with their texts' sets packed; a task gives equal sets once."""

    def made(batch):
        sets, digests = [], []
        for text in batch.column("text").to_pylist():
            own = shingle_set(text).tobytes()
            digest = xxhash.xxh3_128_digest(own)
            if digest not in seen:
                seen.add(digest)
                sets.append(own)
                digests.append(digest)
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(sets, pa.binary())], ["digest", "set"])

    seen: set[bytes] = set()
    found = _sifted(docs.select("doc", "text"), wanted, "doc", "digest binary, set binary", made)
    return settled(found.select(F.xxhash64("digest", F.lit(salt)).alias("node"), "set"), "sets", WIDE_BATCH)


def reaching(own: np.ndarray, flat: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which of the rows flat[starts:stops] overlap enough with own: a row of the product, made block by block of columns.
    Overlaps add up, and a row goes when it can't reach the threshold with all of what is left of both."""
    size = stops - starts
    alive = np.flatnonzero((OVER * np.minimum(size, len(own)) >= UNDER * np.maximum(size, len(own))) & (size > 0))
    count = np.zeros(len(starts), np.int64)
    at, done = starts.copy(), 0
    cuts = [len(own) * (b + 1) // BLOCKS for b in range(BLOCKS)]
    for b, cut in enumerate(cuts):
        if not len(alive):
            break
        block, done = own[done:cut], cut
        if not len(block):
            continue
        # a row's part of the block: up to the next block's first column
        to = stops.copy()
        if b + 1 < BLOCKS:
            to[alive] = [at[i] + np.searchsorted(flat[at[i] : stops[i]], own[cut]) for i in alive]
        lengths = (to - at)[alive]
        part = np.concatenate([flat[at[i] : to[i]] for i in alive])
        hit = np.zeros(len(part) + 1, np.int64)
        np.cumsum(block[np.minimum(np.searchsorted(block, part), len(block) - 1)] == part, out=hit[1:])
        ends = np.cumsum(lengths)
        count[alive] += hit[ends] - hit[ends - lengths]
        at = to
        most = count + np.minimum(len(own) - cut, stops - at)
        alive = alive[((OVER + UNDER) * most >= UNDER * (len(own) + size))[alive]]
    out = np.zeros(len(starts), bool)
    out[alive] = True
    return out


def linked(pairs: DataFrame, sets: DataFrame, half: bool = False) -> DataFrame:
    """Settled pairs (a, b) whose exact overlap reaches the threshold. pairs: (x, y, home, rows). half: rows are packed with
    the upper halves of their digests, which can only agree more often, so all such pairs come and a few others.

    The product is made in tiles: pairs of one home, a column or row that they share, and there of a block of rows by a block
    of rows, of about TILE each. A tile gets the packed rows once, then its pairs. Parts of the tiles go one after the other,
    so that only a part of the packed rows is on the way at a time."""

    def run(batches):
        tile, held = None, {}
        for batch in batches:
            a, b = [], []
            for rows in _tiles(batch):
                tiles, kinds, xs, ys = (rows.column(i).to_numpy() for i in range(4))
                if tiles[0] != tile:
                    tile, held = tiles[0], {}
                first = int(np.searchsorted(kinds, 1))
                for i in range(first):  # rows come before pairs, perhaps in copies from several tasks
                    held[int(xs[i])] = np.frombuffer(rows.column(4)[i].as_py(), kind)
                xs, ys = xs[first:], ys[first:]
                edges = np.concatenate([[0], np.flatnonzero(np.diff(xs)) + 1, [len(xs)]]) if len(xs) else [0]
                for start, stop in zip(edges[:-1], edges[1:], strict=True):
                    own, others = held[int(xs[start])], [held[int(y)] for y in ys[start:stop]]
                    stops = np.cumsum([len(o) for o in others])
                    near = reaching(own, np.concatenate(others), stops - [len(o) for o in others], stops)
                    a.append(xs[start:stop][near])
                    b.append(ys[start:stop][near])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*a, np.empty(0, np.int64)])), pa.array(np.concatenate([*b, np.empty(0, np.int64)]))], ["a", "b"])

    def halved(batch):
        upper = [(np.frombuffer(x.as_buffer(), np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes() for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(upper, pa.binary())], ["node", "set"])

    kind, made = (np.uint32, halved) if half else (np.uint64, lambda batch: batch)
    sides = F.ceil(F.col("rows") / TILE)
    tile = F.xxhash64("home", F.pmod(F.xxhash64("x"), sides), F.pmod(F.xxhash64("y"), sides))
    tiles = settled(pairs.select(tile.alias("tile"), "x", "y"), "tiles")
    found, parts = None, max(1, min(PARTS, tiles.count() // FEW))
    for part in range(parts):
        own = tiles.where(F.pmod(F.xxhash64("tile"), F.lit(parts)) == part)
        asked = own.select("tile", F.explode(F.array("x", "y")).alias("node")).distinct()
        near = _sifted(sets, asked.select("node"), "node", "node long, set binary", made)
        packed = asked.join(near, "node").select("tile", F.lit(0).alias("kind"), F.col("node").alias("x"), F.lit(0).cast("long").alias("y"), "set")
        both = packed.unionByName(own.select("tile", F.lit(1).alias("kind"), "x", "y", F.lit(None).cast("binary").alias("set")))
        placed = both.repartition("tile").sortWithinPartitions("tile", "kind", "x", "y")
        links = settled(placed.mapInArrow(run, "a long, b long"), "links", WIDE_BATCH)
        found = links if found is None else found.unionByName(links)
    found = settled(found, "edges")
    discarded(tiles)
    return found


def _tiles(batch: pa.RecordBatch):
    """A sorted batch's rows of one tile at a time."""
    if batch.num_rows:
        edges = np.concatenate([[0], np.flatnonzero(np.diff(batch.column(0).to_numpy())) + 1, [batch.num_rows]])
        for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield batch.slice(start, stop - start)


def components(edges: DataFrame) -> DataFrame:
    """Settled (node, component: its smallest reachable node) of the nodes of edges (a, b): labels spread to neighbours and
    are followed to their own label, until nothing changes. Every round is settled and takes the place of the one before;
    nothing goes to the driver but a count."""
    both = settled(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = settled(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next")), "hooked")
        jumps = hooked.select(F.col("node").alias("next"), F.col("next").alias("jump"))
        spread = settled(hooked.join(jumps, "next", "left").select("node", F.coalesce("jump", "next").alias("label"), (F.coalesce("jump", "next") != F.col("label")).alias("moved")), "labels")
        discarded(labels, hooked)
        labels = spread
        if spread.where("moved").isEmpty():
            discarded(both)
            return _as(spread, spread.select("node", F.col("label").alias("component")))


def _as(table: DataFrame, view: DataFrame) -> DataFrame:
    """A view of a settled table, to be discarded with it."""
    view._kindred_path = table._kindred_path
    return view


def _relabelled(parts: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Settled components (node, component) after further edges (a, b) between nodes; parts goes."""
    if parts is None:
        return components(edges)
    named = edges
    for side in ("a", "b"):
        named = named.join(parts.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left")
    merged = components(named.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b"))
    moved = parts.join(merged.select(F.col("node").alias("component"), F.col("component").alias("target")), "component", "left")
    fresh = merged.join(parts.select("node"), "node", "left_anti")
    out = settled(moved.select("node", F.coalesce("target", "component").alias("component")).unionByName(fresh), "parts")
    discarded(parts, merged)
    return out


def _placed(buckets: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Buckets with each row's component so far."""
    if parts is None:
        return buckets.withColumn("part", F.col("node"))
    return buckets.join(parts, "node", "left").select(*buckets.columns, F.coalesce("component", "node").alias("part"))


def _contested(placed: DataFrame) -> DataFrame:
    """Settled rows of the columns that hold several components, with the column's number of rows and largest component."""
    sizes = placed.groupBy("column", "part").agg(F.count("*").alias("rows"))
    columns = sizes.groupBy("column").agg(F.sum("rows").alias("rows"), F.count("*").alias("parts"), F.max_by("part", F.struct("rows", "part")).alias("main"))
    return settled(placed.join(columns.where("parts > 1").select("column", "rows", "main"), "column"), "contested")


def _with_head(held: DataFrame, turn: int) -> DataFrame:
    """Each row of a column with the column's head, where that is in another component. The head is the row that is in most
    columns, as the middle of a group of near copies is; in every other round one outside the largest component."""
    degree = held.groupBy("node").agg(F.sum("inside").alias("degree"))
    rows = held.join(degree, "node")
    able = rows.where("part <> main") if turn % 2 else rows
    heads = able.groupBy("column").agg(F.max(F.struct("degree", F.xxhash64("node", F.lit(turn)).alias("order"), "node", "n", "at", "inside", "part")).alias("head"))
    both = held.join(heads, "column").where("part <> head.part")
    return both.select(F.col("head.node").alias("x"), F.col("node").alias("y"), F.col("head.n").alias("nx"), F.col("n").alias("ny"), F.col("head.at").alias("ax"), F.col("at").alias("ay"), F.col("head.inside").alias("ix"), F.col("inside").alias("iy"))


def _caps(held: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Settled (node, cap) of the rows that meet many others in held: how many of a row's columns, leading or not, any row
    it meets there in another component has at all. So near misses in groups of long or many near copies aren't paired."""

    def spread(batches):
        for batch in batches:
            packed = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(2)]
            lengths = [len(x) for x in packed]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*packed, np.empty(0, np.int64)])), pa.array(np.repeat(batch.column(0).to_numpy(), lengths)), pa.array(np.repeat(batch.column(1).to_numpy(), lengths))], ["column", "node", "part"])

    heavy = settled(held.where("inside > 0").groupBy("node").agg(F.sum("rows").alias("met")).where(F.col("met") >= MEETINGS).select("node"), "heavy")
    if heavy.isEmpty():
        return None
    crowds = held.join(held.join(heavy, "node").select("column").distinct(), "column", "left_semi")
    nodes = settled(crowds.select("node", "part").distinct(), "crowd")
    near = _sifted(sets, nodes, "node", "node long, set binary", lambda batch: batch)
    packed = nodes.join(near.dropDuplicates(["node"]), "node").select("node", "part", "set")
    cells = settled(packed.mapInArrow(spread, "column long, node long, part long"), "crowd-cells", WIDE_BATCH)
    columns = cells.groupBy("column").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("column")
    shared = cells.join(heavy, "node").join(columns, "column").groupBy("node").agg(F.count("*").cast("int").alias("cap"))
    caps = settled(heavy.join(shared, "node", "left").select("node", F.coalesce("cap", F.lit(0)).alias("cap")), "caps")
    discarded(heavy, nodes, cells)
    return caps


def _all_across(held: DataFrame, bounds: DataFrame) -> DataFrame:
    """(x, y, home: the first column that both are in, its rows) of all pairs of a column's rows in different components
    that sizes and bounds allow, once each. Rows of the largest component only
    meet the others. Rows meet by column and band of sizes, as no pair is further than one band apart; so a column of many
    rows is many groups.

    Of a pair's rows take the one whose leading block ends first. Whatever it shares up to there with the other one are
    leading columns that rows of like size hold, so its overlap is at most their number and the rest of its columns (most in
    bounds). Thus rows with little but one passage in common don't pair, nor do near misses in large groups."""
    both = OVER + UNDER
    rows = held.join(bounds, "node").withColumn("band", F.floor(F.log(F.col("n").cast("double")) / math.log(OVER / UNDER * (1 + 1e-9))))

    def side(name: str, table: DataFrame, band) -> DataFrame:
        return table.select("column", *(["rows"] if name == "x" else []), band, F.col("node").alias(name), *(F.col(c).alias(c[0] + name) for c in ("n", "at", "inside", "part", "most")), F.col("cut").alias("cut" + name), F.col("cap").alias("cap" + name), (F.col("part") == F.col("main")).alias("main" + name))

    own, other = side("x", rows.where("inside > 0"), F.col("band")), side("y", rows, F.explode(F.array("band", F.col("band") - 1)).alias("band"))
    most = "least(capx, capy, case when cutx < cuty then mx when cuty < cutx then my else greatest(mx, my) end)"
    # a pair meets in its first common column, if at all, with all of its overlap still to come
    allowed = f"px <> py and (nx < ny or (nx = ny and x < y)) and {OVER} * nx >= {UNDER} * ny and {both} * least(nx - ax, ny - ay, {most}) >= {UNDER} * (nx + ny)"
    free = own.where("not mainx").join(other, ["column", "band"]).where(allowed)
    tied = own.where("mainx").join(other.where("not mainy"), ["column", "band"]).where(allowed)
    return free.unionByName(tied).groupBy("x", "y").agg(F.min(F.struct("column", "rows")).alias("first")).select("x", "y", F.col("first.column").alias("home"), "first.rows")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    source = narrowed(df, doc=(id_col, "long"), text=(text_col, "string"))
    docs = source.where(F.col("doc").isNotNull())
    rows = settled(incidence(source, *common_columns(docs)), "incidence", WIDE_BATCH)
    filled = rows.where("doc is not null and n > 0")
    classes, salt = classes_of(filled)
    keyed = rows.withColumn("node", F.when((F.col("n") > 0) & F.col("doc").isNotNull(), F.xxhash64("digest", F.lit(salt))))
    members = settled(keyed.select("doc", "n", "node"), "members")

    whole = keyed.where("node is not null")
    # a part of the columns at a time, so that a part of the entries is on the way
    blocks = [settled(shared_only(entries(whole, True, part, HALVES).repartition("column").sortWithinPartitions("column", "node")), "buckets") for part in range(HALVES)]
    blocks.append(settled(entries(whole, False).distinct().withColumn("able", F.lit(True)), "buckets"))
    buckets = reduce(DataFrame.unionByName, blocks)
    discarded(rows)
    shared = buckets.groupBy("node").agg(F.count("*").alias("shared"), F.first("n").alias("n"))
    most = F.col("shared") + F.ceil(F.lit(UNDER) * F.col("n") / OVER) - 1
    bounds = settled(shared.join(classes, "node").select("node", most.alias("most"), "cut"), "bounds")
    # rows that share an id are one document: their sets are linked
    own = members.where("node is not null")
    several = settled(own.groupBy("doc").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("doc", "a"), "several")
    parts = None
    if not several.isEmpty():
        parts = _relabelled(None, own.join(several, "doc").where("node <> a").select("a", F.col("node").alias("b")).distinct())
    discarded(several)

    def sets_of(nodes: DataFrame) -> DataFrame:
        return packed_sets(docs, nodes.distinct().join(classes, "node").select("doc"), salt)

    whole = merged(buckets.where("able"))
    discarded(*blocks)
    held = _contested(_placed(whole, parts))
    discarded(whole)
    hot, cold = (settled(held.where(kind).select(*ENTRY), "held") for kind in (F.col("rows") > CROWD, F.col("rows") <= CROWD))
    discarded(held)
    sets = None
    for turn in range(STARS):
        crowded = _contested(_placed(hot, parts))
        if sets is None and not crowded.isEmpty():
            sets = sets_of(crowded.select("node"))
        pairs = settled(_likely(_with_head(crowded, turn)), "pairs")
        edges = None if pairs.isEmpty() else linked(pairs, sets)
        discarded(crowded, pairs)
        if edges is None or edges.isEmpty():
            break
        parts = _relabelled(parts, edges)
        discarded(edges)
    # columns of one component have no pairs to give any more
    left = _contested(_placed(hot, parts))
    caps = None if left.isEmpty() else _caps(left, sets)
    rest = left.select(*ENTRY, F.col("n").alias("cap"))
    if caps is not None:
        rest = left.join(caps, "node", "left").select(*ENTRY, F.coalesce("cap", "n").alias("cap")).where(OVER * F.col("cap") >= UNDER * F.col("n"))
    rest = rest.unionByName(cold.select(*ENTRY, F.col("n").alias("cap")))
    last = _contested(_placed(rest, parts))
    discarded(hot, cold, sets, left, caps)
    pairs = settled(_all_across(last, bounds), "pairs")
    discarded(last, bounds)
    if not pairs.isEmpty():
        sets = sets_of(pairs.select(F.explode(F.array("x", "y")).alias("node")))
        # most pairs are near misses: packed rows of half the size rule them out
        near = linked(pairs, sets, half=True)
        left = settled(pairs.join(near.select(F.col("a").alias("x"), F.col("b").alias("y")), ["x", "y"]), "pairs")
        edges = linked(left, sets)
        if not edges.isEmpty():
            parts = _relabelled(parts, edges)
        discarded(near, left, edges, sets)
    discarded(pairs)

    # a component's id is its smallest document, and a document's the smallest of its rows
    if parts is None:
        named = classes.select("node", F.col("doc").alias("component"))
    else:
        joined = classes.join(parts, "node", "left").select("node", "doc", F.coalesce("component", "node").alias("part"))
        least = joined.groupBy("part").agg(F.min("doc").alias("component"))
        named = joined.join(least, "part").select("node", "component")
    named = members.where("node is not null").join(named, "node").groupBy("doc").agg(F.min("component").alias("component"))
    named = settled(named, "named")
    discarded(parts)
    sized = members.select("doc", F.col("n").cast("long").alias("n_shingles"))
    return sized.join(named, "doc", "left").select(F.col("doc").alias(id_col), "n_shingles", F.coalesce("component", "doc").alias("component_id"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one row of each component: the smallest id's. Of several rows of that id the one of the smallest hash stays,
    equal rows being one. Rows without an id stay."""
    found = jaccard_components(df, id_col, text_col).where(F.col(id_col) == F.col("component_id"))
    kept = settled(found.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("rows")), "kept")
    whole = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))
    chosen = whole.join(kept, "id")
    several = chosen.where("rows > 1").groupBy("id").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    out = chosen.where("rows = 1").select("row").unionByName(several.select("row")).unionByName(whole.where("id is null").select("row"))
    return out.select("row.*")
