"""Approximate nearest neighbours by inner product with a hash-prefix forest.

Each tree hashes vectors to strings of 64 signs of random projections and keeps them sorted. A
query descends to its longest common prefix in every tree and then ascends in all trees together, each giving
the same number of rows with the next shorter prefixes, which are scored exactly. Vectors get one
more component that makes all lengths equal, so that the largest inner product is the
smallest angle.

How far to ascend is measured: for ``probes`` queries the true neighbours are found by brute force,
and a bounded sample of rows tells how many rows stand before each of them in the best tree. All rows
are indexed. Equal vectors are indexed once, with the smallest ids that can come into a result.
The trees are cut into ranges by order statistics of the sample; rows of one hash string that fills
several ranges are dealt over them by a salt. A query visits as many ranges on either side as hold the rows it ascends to.
A shard holds the same range of every tree, some ``SHARD * RANGE`` rows: a row is sent once to each shard it has a tree in, and what
several trees give a query there is scored once.

The forest is taken for tables of every size. A caller may ask for ``blocks`` instead: all queries are scored against all rows.

Vectors that are NULL, zero, hold NULL or non-finite components, or lack the most common dimension take no part.
Repeated rows of one id with the same vector count once; ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import batch_of, drawn, mix64
from millrace.workspace import stored

BITS = 64
RANGE = 50_000
#: Ranges' worth of rows in a shard.
SHARD = 4
#: Queries scored in one task at most, row blocks at least, and queries multiplied at once.
QUERIES = 20_000
BLOCKS = 24
STRIP = 32
#: Vectors hashed at once.
STEP = 2_000


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, v) that take part."""
    v = F.col("embedding").cast("array<double>")
    limit = F.lit(float("inf"))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
        & F.exists("v", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


class Forest:
    """Projections of all trees, and the ranges they are cut into."""

    def __init__(self, dim: int, trees: int, longest: float, seed: int = 7):
        self.trees, self.longest = trees, longest
        self.planes = np.random.default_rng(seed).standard_normal((dim + 1, trees * BITS))
        self.cuts: list[np.ndarray] = [np.empty(0, np.uint64)] * trees
        self.room = RANGE

    def hashes(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Hash strings as numbers, a column for each tree."""
        if len(v) > STEP:
            return np.concatenate([self.hashes(v[i : i + STEP], query) for i in range(0, len(v), STEP)])
        rest = np.zeros(len(v)) if query else np.sqrt(np.maximum(self.longest**2 - (v * v).sum(axis=1), 0))
        signs = np.column_stack([v, rest]) @ self.planes > 0
        packed = np.packbits(signs.reshape(len(v), self.trees, BITS), axis=2)
        return np.ascontiguousarray(packed).view(">u8")[:, :, 0].astype(np.uint64)

    def cut(self, sample: np.ndarray, total: int, room: int | None = None) -> int:
        """Cut all trees by the hashes of a sample of ``total`` rows into ranges of ``room``; the number of ranges."""
        self.room = room or RANGE
        ranges = max(1, -(-total // self.room))
        ordered = np.sort(sample, axis=0)
        self.ordered, self.share = ordered, len(ordered) / total
        at = np.arange(1, ranges) * len(ordered) // ranges
        self.cuts = [ordered[at, t] for t in range(self.trees)]
        return ranges

    def limits(self, tree: int, hashes: np.ndarray, rows_each: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest hash of the ``rows_each`` rows a query ascends to, wide by an entry of the sample on either side."""
        ordered = np.ascontiguousarray(self.ordered[:, tree])
        first, last = ascended(ordered, hashes, math.ceil(rows_each * self.share))
        low = np.where(first > 0, ordered[np.maximum(first - 1, 0)], np.uint64(0))
        return low, np.where(last < len(ordered), ordered[np.minimum(last, len(ordered) - 1)], np.uint64(2**64 - 1))

    def span(self, tree: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last range that hold rows of each hash."""
        return tuple(np.searchsorted(self.cuts[tree], hashes, side=side) for side in ("left", "right"))

    def range_of(self, tree: int, hashes: np.ndarray, salts: np.ndarray) -> np.ndarray:
        """The range of each row; rows of a hash that fills several are dealt over them."""
        first, last = self.span(tree, hashes)
        return first + (salts % (last - first + 1).astype(np.uint64)).astype(np.int64)

    def visited(self, tree: int, hashes: np.ndarray, rows_each: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of the query, and range, for all ranges that queries visit."""
        first, last = self.span(tree, hashes)
        reach = -(-rows_each // self.room)
        first, last = np.maximum(first - reach, 0), np.minimum(last + reach, len(self.cuts[tree]))
        query = np.repeat(np.arange(len(hashes)), last - first + 1)
        begin = np.cumsum(last - first + 1) - (last - first + 1)
        return query, first[query] + np.arange(len(query)) - begin[query]


def exact_scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    return (rows * query).sum(axis=1)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _pairs(
    score: np.ndarray, rows: np.ndarray, close: np.ndarray, ids: list, query: np.ndarray, own: int, k: int
) -> list[tuple[float, int]]:
    """The ``k`` best (score, id) of the rows ``close`` for a query; ``score`` is theirs but for rounding."""
    if not len(score):
        return []
    best = close[score >= np.partition(score, -min(k + 1, len(score)))[-min(k + 1, len(score))] - 1e-9]
    exact = exact_scores(rows[best], query)
    pairs = [(s, m) for s, j in zip(exact, best) for m in ids[j] if m != own]
    pairs.sort(key=lambda x: (-x[0], x[1]))
    return pairs[:k]


def _prefix_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of hash strings."""
    x = a ^ b
    high = np.zeros(x.shape, np.int64)
    for shift in (32, 16, 8, 4, 2, 1):
        big = x >> np.uint64(shift) != 0
        high += np.where(big, shift, 0)
        x = np.where(big, x >> np.uint64(shift), x)
    return np.where(a == b, BITS, BITS - 1 - high)


_HIGH = np.array([(1 << 64) - (1 << 64 - t) for t in range(BITS + 1)], np.uint64)


def ascended(hashes: np.ndarray, asked: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """From where to where the ``most`` rows with the longest common prefixes stand in sorted hash strings, per query."""
    if len(hashes) <= most:
        return np.zeros(len(asked), np.int64), np.full(len(asked), len(hashes))

    def span(level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.searchsorted(hashes, asked & _HIGH[level]), np.searchsorted(hashes, asked | ~_HIGH[level], side="right")

    # The longest prefix that as many rows have.
    level, above = np.zeros(len(asked), np.int64), np.full(len(asked), BITS + 1)
    while (above - level > 1).any():
        middle = (level + above) // 2
        left, right = span(middle)
        enough = right - left >= most
        level, above = np.where(enough, middle, level), np.where(enough, above, middle)
    left, _ = span(level)
    # All rows of the next longer prefix, and the nearest of this one, which stand on one side of those.
    a, b = span(np.minimum(level + 1, BITS))
    first = np.where(level == BITS, left, np.where(left < a, b - most, a))
    return first, first + most


def true_neighbours(classes: DataFrame, queries: np.ndarray, k: int) -> np.ndarray:
    """Vectors of the ``k`` best classes for each of a few queries, by brute force over all rows."""
    shared = classes.sparkSession.sparkContext.broadcast(queries)
    schema = pa.schema([("q", pa.int32()), ("score", pa.float64()), ("v", pa.list_(pa.float64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("v"))
            score = rows @ shared.value.T
            for q in range(score.shape[1]):
                best = np.argsort(-score[:, q])[:k]
                yield batch_of({"q": [q] * len(best), "score": score[best, q], "v": list(rows[best])}, schema)

    found = classes.select("v").mapInArrow(scan, "q int, score double, v array<double>")
    order = Window.partitionBy("q").orderBy(F.desc("score"))
    top = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).select("q", "v").toPandas()
    return top["q"].to_numpy(), np.stack(top["v"].to_numpy())


def depth(forest: Forest, sample: np.ndarray, total: int, queries: np.ndarray, owner: np.ndarray, near: np.ndarray, share: float) -> int:
    """Rows a tree must give so that ``share`` of the true neighbours come up in one of them."""
    of_query, of_near, of_rows = forest.hashes(queries, True), forest.hashes(near, False), forest.hashes(sample, False)
    needed = np.full(len(near), np.inf)
    for tree in range(forest.trees):
        for q in range(len(queries)):
            own = owner == q
            to_rows = np.sort(_prefix_bits(of_rows[:, tree], of_query[q, tree]))
            to_near = _prefix_bits(of_near[own, tree], of_query[q, tree])
            before = len(sample) - np.searchsorted(to_rows, to_near, side="left")
            needed[own] = np.minimum(needed[own], before)
    return int(np.ceil(np.quantile(needed, share) * total / len(sample))) + 1


def neighbours(
    vectors: DataFrame, k: int = 20, every: int = 20, trees: int = 24, probes: int = 64, sample: int = 20_000, recall: float = 0.97,
    blocks: bool = False,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` the ``k`` nearest others.

    ``blocks``: score all rows in blocks instead of going by the forest; the sizes never choose.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    # A result needs no more than k + 1 members of a class of equal vectors.
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = rows.distinct().withColumn("r", first).where(F.col("r") <= k + 1)
    classes, _ = stored(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "classes")
    asked, _ = stored(rows.where(F.col("vec_id") % every == 0).distinct(), "queries")
    longest, total = classes.agg(
        F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))), F.count("*")
    ).first()
    if not total or asked.isEmpty():
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    draw = drawn(F.element_at("ids", 1), "rows")
    picked = np.stack(classes.where(draw < sample / total).select("v").toPandas()["v"].to_numpy())
    forest = Forest(picked.shape[1], trees, longest)
    tried = np.stack(asked.orderBy(drawn(F.col("vec_id"), "probes"), "vec_id").limit(probes).select("v").toPandas()["v"].to_numpy())
    owner, near = true_neighbours(classes, tried, k + 1)
    rows_each = max(depth(forest, picked, total, tried, owner, near, recall), k + 1)
    forest.cut(forest.hashes(picked, False), total, max(1, SHARD * RANGE // trees))
    shared = spark.sparkContext.broadcast(forest)
    entry = pa.schema([("shard", pa.int64()), ("v", pa.list_(pa.float32())), ("w", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64()))])
    single = not classes.where(F.exists("v", lambda x: x != x.cast("float").cast("double"))).limit(1).count()

    def entered(shard: np.ndarray, v: np.ndarray, ids: list, spot: np.ndarray) -> pa.RecordBatch:
        flat = list(v[spot])
        return batch_of({
            "shard": shard, "v": flat if single else [None] * len(spot),
            "w": [None] * len(spot) if single else flat, "ids": [ids[i] for i in spot],
        }, entry)

    row_blocks = max(BLOCKS, -(-total // RANGE))
    query_blocks = max(1, -(-asked.count() // QUERIES)) if blocks else 1

    def salted(ids: list) -> np.ndarray:
        return mix64(np.array([i[0] for i in ids], np.int64).view(np.uint64))

    def dealt(query: bool):
        """Row blocks times query blocks; a row goes to all blocks of queries and a query to all blocks of rows."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v, ids = matrix(batch.column("v")), batch.column("ids").to_pylist()
                every = np.arange(len(v))
                own = (salted(ids) % np.uint64(query_blocks if query else row_blocks)).astype(np.int64)
                for other in range(row_blocks if query else query_blocks):
                    if len(v):
                        yield entered(other * query_blocks + own if query else own * query_blocks + other, v, ids, every)
        return run

    def index(query: bool):
        """A row goes to the shard of its range in each tree, a query to those of all ranges it visits, once to each."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forest = shared.value
            for batch in batches:
                for start in range(0, batch.num_rows, STEP):
                    part = batch.slice(start, STEP)
                    v, ids = matrix(part.column("v")), part.column("ids").to_pylist()
                    hashes, salts = forest.hashes(v, query), salted(ids)
                    spots, places = [], []
                    for tree in range(forest.trees):
                        own = hashes[:, tree]
                        spot, place = forest.visited(tree, own, rows_each) if query else (np.arange(len(v)), forest.range_of(tree, own, salts))
                        spots.append(spot)
                        places.append(place)
                    pairs = np.unique(np.stack([np.concatenate(places), np.concatenate(spots)], axis=1), axis=0)
                    for i in range(0, len(pairs), 10 * STEP):
                        place, spot = pairs[i : i + 10 * STEP].T
                        yield entered(place, v, ids, spot)
        return run

    kind = "shard bigint, v array<float>, w array<double>, ids array<bigint>"
    entries = classes.select("v", "ids").mapInArrow((dealt if blocks else index)(False), kind)
    wanted = asked.select("v", F.array("vec_id").alias("ids")).mapInArrow((dealt if blocks else index)(True), kind)
    result = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    vector = "v" if single else "w"

    def all_rows(shard: int, rows: np.ndarray, ids: list, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        every = np.arange(len(rows))
        for i in range(len(queries)):
            if i % STRIP == 0:
                strip = queries[i : i + STRIP] @ rows.T
            yield every, strip[i % STRIP]

    def of_trees(shard: int, rows: np.ndarray, ids: list, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The rows that the trees give each query in this shard, and their scores."""
        forest = shared.value
        hashes, asked, salts = forest.hashes(rows, False), forest.hashes(queries, True), salted(ids)
        spots, begins, ends = [], [], []
        for tree in range(forest.trees):
            own = np.ascontiguousarray(hashes[:, tree])
            here = np.flatnonzero(forest.range_of(tree, own, salts) == shard)
            here = here[np.argsort(own[here], kind="stable")]
            spots.append(here)
            own, query = own[here], np.ascontiguousarray(asked[:, tree])
            low, high = forest.limits(tree, query, rows_each)
            begin, end = ascended(own, query, rows_each)
            begins.append(np.maximum(begin, np.searchsorted(own, low)))
            ends.append(np.minimum(end, np.searchsorted(own, high, side="right")))
        for i in range(0, len(queries), STRIP):
            # What the trees give a strip of queries is multiplied at once; each keeps its own rows.
            given = np.zeros((len(queries[i : i + STRIP]), len(rows)), bool)
            for own, j in zip(given, range(i, len(queries))):
                for spot, begin, end in zip(spots, begins, ends):
                    own[spot[begin[j] : end[j]]] = True
            some = np.flatnonzero(given.any(axis=0))
            score = queries[i : i + STRIP] @ (rows[some] if len(some) < len(rows) else rows).T
            for own, of_own in zip(given, score):
                own = own[some]
                yield some[own], of_own[own]

    def search(key: tuple, entries: pa.Table, wanted: pa.Table) -> pa.Table:
        out: dict[str, list] = {f.name: [] for f in result}
        if entries.num_rows and wanted.num_rows:
            rows, queries = (matrix(t.column(vector).combine_chunks()) for t in (entries, wanted))
            ids = entries.column("ids").to_pylist()
            scored = (all_rows if blocks else of_trees)(key[0].as_py(), rows, ids, queries)
            for own, query, (close, score) in zip(wanted.column("ids").to_pylist(), queries, scored):
                for s, m in _pairs(score, rows, close, ids, query, own[0], k):
                    out["query_id"].append(own[0])
                    out["vec_id"].append(m)
                    out["score"].append(s)
        return pa.Table.from_batches([batch_of(out, result)])

    found = entries.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
