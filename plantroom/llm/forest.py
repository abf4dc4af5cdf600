"""Approximate nearest neighbours with a forest of hash prefixes.

Every vector gets, for each of several trees, a long string of hyperplane signs. A tree is the sorted array of its
strings: all strings that share a prefix lie side by side. A query descends in every tree to its longest prefix and
then ascends in all trees at once, one bit at a time, until the ranges it has reached hold enough rows. These rows are
scored exactly.

The forest is cut into blocks of rows of bounded size; the queries, in blocks, meet every block of the forest, and the
best of each block are merged. Nothing else than the best rows of a block is passed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantroom.llm.shared import stored

#: Trees, and signs in a tree's string.
TREES, BITS = 48, 24
#: A query ascends until its ranges hold this multiple of the block's rows, a row counted once for each tree.
REACH = 0.7
#: Rows of a block of the forest, queries of a block of queries.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 4096
SEED = 11

_PAIRS = "query_id long, query_row long, vec_id long, score double"


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Rows that take part: no null id or vector, no null, infinite or NaN component, not all zero."""
    doubles = F.col(embedding).cast("array<double>")
    return (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), doubles.alias("embedding"))
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
        .where(F.exists("embedding", lambda x: x != 0.0))
    )


def _planes(dims: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dims + 1, TREES * BITS))


def hash_strings(vectors: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """Signs of random projections, one integer per vector and tree.

    `extra` lengthens all indexed vectors to one norm, so that the largest inner product is the smallest angle;
    queries have 0 there.
    """
    signs = np.column_stack([vectors, extra]) @ _planes(vectors.shape[1]) > 0
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    return signs.reshape(len(vectors), TREES, BITS) @ weights


class Forest:
    """Sorted arrays of the strings of one block."""

    def __init__(self, vectors: np.ndarray, longest: float):
        extra = np.sqrt(np.maximum(longest * longest - (vectors * vectors).sum(axis=1), 0.0))
        strings = hash_strings(vectors, extra)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=0)
        self.rows = len(vectors)

    def ranges(self, strings: np.ndarray, enough: float) -> tuple[np.ndarray, np.ndarray]:
        """For each query and tree, the range of rows at the common depth where all ranges together hold enough."""
        low = np.zeros(strings.shape, dtype=np.int64)
        high = np.full(strings.shape, self.rows, dtype=np.int64)
        for depth in range(1, BITS + 1):
            shift = BITS - depth
            prefix = strings >> shift
            lower, upper = np.empty_like(low), np.empty_like(high)
            for t in range(TREES):
                lower[:, t] = np.searchsorted(self.sorted[:, t], prefix[:, t] << shift, "left")
                upper[:, t] = np.searchsorted(self.sorted[:, t], (prefix[:, t] + 1) << shift, "left")
            deeper = (upper - lower).sum(axis=1) >= enough
            if not deeper.any():
                break
            low[deeper], high[deeper] = lower[deeper], upper[deeper]
        return low, high

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows in any tree's range."""
        found = np.zeros(self.rows, dtype=bool)
        for t in range(TREES):
            found[self.order[low[t] : high[t], t]] = True
        return np.flatnonzero(found)


def _best(query_rows, queries, rows, ids, vectors, longest: float, k: int, reach: float):
    """The k best candidates of each query in one block, ties to the smaller id, as places in the block."""
    forest = Forest(vectors, longest)
    low, high = forest.ranges(hash_strings(queries, np.zeros(len(queries))), max(reach * len(ids), 2.0 * k * TREES))
    # what the order of additions can change in a product, for these dimensions and lengths
    rounding = 4 * np.finfo(float).eps * vectors.shape[1] * longest * np.sqrt((queries * queries).sum(axis=1))
    for i, row in enumerate(query_rows):
        found = forest.candidates(low[i], high[i])
        found = found[rows[found] != row]
        scores = vectors[found] @ queries[i]
        if len(found) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            near = scores >= least - rounding[i]
            found, scores = found[near], scores[near]
        # exactly the measure, whatever the order of additions of a product of matrices
        scores = np.array([np.sum(vectors[j] * queries[i]) for j in found]) if len(found) else scores
        top = np.lexsort((ids[found], -scores))[:k]
        yield i, found[top], scores[top]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    rows = len(column)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(rows, -1)


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, reach: float = REACH) -> DataFrame:
    """The k nearest rows of each row whose id is divisible by `every`, among all other rows, by inner product.

    Returns query_id, rank (from 1), vec_id, score (inner product of the original vectors in double precision), ties
    to the smaller vec_id. Rows as in `usable`. Vectors of several lengths are several tables: a query meets those of
    its own length, because no other has an inner product with it. Repeated ids are rows of their own: each queries by
    itself, and its twin is a candidate. With fewer than k other rows, all are returned; an empty table gives no rows.

    Usable rows are numbered and written to the shared folder. The driver gets one row for each length of vectors.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors).withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = F.pmod("vec_id", F.lit(every)) == 0
    lengths = (
        rows.groupBy(F.size("embedding").alias("dims"))
        .agg(
            F.count("*").alias("n"),
            F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)).alias("square"),
            F.count(F.when(asked, 1)).alias("queries"),
        )
        .where("queries > 0")
        .collect()
    )
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = {r["dims"]: float(r["square"]) ** 0.5 for r in lengths}
    blocks = spark.createDataFrame(
        [(r["dims"], -(-r["n"] // BLOCK_ROWS), -(-r["queries"] // BLOCK_QUERIES)) for r in lengths],
        "dims int, row_blocks int, query_blocks int",
    )
    # one row for each length, and the vectors of n lengths hold n * n / 2 numbers at least: this stays small
    sized = rows.withColumn("dims", F.size("embedding")).join(F.broadcast(blocks), "dims")
    # blocks by the row's number: repeated ids or vectors spread as all rows do, and sizes stay even
    spread = F.xxhash64("row")

    def dealt(rows: DataFrame, block, part, query: bool) -> DataFrame:
        return rows.select("dims", block.alias("block"), part.alias("part"), F.lit(query).alias("query"), "row", "vec_id", "embedding")

    def all_of(number: str):
        return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

    def one_of(number: str):
        return F.pmod(spread, F.col(number)).cast("int")

    index = dealt(sized, one_of("row_blocks"), all_of("query_blocks"), False)
    queries = dealt(sized.where(asked), all_of("row_blocks"), one_of("query_blocks"), True)

    def search(table: pa.Table) -> pa.Table:
        asked = table.column("query").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        ids, numbers = table.column("vec_id").to_numpy(), table.column("row").to_numpy()
        matrix = _matrix(table.column("embedding"))
        found: tuple[list, list, list, list] = ([], [], [], [])
        if asked.any() and not asked.all():
            order = np.flatnonzero(~asked)[np.argsort(ids[~asked], kind="stable")]
            for i, best, scores in _best(
                numbers[asked], matrix[asked], numbers[order], ids[order], matrix[order], longest[matrix.shape[1]], k, reach
            ):
                found[0].append(np.full(len(best), ids[asked][i]))
                found[1].append(np.full(len(best), numbers[asked][i]))
                found[2].append(ids[order][best])
                found[3].append(scores)
        types = (np.int64, np.int64, np.int64, np.float64)
        flat = [np.concatenate(x) if x else np.empty(0, t) for x, t in zip(found, types, strict=True)]
        return pa.table(flat, names=["query_id", "query_row", "vec_id", "score"])

    found = index.unionByName(queries).groupBy("dims", "block", "part").applyInArrow(search, _PAIRS)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
