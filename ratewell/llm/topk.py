"""Exact top-k inner products without random access.

Rows are dealt into blocks.  A block keeps, for each component, its rows sorted by that component.  For
a query the lists are read from the end that the sign of the query's component prefers, all to the same
depth.  A row has a lower and an upper bound of its score: what the lists read so far say of it, plus for
each list where it wasn't met the least value in that list or the value at the reading head.  Reading goes
deeper until the k-th best lower bound is above what all but a few rows, met or not, can reach; then the
scores of the rows that are left are resolved.  The best k of the blocks' answers are the answer.

A set of queries reads together: at a depth the bounds of all its queries are two products of matrices,
with what was read from the upper end of the lists and with what was read from the lower end.  Where
reading on would cost more than resolving, all rows still in question are resolved by one product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewell.llm.common import batch_of

DEEPER = 4  # times the depth at each further reading
FIRST = 2  # times k, rows of each list that are read first
SHARE = 16  # lists are read to this part of a block at most; from there resolving costs less
FEW = 4  # times k, rows in question that are resolved at once
TOGETHER = 256  # queries that read together


def in_question(values: np.ndarray, ordered: np.ndarray, places: np.ndarray, queries: np.ndarray, own: tuple, k: int) -> np.ndarray:
    """Which rows (columns) may be among the k best of each query (rows).

    ``ordered[:, d]`` are the values of component d, ascending; ``places`` the place of each row in them.
    ``own`` are the (query, row) that don't count.
    """
    n = len(values)
    none = -np.inf if values.dtype.kind == "f" else np.iinfo(values.dtype).min
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    found = np.ones((len(queries), n), bool)
    found[own] = False
    reading = np.arange(len(queries))
    depth = FIRST * k
    while len(reading) and depth * SHARE <= n:
        above, below = n - 1 - places < depth, places < depth
        least = up[reading] @ np.where(above, values, ordered[0]).T + down[reading] @ np.where(below, values, ordered[-1]).T
        most = up[reading] @ np.where(above, values, ordered[n - depth]).T + down[reading] @ np.where(below, values, ordered[depth - 1]).T
        least[~found[reading]] = none
        bar = np.partition(least, n - k, axis=1)[:, n - k]
        found[reading] &= most >= bar[:, None]
        reading = reading[found[reading].sum(axis=1) > FEW * k]
        depth *= DEEPER
    return found


def best_of(ids: np.ndarray, times: np.ndarray, values: np.ndarray, asked: np.ndarray, queries: np.ndarray, k: int):
    """The k best rows of a block for each query: query, row id and score, ties to smaller ids.

    A row that occurs several times is as many answers.  All scores are whole numbers; doubles are exact
    where no score reaches 2**53, else whole numbers of 64 bits count.
    """
    reach = values.shape[1] * max(float(np.abs(values).max()), 1) * max(float(np.abs(queries).max()), 1)
    kind = np.float64 if reach < 2**53 else np.int64
    values, queries = values.astype(kind), queries.astype(kind)
    lists = np.argsort(values, axis=0, kind="stable")
    places = np.empty(lists.shape, np.int32)
    np.put_along_axis(places, lists, np.arange(len(ids), dtype=np.int32)[:, None], axis=0)
    ordered = np.take_along_axis(values, lists, axis=0)
    by_id = np.argsort(ids, kind="stable")
    low, high = np.searchsorted(ids[by_id], asked), np.searchsorted(ids[by_id], asked, "right")
    for at in range(0, len(asked), TOGETHER):
        some = slice(at, at + TOGETHER)
        count = (high - low)[some]
        spots = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low[some], count)
        own = np.repeat(np.arange(len(count)), count), by_id[spots]
        found = in_question(values, ordered, places, queries[some], own, k)
        score = queries[some] @ values.T
        for q in range(len(count)):
            rows = np.flatnonzero(found[q])
            value = score[q, rows]
            if len(rows) > k:
                rows = rows[value >= np.partition(value, len(value) - k)[len(value) - k]]
                value = score[q, rows]
            best = np.lexsort((ids[rows], -value))[:k]
            best = np.repeat(best, np.minimum(times[rows[best]], k))[:k]
            yield np.full(len(best), asked[at + q]), ids[rows[best]], value[best].astype(np.int64)


def search(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, block_rows: int = 8192, query_rows: int = 8192) -> DataFrame:
    """The k best rows for every row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score.

    A component x counts as floor(scale * x); the score is the integer inner product; ties go to the
    smaller vec_id; a query is not its own answer (rows with its vec_id are left out).  Vectors that
    are null or hold a null or a non-finite component take no part, nor do rows with a null vec_id;
    a missing component of a shorter vector counts as 0.  Scores are exact while they stay below
    2**63.  A repeated row is an answer of its own; a repeated query is asked once.  Fewer than k other
    rows give all of them; an empty table gives no rows; other columns are left out.

    Equal rows are counted first.  Blocks are made by a hash of the row and queries are asked in sets of
    bounded size, so a task holds one block of rows and one set of queries, however large the table.
    Every set meets every block: with one query for a hundred rows that grows with the square.
    """
    spark = vectors.sparkSession
    usable = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull()).where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"),
    )
    count = rows.agg(F.count("*"), F.max(F.size("v")), F.sum((F.col("vec_id") % every == 0).cast("int"))).first()
    total, width, asked = count[0], max(count[1] or 1, 1), count[2] or 0
    blocks = max(1, -(-total // block_rows))
    sets = max(1, -(-asked // query_rows))
    dealt = rows.groupBy("vec_id", "v").agg(F.count("*").alias("times")).withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = queries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(sets)))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    kind = "query_id long, vec_id long, score long"

    def matrix(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        sizes = np.diff(lists.offsets.to_numpy())
        out = np.zeros((len(lists), width), np.int64)
        at = np.arange(len(lists)).repeat(sizes), np.arange(sizes.sum()) - (np.cumsum(sizes) - sizes).repeat(sizes)
        out[at] = lists.flatten().to_numpy()
        return out

    def answer(block: pa.Table, asked: pa.Table) -> pa.Table:
        if not block.num_rows or not asked.num_rows:
            return schema.empty_table()
        ids, times = (block.column(c).to_numpy() for c in ("vec_id", "times"))
        found = best_of(ids, times, matrix(block.column("v")), asked.column("vec_id").to_numpy(), matrix(asked.column("v")), k)
        return pa.Table.from_batches([batch_of(schema, *map(np.concatenate, zip(*found)))])

    # Each set of queries meets each block of rows once; both are bounded.
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    sent = queries.withColumn("block", upto(blocks))
    mine = dealt.withColumn("part", upto(sets))
    found = mine.groupBy("part", "block").cogroup(sent.groupBy("part", "block")).applyInArrow(answer, kind)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
