import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewell.llm.topk import best_of, in_question, search

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k):
    def usable(i, v):
        return i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)

    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows if usable(i, v)]
    found = []
    for q, a in sorted({i: v for i, v in whole if i % every == 0}.items()):
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)
        found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return found


@pytest.mark.parametrize("block_rows, query_rows", [(50, 3), (100_000, 8192)])
def test_against_brute_force(spark, block_rows, query_rows):
    rng = random.Random(block_rows)
    # Multiples of 1/1024 in single precision, few values, so that many scores tie.
    rows = [(i, [rng.choice([-2, -1, 0, 0, 1, 3]) / 1024 for _ in range(8)], 1) for i in range(900)]
    rows += [(i, [rng.uniform(-1, 1) * 0.5**k for k in range(8)], 1) for i in range(900, 1000)]
    rows += [(2000, None, 1), (2001, [1.0, None], 1), (2002, [math.nan] * 8, 1), (2003, [math.inf] * 8, 1), (None, [1.0] * 8, 1)]
    rows += [(2100, [0.0] * 8, 1), (2200, [], 1), (2300, [0.25, 0.5], 1), (7, rows[7][1], 1), (100, rows[100][1], 1)]
    df = spark.createDataFrame(rows, KIND).withColumn("score", F.lit("clash")).withColumn("block", F.lit(1)).withColumn("part", F.lit(1))
    found = search(df, 100, 10, 1024, block_rows, query_rows).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 100, 10)


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("n, shape", [(700, "flat"), (700, "steep"), (3000, "steep"), (3000, "ties"), (40, "flat")])
def test_bounds_keep_every_row_of_the_best(n, shape, large):
    rng = np.random.default_rng(n)
    values = rng.integers(-1000, 1000, (n, 6))
    if shape == "steep":  # few rows decide, so that lists are not read far
        values[: n // 50] *= 50
    if shape == "ties":
        values //= 700
    if large:
        values = values * 2**14
    queries = np.concatenate([values[:7], np.zeros((1, 6), np.int64), rng.integers(-9, 9, (5, 6)) * (2**14 if large else 1)])
    asked = np.concatenate([np.arange(7), [10**6] * 6])
    ids, times = np.arange(n), np.ones(n, np.int64)
    times[3] = 4
    for (q, rows, score), a, v in zip(best_of(ids, times, values, asked, queries, 10), asked, queries):
        exact = values @ v
        every = sorted((-int(exact[i]), int(i)) for i in ids for _ in range(times[i]) if i != a)[:10]
        assert [(-int(s), int(i)) for i, s in zip(rows, score)] == every and (q == a).all()


def test_steep_lists_are_left_early():
    rng = np.random.default_rng(1)
    values = rng.integers(-1000, 1000, (4000, 6)).astype(float)
    values[:40] *= 50
    ordered, places = np.sort(values, axis=0), np.argsort(np.argsort(values, axis=0, kind="stable"), axis=0, kind="stable")
    found = in_question(values, ordered, places, np.abs(values[:20]), (np.arange(20), np.arange(20)), 10)
    assert (found.sum(axis=1) <= 200).sum() >= 8


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [3.0, 1.0], 1), (2, [3.0, 1.0], 1)]
    assert sorted(tuple(r) for r in search(spark.createDataFrame(rows, KIND)).collect()) == brute(rows, 100, 10)
    assert search(spark.createDataFrame(rows[:1], KIND)).collect() == []
    assert search(spark.createDataFrame([], KIND)).collect() == []
