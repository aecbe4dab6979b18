"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item are compared if they share a seed, a run of ``shortest`` words.  Tiles
are then laid: the longest run of unmarked words that both have, found by running Karp-Rabin hashes of
all windows of a length, is marked in both, again and again down to ``shortest``.  An item is leaked if
the tiles cover at least a share of its words, in whatever order its passages stand in the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import batch_of, fresh_name
from ratewell.llm.words import in_slices, shingle_hashes, words_of

_ROLL = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_ROLL), -1, 2**64))


def prepare(rows: list[tuple[int | None, str | None]], shortest: int) -> dict:
    """Some benchmark items: their words, and the items of every seed, ascending by its hash.

    ``ids``; ``words`` and ``first``: item k has words[first[k]:first[k + 1]]; ``seeds``; ``post`` and ``owner``:
    seed k stands in the items owner[post[k]:post[k + 1]]; ``shortest``: of each item, as one of fewer words
    than asked is one seed.
    """
    found = words_of(pa.array([t for _, t in rows], pa.string()), marks=False)
    seeds, owner, least = [], [], []
    for k in range(len(rows)):
        mine = found.hashes[found.first[k] : found.first[k + 1]]
        least.append(max(min(shortest, len(mine)), 1))
        own = np.unique(shingle_hashes(mine, shortest))
        seeds.append(own)
        owner.append(np.full(len(own), k))
    every, owners = np.concatenate(seeds), np.concatenate(owner)
    order = np.lexsort((owners, every))
    distinct, post = np.unique(every[order], return_index=True)
    return {
        "ids": [i for i, _ in rows], "words": found.hashes, "first": found.first, "seeds": distinct,
        "post": np.append(post, len(every)), "owner": owners[order], "shortest": np.array(least),
    }


class Rolling:
    """Karp-Rabin hashes of all windows of words, by running sums; marked words are in no window."""

    def __init__(self, words: np.ndarray, blocked: np.ndarray):
        self.words, self.blocked = words, blocked
        with np.errstate(over="ignore"):
            up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(words), _ROLL)]))
            self.down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(words), _BACK)]))
            self.total = np.concatenate([[np.uint64(0)], np.cumsum(words * up[:-1], dtype=np.uint64)])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and places of the windows without a marked word."""
        if len(self.words) < size:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        marks = np.concatenate([[0], np.cumsum(self.blocked)])
        at = np.flatnonzero(marks[size:] == marks[:-size])
        with np.errstate(over="ignore"):
            return (self.total[at + size] - self.total[at]) * self.down[at], at


def tiles(item: np.ndarray, text: np.ndarray, breaks: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in item, place in text, words), longest first; no tile crosses ``breaks``."""
    a, b = Rolling(item, np.zeros(len(item), bool)), Rolling(text, breaks.copy())
    found: list[tuple[int, int, int]] = []
    longest = min(len(item), len(text))
    while longest >= shortest:
        low, high = shortest - 1, longest  # the longest common window, between these
        while low < high:
            size = (low + high + 1) // 2
            if np.isin(a.windows(size)[0], b.windows(size)[0]).any():
                low = size
            else:
                high = size - 1
        if low < shortest:
            break
        hashes, at = b.windows(low)
        order = np.argsort(hashes, kind="stable")
        hashes, at = hashes[order], at[order]
        for key, i in zip(*a.windows(low)):
            if a.blocked[i : i + low].any():
                continue
            k = int(np.searchsorted(hashes, key))
            while k < len(hashes) and hashes[k] == key:
                j = int(at[k])
                if not b.blocked[j : j + low].any() and (item[i : i + low] == text[j : j + low]).all():
                    a.blocked[i : i + low] = b.blocked[j : j + low] = True
                    found.append((int(i), j, low))
                    break
                k += 1
        longest = low - 1
    return found


def leaks(words: np.ndarray, items: dict, shortest: int, share: float) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """The items whose tiles in a text cover ``share`` of them: item, words covered, tiles."""
    answer = []
    hashes = shingle_hashes(words, shortest)
    if not len(hashes) or not len(items["seeds"]):
        return answer
    place = np.minimum(np.searchsorted(items["seeds"], hashes), len(items["seeds"]) - 1)
    hits = np.flatnonzero(items["seeds"][place] == hashes)
    if not len(hits) and not (items["shortest"] < shortest).any():
        return answer
    seeds = place[hits]
    many = items["post"][seeds + 1] - items["post"][seeds]
    which = items["owner"][np.repeat(items["post"][seeds] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
    where = np.repeat(hits, many)
    order = np.lexsort((where, which))
    which, where = which[order], where[order]
    for k, low, high in zip(*(x.tolist() for x in _groups(which))):
        item = items["words"][items["first"][k] : items["first"][k + 1]]
        size = min(shortest, len(words))
        covered = np.unique((where[low:high, None] + np.arange(size)).ravel())
        # Tiles lie on words under shared seeds, in the text and in the item: too few of either and none are laid.
        shared = np.isin(shingle_hashes(item, shortest), hashes[where[low:high]])
        under = np.convolve(shared, np.ones(min(shortest, len(item)))) > 0.5
        if min(len(covered), under.sum()) < share * len(item):
            continue
        # Words of the text outside seeds can be in no tile; a gap is one blocked place.
        jump = np.flatnonzero(np.diff(covered) > 1) + 1
        text = np.insert(words[covered], jump, np.uint64(0))
        spot = np.insert(covered, jump, -1)
        laid = tiles(item, text, spot < 0, int(items["shortest"][k]))
        count = sum(n for _, _, n in laid)
        if count >= share * len(item):
            answer.append((k, count, [(i, int(spot[j]), n) for i, j, n in laid]))
    return answer


def _groups(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, first = np.unique(which, return_index=True)
    return keys, first, np.append(first[1:], len(which))


def item_blocks(benchmark: DataFrame, shortest: int, most_bytes: int) -> Iterator[dict]:
    """The benchmark in blocks of at most about ``most_bytes`` of text, each small enough to send to all."""
    held, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.lower(F.coalesce("text", F.lit(""))).alias("text")).toLocalIterator():
        held.append((row[0], row[1]))
        size += len(row[1])
        if size >= most_bytes:
            yield prepare(held, shortest)
            held, size = [], 0
    if held:
        yield prepare(held, shortest)


def find_leaks(docs: DataFrame, benchmark: DataFrame, shortest: int = 5, share: float = 0.5, most_bytes: int = 8 << 20) -> DataFrame:
    """One row for each document (doc_id, text) and benchmark item (item_id, text) that it leaks.

    Returns doc_id, item_id, n_words of the item, n_covered and tiles (place in the item, place in the
    document, words).  Case and punctuation are ignored.  An item of fewer words
    than ``shortest`` is leaked by a document that is that item alone.  Null and empty texts leak nothing
    and are not leaked; null ids stay null; a repeated row has rows of its own; empty tables give no
    rows.  Documents are read whole, once for each block of the benchmark, and never shuffled.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_words", pa.int64()), ("n_covered", pa.int64()),
        ("tiles", pa.list_(pa.struct([("in_item", pa.int64()), ("in_doc", pa.int64()), ("words", pa.int64())]))),
    ])
    kind = "doc_id long, item_id long, n_words long, n_covered long, tiles array<struct<in_item: long, in_doc: long, words: long>>"
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    result = spark.createDataFrame([], kind)
    for items in item_blocks(benchmark, shortest, most_bytes):
        shared = spark.sparkContext.broadcast(items)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in in_slices(batches, "text"):
                found, out = words_of(batch.column("text"), marks=False), []
                ids = batch.column("doc_id").to_pylist()
                for k, doc in enumerate(ids):
                    for item, count, laid in leaks(found.hashes[found.first[k] : found.first[k + 1]], items, shortest, share):
                        size = int(items["first"][item + 1] - items["first"][item])
                        spots = [{"in_item": i, "in_doc": j, "words": n} for i, j, n in sorted(laid)]
                        out.append((doc, items["ids"][item], size, count, spots))
                if out:
                    yield batch_of(schema, *zip(*out))

        result = result.union(rows.mapInArrow(search, kind))
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, shortest: int = 5, share: float = 0.5, most_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns kept; see ``find_leaks``."""
    spark = docs.sparkSession
    plain = fresh_name(docs, "plain")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    for items in item_blocks(benchmark, shortest, most_bytes):
        shared = spark.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in in_slices(batches, plain):
                found = words_of(batch.column(plain), marks=False)
                clean = [
                    not leaks(found.hashes[found.first[k] : found.first[k + 1]], shared.value, shortest, share)
                    for k in range(len(found))
                ]
                kept = batch.filter(pa.array(clean, pa.bool_()))
                yield kept.drop_columns([plain])

        docs = docs.withColumn(plain, F.lower("text")).mapInArrow(keep, kind)
    return docs
