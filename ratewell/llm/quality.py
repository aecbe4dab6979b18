"""A quality classifier on learned subword embeddings.

Words, runs of characters in words, pairs of words and two signs of repetition are hashed into one
table of embeddings.  A document is the mean of its features' embeddings; a softmax layer gives the
class.  Both are learned by stochastic gradient descent in numpy on a bounded sample of labelled rows.
To score, the table and the layer are multiplied out to one number per feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import batch_of, crc_of_id, fresh_name
from ratewell.llm.words import in_slices, mix, runs, span_hashes, words_of

GRAMS = (3, 4)
SAME, NEW = np.uint64(0x5A4E), np.uint64(0x4E57)


@dataclass(frozen=True)
class Features:
    """Hashed features of some texts: word features by distinct word, others by occurrence."""

    words: np.ndarray  # buckets of the word itself and its character runs, distinct words in turn
    first: np.ndarray  # word k has words[first[k]:first[k + 1]]
    which: np.ndarray  # the distinct word of every occurrence
    pairs: np.ndarray  # bucket of the pair that every occurrence but a text's first ends
    repeats: np.ndarray  # bucket of the sign of repetition, for the same occurrences
    bounds: np.ndarray  # text i has the occurrences bounds[i]:bounds[i + 1]
    begins: np.ndarray  # whether an occurrence is the first of its text


def features_of(column: pa.Array, buckets: int) -> Features:
    found = words_of(column, lower=False)
    hashes, where, which = np.unique(found.hashes, return_index=True, return_inverse=True)
    mask = np.uint64(buckets - 1)
    low, high = found.start[where], found.end[where]
    size = high - low + 2
    at = np.concatenate([[0], np.cumsum(size)])
    data = np.full(at[-1], ord(">"), np.uint8)
    data[at[:-1]] = ord("<")
    inner = np.repeat(low - at[:-1] - 1, size - 2) + runs(at[:-1] + 1, size - 2)
    data[runs(at[:-1] + 1, size - 2)] = found.data[inner]
    owner, buck = [np.arange(len(hashes))], [hashes & mask]
    for n in GRAMS:
        many = np.maximum(size - n + 1, 0)
        start = runs(at[:-1], many)
        owner.append(np.repeat(np.arange(len(hashes)), many))
        buck.append(mix(span_hashes(data, start, start + n) + np.uint64(n)) & mask)
    owner, buck = np.concatenate(owner), np.concatenate(buck).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[order], np.arange(len(hashes) + 1))
    begins = np.zeros(len(which), bool)
    begins[found.first[:-1][found.first[:-1] < found.first[1:]]] = True
    with np.errstate(over="ignore"):
        before = np.concatenate([[np.uint64(0)], found.hashes[:-1]]) if len(which) else found.hashes
        pairs = mix(before * np.uint64(3) + found.hashes) & mask
    repeats = np.where(before == found.hashes, SAME & mask, NEW & mask)
    return Features(buck[order], first, which, pairs.astype(np.int64), repeats.astype(np.int64), found.first, begins)


def logits(found: Features, weights: np.ndarray, bias: float) -> np.ndarray:
    """The score of each text before the softmax: the mean weight of its features, and the bias."""
    of_word = np.add.reduceat(np.append(weights[found.words], 0.0), found.first[:-1]) if len(found.first) > 1 else np.empty(0)
    value, count = of_word[found.which], np.diff(found.first)[found.which].astype(float)
    value = value + np.where(found.begins, 0.0, weights[found.pairs] + weights[found.repeats])
    count = count + np.where(found.begins, 0, 2)
    total = np.concatenate([[0.0], np.cumsum(value)])
    many = np.concatenate([[0.0], np.cumsum(count)])
    low, high = found.bounds[:-1], found.bounds[1:]
    return (total[high] - total[low]) / np.maximum(many[high] - many[low], 1) + bias


def counted_features(column: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The distinct features of each text and the share of each."""
    found = features_of(column, buckets)
    for a, b in zip(found.bounds[:-1], found.bounds[1:]):
        w = found.which[a:b]
        own = found.words[runs(found.first[w], found.first[w + 1] - found.first[w])]
        rest = slice(a + 1, b) if b > a else slice(a, a)
        every = np.concatenate([own, found.pairs[rest], found.repeats[rest]])
        index, count = np.unique(every, return_counts=True)
        yield index.astype(np.int32), (count / max(len(every), 1)).astype(np.float32)


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, buckets: int = 1 << 17, width: int = 8, steps: int = 12_000, rate: float = 0.5, seed: int = 7) -> tuple[np.ndarray, float]:
    """Learn embeddings and softmax layer; returns the weight of each feature and the bias.

    One step per text, ``steps`` in all over several passes; classes weigh alike.  The same rows in the
    same order give the same model.
    """
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / width, 1 / width, (buckets, width)).astype(np.float32)
    layer, bias = np.zeros((width, 2), np.float32), np.zeros(2, np.float32)
    share = np.bincount(labels, minlength=2) / max(len(labels), 1)
    weigh = np.where(share > 0, 0.5 / np.maximum(share, 1e-9), 0).clip(0, 4)
    epochs, done = -(-steps // max(len(docs), 1)), 0
    steps = epochs * len(docs)
    for _ in range(epochs):
        for k in rng.permutation(len(docs)):
            index, part = docs[k]
            pace = rate * (1 - done / steps) * weigh[labels[k]]
            done += 1
            mean = part @ table[index]
            out = mean @ layer + bias
            out = np.exp(out - out.max())
            out /= out.sum()
            out[labels[k]] -= 1
            back = layer @ out
            layer -= pace * np.outer(mean, out)
            bias -= pace * out
            table[index] -= (pace * 20) * np.outer(part, back)
    return table @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled texts outside the held-out fold (crc32 of the id mod 4 is 2): doc_id, text, y.

    Which ones is decided by a hash of the id, so it doesn't depend on how the tables are partitioned.
    """
    kept = labels.where((crc_of_id(F.col("doc_id")) % 4 != 2) & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    kept = kept.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("long").alias("y"))
    kept = kept.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # One text an id, so a repeated id can't exceed the bound.
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(kept), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))


def learned(rows: DataFrame, buckets: int) -> tuple[np.ndarray, float] | float:
    """The weights and the bias, or the share of label 1 where there is one kind only, 0.5 without rows.

    Texts become counted features where they lie; one task learns from those, and the driver gets the weights.
    """
    features = pa.schema([("doc_id", pa.int64()), ("y", pa.int64()), ("index", pa.list_(pa.int32())), ("share", pa.list_(pa.float32()))])
    model = pa.schema([("kinds", pa.int64()), ("share", pa.float64()), ("weights", pa.binary()), ("bias", pa.float64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            index, part = zip(*counted_features(batch.column("text"), buckets))
            ends = np.concatenate([[0], np.cumsum([len(i) for i in index])]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x))) for x in (index, part)]
            yield batch_of(features, batch.column("doc_id"), batch.column("y"), *lists)

    def learn(some: pa.Table) -> pa.Table:
        some = some.sort_by("doc_id")
        y = some.column("y").to_numpy()
        kinds, weights, bias = len(np.unique(y)), b"", 0.0
        if kinds > 1:
            docs = [(i.values.to_numpy(), p.values.to_numpy()) for i, p in zip(some.column("index"), some.column("share"))]
            found, bias = train(docs, y, buckets)
            weights = found.astype("<f8").tobytes()
        return pa.Table.from_batches([batch_of(model, [kinds], [float(y.mean())], [weights], [bias])])

    made = rows.mapInArrow(count, "doc_id long, y long, index array<int>, share array<float>")
    found = made.groupBy(F.lit(1).alias("all")).applyInArrow(learn, "kinds long, share double, weights binary, bias double").first()
    if found is None:
        return 0.5
    return (np.frombuffer(found["weights"], "<f8"), found["bias"]) if found["kinds"] > 1 else found["share"]


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = 2000, score: str = "score") -> DataFrame:
    """``docs`` with one more column: how likely label 1 is, 0 to 1.

    ``most`` bounds the labelled rows that the model learns from; every whole text is scored.  Only the
    text counts; nulls and texts without words get the score of no features.  Without labels, or with
    one kind only, every score is that of the labels' share.  All columns of ``docs`` stay; a column
    with the name of ``score`` is replaced.
    """
    spark = docs.sparkSession
    buckets = 1 << 17
    found = learned(training_rows(docs, labels, label, most), buckets)
    if isinstance(found, float):
        return docs.withColumn(score, F.lit(found))
    model = spark.sparkContext.broadcast(found)
    out = docs.drop(score)
    mine = fresh_name(out, "score_")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        for batch in in_slices(batches, "text"):
            value = logits(features_of(batch.column("text"), buckets), weights, bias)
            found = 1 / (1 + np.exp(-np.clip(value, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, mine])

    return out.mapInArrow(add, f"{schema}, `{mine}` double").withColumnRenamed(mine, score)
