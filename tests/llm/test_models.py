import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from rows import awkward, documents

from ratewell.llm.backoff import grams_of, pack, score_texts, unpack, walk
from ratewell.llm.quality import NEW, SAME, features_of, logits, score_quality
from ratewell.llm.words import mix, span_hashes, words_of

SMALL = "/root/testdata/sf0.01"


def words(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.translate(lower).split(" ") if w]


def brute(rows, order, strength):
    crc = lambda i: zlib.crc32(("" if i is None else str(i)).encode())
    texts = [(i, ["<s>", *words(t or ""), "</s>"], crc(i) % 10 == 0) for i, t in rows]
    count = Counter()
    for _, w, held in texts:
        if not held:
            count.update(tuple(w[i - k : i + 1]) for i in range(len(w)) for k in range(order) if i >= k)
    single = {g: c for g, c in count.items() if len(g) == 1 and g != ("<s>",)}
    total, floor = sum(single.values()), sum(single.values()) + 0.1 * (len(single) + 1)

    def chance(gram):
        if len(gram) == 1:
            return (single.get(gram, 0) + 0.1) / floor
        return (count[gram] + strength * chance(gram[1:])) / (count[gram[:-1]] + strength)

    found = []
    for i, w, held in texts:
        base = sum(math.log10(chance((x,))) for x in w[1:])
        best = sum(math.log10(chance(tuple(w[max(0, k - order + 1) : k + 1]))) for k in range(1, len(w)))
        found.append((str(i), held, len(w) - 1, sum((x,) in single for x in w[1:]), total, round(base, 6), round(best, 6)))
    return sorted(found)


@pytest.mark.parametrize("order, block_bytes, clashing", [(2, 12 << 20, False), (2, 3000, True), (3, 20_000, False)])
def test_scores_against_brute_force(spark, order, block_bytes, clashing):
    rows = awkward()
    found = score_texts(documents(spark, rows, clashing), order, 5.0, 10, block_bytes).collect()
    got = sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found
    )
    for a, b in zip(got, brute(rows, order, 5.0), strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-4 and abs(a[6] - b[6]) < 1e-4


def test_probabilities_of_a_state_sum_to_one():
    texts = ["a b a c", "b a", "c c b"]
    every = [*texts, "a a", "a b", "a c", "a unknown", "a"]
    grams = grams_of(pa.array(every), 2)
    learn = np.arange(len(grams.at[0])) < grams.first[len(texts)]
    counts = [np.bincount(grams.at[k][learn & (grams.at[k] >= 0)], minlength=len(grams.keys[k])).astype(float) for k in range(2)]
    score = 10 ** walk(grams, counts, 12, 4, 5.0)
    after_a = [score[grams.first[k] + 2] for k in range(len(texts), len(every))]
    assert sum(after_a) == pytest.approx(1) and min(after_a) > 0


def test_keys_survive_packing():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 999, dtype=np.uint64))
    assert (unpack(pack(keys)) == keys).all() and not len(unpack(pack(keys[:0])))


def test_no_documents_no_scores(spark):
    assert score_texts(documents(spark, [])).collect() == []


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = score_quality(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 50 and len({r.quality for r in held}) == 2
    assert sum((r.score >= 0.7) == (r.quality == 1) for r in held) >= 0.98 * len(held)


@pytest.mark.parametrize("clashing", [False, True])
def test_quality_of_awkward_rows(spark, clashing):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").withColumn("text", F.lit("clash"))
    rows = awkward()
    docs = documents(spark, rows, clashing)
    found = score_quality(docs, labels)
    assert set(found.columns) == set(docs.columns) | {"score"} and found.count() == len(rows)
    same = {}
    for r in found.collect():
        assert 0 <= r.score <= 1
        assert same.setdefault(r.text or "", r.score) == pytest.approx(r.score, abs=1e-9)
    assert score_quality(docs, labels.limit(0)).first().score == 0.5
    assert score_quality(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_not_learned(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    one = {r.doc_id: r.score for r in score_quality(docs, labels).collect()}
    two = {r.doc_id: r.score for r in score_quality(docs.repartition(5).drop("lang", "source"), turned).collect()}
    assert all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_logits_against_brute_force():
    buckets, rng = 1 << 10, np.random.default_rng(5)
    weights, bias = rng.normal(size=buckets), 0.25
    texts = ["", None, "one", "One one  one two", "né à\tnaïve", "aa a aaa aaaa aaaaa", " x\ny  ", "word " * 30 + "other word word"]
    mask = np.uint64(buckets - 1)

    def hash_of(word):
        return words_of(pa.array([word]), lower=False).hashes[0]

    def plain(text):
        found = []
        words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
        for k, w in enumerate(words):
            found.append(hash_of(w) & mask)
            data = np.frombuffer(f"<{w}>".encode(), np.uint8)
            for n in (3, 4):
                for at in range(len(data) - n + 1):
                    gram = span_hashes(data[at : at + n], np.array([0]), np.array([n]))
                    found.append(mix(gram + np.uint64(n))[0] & mask)
            if k:
                with np.errstate(over="ignore"):
                    found.append(mix(np.array([hash_of(words[k - 1]) * np.uint64(3) + hash_of(w)]))[0] & mask)
                found.append((SAME if words[k - 1] == w else NEW) & mask)
        return sum(weights[int(f)] for f in found) / max(len(found), 1) + bias

    got = logits(features_of(pa.array(texts), buckets), weights, bias)
    assert got.tolist() == pytest.approx([plain(t) for t in texts])
