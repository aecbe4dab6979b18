import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from rows import awkward, documents

from ratewell.llm.toxicity import INSULTS, NAMES, NEAR, SECOND_PERSON, features_of, hashes_of, learned, plain_tokens, score_toxicity

SMALL = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ", "abcdefghijklmnopqrstuvwxyz" + "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ")
TEXTS = [
    "", None, "   ", "You are an idiot, you know!!", "An 1d10t. A m*o*r*o*n! Not st-up-id", "IDIOT and SCUM??", "du Dummkopf", "ÀÉ éà",
    "loooser looser", "no insult here... at all, my friend", "zebra quagga zebra", "quagga you", "idiot " * 3 + "word " * 10 + "your", "a1b2 33 4c",
]


def plain(text, entries, weight):
    """The features of one text, word by word; ``entries`` maps words to weights."""
    text = text or ""
    small = text.translate(LOWER)
    word = "[0-9a-z\\u0080-\\U0010ffff]+"
    words = re.findall(word, small)
    raw = [m.group() for m in re.finditer("[0-9A-Za-z\\u0080-\\U0010ffff]+", text)]
    n = max(len(words), 1)
    seed, person = [w in INSULTS for w in words], [w in SECOND_PERSON for w in words]
    value = [weight.get(w, 0.0) for w in words]
    strong, mild = [v >= 3 for v in value], [1 <= v < 3 for v in value]
    hits = [k for k in range(len(words)) if seed[k] or strong[k]]
    near = sum(any(person[j] for j in range(max(0, k - NEAR), min(len(words), k + NEAR + 1))) for k in hits)
    data = text.encode()
    letters = max(sum(chr(b).isalpha() and b < 128 or b >= 128 for b in data), 1)
    marks = [33 <= b < 127 and not chr(b).isalnum() for b in data]
    folded = re.findall(word, "".join(c for c in small if c not in "*._-").translate(str.maketrans("013457$@", "oieastsa")))
    hidden = sum(w in INSULTS or entries.get(w, 0) >= 3 for w in folded)
    digits = [sum(c in "0123456789" for c in w) for w in words]
    triples = sum(data[k] == data[k - 1] == data[k - 2] and (chr(data[k]).isalpha() or data[k] >= 128) for k in range(2, len(data)))
    size = max(len(data), 1)
    return [
        math.log1p(len(words)), sum(seed) / n, math.log1p(sum(seed)), sum(strong) / n, math.log1p(sum(strong)), sum(mild) / n, math.log1p(sum(mild)),
        sum(value) / n, max(value, default=0.0), sum(person) / n, near / max(len(hits), 1),
        sum(65 <= b < 91 for b in data) / letters, sum(len(w.encode()) > 1 and all("A" <= c <= "Z" for c in w) for w in raw) / n,
        data.count(b"!") / size, data.count(b"?") / size, sum(marks) / size, sum(marks[k] and data[k] == data[k - 1] for k in range(1, len(data))) / size,
        math.log1p(max(hidden - len(hits), 0)), sum(0 < d < len(w.encode()) for d, w in zip(digits, words)) / n, triples / letters,
    ]


@pytest.mark.parametrize("label", [None, 0, 1])
def test_features_against_brute_force(label):
    counts = {"zebra": (9, 0), "quagga": (5, 2), "friend": (2, 0), "word": (40, 39)}
    n_toxic, n_clean = 50, 400

    def weight(toxic, clean, n_toxic, n_clean):
        return max(math.log((toxic + 0.5) / (n_toxic + 1) / ((clean + 0.5) / (n_clean + 1))), 0) if toxic >= 2 else 0

    order = sorted(counts, key=lambda w: hashes_of([w])[0])
    lexicon = learned(hashes_of(order), *(np.array([counts[w][k] for w in order], float) for k in (0, 1)), n_toxic, n_clean)
    full = {w: weight(*c, n_toxic, n_clean) for w, c in counts.items()}
    own = full
    if label == 0:
        own = {w: weight(t, max(c - 1, 0), n_toxic, n_clean - 1) for w, (t, c) in counts.items()}
    if label == 1:
        own = {w: weight(t - 1, c, n_toxic - 1, n_clean) for w, (t, c) in counts.items()}
    y = None if label is None else np.full(len(TEXTS), label)
    found = features_of(pa.array(TEXTS), lexicon, hashes_of(INSULTS), hashes_of(SECOND_PERSON), y)
    assert found.shape == (len(TEXTS), len(NAMES))
    for text, got in zip(TEXTS, found):
        for name, a, b in zip(NAMES, got, plain(text, full, own)):
            assert a == pytest.approx(b), (text, name)


def test_words_of_all_texts_have_one_hash():
    found = plain_tokens(pa.array(["Éa b", "éA"]))
    assert found.hashes[0] == found.hashes[2] and len(found.hashes) == 3


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    return {r.doc_id: r.score for r in score_toxicity(docs, labels).select("doc_id", "score").collect()}


def test_held_out_accuracy(spark, scored):
    rows = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    seen = Counter((r.toxic, scored[r.doc_id] >= 0.7) for r in held)
    assert seen[0, True] == 0 and seen[1, True] >= 0.75 * (seen[1, True] + seen[1, False]) and len(held) > 80


def test_held_out_labels_sources_and_languages_are_not_learned(spark, scored):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    two = {r.doc_id: r.score for r in score_toxicity(docs.drop("lang", "source"), turned).collect()}
    assert all(abs(scored[k] - two[k]) < 1e-6 for k in scored)


def test_toxicity_of_awkward_rows(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").withColumn("text", F.lit("clash"))
    few = labels.where("doc_id < 60")
    rows = awkward()
    for clashing in (False, True):
        docs = documents(spark, rows, clashing)
        if clashing:
            docs = docs.withColumn("dense", F.lit("clash")).withColumn("margin", F.lit("clash")).withColumn("rawPrediction", F.lit("clash"))
        found = score_toxicity(docs, few.withColumn("toxic", (F.col("doc_id") % 2)), trees=2)
        assert set(found.columns) == set(docs.columns) | {"score"} and found.count() == len(rows)
        same = {}
        for r in found.collect():
            assert 0 <= r.score <= 1
            assert same.setdefault(r.text or "", r.score) == r.score
    docs = documents(spark, rows)
    assert score_toxicity(docs, labels.limit(0)).first().score == 0.5
    assert score_toxicity(docs, few.withColumn("toxic", F.lit(1))).first().score == 1.0
    assert score_toxicity(docs.limit(0), labels).count() == 0
