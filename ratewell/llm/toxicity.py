"""Toxicity of texts by gradient-boosted trees over dense features, calibrated by isotonic regression.

A text is a row of densities: words of a fixed lexicon and of one learned from labels, how near they
stand to the second person, capitals, punctuation and signs of obfuscation.  The trees and the
calibration are trained by Spark on a bounded sample of labelled rows; the calibration on rows that the trees don't see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import batch_of, crc_of_id, fresh_name
from ratewell.llm.words import in_slices, text_bytes, word_hashes
from ratewell.staging import stage

INSULTS = """
idiot idiots moron morons stupid loser losers trash scum worthless disgusting pathetic clown dumb fool
fools jerk pig scumbag garbage filthy filth vermin freak ugly hate bastard bitch damn crap shut sucks
dumm dummkopf trottel blöd blödmann arsch arschloch schwein abschaum widerlich versager depp
idiote imbécile crétin débile salaud ordure connard con abruti dégoûtant
idiota imbécil estúpido estúpida tonto tonta basura asqueroso inútil payaso cerdo
""".split()
SECOND_PERSON = """
you your yours yourself yourselves u ur
du dich dir dein deine deinen deiner ihr euch euer eure
tu toi te ton ta tes vous votre vos
tú ti tus usted ustedes vosotros vuestro
""".split()
NEAR = 5  # words between an insult and the second person
# Marks that stand for letters, and marks that part the letters of a word.
FOLDED = dict(zip("013457$@", "oieastsa"))
PARTING = "*._-"
NAMES = (
    "words", "seed_density", "seed_hits", "strong_density", "strong_hits", "mild_density", "mild_hits", "weight_density", "heaviest",
    "second_person", "near_second_person", "capitals", "capital_words", "exclamations", "questions", "marks", "repeated_marks",
    "hidden_hits", "mixed_words", "long_runs",
)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_FOLD = _LOWER.copy()
for _mark, _letter in FOLDED.items():
    _FOLD[ord(_mark)] = ord(_letter)
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LETTER = _WORD.copy()
_LETTER[0x30:0x3A] = False
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


@dataclass(frozen=True)
class Tokens:
    """The hashed words of some texts, text i has first[i]:first[i + 1], and where they stand."""

    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z and the capitals from U+00C0 to U+00DE as small letters."""
    data = _LOWER[raw]
    wide = np.zeros(len(raw), bool)
    wide[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    data[wide] += 0x20
    return data


def tokens_of(data: np.ndarray, bounds: np.ndarray) -> Tokens:
    inside = _WORD[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = bounds[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Tokens(word_hashes(data, start, end), np.searchsorted(start, bounds), start, end)


def plain_tokens(column: pa.Array) -> Tokens:
    raw, bounds = text_bytes(column)
    return tokens_of(lowered(raw), bounds)


def hashes_of(words: list[str]) -> np.ndarray:
    return np.unique(plain_tokens(pa.array(words)).hashes)


def known(hashes: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are among sorted entries, and the place of each."""
    if not len(entries):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    place = np.minimum(np.searchsorted(entries, hashes), len(entries) - 1)
    return entries[place] == hashes, place


def weights(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """The log of how much likelier a word is in toxic texts; nothing for words of fewer than two of them."""
    value = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return np.where(toxic >= 2, np.maximum(value, 0), 0)


def learned(entries: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> tuple:
    """A lexicon: sorted hashes and the weight of each, for a new text, a clean and a toxic one of those it was learned from.

    A text it was learned from is weighed by what the others say, so that it doesn't vouch for itself.
    """
    return (
        entries,
        weights(toxic, clean, n_toxic, n_clean),
        weights(toxic, np.maximum(clean - 1, 0), n_toxic, max(n_clean - 1, 0)),
        weights(np.maximum(toxic - 1, 0), clean, max(n_toxic - 1, 0), n_clean),
    )


def features_of(column: pa.Array, lexicon: tuple, seeds: np.ndarray, second: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """A row of ``NAMES`` for each text; ``label`` where the lexicon was learned from these texts."""
    raw, bounds = text_bytes(column)
    n, low, high = len(bounds) - 1, bounds[:-1], bounds[1:]
    found = tokens_of(lowered(raw), bounds)
    first, owner = found.first, np.repeat(np.arange(n), np.diff(found.first))
    words = np.maximum(np.diff(first), 1)
    per_word = lambda flags: np.add.reduceat(np.append(flags.astype(float), 0.0), first[:-1]) * (np.diff(first) > 0)
    upto = lambda flags: np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    per_byte = lambda flags: (lambda t: t[high] - t[low])(upto(flags)).astype(float)

    entries, *tables = lexicon
    hit, place = known(found.hashes, entries)
    pick = np.zeros(n, np.int64) if label is None else label + 1
    weight = np.zeros(len(found.hashes))
    for k, table in enumerate(tables):
        own = hit & (pick[owner] == k)
        weight[own] = table[place[own]]
    seed = known(found.hashes, seeds)[0]
    strong, mild = weight >= 3, (weight >= 1) & (weight < 3)
    heaviest = np.zeros(n)
    np.maximum.at(heaviest, owner, weight)

    # The last and the next word of the second person within a text, seen from each hit.
    person = known(found.hashes, second)[0]
    at = np.flatnonzero(person)
    hits = np.flatnonzero(seed | strong)
    near = np.zeros(len(hits), bool)
    if len(at):
        after = np.searchsorted(at, hits)
        for spot in (np.minimum(after, len(at) - 1), np.maximum(after - 1, 0)):
            near |= (np.abs(at[spot] - hits) <= NEAR) & (owner[at[spot]] == owner[hits])

    letters = np.maximum(per_byte(_LETTER[raw]), 1)
    chars = np.maximum((high - low).astype(float), 1)
    upper = upto(_UPPER[raw])
    size = found.end - found.start
    capital = (upper[found.end] - upper[found.start] == size) & (size > 1)
    mark = _MARK[raw]
    same = np.zeros(len(raw), bool)
    same[1:] = raw[1:] == raw[:-1]
    same[low[(low < high)]] = False
    digit = upto(_WORD[raw] & ~_LETTER[raw])
    digits = digit[found.end] - digit[found.start]
    triple = same.copy()
    triple[1:] &= same[:-1]

    keep = ~np.isin(raw, np.frombuffer(PARTING.encode(), np.uint8))
    folded = tokens_of(_FOLD[lowered(raw)[keep]], upto(keep)[bounds])
    shown = per_word(seed | strong)
    others = known(folded.hashes, seeds)[0]
    in_lexicon, spots = known(folded.hashes, entries)
    others |= in_lexicon & (tables[0][spots] >= 3 if len(entries) else False)
    hidden = np.add.reduceat(np.append(others.astype(float), 0.0), folded.first[:-1]) * (np.diff(folded.first) > 0)

    return np.column_stack([
        np.log1p(np.diff(first)), per_word(seed) / words, np.log1p(per_word(seed)), per_word(strong) / words, np.log1p(per_word(strong)),
        per_word(mild) / words, np.log1p(per_word(mild)), np.bincount(owner, weight, n) / words, heaviest,
        per_word(person) / words, np.bincount(owner[hits], near, n) / np.maximum(shown, 1),
        per_byte(_UPPER[raw]) / letters, per_word(capital) / words, per_byte(raw == 0x21) / chars, per_byte(raw == 0x3F) / chars,
        per_byte(mark) / chars, per_byte(mark & same) / chars, np.log1p(np.maximum(hidden - shown, 0)),
        per_word((digits > 0) & (digits < size)) / words, per_byte(triple & _LETTER[raw]) / letters,
    ])


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled texts outside the held-out fold (crc32 of the id mod 3 is 1): doc_id, text, y; a text an id.

    Which ones is decided by a hash of the id, so it doesn't depend on how the tables are partitioned.
    """
    kept = labels.where((crc_of_id(F.col("doc_id")) % 3 != 1) & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    kept = kept.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("long").alias("y"))
    kept = kept.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(kept), "doc_id")
    return texts.groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def word_counts(rows: DataFrame) -> DataFrame:
    """How many toxic and how many clean texts hold each word: word (its hash), toxic, clean."""
    schema = pa.schema([("word", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            found = plain_tokens(batch.column("text"))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(found.first))
            order = np.lexsort((owner, found.hashes))
            hashes, owner = found.hashes[order], owner[order]
            once = np.ones(len(hashes), bool)
            once[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            hashes, y = hashes[once], batch.column("y").to_numpy()[owner[once]]
            words, which = np.unique(hashes, return_inverse=True)
            toxic = np.bincount(which, y, len(words)).astype(np.int64)
            yield batch_of(schema, words.view(np.int64), toxic, np.bincount(which, minlength=len(words)) - toxic)

    made = rows.select("text", "y").mapInArrow(count, "word long, toxic long, clean long")
    return made.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(rows: DataFrame, n_toxic: int, n_clean: int, most_words: int) -> tuple:
    """The ``most_words`` words that tell most of toxic texts, of those that three toxic texts or more hold."""
    ratio = (F.col("toxic") + 0.5) / (n_toxic + 1) / ((F.col("clean") + 0.5) / (n_clean + 1))
    told = word_counts(rows).where((F.col("toxic") >= 3) & (ratio >= 2)).orderBy(F.desc(F.col("toxic") * F.log(ratio)), "word").limit(most_words)
    found = told.toArrow()
    words = found.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    counts = [found.column(c).to_numpy()[order].astype(float) for c in ("toxic", "clean")]
    return learned(words[order], *counts, n_toxic, n_clean)


def with_features(rows: DataFrame, shared, label: str | None, name: str) -> DataFrame:
    """``rows`` with their features as one more column, an array."""
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, seeds, second = shared.value
        for batch in in_slices(batches, "text"):
            y = None if label is None else batch.column(label).to_numpy()
            found = features_of(batch.column("text"), lexicon, seeds, second, y)
            lists = pa.ListArray.from_arrays(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, name])

    return rows.mapInArrow(add, f"{kind}, `{name}` array<double>")


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = 20_000, most_words: int = 1 << 16, trees: int = 20, depth: int = 3, score: str = "score") -> DataFrame:
    """``docs`` (doc_id, text) with one more column: how likely label 1 is, 0 to 1.

    Learns from ``most`` labelled rows outside the held-out fold: a lexicon of at most ``most_words`` words, the
    trees from two thirds of the rows, by a hash of the id, and the calibration from the rest.  Where that
    rest has one class only, all rows calibrate.  Every whole text is scored, and by the text alone; null
    and empty texts get the score of a text without words.  Without labels, or with one kind only, every
    score is that of the labels' share, 0.5 without any.  A repeated row is scored again; null ids stay;
    an empty table gives no rows.  All columns of ``docs`` stay; a column with the name of ``score`` is
    replaced.
    """
    spark = docs.sparkSession
    rows = stage(training_rows(docs, labels, label, most))
    share = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("toxic")).first()
    n_toxic, n_clean = share["toxic"], share["n"] - share["toxic"]
    if not n_toxic or not n_clean:
        return docs.withColumn(score, F.lit(float(n_toxic > 0) if share["n"] else 0.5))
    lexicon = learn_lexicon(rows, n_toxic, n_clean, most_words)
    shared = spark.sparkContext.broadcast((lexicon, hashes_of(INSULTS), hashes_of(SECOND_PERSON)))
    made = with_features(rows, shared, "y", "dense").select(
        array_to_vector("dense").alias("features"), F.col("y").cast("double").alias("label"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("rest")
    )
    made = stage(made.repartition(1))  # at most ``most`` rows of few numbers: trees are grown in many small jobs
    rest = made.where("rest")
    seen = made.where("not rest")
    kinds = made.groupBy("rest").agg(F.countDistinct("label").alias("kinds")).collect()
    kinds = {row["rest"]: row["kinds"] for row in kinds}
    if kinds.get(True, 0) < 2 or kinds.get(False, 0) < 2:
        rest = seen = made
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, cacheNodeIds=False).fit(seen)
    told = model.transform(rest).select("label", vector_to_array("rawPrediction").getItem(1).alias("margin"))
    curve = IsotonicRegression(featuresCol="margin").fit(told)

    out = docs.drop(score)
    dense, vector, raw, value = (fresh_name(out, c) for c in ("dense", "vector", "raw", "margin"))
    scored = with_features(out, shared, None, dense).withColumn(vector, array_to_vector(dense))
    model = model.setFeaturesCol(vector).setRawPredictionCol(raw).setProbabilityCol("").setPredictionCol("")
    scored = model.transform(scored).withColumn(value, vector_to_array(raw).getItem(1))
    scored = curve.setFeaturesCol(value).setPredictionCol(score).transform(scored)
    return scored.select(*out.columns, F.least(F.greatest(F.col(score), F.lit(0.0)), F.lit(1.0)).alias(score))
