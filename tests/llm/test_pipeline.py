import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import SF, awkward, documents
from test_jaccard import brute
from test_secrets import base_spans
from test_tiling import tiled, tokens
from test_tokens import plain

import corpus_pipeline
from ratewell.llm.queries import WORD_BPE


def written(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    made, last = [], docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        last = written(stage(spark, last, SF), tmp_path / str(k))
        made.append(last)
        if k < 4:
            assert last.columns == docs.columns

    good = rows_of(made[0])
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    kept = {i for i, _ in good}
    assert sum((i in kept) == (q == 1) for i, q in labels.items()) >= 0.97 * len(labels)

    one = rows_of(made[1])
    expected = sorted(i for i, _, c in brute(good, 5, 80) if i == c)
    assert sorted(i for i, _ in one) == expected and len(expected) < len(good)

    items = [tokens(t) for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    seeds = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in items]
    clean = rows_of(made[2])
    expected = []
    for i, t in one:
        w = tokens(t)
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        near = [k for k, s in enumerate(seeds) if len(s & own) * 5 >= 0.5 * len(items[k])]
        if not any(tiled(items[k], _around(w, seeds[k]), 5) >= 0.5 * len(items[k]) for k in near):
            expected.append(i)
    assert sorted(i for i, _ in clean) == sorted(expected) and len(clean) < len(one)

    masked = dict(rows_of(made[3]))
    assert sorted(masked) == sorted(i for i, _ in clean)
    changed = 0
    for i, t in clean:
        if not base_spans(t):
            assert masked[i] == t or "[SECRET]" in masked[i]
        changed += masked[i] != t
        assert len(re.findall("[0-9a-f]{24,}", masked[i])) == 0
    assert changed == sum(bool(base_spans(t)) for _, t in clean)

    found = made[4].collect()
    pieces = []
    for i, ids in zip(masked, plain(WORD_BPE, masked.values())):
        ids = np.append(ids, 1).astype("<u4")
        pieces += [(i, k, at, zlib.crc32(ids[at : at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
    assert sorted((r.doc_id, r.piece, r.start, r.ids_crc32) for r in found) == sorted(pieces)
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect()) == sorted(
        tuple(r) for r in made[4].drop("sequence_id", "offset").collect()
    )


def _around(words, seeds):
    """The words of seeds, with a mark where others are left out."""
    inside = np.zeros(len(words), bool)
    for k in range(len(words) - 4):
        if tuple(words[k : k + 5]) in seeds:
            inside[k : k + 5] = True
    found = []
    for k, w in enumerate(words):
        if inside[k]:
            found.append(w)
        elif found and found[-1] is not None:
            found.append(None)
    return found


def test_repeated_ids_of_unlike_texts_lose_no_document(spark):
    rng = np.random.default_rng(3)
    a, b, c, d = (" ".join(f"{x}{k}" for k in rng.integers(0, 900, 60)) for x in "abcd")
    rows = [(5, a), (5, b), (3, b), (5, c), (7, d), (7, d), (None, d), (8, d + " more"), (None, c + " x"), (9, None), (9, ""), (9, None)]
    found = corpus_pipeline.one_of_each_group(spark, documents(spark, rows).repartition(3), SF).select("doc_id", "text").collect()
    assert sorted(map(str, found)) == sorted(
        str(spark.createDataFrame([r], "doc_id long, text string").first()) for r in [(5, a), (3, b), (5, c), (7, d), (9, None), (9, ""), (9, None)]
    )


@pytest.mark.parametrize("clashing", [False, True])
def test_awkward_rows_and_empty_tables(spark, tmp_path, clashing):
    rows = awkward()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = documents(spark, rows, clashing)
        if clashing:
            docs = docs.withColumn("quality_score", F.lit("clash")).withColumn("plain", F.lit("clash")).withColumn("state", F.lit("clash"))
        found = written(stage(spark, docs, SF), tmp_path / f"{k}")
        assert k == 4 or found.columns == docs.columns, name
        if name == "n-gram Jaccard join":
            ids = [r.doc_id for r in found.select("doc_id").collect()]
            assert sorted(i for i in ids if i is not None) == sorted({i for i, _, c in brute(rows, 5, 80) if i is not None and i == c})
            assert ids.count(None) == 2  # one text without words, one that no other is like
        if name in ("benchmark decontamination", "secret scans"):
            assert found.count() == len(rows)
        assert stage(spark, docs.limit(0), SF).count() == 0, name


