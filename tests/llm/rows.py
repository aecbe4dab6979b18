"""Small awkward tables for the operators' tests."""

import random

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = "score part block class n nth row row_id spans shard slot size state plain body k v rank gram root live score_ owner hash start".split()


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def near_copies(rng, base, copies, edits):
    found = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        found.append(w)
    return found


def documents(spark, rows, clashing=False):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if clashing:
        for c in CLASHING:
            df = df.withColumn(c, F.lit("clash"))
    return df


def awkward(seed=1):
    """Nulls, empty and blank texts, a very long one, exact and near copies, repeated rows, odd characters."""
    rng = random.Random(seed)
    base = words(rng, 120)
    rows = [(k, " ".join(words(rng, rng.randint(1, 90)))) for k in range(1, 40)]
    rows += [(100 + k, " ".join(w)) for k, w in enumerate(near_copies(rng, base, 25, 6))]
    rows += [(200 + k, " ".join(base)) for k in range(5)]
    rows += [(300, None), (301, ""), (302, "  \t\n\x0b "), (303, None), (None, "no id here at all"), (None, None)]
    rows += [(304, "Ünïcode ÀÉ   words here 日本 𝔘 é"), (305, "ONE two"), (306, "one TWO"), (307, "one  two")]
    rows += [(308, " ".join(words(rng, 30_000, 5_000)))]
    rows += [(1, rows[0][1]), (200, " ".join(base))]
    return rows
