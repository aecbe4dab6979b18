import random

from pyspark.sql import functions as F
from rows import awkward, documents, words

from ratewell.llm.tiling import find_leaks, without_leaks


def tokens(text):
    held, found = "", []
    for c in (text or "").lower() + " ":
        if ord(c) < 128 and not c.isalnum():
            found += [held] if held else []
            held = ""
        else:
            held += c
    return found


def tiled(item, text, shortest):
    """Greedy string tiling in its plain form: words covered."""
    a, b, covered = [False] * len(item), [False] * len(text), 0
    while True:
        best = 0, 0, 0
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and not a[i + n] and not b[j + n] and item[i + n] == text[j + n]:
                    n += 1
                if n > best[0]:
                    best = n, i, j
        n, i, j = best
        if n < shortest:
            return covered
        for k in range(n):
            a[i + k] = b[j + k] = True
        covered += n


def benchmark(spark, items, clashing=False):
    df = spark.createDataFrame(items, "item_id long, text string")
    return df.withColumn("doc_id", F.lit("clash")).withColumn("lang", F.lit(1)) if clashing else df


def leaky(seed=2):
    rng = random.Random(seed)
    items = [words(rng, rng.randint(8, 30), 60) for _ in range(12)]
    rows = [(k, " ".join(words(rng, rng.randint(1, 60), 60))) for k in range(20)]
    for k, item in enumerate(items):
        cut = len(item) // 2
        around = lambda: words(rng, 12, 60)
        rows.append((100 + k, " ".join(around() + item + around())))
        rows.append((200 + k, " ".join(around() + item[cut:] + around() + item[:cut] + around())))
        rows.append((300 + k, " ".join(around() + item[: cut // 2] + around())))
        rows.append((400 + k, ("! ".join(item)).upper()))
        rows.append((500 + k, " ".join(item[:6] * 4)))
    return items, rows


def test_against_plain_tiling(spark):
    items, rows = leaky()
    table = [(k, " ".join(w)) for k, w in enumerate(items)] + [(90, None), (91, ""), (None, "one two three four five six"), (92, "short item")]
    rows += [(600, "short item"), (601, "a short item"), (602, "One, two three four five six!")]
    expected = sorted(
        ((doc, item, len(tokens(t)), n) for doc, d in rows for item, t in table
         if tokens(t) and (n := tiled(tokens(t), tokens(d), min(5, len(tokens(t))))) >= 0.5 * len(tokens(t)) and
         (len(tokens(t)) >= 5 or tokens(t) == tokens(d))),
        key=str,
    )
    for block in (1, 8 << 20):  # one item a block, and all in one
        found = find_leaks(documents(spark, rows), benchmark(spark, table, True), 5, 0.5, block).collect()
        assert sorted(((r.doc_id, r.item_id, r.n_words, r.n_covered) for r in found), key=str) == expected
    reordered = [r for r in found if r.doc_id and 200 <= r.doc_id < 300 and r.item_id == r.doc_id - 200]
    assert all(r.n_covered >= r.n_words - 9 for r in reordered) and len(reordered) >= 8
    by = dict(rows)
    for r in found:
        item = tokens(dict(table)[r.item_id])
        text = tokens(by[r.doc_id])
        for t in r.tiles:
            assert item[t.in_item : t.in_item + t.words] == text[t.in_doc : t.in_doc + t.words]


def test_kept_rows_keep_all_columns(spark):
    items, rows = leaky(3)
    rows = rows + [(i and i + 5000, t) for i, t in awkward()]
    docs = documents(spark, rows, clashing=True)
    bench = benchmark(spark, [(k, " ".join(w)) for k, w in enumerate(items)], True)
    gone = {r.doc_id for r in find_leaks(docs, bench).collect()}
    kept = without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == sorted((i or -1, t or "") for i, t in rows if i not in gone)


def test_empty_tables(spark):
    none, some = documents(spark, []), documents(spark, [(1, "a b c d e f")])
    items = benchmark(spark, [(1, "a b c d e f")])
    assert find_leaks(none, items).collect() == [] and without_leaks(none, items).collect() == []
    assert find_leaks(some, items.limit(0)).collect() == [] and without_leaks(some, items.limit(0)).count() == 1
    assert len(find_leaks(some, items).collect()) == 1
