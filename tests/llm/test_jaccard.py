import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from rows import awkward, documents, near_copies, words

from ratewell.llm import jaccard
from ratewell.llm.components import connected
from ratewell.llm.jaccard import SIGNS, global_order, heads, hopeful, jaccard_components, linked_pairs, of_pairs, once, wanted_segments


def sets_of(rows, size):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = []
    for _, text in rows:
        w, held = [], ""
        for c in (text or "").translate(lower) + " ":
            if c in " \t\n\x0b\x0c\r":
                w += [held] if held else []
                held = ""
            else:
                held += c
        found.append({tuple(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set())
    return found


def brute(rows, size, percent):
    sets = sets_of(rows, size)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    return sorted(((rows[k][0], len(sets[k]), least.get(find(k))) for k in range(len(rows))), key=str)


def found_by(spark, rows, size, percent, clashing=False):
    found = jaccard_components(documents(spark, rows, clashing), size, percent, fragments=4)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str)


@pytest.mark.parametrize("size, percent, clashing", [(4, 85, False), (5, 80, True), (1, 60, False)])
def test_against_brute_force(spark, size, percent, clashing):
    rows = awkward(size)
    assert found_by(spark, rows, size, percent, clashing) == brute(rows, size, percent)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_with_chains_and_outliers(spark, seed):
    rng = random.Random(seed)
    rows, at = [], 0
    for _ in range(4):
        base = words(rng, rng.randint(30, 150), 3000)
        for w in near_copies(rng, base, 40, rng.randint(2, 9)):
            at += 1
            rows.append((at, " ".join(w)))
        for _ in range(10):  # a chain: each a small step from the last
            base = near_copies(rng, base, 1, 3)[0]
            at += 1
            rows.append((at, " ".join(base)))
    passage = " ".join(words(rng, 60, 3000))  # shared by documents that are otherwise unlike
    for _ in range(40):
        at += 1
        rows.append((at, " ".join(words(rng, rng.randint(5, 60), 3000)) + " " + passage))
    rng.shuffle(rows)
    assert found_by(spark, rows, 4, 85) == brute(rows, 4, 85)


def test_copies_bring_their_segments_once(spark):
    rng = random.Random(5)
    base = words(rng, 90, 3000)
    near = [*base[:-1], "other"]
    rows = [(k, " ".join(base if k % 2 else near)) for k in range(60)]
    docs = documents(spark, rows).repartition(4)
    order = spark.sparkContext.broadcast(global_order(docs, 4, 4))
    found = heads(docs, order, 4, 85)
    one, two = found.select("class", "n").distinct().collect()
    pairs = spark.createDataFrame([(one["class"], one["n"], two["class"], two["n"])], "a long, na long, b long, nb long")
    parts = wanted_segments(docs, pairs, order, 4)
    assert 2 <= once(parts).count() == parts.select("class", "fragment").distinct().count() <= 8 and parts.count() <= 4 * 8
    assert [(r.a, r.b) for r in linked_pairs(pairs, parts, 85, 4).collect()] == [(one["class"], two["class"])]
    assert hopeful(pairs, of_pairs(parts, pairs), 85, 4).count() == 1
    assert found_by(spark, rows, 4, 85) == brute(rows, 4, 85)


def test_classes_with_one_passage_that_cannot_link_do_not_meet(spark):
    # 17 shared n-grams after 3 own: 17 / 23 is below the threshold.
    rows = [(1, 3, k, 20, k, 0, 500) for k in range(500)]
    posted = spark.createDataFrame(rows, "gram long, pos int, class long, n long, root long, main long, holders long")
    posted = posted.select("*", *[F.lit(0).cast("long").alias(c) for c in SIGNS])
    keys = ["gram", "high", "low"]
    assert jaccard.by_size(posted, 85, True).join(jaccard.by_size(posted, 85, False), keys).count() == 0


def test_pairs_by_size_are_those_of_all(spark, monkeypatch):
    rng = random.Random(3)
    rows = []
    for k in range(300):
        n = rng.choice([rng.randint(1, 40), rng.randint(110, 150), rng.randint(900, 1100)])
        rows.append((k % 2, rng.randint(0, n - -(-85 * n // 100)), k, n, rng.randint(0, 60), 7, 150))
    posted = spark.createDataFrame(rows, "gram long, pos int, class long, n long, root long, main long, holders long")
    posted = posted.select("*", *[F.lit(0).cast("long").alias(c) for c in SIGNS])
    need = lambda n, m: -(-85 * (n + m) // 185)
    expected = {
        (x[2], x[3], y[2], y[3]) for x in rows for y in rows
        if x[2] < y[2] and x[0] == y[0] and x[4] != y[4] and 100 * min(x[3], y[3]) >= 85 * max(x[3], y[3])
        and x[3] - x[1] >= need(x[3], y[3]) <= y[3] - y[1]
    }
    for several in (1, 1000):
        monkeypatch.setattr(jaccard, "SEVERAL", several)
        found = [tuple(r) for r in jaccard.crossed_pairs(posted, 85).collect()]
        assert len(found) == len(set(found)) and set(found) == expected and expected


def test_components_where_all_pairs_go_by_size(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SEVERAL", 1)
    rng = random.Random(4)
    passage = words(rng, 30, 3000)
    rows = [(k, " ".join([*words(rng, rng.randint(0, 6), 3000), *passage])) for k in range(60)]
    rows += [(100 + k, " ".join(w)) for k, w in enumerate(near_copies(rng, words(rng, 200, 3000), 30, 9))]
    assert found_by(spark, rows, 4, 85) == brute(rows, 4, 85)


def test_pairs_that_the_rare_fragments_tell_apart(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(w)) for k, w in enumerate(near_copies(rng, words(rng, 400, 9000), 6, 8))]
    rows += [(10 + k, " ".join(words(rng, 400, 9000))) for k in range(6)]
    docs = documents(spark, rows)
    order = spark.sparkContext.broadcast(global_order(docs, 4, 16))
    found = heads(docs, order, 4, 85).select("doc_id", "class", "n").collect()
    pairs = [(x["class"], x.n, y["class"], y.n) for x in found for y in found if x.doc_id < y.doc_id]
    pairs = spark.createDataFrame(pairs, "a long, na long, b long, nb long")
    parts = wanted_segments(docs, pairs, order, 4)
    kept = {(r.a, r.b) for r in hopeful(pairs, parts, 85, 16).collect()}
    linked = {(r.a, r.b) for r in linked_pairs(pairs, parts, 85, 16).collect()}
    assert linked and linked <= kept and len(kept) < 40 < pairs.count()


def test_empty_table(spark):
    assert jaccard_components(documents(spark, [])).collect() == []


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(100, 200), (200, 300), (300, 100), (7, 7), (100, 200)] + [(500, k) for k in range(501, 560)]
    found = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{k: 1 for k in range(1, 61)}, 100: 100, 200: 100, 300: 100, **{k: 500 for k in range(500, 560)}}
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_texts_reach_the_workers_in_small_batches(spark, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(key)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])

    def recorded(run):
        def measured(*args):
            long = spark.range(0, 24, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
            seen.append(max(r.bytes for r in long.mapInArrow(sizes, "bytes long").collect()))
            return run(*args)

        return measured

    for name in ("global_order", "stage", "bit_table"):
        monkeypatch.setattr(jaccard, name, recorded(getattr(jaccard, name)))
    text = " ".join(f"w{k}" for k in range(40))
    assert found_by(spark, [(1, text), (2, text + " x"), (3, "y")], 4, 85) == [(1, 37, 1), (2, 38, 1), (3, 1, 3)]
    assert len(seen) > 3 and max(seen) < 8 << 20 and spark.conf.get(key) == before
