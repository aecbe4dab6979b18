import random
import re
import zlib
from collections import Counter

import pytest
from rows import SF, awkward, documents

from ratewell.llm.spelling import spelling_variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def brute(rows, least=7, every=31, times=10):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= least and c >= 2}
    near = {w: set() for w in n}
    for w in n:
        edits = {w[:k] + w[k + 1 :] for k in range(len(w))}
        edits |= {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in LETTERS}
        for e in edits - {w}:
            if e in n:
                near[w].add(e)
                near[e].add(w)
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda e: (-n[e], e), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def rows_of(found):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect())


def misspelt(seed):
    """Texts of a few words and their variants, of edges, chains of forms, ties, runs of one letter and long words."""
    rng = random.Random(seed)
    base = ["abcdefg", "aaaaaaaa", "Ünivérsity", "mississippi", "ÀÀÿÿ×÷àb", "international", "x" * 70 + "ab" * 10, "zzzzzzzz"]
    words = []
    for b in base:
        words += [b] * 120
        for _ in range(25):
            w, times = list(b), rng.choice([2, 3, 11, 12])
            for _ in range(rng.choice([1, 1, 2, 3])):
                k, what = rng.randrange(len(w)), rng.randrange(3)
                w[k : k + (what > 0)] = [rng.choice(LETTERS)] if what < 2 else []
            words += ["".join(w)] * times
    words += ["chainsaw"] * 1000 + ["chainsax"] * 100 + ["chainsxx"] * 10 + ["chaixsxx"] * 1 + ["chaizsxx"] * 2
    words += ["tietiea", "tietieb"] * 40 + ["tietiec"] * 4
    rng.shuffle(words)
    return [(k, " ".join(words[at : at + 50]) + ".") for k, at in enumerate(range(0, len(words), 50))]


@pytest.mark.parametrize("most_bits, clashing", [(1 << 28, False), (3000, True)])
def test_variants_against_brute_force(spark, most_bits, clashing):
    rows = awkward() + misspelt(1) + [(900, "a-b " * 9), (901, None), (None, "Wörterbuch wörterbuch WöRTERBUCH wörterbuc")]
    found = rows_of(spelling_variants(documents(spark, rows, clashing).repartition(3), most_bits=most_bits))
    expected = brute(rows)
    assert found == expected
    assert max(n for *_, n, _ in expected) > 3 and sum(f is not None and f != r for _, f, r, *_ in expected) > 1


def test_few_bits_lose_nothing(spark):
    rows = misspelt(2)
    assert rows_of(spelling_variants(documents(spark, rows), bits_each=1)) == brute(rows)


def test_given_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = rows_of(spelling_variants(docs))
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()]) and len(found) > 1000


def test_no_documents(spark):
    assert spelling_variants(documents(spark, [])).collect() == []
    assert spelling_variants(documents(spark, [(1, "short words only")])).collect() == []
