import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from rows import SF, awkward, documents

from ratewell.llm.alignment import PairEncoder, align_tokens, byte_level_bytes, piece_bytes, shared_cuts
from ratewell.llm.queries import BYTE_BPE, PIECE_BPE

ODD = [
    "a", " a", "  a  b", "a\nb", "a \n b\n \nc", "\n", "\n\nx", " \t x", "<|endoftext|> x", "<s> a </s><unk>", "a▁b", "▁", "a ▁b", "日本 𝔘 é",
    "x\x00y", "\x0b\x0c\r\n q", "it's 's", "\xa0a　 b", "x   ", "     y", "ﬁne ½", "<0x41> b", "tab\t\tz", "don't\n  stop",
]


def plain_ids(texts):
    (a, bytes_a), (b, bytes_b) = byte_level_bytes(BYTE_BPE), piece_bytes(PIECE_BPE)
    for text in texts:
        ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        whole = (" " + (text or "")).encode()
        right = text and b"".join(bytes_a[i] for i in ids_a) == whole == b"".join(bytes_b[i] for i in ids_b)
        yield ([(i, len(bytes_a[i])) for i in ids_a], [(i, len(bytes_b[i])) for i in ids_b]) if right else ([], [])


def brute(rows):
    """Two pointers over each text, byte by byte; counts in one dictionary."""
    found, held = [], Counter()
    for (doc, _), (a, b) in zip(rows, plain_ids([t for _, t in rows])):
        of_a = [k for k, (_, n) in enumerate(a) for _ in range(n)]
        of_b = [k for k, (_, n) in enumerate(b) for _ in range(n)]
        links = sorted(set(zip(of_a, of_b)))
        groups, now = [], ([], [])
        for at in range(len(of_a)):
            for k, (of, ids) in enumerate(((of_a, a), (of_b, b))):
                if at + 1 == len(of) or of[at + 1] != of[at]:
                    now[k].append(ids[of[at]][0])
            if at + 1 == len(of_a) or (of_a[at + 1] != of_a[at] and of_b[at + 1] != of_b[at]):
                groups.append(now)
                now = ([], [])
        pairs = [(a[i][0], b[j][0]) for i, j in links]
        held.update(set(pairs))
        found.append((doc, len(a), len(b), groups, pairs))
    most = {}
    for (a, _), n in held.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for doc, n_a, n_b, groups, pairs in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        best = sum(held[p] == most[p[0]] for p in pairs)
        out.append((str(doc), n_a, n_b, len(groups), len(pairs), best, sum(held[p] for p in pairs), digest))
    return sorted(out)


def test_pieces_give_the_ids_of_the_whole():
    rng = random.Random(7)
    texts = ODD + ["".join(rng.choice("ab '\n\t.é  ３<|>日S▁") for _ in range(rng.randint(1, 50))) for _ in range(600)]
    for keep in (1, 100_000):
        coder, found = PairEncoder(BYTE_BPE, PIECE_BPE, keep), []
        for at in range(0, len(texts), 50):
            both, right = coder.encode(pa.array([" " + t for t in texts[at : at + 50]]))
            for k, ok in enumerate(right):
                found.append([ids[first[k] : first[k + 1]].tolist() if ok else [] for ids, first in both])
        for text, (a, b), got in zip(texts, plain_ids(texts), found):
            assert got == [[i for i, _ in a], [i for i, _ in b]], repr(text)


def test_cuts_are_the_common_ends():
    rng = random.Random(8)
    for _ in range(300):
        first, ends_a, ends_b, common, base = [0], [], [], [], 0
        for _ in range(rng.randint(0, 5)):
            size = rng.randint(1, 200)
            share = rng.choice([0.02, 0.3, 0.9])
            a = sorted({k for k in range(1, size) if rng.random() < share} | {size})
            b = sorted({k for k in range(1, size) if rng.random() < rng.choice([0.02, share])} | {size})
            ends_a += [base + x for x in a]
            ends_b += [base + x for x in b]
            common += [first[-1] + k for k, x in enumerate(a) if x in set(b)]
            first.append(len(ends_a))
            base += size
        if rng.random() < 0.2:
            first.append(first[-1])  # a text without tokens
        if ends_a:
            got = shared_cuts(np.array(ends_a), np.array(ends_b), np.array(first))
            assert got.tolist() == common


def rows_of(found):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((str(r.doc_id), *(r[c] for c in names)) for r in found.collect())


@pytest.mark.parametrize("slice_bytes, clashing", [(8 << 20, False), (300, True)])
def test_alignment_against_brute_force(spark, slice_bytes, clashing):
    rows = awkward() + [(400 + k, t) for k, t in enumerate(ODD)]
    found = align_tokens(documents(spark, rows, clashing).repartition(3), BYTE_BPE, PIECE_BPE, slice_bytes)
    assert rows_of(found) == brute(rows)


def test_given_documents_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(align_tokens(docs, BYTE_BPE, PIECE_BPE)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_no_documents(spark):
    assert align_tokens(documents(spark, []), BYTE_BPE, PIECE_BPE).collect() == []
