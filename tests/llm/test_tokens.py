import glob
import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from rows import awkward, documents

from ratewell.llm import packing, words
from ratewell.llm.packing import pack_pieces, plan_bins, token_pieces
from ratewell.llm.queries import BYTE_BPE, WORD_BPE
from ratewell.llm.token_files import read_token_files, with_starts, write_token_files
from ratewell.llm.tokens import Encoder
from ratewell.llm.words import words_of
from ratewell.staging import stage

ODD = [
    "", " ", "  a  b ", "a\n\n b", "a\x1c b \x85 c  d", "it's 's <|endoftext|> x", "é ́a", "  x\ty", "İI ΑΣ ", "12３ 4",
    "a   b", " lead", None, "\n\n", "a \n b\n \nc", "a　 b", "x  y  z", "tab\t\n z", "\r\n a\r\nb", "日本 𝔘", "end \n",
]


def plain(path, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [np.array(x.ids, "<u4") for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path, cut", [(BYTE_BPE, "spaced"), (WORD_BPE, "words")])
@pytest.mark.parametrize("keep", [1, 10_000])
def test_pieces_give_the_ids_of_the_whole(path, cut, keep):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab '\n\t.é  ３<|>日S") for _ in range(rng.randint(0, 60))) for _ in range(800)]
    encoder, found = Encoder(path, cut, keep), []
    for at in range(0, len(texts), 100):
        found += encoder.encode(pa.array(texts[at : at + 100], pa.string()))
    for text, a, b in zip(texts, found, plain(path, texts)):
        assert a.tolist() == b.tolist(), repr(text)


def test_words_and_their_marks_are_learned_once():
    rng = random.Random(8)
    some = ["".join(rng.choice("abcdeéñß") for _ in range(9)) for _ in range(50)]
    marks = ["", ".", ",", "&&&", "***", ")", "-12", ";7", "'"]
    texts = [" ".join(rng.choice("(\"#") + w + m for w in some) + " " + " ".join(w[:1].upper() + w[1:] + m for w in some) for m in marks]
    encoder = Encoder(WORD_BPE, "words")
    found = encoder.encode(pa.array(texts))
    assert [a.tolist() for a in found] == [b.tolist() for b in plain(WORD_BPE, texts)]
    assert len(encoder.known) <= 2 * len(some) + 40  # words as they stand between spaces: some 800


def test_cuts_inside_words_change_no_id():
    """Contractions, letters that marks beyond ASCII join, letters of one case alone, numbers, signs of every kind."""
    rng = random.Random(12)
    texts = ["J\u030c T\u0308 J\u030cx H\u0331. x\u0301,", "a\u00d7b\u00f7c", "don't 'TIS '' 's's ''s x.'S 'é l'été 'l 'll 'LL", "·a ·. —, .— a—b", "\x01a \x1c. a\x7fb", "A\u0300À\u0301 ª º µ² ½3 1½", "Σ. ΑΣ aΣ Σa İ ŉ ﬁ. ẞa"]
    letters = "ab'sStTlLvVreEmMdD09.,-é\u0301ÉÀß×÷Σ—½ \x01\x1c\x85\xa0\u200bJ\u030c日"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(4000)]
    found = Encoder(WORD_BPE, "words", keep=1000).encode(pa.array(texts))
    for text, a, b in zip(texts, found, plain(WORD_BPE, texts)):
        assert a.tolist() == b.tolist(), repr(text)


def other_tokenizer(tmp_path, **changed):
    with open(WORD_BPE) as file:
        made = json.load(file)
    (tmp_path / "other.json").write_text(json.dumps(made | changed))
    return str(tmp_path / "other.json")


@pytest.mark.parametrize(
    "changed",
    [
        {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}},
        {"normalizer": {"type": "NFC"}},
        {"normalizer": None},
    ],
)
def test_a_tokenizer_that_parts_words_otherwise_gets_whole_words(tmp_path, changed):
    path = other_tokenizer(tmp_path, **changed)
    texts = ["Some words, and (others) don't", "x1y2 É. 12"]
    assert [a.tolist() for a in Encoder(path, "words").encode(pa.array(texts))] == [b.tolist() for b in plain(path, texts)]


def test_texts_are_encoded_in_small_batches(spark, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(key)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])

    def recorded(df):
        long = spark.range(0, 64, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
        seen.append(max(r.bytes for r in long.mapInArrow(sizes, "bytes long").collect()))
        return stage(df)

    monkeypatch.setattr(packing, "stage", recorded)
    pack_pieces(token_pieces(documents(spark, [(1, "some words")]), WORD_BPE).drop("ids")).collect()
    assert seen[0] < 8 << 20 and spark.conf.get(key) == before


def test_memory_goes_back_after_the_last_slice(monkeypatch):
    calls = []
    monkeypatch.setattr(words, "give_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(["ab cd"] * 100)], ["text"])
    assert sum(b.num_rows for b in words.in_slices(iter([batch, batch]), "text", 50)) == 200 and calls == [1]
    monkeypatch.undo()
    words.give_back()


def thue_morse(n):
    return "".join("ab"[bin(k).count("1") % 2] for k in range(n))


@pytest.mark.parametrize("size", [1024, 2048, 8192])
def test_long_words_in_the_order_of_thue_and_morse_differ(size):
    word = thue_morse(size)
    other = word.translate(str.maketrans("ab", "ba"))
    found = words_of(pa.array([f"{word} {other}"])).hashes
    assert found[0] != found[1]
    for path, cut in ((BYTE_BPE, "spaced"), (WORD_BPE, "words")):
        texts = [word, f"x {other}", f"y {word}"]
        assert [a.tolist() for a in Encoder(path, cut).encode(pa.array(texts))] == [b.tolist() for b in plain(path, texts)]


def test_a_word_has_one_hash_wherever_it_stands():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 30))) for _ in range(60)]
    texts = [" " * rng.randint(0, 9) + "  ".join(rng.sample(words, 20)) for _ in range(200)]
    found, seen = words_of(pa.array(texts)), {}
    for s, e, h in zip(found.start, found.end, found.hashes):
        assert seen.setdefault(found.data[s:e].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


def placed(counts, capacity):
    """Every piece of a plan: bin -> (offset, length)."""
    runs, bins = plan_bins(counts, capacity)
    by, found = {}, {}
    for run in sorted(runs):
        by.setdefault(run[0], []).append(run)
    for length, count in counts.items():
        for rank in range(count):
            _, first, start, each, used = [r for r in by[length] if r[1] <= rank][-1]
            nth = rank - first
            found.setdefault(start + nth // each, []).append((used + nth % each * length, length))
    return found, bins


def test_plans_are_gapless_and_pair_large_items():
    rng = random.Random(3)
    for _ in range(400):
        capacity = rng.choice([10, 30, 100])
        counts = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(1, 20))}
        found, bins = placed(counts, capacity)
        assert sorted(found) == list(range(bins))
        for some in found.values():
            at = 0
            for offset, length in sorted(some):
                assert offset == at
                at += length
            assert at <= capacity
            assert sum(3 * length > capacity for _, length in some) <= 2


def test_large_pieces_take_the_fewest_bins():
    def least(some, capacity):
        if not some:
            return 0
        first, rest = some[0], some[1:]
        fits = [k for k, n in enumerate(rest) if first + n <= capacity]
        return 1 + min([least(rest, capacity)] + [least(rest[:k] + rest[k + 1 :], capacity) for k in fits])

    assert plan_bins({2000: 1, 1500: 1}, 4096)[1] == 1
    rng = random.Random(6)
    for _ in range(150):
        some = [rng.randint(34, 60) for _ in range(rng.randint(1, 7))]
        assert plan_bins({n: some.count(n) for n in some}, 100)[1] == least(some, 100)


def test_plan_is_near_the_least():
    rng = random.Random(4)
    counts = {}
    for _ in range(20_000):
        n = min(4096, int(rng.lognormvariate(6.3, 1)) + 1)
        counts[n] = counts.get(n, 0) + 1
    _, bins = plan_bins(counts, 4096)
    assert bins <= 1.005 * sum(n * c for n, c in counts.items()) / 4096 + 1


@pytest.mark.parametrize("clashing", [False, True])
def test_packing_against_brute_force(spark, clashing):
    rows = awkward()
    found = pack_pieces(token_pieces(documents(spark, rows, clashing), WORD_BPE, 64).drop("ids"), 64).collect()
    expected = []
    for (doc, _), ids in zip(rows, plain(WORD_BPE, [t for _, t in rows])):
        ids = np.append(ids, 1).astype("<u4")
        for k, at in enumerate(range(0, len(ids), 64)):
            some = ids[at : at + 64]
            expected.append((doc or -1, k, at, len(some), zlib.crc32(some.tobytes())))
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(expected)
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for some in bins.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 64
    assert pack_pieces(token_pieces(documents(spark, []), WORD_BPE).drop("ids")).collect() == []


def test_pieces_can_carry_their_ids(spark):
    row = token_pieces(documents(spark, [(1, "some words")]), WORD_BPE, with_ids=True).first()
    assert zlib.crc32(row.ids) == row.ids_crc32 and len(row.ids) == 4 * row.length


@pytest.mark.parametrize("clashing", [False, True])
def test_token_files_round_trip(spark, tmp_path, clashing):
    rows = awkward()
    folder = str(tmp_path / "files")
    index = write_token_files(documents(spark, rows, clashing), BYTE_BPE, 2, folder, frame_bytes=2000, part_bytes=20_000)
    found = with_starts(index, read_token_files(index)).collect()
    order = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    at, expected = 0, {}
    for (doc, _), ids in zip(rows, plain(BYTE_BPE, [t for _, t in rows])):
        expected.setdefault(doc, []).append(np.append(ids, 2).astype("<u4").tobytes())
    for r in order:
        assert r.start == at
        at += r.n_tokens
        assert r.ids_crc32 == zlib.crc32(r.ids)
        expected[r.doc_id].remove(bytes(r.ids))
    assert not any(expected.values())
    some = read_token_files(index.where("doc_id in (7, 150, 308)")).collect()
    assert {r.doc_id: bytes(r.ids) for r in some} == {r.doc_id: bytes(r.ids) for r in found if r.doc_id in (7, 150, 308)}


def test_files_are_standard_frames_and_damage_is_found(spark, tmp_path):
    import zstandard

    folder = str(tmp_path / "files")
    index = write_token_files(documents(spark, [(k, f"word {k} again") for k in range(500)]), BYTE_BPE, 2, folder, frame_bytes=512)
    whole = 0
    for name in glob.glob(f"{folder}/*.zst"):
        with open(name, "rb") as file:
            whole += len(zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read())
    assert whole == 4 * index.agg(F.sum("n_tokens")).first()[0]
    with open(name, "r+b") as file:
        file.seek(20)
        byte = file.read(1)
        file.seek(20)
        file.write(bytes([byte[0] ^ 0xFF]))
    with pytest.raises(Exception, match="damaged|decompress"):
        read_token_files(index).collect()


def test_no_documents_no_files(spark):
    index = write_token_files(documents(spark, []), BYTE_BPE)
    assert with_starts(index, read_token_files(index)).collect() == []
