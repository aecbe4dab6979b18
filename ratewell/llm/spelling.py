"""Spelling variants of words, found by probing their edits against Bloom filters of the vocabulary.

The vocabulary is counted over all texts.  Blocked Bloom filters of its words, one for each length, go to
all executors.  A task makes the edits of its words: every deletion, and every replacement of a code
point by a larger one, which meets each pair of near words once.  An edit whose changed place shows three
code points that stand together in no word is out at once; the others are probed in the filter of their
length.  Only positives are shuffled, to a join with the vocabulary that leaves the true ones.

The filters together have at most a given number of bits.  A vocabulary that needs more is cut by hash
into slices with filters of their own, each probed in a round of its own, so a larger vocabulary costs
more rounds, never larger broadcasts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import batch_of
from ratewell.llm.words import mix
from ratewell.staging import stage

RUN = "[A-Za-z\\u00C0-\\u00FF]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint8)  # all code points of a word
CODE = np.zeros(256, np.int64)  # 0 is the edge of a word
CODE[LETTERS] = np.arange(1, len(LETTERS) + 1)
SIDE = len(LETTERS) + 1
LONGEST = 64  # longer words share a filter
PLACES = 512  # bits of a block of a filter
SEGMENT = 1 << 16  # bytes of a filter that one group makes
_BASE = np.uint64(0x9E3779B97F4A7C15)
_VALUE = mix(np.arange(1, SIDE + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def noisy_words(docs: DataFrame, least: int, every: int) -> DataFrame:
    """The words of all texts with their count: runs of letters, with the noise that ``every`` stands for.

    Of a run one code point is deleted where ``every`` divides the crc32 of its document's id and itself.
    """
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(f"{RUN}{{{least},}}"), F.lit(0))).alias("run"),
    )
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    size = F.length("run")
    spot = (h % size).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), spot), F.col("run").substr(spot + 2, size))
    words = runs.select(F.when(h % every == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))


def hashes_of(words: np.ndarray) -> np.ndarray:
    """The hash of each row of letters: a polynomial, so that an edit's follows from its word's."""
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(max(words.shape[1] - 1, 0), _BASE)]))
        return (_VALUE[CODE[words]] * powers[: words.shape[1]]).sum(axis=1, dtype=np.uint64)


def probes(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash and its four places in it."""
    mixed = mix(hashes)
    block = (mixed >> np.uint64(32)) % np.uint64(blocks)
    places = np.stack([mix(mixed + np.uint64(k)) % np.uint64(PLACES) for k in range(1, 5)])
    return block.astype(np.int64), places.astype(np.int64)


def slot(size: np.ndarray | int) -> np.ndarray:
    return np.minimum(size, LONGEST)


def by_length(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of words of one length and their letters as a matrix of about ``most`` bytes."""
    words = [w.encode("latin-1") for w in column.to_pylist()]
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, most // size)
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            yield some, np.frombuffer(b"".join([words[k] for k in some]), np.uint8).reshape(len(some), size)


def in_filters(filters: tuple, size: int, hashes: np.ndarray) -> np.ndarray:
    """Which hashes of words of a length may be in the vocabulary."""
    blocks, bits, first, _ = filters
    length = int(slot(size))
    if not blocks.get(length):
        return np.zeros(len(hashes), bool)
    block, places = probes(hashes, blocks[length])
    at = first[length] + block * (PLACES // 8)
    found = np.ones(len(hashes), bool)
    for place in places:
        found &= (bits[at + (place >> 3)] >> (place & 7).astype(np.uint8) & 1).astype(bool)
    return found


def positives(words: np.ndarray, filters: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and letters of the edits of words of one length that pass the filters.

    Deletions, and replacements by a larger letter.
    """
    n, size = words.shape
    threes = filters[3]
    codes = CODE[words]
    edge = np.zeros((n, 1), np.int64)
    padded = np.concatenate([edge, codes, edge], axis=1)
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, _BASE)]))
        values = _VALUE[codes] * powers[:size]
        total = values.sum(axis=1, dtype=np.uint64)
        back = np.uint64(pow(int(_BASE), -1, 2**64))
        before = np.zeros(n, np.uint64)
        rest = total.copy()
        for k in range(size):
            rest = rest - values[:, k]
            left, right = padded[:, k], padded[:, k + 2]
            # Equal neighbours give one deletion, made for the first of them; what then stands together must stand so in a word.
            some = np.flatnonzero(codes[:, k] != left)
            if size > 1:
                outer = padded[some, k - 1] if k else np.zeros(len(some), np.int64)
                fits = threes[outer, left[some], right[some]] if k else np.ones(len(some), bool)
                after = padded[some, k + 3] if k + 3 < size + 2 else np.zeros(len(some), np.int64)
                fits &= threes[left[some], right[some], after] if k + 1 < size else True
                some = some[fits]
                some = some[in_filters(filters, size - 1, before[some] + rest[some] * back)]
                if len(some):
                    yield some, np.delete(words[some], k, axis=1)
            # Replacements: letters that stand between these neighbours in some word.
            row, new = np.nonzero(threes[left, :, right])
            larger = new > codes[row, k]
            row, new = row[larger], new[larger]
            passed = in_filters(filters, size, total[row] + (_VALUE[new] - _VALUE[codes[row, k]]) * powers[k])
            row, new = row[passed], new[passed]
            if len(row):
                changed = words[row]
                changed[:, k] = LETTERS[new - 1]
                yield row, changed
            before = before + values[:, k]


def bloom_filters(words: DataFrame, lengths: dict[int, int], bits_each: int, slices: int, turn: int) -> tuple:
    """The filters of one slice of the vocabulary, made in segments by tasks, and the threes of all words."""
    blocks = {k: max(1, -(-n * bits_each // (slices * PLACES))) for k, n in lengths.items()}
    first, upto = {}, 0
    for k in sorted(blocks):
        first[k] = upto
        upto += blocks[k] * (PLACES // 8)
    schema = pa.schema([("segment", pa.int64()), ("spot", pa.int64())])

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, some in by_length(batch.column("word")):
                hashes = hashes_of(some)
                hashes = hashes[in_slice(hashes, slices, turn)]
                length = int(slot(some.shape[1]))
                block, places = probes(hashes, blocks[length])
                at = np.unique(((first[length] + block * (PLACES // 8)) * 8 + places).ravel())
                yield batch_of(schema, at // (SEGMENT * 8), at % (SEGMENT * 8))

    made = pa.schema([("segment", pa.int64()), ("bits", pa.binary())])

    def gather(some: pa.Table) -> pa.Table:
        held = np.zeros(SEGMENT * 8, np.uint8)
        held[some.column("spot").to_numpy()] = 1
        bits = np.packbits(held, bitorder="little").tobytes()
        return pa.Table.from_batches([batch_of(made, [some.column("segment")[0].as_py()], [bits])])

    # Words are distinct, so a segment has as many as its bits are made for.
    rows = words.select("word").mapInArrow(spots, "segment long, spot long")
    bits = np.zeros(-(-max(upto, 1) // SEGMENT) * SEGMENT, np.uint8)
    for row in rows.groupBy("segment").applyInArrow(gather, "segment long, bits binary").collect():
        bits[row["segment"] * SEGMENT : (row["segment"] + 1) * SEGMENT] = np.frombuffer(row["bits"], np.uint8)
    return blocks, bits, first


def in_slice(hashes: np.ndarray, slices: int, turn: int) -> np.ndarray:
    """Which hashes belong to a slice of the vocabulary."""
    return (mix(hashes + np.uint64(977)) % np.uint64(slices)).astype(np.int64) == turn


def letter_threes(words: DataFrame) -> np.ndarray:
    """Which three letters stand together in some word; the edge of a word counts as a letter."""
    schema = pa.schema([("three", pa.int64())])

    def threes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(SIDE**3, bool)
        for batch in batches:
            for _, some in by_length(batch.column("word")):
                codes = np.pad(CODE[some], ((0, 0), (1, 1)))
                held[((codes[:, :-2] * SIDE + codes[:, 1:-1]) * SIDE + codes[:, 2:]).ravel()] = True
        yield batch_of(schema, np.flatnonzero(held))

    held = np.zeros(SIDE**3, bool)  # 91 ** 3 at most, whatever the vocabulary
    rows = words.select("word").mapInArrow(threes, "three long").distinct().toArrow()
    held[rows.column("three").to_numpy()] = True
    return held.reshape(SIDE, SIDE, SIDE)


def near_words(vocabulary: DataFrame, bits_each: int, most_bits: int) -> DataFrame:
    """Pairs of the vocabulary (word, n) that differ by one edit, each once: word, n, near, near_n."""
    spark = vocabulary.sparkSession
    sizes = vocabulary.groupBy(F.least(F.length("word"), F.lit(LONGEST)).alias("size")).agg(F.count("*").alias("words"))
    lengths = {row["size"]: row["words"] for row in sizes.collect()}  # at most LONGEST rows
    if not lengths:
        return spark.createDataFrame([], "word string, n long, near string, near_n long")
    total = sum(lengths.values())
    slices = max(1, -(-total * bits_each // most_bits))
    # Probing takes long for the bytes it reads, so a task gets a bounded number of words.
    dealt = vocabulary.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 50_000), "word")
    threes = letter_threes(vocabulary)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string())])
    found = None
    for turn in range(slices):
        shared = spark.sparkContext.broadcast((*bloom_filters(vocabulary, lengths, bits_each, slices, turn), threes))

        def probe(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column("word")
                for rows, some in by_length(column, 1 << 18):
                    for row, edits in positives(some, shared.value):
                        if slices > 1:
                            mine = in_slice(hashes_of(edits), slices, turn)
                            row, edits = row[mine], edits[mine]
                        near = edits.view(f"S{edits.shape[1]}").ravel().tolist()
                        mine = batch.take(pa.array(rows[row]))
                        yield batch_of(schema, *mine.columns, [w.decode("latin-1") for w in near])

        made = stage(dealt.select("word", "n").mapInArrow(probe, "word string, n long, near string"))
        shared.destroy()
        found = made if found is None else found.union(made)
    # Of the positives the false ones are in no vocabulary.
    return found.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")


def roots_of(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain of forms, for the words with a form (word, form).

    Each round every word jumps to the form of its form, so the rounds grow with the logarithm of the
    longest chain; a form has ten times its word's count, so chains are short.  Words that have arrived
    take no part in further rounds.
    """
    links = forms.select(F.col("word").alias("at"), F.col("form").alias("next"))
    open_, done = forms.select("word", F.col("form").alias("root")), None
    while True:
        moved = open_.join(links, open_["root"] == links["at"], "left")
        moved = stage(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")))
        ended = moved.where(~F.col("more")).select("word", "root")
        done = ended if done is None else done.union(ended)
        open_ = moved.where("more").select("word", "root")
        if open_.isEmpty():
            return done
        # Twice as far: a link's own next, where it has one.
        far = links.select(F.col("at").alias("at_"), F.col("next").alias("next_"))
        links = links.join(far, links["next"] == far["at_"], "left")
        links = stage(links.select("at", F.coalesce("next_", "next").alias("next")))


def spelling_variants(docs: DataFrame, least: int = 7, every: int = 31, times: int = 10, bits_each: int = 16, most_bits: int = 1 << 28) -> DataFrame:
    """One row for each word of the texts: word, form, root, n, n_near, form_n.

    Words are the distinct runs of letters (ASCII and U+00C0 to U+00FF, only A-Z lower-cased) of ``least``
    code points or more that stand at least twice in the texts (doc_id, text), after the noise that
    ``every`` stands for, see ``noisy_words``.  Two are near if one insertion, deletion or replacement
    makes one of the other: ``n_near`` counts them.  ``form`` is the near word with the largest count, the
    smaller in code-point order of two, if that count is ``times`` the word's or more, else null, and
    ``form_n`` its count; ``root`` is the last word that following forms leads to, the word itself
    without a form.

    Null and empty texts have no words; a null doc_id counts as the empty text in the noise; a repeated
    row counts again; an empty table gives no rows; other columns are left out.  A word has at most
    about 180 times its length near words, so no word is a hot key.
    """
    vocabulary = stage(noisy_words(docs.select("doc_id", "text"), least, every).where("n >= 2"))
    turned = F.array(F.struct("word", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    both = near_words(vocabulary, bits_each, most_bits).select(F.inline(turned))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    named = vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")
    )
    fits = F.col("near_n") >= times * F.col("n")
    named = stage(named.select("word", "n", "n_near", F.when(fits, F.col("near")).alias("form"), F.when(fits, F.col("near_n")).alias("form_n")))
    roots = roots_of(named.where("form is not null").select("word", "form"))
    out = named.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
