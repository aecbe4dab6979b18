"""Exact n-gram Jaccard join by vertical partitioning.

All n-grams have one global order; it is cut into fragments and every document's set with it.  The
overlap of two documents is counted in each fragment alone and summed per pair.  Candidates come from
the head of the order: two sets whose Jaccard similarity reaches the threshold share an n-gram among
the first ``n - ceil(threshold * n) + 1`` of each.

The order puts rare n-grams first.  How rare an n-gram is, is read from a table of 2**20 counters that
all documents add to; its size is fixed, and being an order it never decides what is linked.

Documents with one set are one class.  Within the classes that share a head n-gram, all are first
compared with the one that has it earliest; classes that this joins need no more comparing with each
other, and only pairs that are still in different components follow.  So a group of many copies costs
its size, not the square of it, and no link between different sets is lost that could join components.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import batch_of, small_batches
from ratewell.llm.components import connected
from ratewell.llm.words import in_slices, mix, shingle_hashes, words_of
from ratewell.staging import stage

COUNTERS = 20  # as a power of two
BLOCK = 14
WIDTH = 8  # words of 64 bits of a class's signature
SIGNS = [f"s{k}" for k in range(WIDTH)]
SEVERAL = 64  # classes of an n-gram up to which all are compared without regard to size
BANDS = 16  # of sizes, for a factor of e
MEMBERS = 26  # bits of the table that says which classes are asked for


def place(order: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Hashes as sorted positions in the global order; a bijection, so equal only if they were.

    An order is the rank of each counter of n-grams, and the positions where fragments begin.
    """
    shift = np.uint64(64 - COUNTERS)
    return np.sort(order[0][hashes >> shift] << shift | hashes & np.uint64((1 << (64 - COUNTERS)) - 1))


def document_sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """The distinct n-grams of each text; fewer words than ``size`` are one n-gram, none are none."""
    found = words_of(batch.column("text"))
    bounds = found.first.tolist()
    for low, high in zip(bounds[:-1], bounds[1:]):
        yield np.unique(shingle_hashes(found.hashes[low:high], size))


def without_words(text: Column) -> Column:
    """Whether a text has no words: it is null, or holds nothing but spaces and ``\\x09``-``\\x0d``."""
    return ~F.coalesce(text, F.lit("")).rlike("[^\\x20\\x09-\\x0D]")


def class_of(hashes: np.ndarray) -> int:
    """One number for a set."""
    with np.errstate(over="ignore"):
        total = np.array([mix(hashes ^ np.uint64(0xA0761D6478BD642F)).sum() + np.uint64(len(hashes))], np.uint64)
    return int(mix(total).view(np.int64)[0])


def global_order(docs: DataFrame, size: int, fragments: int) -> tuple[np.ndarray, np.ndarray]:
    """Counters of all n-grams of all documents, rare first; 2**20 numbers reach the driver."""
    schema = pa.schema([("block", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTERS, np.int64)
        for batch in in_slices(batches, "text"):
            every = [s >> np.uint64(64 - COUNTERS) for s in document_sets(batch, size)]
            total += np.bincount(np.concatenate(every).astype(np.int64), minlength=1 << COUNTERS)
        blocks = total.astype("<u4").reshape(-1, 1 << BLOCK)
        yield batch_of(schema, np.arange(len(blocks), dtype=np.int32), [zlib.compress(b.tobytes(), 1) for b in blocks])

    def add(some: pa.Table) -> pa.Table:
        total = np.zeros(1 << BLOCK, "<i8")
        for packed in some.column("counts"):
            total += np.frombuffer(zlib.decompress(packed.as_py()), "<u4")
        return pa.Table.from_batches([batch_of(schema, [some.column("block")[0].as_py()], [total.tobytes()])])

    kind = "block int, counts binary"
    rows = docs.select("text").mapInArrow(count, kind).groupBy("block").applyInArrow(add, kind).collect()
    load = np.zeros(1 << COUNTERS, np.int64)
    for row in rows:
        load[row["block"] << BLOCK : (row["block"] + 1) << BLOCK] = np.frombuffer(row["counts"], "<i8")
    order = np.argsort(load, kind="stable")
    rank = np.empty(1 << COUNTERS, np.uint64)
    rank[order] = np.arange(1 << COUNTERS, dtype=np.uint64)
    upto = np.cumsum(load[order])
    shares = upto[-1] * np.arange(1, fragments) / fragments
    cuts = np.searchsorted(upto, shares).astype(np.uint64) << np.uint64(64 - COUNTERS)
    return rank, cuts


def heads(docs: DataFrame, order, size: int, percent: int) -> DataFrame:
    """Per row its columns other than the text, its set's class, size and head in the global order, and the signature.

    The signature has a bit for each of 64 * ``WIDTH`` buckets of n-grams: whether their number is odd.
    """
    kept = [f for f in docs.schema if f.name != "text"]
    kind = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "class long, n long, head array<long>", *(f"{c} long" for c in SIGNS)])
    names = [f.name for f in kept]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = order.value
        for batch in in_slices(batches, "text"):
            kinds, sizes, first, odd = [], [], [], []
            for found in document_sets(batch, size):
                n = len(found)
                kinds.append(class_of(found))
                sizes.append(n)
                buckets = np.bincount((found & np.uint64(64 * WIDTH - 1)).astype(np.int64), minlength=64 * WIDTH)
                odd.append(np.packbits((buckets & 1).astype(np.uint8)).view(np.int64))
                first.append(place(ranked, found)[: n - -(-percent * n // 100) + 1].view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(f) for f in first])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(first), pa.int64()))
            signs = [pa.array(np.ascontiguousarray(c)) for c in np.stack(odd).T]
            columns = [*(batch.column(c) for c in names), pa.array(kinds, pa.int64()), pa.array(sizes, pa.int64()), lists, *signs]
            yield pa.RecordBatch.from_arrays(columns, [*names, "class", "n", "head", *SIGNS])

    return docs.mapInArrow(cut, kind)


def bit_table(values: DataFrame, column: str) -> np.ndarray:
    """A table of 2**26 bits that says which values there are, by their last bits; its size doesn't grow.

    What passes it may still be another value with the same last bits, and has to be joined.
    """
    bits = F.col(column).bitwiseAND((1 << MEMBERS) - 1)
    schema = pa.schema([("block", pa.int64()), ("bits", pa.binary())])

    def collect(some: pa.Table) -> pa.Table:
        held = np.zeros(1 << 16, np.uint8)
        held[some.column("bit").to_numpy() & 0xFFFF] = 1
        return pa.Table.from_batches([batch_of(schema, [some.column("bit")[0].as_py() >> 16], [np.packbits(held).tobytes()])])

    # At most 2**16 distinct bits a block.
    blocks = values.select(bits.alias("bit")).distinct().groupBy(F.shiftright("bit", 16).alias("block"))
    held = np.zeros(1 << (MEMBERS - 3), np.uint8)
    for row in blocks.applyInArrow(collect, "block long, bits binary").collect():
        held[row["block"] << 13 : (row["block"] + 1) << 13] = np.frombuffer(row["bits"], np.uint8)
    return held


def has_bit(held: np.ndarray, values: np.ndarray) -> np.ndarray:
    bit = values & ((1 << MEMBERS) - 1)
    return (held[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1).astype(bool)


def postings(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """The n-grams of all heads that several classes have, as a written table: gram, pos, class, n.

    ``shared`` are those n-grams.  The others are left out by a table of bits where they lie, so that
    few of them are shuffled.
    """
    members = rows.sparkSession.sparkContext.broadcast(bit_table(shared, "gram"))
    schema = pa.schema([("gram", pa.int64()), ("pos", pa.int32()), ("class", pa.int64()), ("n", pa.int64())])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = members.value
        for batch in batches:
            head = batch.column("head")
            sizes = np.diff(head.offsets.to_numpy())
            grams = head.flatten().to_numpy()
            hit = np.flatnonzero(has_bit(held, grams))
            row = np.repeat(np.arange(len(sizes)), sizes)[hit]
            pos = hit - (np.cumsum(sizes) - sizes)[row]
            yield batch_of(schema, grams[hit], pos.astype(np.int32), batch.column("class").to_numpy()[row], batch.column("n").to_numpy()[row])

    found = rows.where("n > 0").select("class", "n", "head").mapInArrow(post, "gram long, pos int, class long, n long")
    found = stage(found.join(shared, "gram", "left_semi").distinct())
    members.destroy()
    return found


def segments(docs: DataFrame, wanted: DataFrame, order, size: int) -> DataFrame:
    """The sets of the ``wanted`` classes, cut at the fragments: class, fragment, segment, as a written table.

    Rows of one class have the same segments: a task cuts those of the first, and ``once`` leaves one of
    what tasks found, so a pair of classes costs no more for having many copies.  Classes that only share
    a bit with one that is asked for may be among them.
    """
    members = docs.sparkSession.sparkContext.broadcast(bit_table(wanted, "class"))
    out = pa.schema([("class", pa.int64()), ("fragment", pa.int32()), ("segment", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held = set(), members.value
        for batch in in_slices(batches, "text"):
            rows = []
            for found in document_sets(batch, size):
                kind = class_of(found)
                if not len(found) or kind in done or not has_bit(held, np.array([kind]))[0]:
                    continue
                done.add(kind)
                placed = place(order.value, found)
                ends = [0, *np.searchsorted(placed, order.value[1]).tolist(), len(placed)]
                rows += [(kind, k, placed[a:b].tobytes()) for k, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
            if rows:
                yield batch_of(out, *zip(*rows))

    found = stage(docs.select("text").mapInArrow(cut, "class long, fragment int, segment binary"))
    members.destroy()
    return found


def once(parts: DataFrame) -> DataFrame:
    return parts.dropDuplicates(["class", "fragment"])


def of_pairs(parts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The segments of the classes of some pairs, found by a table of bits where they lie."""
    held = bit_table(classes_of(pairs), "class")
    members = parts.sparkSession.sparkContext.broadcast(held)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(has_bit(members.value, batch.column("class").to_numpy())))

    return parts.mapInArrow(keep, "class long, fragment int, segment binary")


def classes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()


def overlaps(pairs: DataFrame, parts: DataFrame, first: int, upto: int) -> DataFrame:
    """Pairs (a, na, b, nb) with ``common``, their partial overlaps in some fragments, summed, and ``la`` and ``lb``.

    Those are the n-grams that either has in the fragments that both have.  The segments stay where
    ``once`` put them, for both joins.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("a", "na", "b", "nb", "common", "la", "lb")])

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                counts.append((len(np.intersect1d(x, y, True)), len(x), len(y)))
            yield batch_of(schema, *[batch.column(c) for c in schema.names[:4]], *zip(*counts))

    parts = once(parts.where(F.col("fragment").between(first, upto - 1)))
    left = parts.select(F.col("class").alias("a"), "fragment", F.col("segment").alias("sa"))
    right = parts.select(F.col("class").alias("b"), "fragment", F.col("segment").alias("sb"))
    spread = pairs.select("a", "na", "b", "nb", F.explode(F.sequence(F.lit(first), F.lit(upto - 1))).alias("fragment"))
    both = spread.join(right, ["b", "fragment"]).join(left, ["a", "fragment"]).select("a", "na", "b", "nb", "sa", "sb")
    counted = both.mapInArrow(overlap, "a long, na long, b long, nb long, common long, la long, lb long")
    return counted.groupBy("a", "na", "b", "nb").agg(*[F.sum(c).alias(c) for c in ("common", "la", "lb")])


def linked_pairs(pairs: DataFrame, parts: DataFrame, percent: int, fragments: int) -> DataFrame:
    """The pairs (a, na, b, nb) that link: partial overlaps by fragment, summed per pair."""
    total = overlaps(pairs, parts, 0, fragments)
    return total.where(F.expr(f"100 * common >= {percent} * (na + nb - common)")).select("a", "b")


def hopeful(pairs: DataFrame, parts: DataFrame, percent: int, fragments: int) -> DataFrame:
    """The pairs that may still link after the rarest quarter of the fragments.

    Outside it, two sets share no more than the smaller rest.  A pair without a common fragment there
    is not told apart.
    """
    seen = overlaps(pairs, parts, 0, max(1, fragments // 4)).select("a", "b", "common", "la", "lb")
    most = "(coalesce(common, 0) + least(na - coalesce(la, 0), nb - coalesce(lb, 0)))"
    kept = pairs.join(seen, ["a", "b"], "left").where(F.expr(f"100 * {most} >= {percent} * (na + nb - {most})"))
    return kept.select("a", "na", "b", "nb")


def alike(percent: int) -> Column:
    """Whether the signatures of a pair differ in no more bits than sets that link may differ in n-grams.

    An n-gram that one set has more changes one bit, so sets differ in at least as many n-grams as their
    signatures in bits: nothing that links is lost, and unlike sets are told apart where they meet,
    without being sent anywhere.  The other set's columns end in ``_``.
    """
    bits = reduce(lambda a, b: a + b, [F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_"))) for c in SIGNS])
    need = F.expr(f"(({percent} * (n + n_) + {99 + percent}) div {100 + percent})")
    return bits <= F.col("n") + F.col("n_") - 2 * need


def renamed(rows: DataFrame, *keys: str) -> DataFrame:
    """The columns of the other side of a pair, all but the keys."""
    return rows.select(*keys, *[F.col(c).alias(f"{c}_") for c in rows.columns if c not in keys])


def may_link(na: str, pa_: str, nb: str, pb: str, percent: int) -> Column:
    """Whether two sets of these sizes can link if their first common n-gram is at these positions."""
    need = f"(({percent} * ({na} + {nb}) + {99 + percent}) div {100 + percent})"
    return F.expr(
        f"100 * least({na}, {nb}) >= {percent} * greatest({na}, {nb}) and {na} - {pa_} >= {need} and {nb} - {pb} >= {need}"
    )


def band(n: Column) -> Column:
    """Ranges of sizes, in order.

    A set is put into all bands that it may link with, four or five: finer ones would repeat it more
    often, and what coarser ones let meet is told apart where it meets.
    """
    return F.floor(F.log(n.cast("double")) * BANDS).cast("long")


def by_size(posted: DataFrame, percent: int, longer: bool) -> DataFrame:
    """``posted`` once for each pair of bands (high, low) in which it can be the longer, or the shorter, of a linking pair.

    A set that has an n-gram at ``pos`` as the first that both have, links with no set larger than ``reach``.
    """
    reach = f"((100 + {percent}) * (n - pos)) div {percent} - n"
    if longer:
        some = posted.withColumn("from", F.expr(f"({percent} * n + 99) div 100")).withColumn("to", F.expr(f"least(n, {reach})"))
    else:
        some = posted.withColumn("from", F.col("n")).withColumn("to", F.expr(f"least((100 * n) div {percent}, {reach})"))
    own, other = ("high", "low") if longer else ("low", "high")
    bands = F.explode(F.sequence(band(F.col("from")), band(F.col("to")))).alias(other)
    return some.where(F.col("from") <= F.col("to")).select("gram", "pos", "class", "n", "root", *SIGNS, band(F.col("n")).alias(own), bands)


def crossed_pairs(parted: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, na, b, nb) of classes with an n-gram and different roots, from (gram, pos, class, n, root, main, holders).

    Members of the component that holds the first one are not paired among themselves.  Where many
    classes hold an n-gram, only those meet whose sizes and positions let them link, up to the width
    of a band: classes that share one passage and are too unlike for their sizes don't meet at all.
    """
    right = may_link("n_", "pos_", "n", "pos", percent) & alike(percent)
    few, many = parted.where(F.col("holders") <= SEVERAL), parted.where(F.col("holders") > SEVERAL)
    pairs = renamed(few.where("root <> main").drop("main", "holders"), "gram").join(few, "gram").where("root <> root_").where(right).select("class", "n", "class_", "n_")
    bands = ("gram", "high", "low")
    for longer, shorter in ((many.where("root <> main"), many), (many.where("root = main"), many.where("root <> main"))):
        met = renamed(by_size(longer, percent, True), *bands).join(by_size(shorter, percent, False), list(bands))
        met = met.where("root <> root_ and (n_ > n or n_ = n and class_ < class)").where(right)
        pairs = pairs.union(met.select("class", "n", "class_", "n_"))
    return pairs.select(
        F.least("class", "class_").alias("a"), F.when(F.expr("class < class_"), F.col("n")).otherwise(F.col("n_")).alias("na"),
        F.greatest("class", "class_").alias("b"), F.when(F.expr("class < class_"), F.col("n_")).otherwise(F.col("n")).alias("nb"),
    ).distinct()


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85, fragments: int = 16, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Two documents link when ``100 * |A and B| >= percent * |A or B|`` for their sets of distinct
    n-grams of ``size`` words; ``component_id`` is the smallest doc_id that links reach.  A document
    with fewer words is one n-gram; one without words, or with a null text, has none and links with
    nothing.  A repeated row is a document of its own; a null doc_id is no name for a component
    unless its component has no other.  An empty table gives no rows; other columns are left out, but the
    ``keys``, columns that the caller tells rows apart by: with them ``component`` is a number of the
    component, null for a document without words.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keys, F.coalesce("text", F.lit("")).alias("text"))
    with small_batches(spark):  # texts, heads and segments are of any length
        order = spark.sparkContext.broadcast(global_order(docs, size, fragments))
        rows = stage(heads(docs, order, size, percent))
        shared = rows.where("n > 0").select("class", F.explode("head").alias("gram")).groupBy("gram")
        shared = shared.agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("gram")
        posted = postings(rows, stage(shared))
        signs = rows.where("n > 0").select("class", *SIGNS).dropDuplicates(["class"])

        first = posted.groupBy("gram").agg(F.min(F.struct("pos", "class", "n")).alias("f"))
        first = first.select("gram", *[F.col(f"f.{c}").alias(f"{c}_") for c in ("pos", "class", "n")])
        stars = posted.join(first, "gram").where("class <> class_").where(may_link("n_", "pos_", "n", "pos", percent))
        stars = stars.select("class", "n", "class_", "n_").distinct().join(signs, "class").join(renamed(signs), "class_").where(alike(percent))
        stars = stage(stars.select(F.col("class_").alias("a"), F.col("n_").alias("na"), F.col("class").alias("b"), F.col("n").alias("nb")))
        found = stage(linked_pairs(stars, wanted_segments(docs, stars, order, size), percent, fragments))

        roots = connected(found)
        named = posted.join(roots, posted["class"] == roots["node"], "left")
        named = stage(named.select("gram", "pos", "class", "n", F.coalesce("root", "class").alias("root")))
        parted = named.groupBy("gram").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.min_by("root", F.struct("pos", "class")).alias("main"),
            F.count("*").alias("holders"),
        )
        # What still has to meet carries its signature, so that unlike sets make no pair.
        parted = stage(named.join(parted.where("low < high").select("gram", "main", "holders"), "gram").join(signs, "class"))
        crossed = crossed_pairs(parted, percent)
        done = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        crossed = stage(crossed.join(done, ["a", "b"], "left_anti"))
        if not crossed.isEmpty():
            parts = wanted_segments(docs, crossed, order, size)
            crossed = stage(hopeful(crossed, parts, percent, fragments))
            parts = of_pairs(parts, crossed)
            # One pair for each class and component first: where it links, the others need no counting.
            some = stage(one_partner(apart(crossed, roots)))
            found = found.union(stage(linked_pairs(some, parts, percent, fragments)))
            roots = connected(found)
            rest = stage(apart(crossed.join(some.select("a", "b"), ["a", "b"], "left_anti"), roots).select("a", "na", "b", "nb"))
            if not rest.isEmpty():
                found = found.union(stage(linked_pairs(rest, parts, percent, fragments)))
                roots = connected(found)
        order.destroy()

        classes = rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
        classes = classes.join(roots, classes["class"] == roots["node"], "left")
        classes = stage(classes.select("class", "least", F.coalesce("root", "class").alias("root")))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "root").select("class", "component_id", "root")
    several = rows.select("doc_id", *keys, "class", "n").join(named, "class", "left")
    return several.select(
        "doc_id", *keys, F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *([F.col("root").alias("component")] if keys else []),
    )


def wanted_segments(docs: DataFrame, pairs: DataFrame, order, size: int) -> DataFrame:
    """The segments of all classes in some pairs, as a written table."""
    return segments(docs, classes_of(pairs), order, size)


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose classes are in different components, with ``ra`` and ``rb``, their roots."""
    first = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    second = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    both = pairs.join(first, "a", "left").join(second, "b", "left")
    named = both.withColumn("ra", F.coalesce("ra", "a")).withColumn("rb", F.coalesce("rb", "b"))
    return named.where("ra <> rb").select("a", "na", "b", "nb", "ra", "rb")


def one_partner(pairs: DataFrame) -> DataFrame:
    """Of the pairs of a class with a component, one; every two components with pairs keep one."""
    right = pairs.groupBy("a", "rb").agg(F.min("b").alias("b"))
    left = pairs.groupBy("b", "ra").agg(F.min("a").alias("a"))
    return pairs.join(right, ["a", "rb", "b"], "left_semi").join(left, ["b", "ra", "a"], "left_semi").select("a", "na", "b", "nb")
