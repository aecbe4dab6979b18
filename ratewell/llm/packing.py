"""Documents packed into fixed-length sequences: large ones matched, small ones best-fit.

The packing is found on the histogram of piece lengths, which has at most ``capacity`` entries however
many documents there are, so it is the packing of the whole table; each piece then takes the place of
its rank among the pieces of its length.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewell.llm.common import batch_of, small_batches
from ratewell.llm.tokens import encoder
from ratewell.llm.words import in_slices
from ratewell.staging import stage


def plan_bins(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Where the pieces of each length go: runs (length, first rank, first bin, per bin, offset), and the bins.

    Pieces above a third of the capacity come first, at most two to a bin: the longest takes the
    longest other that still fits.  Then shorter ones, longest first, each into the bin whose gap is
    the smallest that takes it, or a new one.  Bins filled alike are handled as one range of numbers.
    """
    runs, bins = [], 0
    taken = dict.fromkeys(counts, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges (first bin, bins)
    order: list[int] = []  # the gaps, ascending

    def free(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, n))

    def put(length: int, n: int, first: int, each: int, used: int) -> None:
        runs.append((length, taken[length], first, each, used))
        taken[length] += n

    left = {n: c for n, c in counts.items() if 3 * n > capacity and c}
    lengths = sorted(left)
    while lengths:
        longest = lengths[-1]
        mate = bisect_left(lengths, capacity - longest + 1) - 1
        if mate >= 0 and lengths[mate] == longest and left[longest] == 1:
            mate -= 1  # not its own mate; an odd one takes the next shorter
        if mate < 0:
            n = left[longest]
            put(longest, n, bins, 1, 0)
            free(capacity - longest, bins, n)
            bins += n
        elif lengths[mate] == longest:
            n = left[longest] - left[longest] % 2
            put(longest, n, bins, 2, 0)
            free(capacity - 2 * longest, bins, n // 2)
            bins += n // 2
            left[longest] -= n
            if left[longest]:
                continue
        else:
            other = lengths[mate]
            n = min(left[longest], left[other])
            put(longest, n, bins, 1, 0)
            put(other, n, bins, 1, longest)
            free(capacity - longest - other, bins, n)
            bins += n
            left[other] -= n
            if not left[other]:
                lengths.remove(other)
            left[longest] -= n
            if left[longest]:
                continue
        lengths.remove(longest)
    for length in sorted((n for n, c in counts.items() if 3 * n <= capacity and c), reverse=True):
        n = counts[length]
        while n:
            at = bisect_left(order, length)
            if at == len(order):
                each = capacity // length
                free(capacity, bins, -(-n // each))
                bins += -(-n // each)
                continue
            gap = order[at]
            first, many = gaps[gap].pop()
            each = gap // length
            full = min(many, n // each)
            used = capacity - gap
            if full:
                put(length, full * each, first, each, used)
                free(gap - each * length, first, full)
                n -= full * each
            if n and full < many:
                put(length, n, first + full, each, used)
                free(gap - n * length, first + full, 1)
                full, n = full + 1, 0
            free(gap, first + full, many - full)
            if not gaps[gap]:
                del gaps[gap]
                order.remove(gap)
    return runs, bins


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document is the ids of its whole text and ``end_id``; only one longer than ``capacity`` is cut.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
    end, width = struct.pack("<I", end_id), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path, "words", keep=500_000)
        for batch in in_slices(batches, "text"):
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(batch.column("text"))):
                ids = ids.tobytes() + end
                for k, at in enumerate(range(0, len(ids), width)):
                    some = ids[at : at + width]
                    rows.append((doc, k, at // 4, len(some) // 4, zlib.crc32(some), some if with_ids else None))
            yield batch_of(schema, *zip(*rows))

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return whole.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def pack_pieces(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ids_crc32, ...) with sequence_id and offset.

    Ranks within a length are counted range by range, so a length that most pieces share is spread
    over many partitions.  To the driver go one count per length and range.  Repeated rows are packed
    as often as they occur; a null doc_id ranks first; an empty table gives no rows.
    """
    spark = pieces.sparkSession
    with small_batches(spark):
        pieces = stage(pieces)  # ranges are drawn from a first reading, which must not encode again
    line = ["length", "doc_id", "piece", "ids_crc32"]
    ranged = stage(pieces.repartitionByRange(*line).withColumn("part", F.spark_partition_id()))
    found = ranged.groupBy("length", "part").count().orderBy("length", "part").collect()
    counts: dict[int, int] = {}
    firsts = []
    for row in found:
        firsts.append((row["length"], row["part"], counts.get(row["length"], 0)))
        counts[row["length"]] = counts.get(row["length"], 0) + row["count"]
    runs, _ = plan_bins(counts, capacity)
    runs.sort()
    plan = np.array(runs, np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(plan)
    starts = spark.createDataFrame(firsts, "length long, part int, first long")
    inside = Window.partitionBy("part", "length").orderBy(*line)
    ranked = (
        ranged.withColumn("nth", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), ["length", "part"])
        .withColumn("rank", F.col("first") + F.col("nth"))
        .drop("first", "nth", "part")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        keys = plan[:, 0] << 48 | plan[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            run = plan[np.searchsorted(keys, length << 48 | rank, "right") - 1]
            nth = rank - run[:, 1]
            sequence = run[:, 2] + nth // np.maximum(run[:, 3], 1)
            offset = run[:, 4] + nth % np.maximum(run[:, 3], 1) * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence), pa.array(offset)], [*batch.schema.names, "sequence_id", "offset"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long").drop("rank")
