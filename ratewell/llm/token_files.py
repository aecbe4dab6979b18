"""Token ids in seekable Zstandard files: independent frames, a trailing seek table, checksums.

A file is a run of frames, each a complete Zstandard frame of whole documents' ids (little-endian
unsigned 32-bit), then one skippable frame with the seek table of the public seekable format: for each
frame its compressed size, its plain size and the low 32 bits of the xxh64 of its plain bytes, then the
number of frames, a flag byte and a magic number.  A reader takes the table from the end of a file and
reads, checks and decompresses only the frames that hold the documents asked for.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import batch_of, files_at, new_folder, parts_for
from ratewell.llm.tokens import encoder
from ratewell.llm.words import in_slices
from ratewell.staging import stage

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80



def seek_table(frames: list[tuple[int, int, int]]) -> bytes:
    """The skippable frame that ends a file; frames: compressed size, plain size, checksum."""
    body = b"".join(struct.pack("<III", *f) for f in frames) + struct.pack("<IBI", len(frames), CHECKSUMS, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(source: pa.NativeFile, size: int) -> list[tuple[int, int, int]]:
    """The frames of a file, from its end."""
    if size < 17:
        raise ValueError("not a seekable file")
    source.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE or not flags & CHECKSUMS or size < 17 + 12 * count:
        raise ValueError("not a seekable file with checksums")
    source.seek(size - 9 - 12 * count)
    return list(struct.iter_unpack("<III", source.read(12 * count)))


class FrameWriter:
    """Writes ids as frames of about ``frame_bytes``; a document is never parted between frames."""

    def __init__(self, sink, frame_bytes: int, level: int):
        import zstandard

        self.sink, self.frame_bytes = sink, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.held, self.size, self.frames = [], 0, []

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        import xxhash

        if self.size:
            plain = b"".join(self.held)
            packed = self.packer.compress(plain)
            self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
            self.sink.write(packed)
        self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.sink.write(seek_table(self.frames))


def read_ids(source: pa.NativeFile, size: int, spans: list[tuple[int, int]]) -> Iterator[bytes]:
    """The bytes of the given (first id, ids) spans in order; one frame is held at a time."""
    import xxhash
    import zstandard

    frames = read_seek_table(source, size)
    places = list(accumulate((f[0] for f in frames), initial=0))
    begins = np.array(list(accumulate((f[1] for f in frames), initial=0)))
    opener, held, plain = zstandard.ZstdDecompressor(), -1, b""
    for first, count in spans:
        low, high, found = 4 * first, 4 * (first + count), []
        k = int(np.searchsorted(begins, low, "right")) - 1
        while low < high:
            if k != held:
                source.seek(places[k])
                plain = opener.decompress(source.read(frames[k][0]), max_output_size=frames[k][1])
                if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != frames[k][2]:
                    raise ValueError(f"frame {k} is damaged")
                held = k
            found.append(plain[low - begins[k] : high - begins[k]])
            low, k = int(begins[k + 1]), k + 1
        yield b"".join(found)


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    folder: str | None = None,
    frame_bytes: int = 256 << 10,
    level: int = 3,
    part_bytes: int = 32 << 20,
) -> DataFrame:
    """Write the ids of every whole text in ascending doc_id order; returns the index of documents.

    The text of a row is encoded, ``end_id`` appended, and the row written to the file of its range of
    doc_ids; the index (doc_id, part, nth, file, at, n_tokens) says where.  Files are named anew by
    each attempt and the index, itself a written table, lists those of the attempts that ended, so a
    lost executor or a repeated task leaves a file nobody reads.  Rows with one doc_id stay in order
    of a hash of their text; a null doc_id comes first, a null text is empty, an empty table gives no file.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    schema = pa.schema([("doc_id", pa.int64()), ("nth", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("n_tokens", pa.int64())])
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, rows, at = encoder(tokenizer_path, "spaced"), [], 0
        place, path = files_at(folder)
        name = f"{uuid4().hex}.zst"
        writer = None
        for batch in in_slices(batches, "text", 4 << 20):
            if writer is None:
                place.create_dir(path, recursive=True)
                sink = place.open_output_stream(f"{path}/{name}", compression=None)
                writer = FrameWriter(sink, frame_bytes, level)
            for doc, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(batch.column("text"))):
                writer.add(ids.tobytes() + end)
                count = len(ids) + 1
                rows.append((doc, len(rows), name, at, count))
                at += count
        if writer is not None:
            writer.close()
            sink.close()
            for some in range(0, len(rows), 10_000):
                yield batch_of(schema, *zip(*rows[some : some + 10_000]))

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = whole.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    line = ["doc_id", F.xxhash64("text")]  # the sample that ranges are drawn from holds no texts
    ranged = whole.repartitionByRange(parts_for(spark, size, part_bytes), *line).sortWithinPartitions(*line)
    index = ranged.mapInArrow(write, "doc_id long, nth long, file string, at long, n_tokens long")
    return stage(index.select("doc_id", F.spark_partition_id().alias("part"), "nth", "file", "at", "n_tokens").withColumn("folder", F.lit(folder)))


def read_token_files(index: DataFrame, keep_ids: bool = True) -> DataFrame:
    """The documents that rows of an index ask for, read back: doc_id, n_tokens, ids_crc32 and ids.

    A file is one group, at most the ids of one range partition; any subset of an index may be read
    and only the frames that it touches are decompressed.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("nth", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def read(asked: pa.Table) -> pa.Table:
        asked = asked.sort_by("nth")
        place, path = files_at(asked.column("folder")[0].as_py())
        name = f"{path}/{asked.column('file')[0].as_py()}"
        spans = list(zip(asked.column("at").to_pylist(), asked.column("n_tokens").to_pylist()))
        counts, sums, ids = [], [], []
        with place.open_input_file(name) as source:
            for plain in read_ids(source, source.size(), spans):
                counts.append(len(plain) // 4)
                sums.append(zlib.crc32(plain))
                ids.append(plain if keep_ids else None)
        same = [asked.column(c).combine_chunks() for c in ("doc_id", "part", "nth", "at")]
        return pa.Table.from_batches([batch_of(schema, *same, counts, sums, ids)])

    return index.groupBy("file").applyInArrow(read, "doc_id long, part int, nth long, at long, n_tokens long, ids_crc32 long, ids binary")


def with_starts(index: DataFrame, found: DataFrame) -> DataFrame:
    """``start`` of each document: the ids of all documents before it, over all files."""
    spark = index.sparkSession
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before = accumulate((t["n"] for t in totals), initial=0)
    bases = spark.createDataFrame([(t["part"], b) for t, b in zip(totals, before)], "part int, base long")
    return found.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("at")).drop("base")
