"""Alignment of two tokenizers over one text, by divide and conquer at shared cuts.

Both tokenizers cut a text's bytes.  In an interval of tokens the end that both have nearest to the
middle is found by bisecting the ends of the second tokenizer; the interval is parted there and so are
its halves, until an interval has no such end inside: it is a group.  All intervals of a batch of texts
are parted at once, level by level.

How many documents link a pair of ids is counted over the corpus.  Documents are dealt into blocks as
they are read; a block names each of its pairs once and asks for their counts, so what is shuffled are a
block's pairs, not those of every document.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import batch_of, kept_by_worker
from ratewell.llm.words import in_slices, runs, spaced_pieces, text_bytes
from ratewell.staging import stage


def byte_level_bytes(path: str) -> tuple[object, list[bytes]]:
    """A byte-level tokenizer that takes special tokens' strings as text, and the bytes of each id."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    # Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {chr(b): b for b in printable}
    shown |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printable))}
    entries = [b""] * tokenizer.get_vocab_size()
    for entry, k in tokenizer.get_vocab().items():
        entries[k] = bytes(shown[c] for c in entry) if all(c in shown for c in entry) else entry.encode()
    return tokenizer, entries


def piece_bytes(path: str) -> tuple[object, list[bytes]]:
    """A tokenizer of pieces, and the bytes of each id."""
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=path)
    entries = []
    for k in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(k)
        entries.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(k) else piece.replace("▁", " ").encode())
    return pieces, entries


class PairEncoder:
    """Ids of both tokenizers for texts that begin with a space; keeps those of at most ``keep`` pieces of text.

    Texts are cut where both tokenizers cut them in any case: before a space or line end that a visible
    character follows and no space precedes.
    """

    def __init__(self, path_a: str, path_b: str, keep: int = 500_000):
        self.a, bytes_a = byte_level_bytes(path_a)
        self.b, bytes_b = piece_bytes(path_b)
        self.entries = bytes_a, bytes_b
        self.sizes = tuple(np.array([len(e) for e in some], np.int64) for some in self.entries)
        self.mark = self.b.piece_to_id("▁")
        self.keep = keep
        self.forget()

    def forget(self) -> None:
        self.known, self.at = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.right = np.empty(0, bool)
        self.first, self.ids = [np.zeros(1, np.int64)] * 2, [np.empty(0, np.uint32)] * 2

    def learn(self, texts: list[bytes], hashes: np.ndarray) -> None:
        plain = [t.decode() for t in texts]
        coded_a = [x.ids for x in self.a.encode_batch_fast(plain, add_special_tokens=False)]
        # The second tokenizer adds a space of its own; before a line end it is a piece alone.
        spaced = [t[:1] == " " for t in plain]
        coded_b = self.b.encode([t[1:] if s else t for t, s in zip(plain, spaced)], num_threads=1)
        own = [s or not ids or ids[0] == self.mark for s, ids in zip(spaced, coded_b)]
        coded_b = [ids if s else ids[1:] for s, ids in zip(spaced, coded_b)]
        right = [
            o and b"".join([self.entries[0][i] for i in a]) == t == b"".join([self.entries[1][i] for i in b])
            for t, a, b, o in zip(texts, coded_a, coded_b, own)
        ]
        at = np.concatenate([self.at, len(self.right) + np.arange(len(texts))])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known)
        self.known, self.at = known[order], at[order]
        self.right = np.concatenate([self.right, np.array(right, bool)])
        for k, coded in enumerate((coded_a, coded_b)):
            ends = self.first[k][-1] + np.cumsum([len(ids) for ids in coded], dtype=np.int64)
            more = np.fromiter(chain.from_iterable(coded), np.uint32)
            self.first = [*self.first[:k], np.concatenate([self.first[k], ends]), *self.first[k + 1 :]]
            self.ids = [*self.ids[:k], np.concatenate([self.ids[k], more]), *self.ids[k + 1 :]]

    def encode(self, column: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """The ids of either tokenizer with the bounds of each text, and whether both give back the text."""
        found = spaced_pieces(column, spaces_together=True)
        hashes, where, which = np.unique(found.hashes, return_index=True, return_inverse=True)
        if len(self.known) > self.keep:
            self.forget()
        place = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = self.known[place] != hashes if len(self.known) else np.ones(len(hashes), bool)
        if new.any():
            spans = zip(found.start[where[new]].tolist(), found.end[where[new]].tolist())
            self.learn([found.data[s:e].tobytes() for s, e in spans], hashes[new])
        at = self.at[np.searchsorted(self.known, hashes)][which]
        out = []
        for first, ids in zip(self.first, self.ids):
            low, count = first[at], first[at + 1] - first[at]
            out.append((ids[runs(low, count)], np.concatenate([[0], np.cumsum(count)])[found.first]))
        wrong = np.concatenate([[0], np.cumsum(~self.right[at])])[found.first]
        return out, np.diff(wrong) == 0


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The tokens of A, ascending, whose end B has too.

    Ends are ascending byte offsets.  Text i has the tokens first[i]:first[i + 1] of A; its last end must
    be an end of B.
    """
    low, high = first[:-1], first[1:] - 1  # candidates inside; the last end is a cut in any case
    found = [high[high >= low]]
    some = low < high
    low, high = low[some], high[some]
    while len(low):
        middle = (low + high) // 2
        cut = np.full(len(low), -1)
        active, radius = np.arange(len(low)), 0
        # The middle alone, then ever wider rings around it.
        while len(active):
            inner = radius // 2 + 1 if radius else 0
            m = middle[active]
            left = np.maximum(m - radius, low[active])
            right = np.minimum(m + radius + 1, high[active])
            if radius:
                near = np.maximum(m - inner + 1, left)  # left:near and far:right haven't been looked at
                far = np.minimum(m + inner, right)
            else:
                near, far = right, right
            counts = np.concatenate([near - left, right - far])
            spots = runs(np.concatenate([left, far]), counts)
            owner = np.repeat(np.concatenate([active, active]), counts)
            value = ends_a[spots]
            hit = ends_b[np.minimum(np.searchsorted(ends_b, value), len(ends_b) - 1)] == value
            spots, owner = spots[hit], owner[hit]
            # Of each interval's hits the nearest to the middle, the earlier of two.
            order = np.lexsort((spots, np.abs(spots - middle[owner]), owner))
            owner, spots = owner[order], spots[order]
            nearest = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, bool)
            cut[owner[nearest]] = spots[nearest]
            open_ = (cut[active] < 0) & ((m - radius > low[active]) | (m + radius + 1 < high[active]))
            active = active[open_]
            radius = 2 * radius if radius else 1
        parted = cut >= 0
        found.append(cut[parted])
        low, high, cut = low[parted], high[parted], cut[parted]
        low, high = np.concatenate([low, cut + 1]), np.concatenate([cut, high])
        some = low < high
        low, high = low[some], high[some]
    return np.sort(np.concatenate(found))


def written_ids(ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of decimal numbers, a mark after each, and where each number's bytes end."""
    digits = max(len(str(int(ids.max()))), 1) if len(ids) else 1
    out = np.empty((len(ids), digits + 1), np.uint8)
    keep = np.ones((len(ids), digits + 1), bool)
    left = ids.astype(np.int64)
    for k in range(digits - 1, -1, -1):
        out[:, k] = left % 10 + ord("0")
        keep[:, k] = (left > 0) | (k == digits - 1)
        left = left // 10
    out[:, -1] = marks
    return out[keep], np.cumsum(keep.sum(axis=1))


class Aligned:
    """The groups and links of a batch of texts, from both tokenizers' ids and the bounds of each text."""

    def __init__(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], sizes: tuple[np.ndarray, np.ndarray]):
        (self.ids_a, self.first_a), (self.ids_b, self.first_b) = a, b
        self.ends_a, self.ends_b = (np.cumsum(size[ids]) for size, ids in zip(sizes, (self.ids_a, self.ids_b)))
        self.cuts = shared_cuts(self.ends_a, self.ends_b, self.first_a) if len(self.ids_a) else np.empty(0, np.int64)

    def groups(self) -> np.ndarray:
        """Groups of each text."""
        return np.diff(np.searchsorted(self.cuts, self.first_a))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The A and B id of every pair of tokens whose bytes overlap, and the bounds of each text."""
        starts = self.ends_a - np.diff(np.concatenate([[0], self.ends_a]))
        low = np.searchsorted(self.ends_b, starts, "right")
        count = np.searchsorted(self.ends_b, self.ends_a, "left") - low + 1
        bounds = np.concatenate([[0], np.cumsum(count)])[self.first_a]
        return np.repeat(self.ids_a, count), self.ids_b[runs(low, count)], bounds

    def digests(self) -> list[str]:
        """sha256 of ``a1,a2|b1;a3|b2,b3`` for each text, empty for a text without tokens."""
        n_a, n_b = len(self.ids_a), len(self.ids_b)
        last_b = np.searchsorted(self.ends_b, self.ends_a[self.cuts])  # the last token of B in each group
        size_a, size_b = np.diff(np.concatenate([[-1], self.cuts])), np.diff(np.concatenate([[-1], last_b]))
        place_a = np.arange(n_a) + np.repeat(last_b + 1 - size_b, size_a)
        place_b = np.arange(n_b) + np.repeat(self.cuts + 1, size_b)
        ids, marks = np.empty(n_a + n_b, np.uint32), np.full(n_a + n_b, ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.ids_a, self.ids_b
        marks[place_a[self.cuts]], marks[place_b[last_b]] = ord("|"), ord(";")
        data, ends = written_ids(ids, marks)
        upto = np.concatenate([[0], ends])[self.first_a + self.first_b]
        data = memoryview(np.ascontiguousarray(data))
        return [hashlib.sha256(data[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(upto[:-1].tolist(), upto[1:].tolist())]


def align_tokens(docs: DataFrame, path_a: str, path_b: str, slice_bytes: int = 3 << 20) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): how the tokens of two tokenizers lie over its text.

    A is a byte-level tokenizer, B one of pieces that puts a space before a text; A is given that space.
    Returns doc_id, n_a and n_b (tokens), n_groups, n_links (pairs of tokens whose bytes overlap), n_best
    (links whose pair of ids is held linked by as many documents as any pair of its A id), count_sum (the
    documents that hold a link's pair, summed over links) and groups_sha256 of the groups' ids.  A text that
    is null, empty or not given back by both tokenizers has no tokens: zeros and ''.  A repeated row is a
    document of its own; null ids stay null; an empty table gives no rows; other columns are left out.

    Texts are read once, in slices of ``slice_bytes``; a longer text is a slice of its own.  The table of
    counts is never in one place: a slice is joined with the counts of its own pairs.
    """
    kept = pa.schema([
        ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("groups_sha256", pa.string()), ("steps", pa.binary()), ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int32())),
    ])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept_by_worker(("pair", path_a, path_b), lambda: PairEncoder(path_a, path_b))
        width = len(coder.entries[1])
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        for nth, batch in enumerate(in_slices(batches, "text", slice_bytes)):
            block = task << 32 | nth
            column = batch.column("text")
            both, right = coder.encode(column)
            right &= np.diff(both[0][1]) > 0
            right &= np.diff(text_bytes(column)[1]) > 1
            cleared = []
            for ids, first in both:  # texts that aren't given back have no tokens
                count = np.where(right, np.diff(first), 0)
                cleared.append((ids[runs(first[:-1], count)], np.concatenate([[0], np.cumsum(count)])))
            found = Aligned(*cleared, coder.sizes)
            a, b, bounds = found.links()
            pairs, which = np.unique(a.astype(np.int64) * width + b, return_inverse=True)
            # A text's pairs once each, by their number in the slice, with how often it links them.
            size = np.diff(bounds)
            own, times = np.unique(np.repeat(np.arange(len(size)), size) * max(len(pairs), 1) + which, return_counts=True)
            upto = np.searchsorted(own, np.arange(len(size) + 1) * max(len(pairs), 1))
            own %= max(len(pairs), 1)
            held = np.bincount(own, minlength=len(pairs))
            steps, times = own.astype("<u4"), times.astype("<u4")
            steps[1:] -= steps[:-1].copy()
            begins = upto[:-1][upto[:-1] < upto[1:]]
            steps[begins] = own[begins]
            part = lambda x: [x[s:e].tobytes() for s, e in zip(upto[:-1].tolist(), upto[1:].tolist())]  # noqa: E731,B023
            n = batch.num_rows
            yield batch_of(
                kept, np.full(n, block), batch.column("doc_id"), np.diff(cleared[0][1]), np.diff(cleared[1][1]), found.groups(), size,
                found.digests(), part(steps), part(times), pa.nulls(n, kept.field("pairs").type), pa.nulls(n, kept.field("held").type),
            )
            if len(pairs):
                named = pa.ListArray.from_arrays(np.array([0, len(pairs)], np.int32), pa.array(pairs))
                counted = pa.ListArray.from_arrays(np.array([0, len(pairs)], np.int32), pa.array(held.astype(np.int32)))
                yield batch_of(kept, [block], *[pa.nulls(1, f.type) for f in list(kept)[1:-2]], named, counted)

    kind = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, steps binary, times binary, pairs array<long>, held array<int>"
    text = F.concat(F.lit(" "), F.coalesce("text", F.lit("")))
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(align, kind))
    asked = rows.where("pairs is not null").select(F.col("block").alias("asker"), F.explode(F.arrays_zip("pairs", "held")).alias("p"))
    asked = asked.select("asker", F.col("p.pairs").alias("pair"), F.col("p.held").alias("held"))
    return _scored(rows.where("n_a is not null"), asked, piece_count(path_b))


def piece_count(path: str) -> int:
    return len(piece_bytes(path)[1])


def _scored(rows: DataFrame, asked: DataFrame, width: int) -> DataFrame:
    """``rows`` with the counts of their links, from the pairs that each block asks for."""
    counts = stage(asked.groupBy("pair").agg(F.sum("held").alias("n")).withColumn("a", F.expr(f"pair div {width}")))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    known = counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = asked.select("asker", "pair").join(known, "pair")
    out = pa.schema([
        ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()),
        ("count_sum", pa.int64()), ("groups_sha256", pa.string()),
    ])

    def score(some: pa.Table, told: pa.Table) -> pa.Table:
        order = np.argsort(told.column("pair").to_numpy())
        n = told.column("n").to_numpy()[order]
        best = told.column("best").to_numpy(zero_copy_only=False)[order]
        sums, tops = [], []
        for steps, times in zip(some.column("steps"), some.column("times")):
            own = np.cumsum(np.frombuffer(steps.as_buffer(), "<u4"), dtype=np.int64)
            times = np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
            sums.append(int((n[own] * times).sum()))
            tops.append(int(times[best[own]].sum()))
        columns = [some.column(c).combine_chunks() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.Table.from_batches([batch_of(out, *columns, tops, sums, some.column("groups_sha256").combine_chunks())])

    named = rows.select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "steps", "times")
    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return named.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(score, kind)
