"""Language-model scores from a weighted backoff automaton over smoothed n-grams.

States are the contexts that occur in training text, the empty one among them.  A state has an arc for
every token seen after it, weighted with the log-probability of the smoothed n-gram, and a failure arc
to the state of the next shorter context, weighted with what smoothing leaves for unseen tokens.  A text
is read once from left to right: the state carried is the longest context that the model has, a token
takes its arc or, through failure arcs, the arc of a shorter context.  The texts of a block are read side
by side, a token of each at a step.

Smoothing: p(w | u) = (c(u, w) + m * p(w | shorter u)) / (c(u) + m); the empty context has additive
smoothing with one more token for all unknown ones, so every state's probabilities sum to one.

The model is never in one place.  Texts are dealt into blocks of bounded size.  A block sends each of
its distinct n-grams once, with its count in training texts, to the partition of that n-gram; partitions
add up and answer with the counts in the order asked, and the block builds the part of the automaton
that its own texts can reach.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.common import batch_of, crc_of_id, parts_for
from ratewell.llm.words import mix, words_of
from ratewell.staging import stage

BEGIN, END = np.uint64(0xB0B0C0DE12345671), np.uint64(0xE0D0C0DE76543211)
STEP = [np.uint64(x) for x in (0, 0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
EXTRA = 0.1  # added to each count of the empty context


@dataclass(frozen=True)
class Grams:
    """The n-grams that end at each token of some texts, the begin mark being a token of its own.

    ``keys[k]`` are the distinct n-grams of k + 1 tokens, ascending; ``at[k]`` which one ends at each
    token (-1 where the text hasn't as many); text i has the tokens first[i]:first[i + 1].
    """

    keys: list[np.ndarray]
    at: list[np.ndarray]
    first: np.ndarray


def grams_of(column: pa.Array | pa.ChunkedArray, order: int) -> Grams:
    found = words_of(column)
    sizes = np.diff(found.first) + 2
    first = np.concatenate([[0], np.cumsum(sizes)])
    tokens = np.empty(first[-1], np.uint64)
    inner = np.ones(len(tokens), bool)
    inner[first[:-1]] = inner[first[1:] - 1] = False
    tokens[inner], tokens[first[:-1]], tokens[first[1:] - 1] = found.hashes, BEGIN, END
    nth = np.arange(len(tokens)) - np.repeat(first[:-1], sizes)
    keys, at, gram = [], [], tokens
    for k in range(order):
        if k:
            with np.errstate(over="ignore"):
                gram = np.concatenate([[np.uint64(0)], mix(gram[:-1] * STEP[k + 1] + tokens[1:])]) if len(gram) else gram
        some = nth >= k
        distinct, which = np.unique(gram[some], return_inverse=True)
        place = np.full(len(tokens), -1)
        place[some] = which
        keys.append(distinct)
        at.append(place)
    return Grams(keys, at, first)


def pack(keys: np.ndarray) -> bytes:
    """Ascending keys as gaps, byte by byte place, so that high zero bytes lie together."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return gaps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


@dataclass(frozen=True)
class Automaton:
    """States are numbers, 0 the empty context.

    ``fail`` and ``penalty``: the state that a state's failure arc leads to and the arc's weight.  ``arcs``
    are ascending, state times ``tokens`` plus token; ``weight`` and ``target`` belong to them.  Weights are
    log10 probabilities.  State 0 has an arc for every token, so every walk ends there at last.
    """

    start: int
    tokens: int
    fail: np.ndarray
    penalty: np.ndarray
    arcs: np.ndarray
    weight: np.ndarray
    target: np.ndarray


def automaton(grams: Grams, counts: list[np.ndarray], total: int, words: int, strength: float) -> Automaton:
    """The part of the model's automaton that these texts can reach; ``counts[k]`` belongs to ``grams.keys[k]``.

    Contexts of fewer tokens than the order that occur in training are states.  The arc of a context and
    a token leads to the longest state that ends them.
    """
    order, tokens = len(grams.keys), len(grams.keys[0])
    before = [np.concatenate([[-1], a[:-1]]) for a in grams.at]
    state, upto = [], 1  # of every n-gram that is a context, 0 for one that doesn't occur in training
    for k in range(order - 1):
        there = counts[k] > 0
        state.append(np.where(there, upto - 1 + np.cumsum(there), 0))
        upto += int(there.sum())
    fail, penalty = np.zeros(upto, np.int64), np.zeros(upto)
    chance = (counts[0] + EXTRA) / (total + EXTRA * (words + 1))
    arcs, weight = [np.arange(tokens)], [np.log10(chance)]
    target = [state[0] if state else np.zeros(tokens, np.int64)]
    for k in range(order):
        sample = np.zeros(len(grams.keys[k]), np.int64)  # a place where the n-gram ends
        inside = np.flatnonzero(grams.at[k] >= 0)
        sample[grams.at[k][inside]] = inside
        if k:
            context, shorter = before[k - 1][sample], grams.at[k - 1][sample]
            chance = (counts[k] + strength * chance[shorter]) / (counts[k - 1][context] + strength)
            seen = counts[k] > 0
            arcs.append(state[k - 1][context[seen]] * tokens + grams.at[0][sample[seen]])
            weight.append(np.log10(chance[seen]))
            target.append(state[k][seen] if k < order - 1 else state[k - 1][shorter[seen]])
        if k < order - 1:
            own = counts[k] > 0
            if k:
                fail[state[k][own]] = state[k - 1][shorter[own]]
            penalty[state[k][own]] = np.log10(strength / (counts[k][own] + strength))
    arcs, weight, target = map(np.concatenate, (arcs, weight, target))
    by = np.argsort(arcs)
    begin = np.searchsorted(grams.keys[0], BEGIN)
    start = int(state[0][begin]) if state and begin < tokens and grams.keys[0][begin] == BEGIN else 0
    return Automaton(start, tokens, fail, penalty, arcs[by], weight[by], target[by])


def walk(grams: Grams, counts: list[np.ndarray], total: int, words: int, strength: float) -> np.ndarray:
    """The log10 probability of every token but the begin marks, which get 0.

    All texts are read from left to right together, a token of each at a step.  A text carries its state;
    its token takes the state's arc or, through failure arcs, that of the first state that has one.
    """
    model = automaton(grams, counts, total, words, strength)
    token, score = grams.at[0], np.zeros(len(grams.at[0]))
    sizes = np.diff(grams.first)
    longest = np.argsort(-sizes, kind="stable")
    reading = np.searchsorted(-sizes[longest], -np.arange(sizes.max(initial=1)), "left")  # texts of more tokens than a step's number
    state = np.full(len(sizes), model.start)
    first = grams.first[:-1][longest]
    for step in range(1, sizes.max(initial=1)):
        n = reading[step]
        at = first[:n] + step
        now, open_ = state[:n], np.arange(n)
        while len(open_):
            want = now[open_] * model.tokens + token[at[open_]]
            place = np.minimum(np.searchsorted(model.arcs, want), len(model.arcs) - 1)
            found = model.arcs[place] == want
            took, missed = open_[found], open_[~found]
            score[at[took]] += model.weight[place[found]]
            now[took] = model.target[place[found]]
            score[at[missed]] += model.penalty[now[missed]]
            now[missed] = model.fail[now[missed]]
            open_ = missed
    return score


def score_texts(docs: DataFrame, order: int = 2, strength: float = 100.0, fold: int = 10, block_bytes: int = 12 << 20) -> DataFrame:
    """Train on the rows whose crc32 of doc_id, as text, mod ``fold`` is not 0 and score all rows.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.  Tokens are words
    with A-Z in lower case and one end per text.  Null and empty texts are the end alone; a null
    doc_id counts as the empty text in the fold; repeated rows are counted and scored as often as they
    occur; without training rows every token is unknown; an empty table gives no rows.
    """
    spark = docs.sparkSession
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        (crc_of_id(F.col("doc_id")) % fold == 0).alias("held_out"),
    )
    size = whole.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    blocks = parts_for(spark, size, block_bytes)
    parts = max(1, -(-size * order // (24 << 20)))
    whole = whole.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    asked = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("k", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
    told = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("k", pa.int32()), ("counts", pa.binary()), ("total", pa.int64()), ("words", pa.int64())])
    scored = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])

    def ask(some: pa.Table) -> pa.Table:
        grams = grams_of(some.column("text"), order)
        learn = np.repeat(~some.column("held_out").to_numpy(zero_copy_only=False), np.diff(grams.first))
        rows, block = [], some.column("block")[0].as_py()
        for k, keys in enumerate(grams.keys):
            counts = np.bincount(grams.at[k][learn & (grams.at[k] >= 0)], minlength=len(keys)).astype("<u4")
            part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            cuts = np.searchsorted(part, np.arange(parts + 1)).tolist()
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if b > a:
                    rows.append((p, block, k, pack(keys[a:b]), zlib.compress(counts[a:b].tobytes(), 1)))
        return pa.Table.from_batches([batch_of(asked, *zip(*rows))])

    def add(some: pa.Table) -> pa.Table:
        rows, part = [], some.column("part")[0].as_py()
        for k in range(order):
            mine = [r for r in some.select(["block", "k", "keys", "counts"]).to_pylist() if r["k"] == k]
            if not mine:
                continue
            keys = [unpack(r["keys"]) for r in mine]
            own = np.concatenate([np.frombuffer(zlib.decompress(r["counts"]), "<u4") for r in mine])
            distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
            every = np.bincount(which, weights=own, minlength=len(distinct)).astype("<u8")
            real = (distinct != BEGIN) & (every > 0)
            sums = (int(every[real].sum()), int(real.sum())) if k == 0 else (0, 0)
            ends = np.cumsum([0, *map(len, keys)])
            for r, a, b in zip(mine, ends, ends[1:]):
                rows.append((r["block"], part, k, zlib.compress(every[which[a:b]].tobytes(), 1), *sums))
                sums = (0, 0)
        return pa.Table.from_batches([batch_of(told, *zip(*rows))])

    asks = whole.groupBy("block").applyInArrow(ask, "part int, block int, k int, keys binary, counts binary")
    answers = asks.groupBy("part").applyInArrow(add, "block int, part int, k int, counts binary, total long, words long")
    answers = stage(answers)
    sums = answers.agg(F.sum("total"), F.sum("words")).first()
    total, words = int(sums[0] or 0), int(sums[1] or 0)

    def score(some: pa.Table, known: pa.Table) -> pa.Table:
        grams = grams_of(some.column("text"), order)
        known = known.sort_by([("k", "ascending"), ("part", "ascending")])
        counts: list[list[np.ndarray]] = [[] for _ in range(order)]
        for k, packed in zip(known.column("k").to_pylist(), known.column("counts")):
            counts[k].append(np.frombuffer(zlib.decompress(packed.as_py()), "<u8"))
        found = [np.concatenate(c).astype(np.float64) for c in counts]
        own = found[0][grams.at[0]]
        inner = np.ones(len(own), bool)
        inner[grams.first[:-1]] = False
        base = np.where(inner, np.log10((own + EXTRA) / (total + EXTRA * (words + 1))), 0)
        best = walk(grams, found, total, words, strength)
        by = lambda x: np.add.reduceat(x, grams.first[:-1])
        return pa.Table.from_batches([
            batch_of(scored, some.column("doc_id").combine_chunks(), some.column("held_out").combine_chunks(),
                     np.diff(grams.first) - 1, by(((own > 0) & inner).astype(np.int64)), by(base), by(best))
        ])

    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"
    result = whole.groupBy("block").cogroup(answers.drop("total", "words").groupBy("block")).applyInArrow(score, kind)
    return result.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )
