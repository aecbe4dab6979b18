"""Token ids of whole texts, each distinct piece of text encoded once while it is kept.

A text is cut where the tokenizer cuts it in any case, so the ids of the pieces, one after the other,
are those of the whole.  ``words``: at white space, for a tokenizer that drops it.  ``spaced``: before a
space or line end that a visible character follows, for byte-level ones, where it begins a new piece.
A text that may hold the string of a special token is encoded whole, since such a string parts a text
before the tokenizer does.

Most new words are plain ones.  Where it is known how the tokenizer lower-cases and parts those, its model
is given the parts; the ids are the same for a third of the time.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from ratewell.llm.common import kept_by_worker
from ratewell.llm.words import Words, parted_words, spaced_pieces, text_bytes, words_of

#: Words of visible ASCII and Latin-1 letters: composed already, and lower-cased letter by letter.
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: What the pattern below finds in a plain word in lower case.
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUTS = [
    {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def known_parts(tokenizer) -> dict | None:
    """The letters that the tokenizer's model has for each other letter of plain words.

    None if the tokenizer doesn't do just this before its model: NFC, lower case, the parts above, bytes as letters.
    """
    steps = [json.loads(x.__getstate__()) if x else {} for x in (tokenizer.normalizer, tokenizer.pre_tokenizer)]
    if steps[0].get("normalizers") != _NORMAL or steps[1].get("pretokenizers") != _CUTS:
        return None
    letters = [c for c in map(chr, range(0xDF, 0x100)) if PLAIN.match(c)]
    return str.maketrans({c: tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters})


def encoder(path: str, cut: str, special: bool = True, keep: int = 1_500_000) -> Encoder:
    """The encoder of this worker, with the pieces it knows from earlier tasks."""
    return kept_by_worker(("encoder", path, cut, special, keep), lambda: Encoder(path, cut, keep, special))


class Encoder:
    """Ids of texts as unsigned 32-bit numbers; keeps the ids of at most ``keep`` pieces and a batch.

    The ids are those of ``encode(text, add_special_tokens=False)``: the string of a special token in a
    text is that token.  Without ``special`` it is ordinary text.
    """

    def __init__(self, path: str, cut: str, keep: int = 1_500_000, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        strings = {t.content[:2].encode() for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.marks = strings if special else set()
        self.cut, self.keep = cut, keep
        self.letters = known_parts(self.tokenizer) if cut == "words" and special else None
        self.forget()

    def forget(self) -> None:
        self.known, self.at = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.first, self.ids = np.zeros(1, np.int64), np.empty(0, np.uint32)

    def learn(self, found: Words, hashes: np.ndarray, where: np.ndarray) -> None:
        """Encode the pieces ``where`` and keep their ids under their hashes, which ascend."""
        data, counts, ids = found.data, [], []
        for at in range(0, len(where), 8192):
            some = where[at : at + 8192]
            texts = [data[s:e].tobytes().decode() for s, e in zip(found.start[some].tolist(), found.end[some].tolist())]
            coded = self.ids_of(texts)
            counts.extend(map(len, coded))
            ids.append(np.fromiter(chain.from_iterable(coded), np.uint32))
        place = np.searchsorted(self.known, hashes)
        self.at = np.insert(self.at, place, len(self.first) - 1 + np.arange(len(hashes)))
        self.known = np.insert(self.known, place, hashes)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(counts, dtype=np.int64)])
        self.ids = np.concatenate([self.ids, *ids])

    def ids_of(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each piece, those of plain words from the model alone."""
        plain = [self.letters is not None and PLAIN.fullmatch(x) is not None for x in pieces]
        rest = [x for x, p in zip(pieces, plain) if not p]
        others = (x.ids for x in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        model = self.tokenizer.model.tokenize
        as_bytes = lambda part: part if part.isascii() else part.translate(self.letters)
        return [
            [t.id for part in PARTS.findall(x.lower()) for t in model(as_bytes(part))] if p else next(others)
            for x, p in zip(pieces, plain)
        ]

    def encode(self, column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
        """The ids of every text of a column; null counts as empty."""
        raw, bounds = text_bytes(column)
        raw, whole = raw.tobytes(), set()
        for mark in self.marks:  # texts with the first two bytes of a special token's string
            at = raw.find(mark)
            while at >= 0:
                row = int(np.searchsorted(bounds, at, "right")) - 1
                whole.add(row)
                at = raw.find(mark, int(bounds[row + 1]))
        ids = self.by_pieces(column)
        for row in whole:
            text = raw[bounds[row] : bounds[row + 1]].decode()
            ids[row] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        return ids

    def by_pieces(self, column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
        """The ids of every text, from those of its pieces."""
        if self.letters:
            found = parted_words(column)
        else:
            found = words_of(column, lower=False) if self.cut == "words" else spaced_pieces(column)
        hashes, where, which = np.unique(found.hashes, return_index=True, return_inverse=True)
        if len(self.known) > self.keep:
            self.forget()
        place = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = self.known[place] != hashes if len(self.known) else np.ones(len(hashes), bool)
        if new.any():
            self.learn(found, hashes[new], where[new])
        at = self.at[np.searchsorted(self.known, hashes)][which]
        low, count = self.first[at], self.first[at + 1] - self.first[at]
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(low - total[:-1], count) + np.arange(total[-1])]
        bounds = total[found.first]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
