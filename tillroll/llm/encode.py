"""Ids of whole texts from the tokenizers library, which sees each distinct piece of text once.

A text is cut before white space that starts a word, where neither tokenizer joins tokens: byte BPE
takes one space into the next word and leaves other white space alone, word BPE drops white space.
The ids of a text are those of its pieces in order. Texts with a special token's opening are given
to the library uncut.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The code points of the Unicode property White_Space.
WHITE_POINTS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WHITE = "".join(map(chr, WHITE_POINTS))
PIECE = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
WORD = re.compile(f"[^{WHITE}]+")

# Pieces that one worker remembers before a new memory is begun; the one before it is kept for look-ups.
MEMORY = 500_000
RUN = 500  # new pieces in one text for the library
# Signs at the end of a word: both tokenizers part a run of them from a letter before it.
SIGNS = ",.;:!?#$%&*|<>"
LAST_LETTER = 0xFF  # of Latin-1: lowering or composing such a letter gives one letter again, unlike U+0130

_encoders: dict[str, "Encoder"] = {}


class Encoder:
    """Encodes batches; ids come back as the bytes of little-endian unsigned 16-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.get_vocab_size(True) > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        drops_white = not self.tokenizer.encode(" \n", add_special_tokens=False).ids
        self.cut = (WORD if drops_white else PIECE).findall
        # A sign that always makes one id of its own between two pieces.
        self.between, self.sign = (" \x01 ", "\x01") if drops_white else ("\n", "\n")
        [self.between_id] = self.tokenizer.encode(self.between, add_special_tokens=False).ids
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("H", x.ids).tobytes() for x in found]

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces; a word and the signs at its end are looked up apart, as most words come with several."""
        stems = {}
        for p in pieces:
            stem = p.rstrip(SIGNS)
            if stem and stem != p and ord(stem[-1]) <= LAST_LETTER and stem[-1].isalpha():
                stems[p] = stem
        wanted = {p for p in pieces if p not in stems}
        wanted.update(stems.values())
        wanted.update([p[len(stem) :] for p, stem in stems.items()])
        self._ask([p for p in wanted if p not in self.known and not self._recalled(p)])
        known = self.known
        for p, stem in stems.items():
            known[p] = known[stem] + known[p[len(stem) :]]

    def _recalled(self, piece: str) -> bool:
        """Whether the memory before this one has the piece, which then passes into this one."""
        ids = self.older.get(piece)
        if ids is None:
            return False
        self.known[piece] = ids
        return True

    def _ask(self, pieces: list[str]) -> None:
        """Ids of pieces: many in one text for the library, told apart by the id between them."""
        odd = [p for p in pieces if self.sign in p or p.isspace()]
        self.known.update(zip(odd, self._library(odd)))
        pieces = [p for p in pieces if p not in self.known] if odd else pieces
        joined = [pieces[i : i + RUN] for i in range(0, len(pieces), RUN)]
        for at in range(0, len(joined), 16):
            runs = joined[at : at + 16]
            for run, raw in zip(runs, self._library([self.between.join(r) for r in runs])):
                cuts = (2 * np.flatnonzero(np.frombuffer(raw, "<u2") == self.between_id)).tolist()
                self.known.update(zip(run, [raw[a:b] for a, b in zip([0, *[c + 2 for c in cuts]], [*cuts, len(raw)])]))

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text, in order; null counts as empty."""
        cut, whole, fresh = [], {}, set()
        if len(self.known) > MEMORY:
            self.known, self.older = {}, self.known
        for at, text in enumerate(texts):
            if not text:
                cut.append(())
            elif any(s in text for s in self.specials):
                cut.append(())
                whole[at] = self._library([text])[0]
            else:
                cut.append(self.cut(text))
                fresh.update(cut[-1])
        fresh = [p for p in fresh if p not in self.known]  # a look-up for each, not a walk over all that is known
        self._learn([p for p in fresh if not self._recalled(p)] if self.older else fresh)
        known = self.known.__getitem__
        for at, pieces in enumerate(cut):
            yield whole[at] if at in whole else b"".join(map(known, pieces))


def encoder(path: str) -> Encoder:
    """One encoder per worker and tokenizer."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def batches(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about ``most`` bytes, with the place of the first; only one run at a time is made of Python strings."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, before = 0, 0
    while start < len(texts):
        end = min(int(np.searchsorted(ends, before + most)) + 1, len(texts))
        yield start, texts.slice(start, end - start).to_pylist()
        start, before = end, int(ends[end - 1])
