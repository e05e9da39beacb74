"""BPE by a pair occurrence index over all distinct pieces of a batch at once.

The symbols of all new pieces form one linked list in numpy arrays. An index maps each mergeable pair
(by its rank) to all its positions. Ranks are taken in ascending order; one step merges every position
of a pair, left to right where occurrences overlap, and adds the pairs that appear to the lists of
their ranks, which are higher, as a merge only uses symbols that earlier merges made (checked when
the merges are read). Positions that an earlier merge used up are dropped when their rank comes.

Texts are cut at white space, which the tokenizer drops; pieces are normalised (NFC, lower case letter
by letter), split into letter runs, single digits and runs of other signs, and written as bytes with an
end mark. Special tokens found in a text get their ids; the text around them is encoded by itself.
Decoding gives the symbols' texts joined by spaces, which is what the file, having no decoder, asks for.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import regex

from tillroll.llm.encode import WORD

# The tokenizer file's split pattern, with a line feed to tell pieces apart.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")

MEMORY = 400_000  # pieces remembered by one worker


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones as they are."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def normalised(text: str) -> str:
    if text.isascii():
        return text.lower()
    # letter by letter: a final sigma is lowered like any other
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class PairIndexBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        suffix = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = np.array([self.vocab[c] for c in letters], np.int64)
        self.final = np.array([self.vocab[c + suffix] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in merges], np.int64)
        right = np.array([self.vocab[b] for _, b in merges], np.int64)
        made = np.array([self.vocab[a + b] for a, b in merges], np.int64)
        self.width = max(self.vocab.values()) + 1
        first_made = np.full(self.width, -1, np.int64)
        np.maximum.at(first_made, made, np.arange(len(made)))
        if (first_made[left] >= np.arange(len(made))).any() or (first_made[right] >= np.arange(len(made))).any():
            raise ValueError("a merge uses a symbol that a later merge makes")
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.left, self.right, self.made = left, right, made
        self.known: dict[str, tuple[np.ndarray, str, str]] = {}
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it never merges."""
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def merge(self, symbols: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Apply all merges in place; the mask of positions still in use. ``last`` ends a word."""
        n = len(symbols)
        alive = np.ones(n, bool)
        after = np.arange(1, n + 1)
        after[last] = -1
        before = np.arange(-1, n - 1)
        before[np.flatnonzero(last)[:-1] + 1] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            if not len(at):
                return
            ranks = self._ranks(symbols[at], symbols[after[at]])
            fine = ranks >= 0
            at, ranks = at[fine], ranks[fine]
            if not len(at):
                return
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(active, rank)

        add(np.flatnonzero(~last))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[rank], self.right[rank]
            at = at[alive[at] & (symbols[at] == a) & (after[at] >= 0)]
            at = at[symbols[after[at]] == b]
            if not len(at):
                continue
            if a == b:  # in a run of the same symbol every second position merges
                at = np.unique(at)
                follows = np.concatenate([[False], after[at[:-1]] == at[1:]])
                begin = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - begin) % 2 == 0]
            gone = after[at]
            symbols[at] = self.made[rank]
            alive[gone] = False
            nxt = after[gone]
            after[at] = nxt
            before[nxt[nxt >= 0]] = at[nxt >= 0]
            prev = before[at]
            add(np.concatenate([prev[prev >= 0], at[nxt >= 0]]))
        return alive

    def encode_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece of text without white space."""
        found = SPLIT.findall("\n".join(map(normalised, pieces)) + "\n")
        raw = [w.encode() for w in found]
        is_break = np.array([w == "\n" for w in found], bool)
        sizes = np.array([len(w) for w in raw], np.int64)
        sizes[is_break] = 0
        data = np.frombuffer(b"".join(w for w in raw if w != b"\n"), np.uint8)
        ends = np.cumsum(sizes)
        last = np.zeros(len(data), bool)
        last[ends[~is_break] - 1] = True
        symbols = np.where(last, self.final[data], self.inner[data])
        alive = self.merge(symbols, last) if len(data) else np.zeros(0, bool)
        kept = np.concatenate([[0], np.cumsum(alive)])
        cuts = kept[ends[is_break]]
        return np.split(symbols[alive].astype(np.int32), cuts[:-1]) if len(cuts) else []

    def learn(self, texts: list[str]) -> None:
        """Encode all pieces of these texts that are not known yet."""
        if len(self.known) > MEMORY:
            self.known.clear()
        fresh: set[str] = set()
        for text in texts:
            fresh.update(WORD.findall(text))
        fresh.difference_update(self.known)
        pieces = list(fresh)
        for piece, ids in zip(pieces, self.encode_pieces(pieces)):
            self.known[piece] = (ids, " ".join(map(str, ids.tolist())), self.decode(ids))

    def parts(self, text: str) -> list[str]:
        """The text cut at special tokens, which keep a place of their own."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return [text]
        out, at = [], 0
        for hit in self.special_pattern.finditer(text):
            out += [text[at : hit.start()], hit.group()]
            at = hit.end()
        return [*out, text[at:]]

    def pieces(self, texts: list[str | None]) -> Iterator[list[tuple[np.ndarray, str, str]]]:
        """For each text its pieces as (ids, ids in decimals, decoded)."""
        cut = [self.parts(t or "") for t in texts]
        self.learn([p for parts in cut for p in parts if p not in self.special])
        for parts in cut:
            out = []
            for part in parts:
                if part in self.special and len(parts) > 1:
                    i = self.special[part]
                    out.append((np.array([i], np.int32), str(i), self.names[i]))
                else:
                    out += map(self.known.__getitem__, WORD.findall(part))
            yield out

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [[i for ids, _, _ in found for i in ids.tolist()] for found in self.pieces(texts)]

    def decode(self, ids) -> str:
        """The symbols' texts, special ones included, joined by spaces."""
        names = self.names
        return " ".join([names[i] for i in (ids.tolist() if hasattr(ids, "tolist") else ids)])


_coders: dict[str, PairIndexBpe] = {}


def coder(path: str) -> PairIndexBpe:
    if path not in _coders:
        _coders[path] = PairIndexBpe(path)
    return _coders[path]
