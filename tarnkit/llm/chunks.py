"""Token ids and prefix token counts of text chunks, by the word BPE's own rules.

The tokenizer's pre-tokens never reach over white space, so a text's tokens are those of its
chunks between spaces and line feeds, one after the other. Each worker remembers chunks it has seen.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from itertools import accumulate
from operator import sub

import numpy as np
import regex
from tokenizers import Tokenizer

#: Chunks remembered by a worker, in each of two generations, and the longest one it remembers.
CACHED_CHUNKS = 200_000
CACHED_LENGTH = 48

_PUNCTUATION = ".,!?;:$%&*#"


def chunks_of(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


def _byte_symbols() -> list[str]:
    """Byte-level BPE's printable symbol of each byte: Latin-1's printable characters stand for
    themselves, all other bytes for the characters from U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


_SYMBOLS = _byte_symbols()


def _lower(text: str) -> str:
    # a whole string's lower() treats a final sigma apart; all other code points it lowers one by one
    return text.lower() if "Σ" not in text else "".join([c.lower() for c in text])


def _symbols(piece: str) -> str:
    lower = _lower(piece)
    return lower if lower.isascii() and lower.isprintable() else "".join([_SYMBOLS[b] for b in lower.encode("utf-8", "replace")])


def _plain(text: str) -> bool:
    """Whether normalising only lower-cases code points one to one."""
    return text.isascii() or ("İ" not in text and unicodedata.is_normalized("NFC", text))


class _Remembered(dict):
    """A dictionary that computes what it lacks and stays small: when it is full it becomes the old generation, which is asked before anything is
    computed again, so what is used often stays."""

    def __init__(self):
        super().__init__()
        self._old: dict = {}

    def __missing__(self, key):
        value = self._old.get(key)
        return self.keep(key, self.compute(key) if value is None else value)

    def compute(self, key):
        raise NotImplementedError

    def keep(self, key, value):
        if len(self) >= CACHED_CHUNKS:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


class ChunkIds(_Remembered):
    """chunk -> its token ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        super().__init__()
        self._library = Tokenizer.from_file(path)
        self._model = self._library.model
        self._model._resize_cache(0)  # every word comes here once

    def keep(self, chunk: str, ids: bytes) -> bytes:
        return super().keep(chunk, ids) if len(chunk) <= CACHED_LENGTH else ids

    def compute(self, chunk: str) -> bytes:
        word = chunk.rstrip(_PUNCTUATION)
        if word.isalpha() and _plain(word):
            # letters are one pre-token, and so is the punctuation after them
            ids = np.array([t.id for t in self._model.tokenize(_symbols(word))], "<u4").tobytes()
            if len(word) < len(chunk):
                ids += self[chunk[len(word) :]]
        else:
            ids = np.array(self._library.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        return ids

    def of_text(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, chunks_of(text)))


class PrefixCounts(_Remembered):
    """chunk -> how the token count changes with each of its code points, one signed 16-bit number each.

    Within a pre-token, dynamic programming over its prefixes finds the last token of each: the one
    token that ends there and stays apart from the last token of the prefix before it. A prefix has
    one token more than the prefix before its last token. A text cut inside a pre-token ends in the
    marked form of its last symbol (end of word), so the table also holds, for each prefix, the count
    with a marked last token, standing on the unmarked prefix before it.
    """

    PRETOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        super().__init__()
        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges, end = spec["model"]["vocab"], spec["model"]["merges"], spec["model"]["end_of_word_suffix"]
        names = {token.removesuffix(end) for token in vocab} - {""}
        self._endings = _Endings({name: (vocab.get(name), vocab.get(name + end)) for name in names})
        rank: dict[tuple[int, int], int] = {}  # pair of ids -> order of its merge
        halves: dict[int, tuple[int, int, int]] = {}  # id -> order, left and right of the merge that makes it
        for order, (left, right) in enumerate(merges):
            pair = vocab[left], vocab[right]
            rank[pair] = order
            halves.setdefault(vocab[left + right], (order, *pair))
        self._apart = _Apart(halves, rank)
        names = "|".join(regex.escape(t["content"]) for t in spec["added_tokens"])
        self._special = regex.compile(f"({names})") if names else None
        # of each prefix of the word last counted: where it ends, its last unmarked token, its count, the count with a marked end
        self._last, self._states, self._ends, self._counts, self._closed = "", [0], [-1], [0], [0]

    def keep(self, chunk: str, changes: bytes) -> bytes:
        return super().keep(chunk, changes) if len(chunk) <= CACHED_LENGTH else changes

    def learn(self, texts: list[str]) -> None:
        """Count the words of texts that are not remembered, in order, so that each begins where the one before it ends to agree with it."""
        old = self._old
        new = [c for c in set().union(*map(chunks_of, texts)).difference(self.keys()) if c not in old and len(c) <= CACHED_LENGTH]
        words = {_lower(w) for w in {c.rstrip(_PUNCTUATION) for c in new} if w.isalpha() and _plain(w)}
        for word in sorted(words.difference(self.keys(), old.keys())):
            self.keep(word, self._changes(self._word(word)))

    @staticmethod
    def _changes(counts: list[int]) -> bytes:
        return array("h", map(sub, counts, [0, *counts])).tobytes()

    def compute(self, chunk: str) -> bytes:
        word = chunk.rstrip(_PUNCTUATION)
        if not (word.isalpha() and _plain(word)):
            return self._changes(self.prefix_counts(chunk))
        # letters are one pre-token, and so is the punctuation after them; their changes just follow each other
        lower = _lower(word)
        if lower == chunk:
            return self._changes(self._word(lower))
        return self[lower] + (self[chunk[len(word) :]] if len(word) < len(chunk) else b"")

    def of_text(self, text: str) -> np.ndarray:
        """The token count of every prefix of ``text``: entry i is that of its first i + 1 code points."""
        changes = b"\0\0".join(map(self.__getitem__, chunks_of(text)))
        return np.cumsum(np.frombuffer(changes, "<i2"), dtype=np.int64)

    def prefix_counts(self, text: str) -> list[int]:
        """Token counts of the prefixes of a chunk, from the first code point to the whole."""
        parts = self._special.split(text) if self._special and "<" in text else [text]
        out: list[int] = []
        base = 0
        for segment, special in zip(parts[::2], [*parts[1::2], ""]):
            # a special token that is cut is ordinary text
            counts = self._segment(segment + special[:-1])
            out += [base + n for n in counts] if base else counts
            if special:
                base += (counts[len(segment) - 1] if segment else 0) + 1
                out.append(base)
        return out

    def _segment(self, text: str) -> list[int]:
        if _plain(text):
            return self._pretokens(text)
        # normalising moves code points here: the library counts every prefix of each run up to the next word
        out: list[int] = []
        base = 0
        for run in regex.split(r"(?<=[^\p{L}'])(?=\p{L})", text):
            for i in range(1, len(run) + 1):
                out.append(base + len(self._library.encode(run[:i], add_special_tokens=False).ids))
            base = out[-1]
        return out

    def _pretokens(self, text: str) -> list[int]:
        out: list[int] = []
        base = at = 0
        for match in self.PRETOKENS.finditer(text):
            piece = match.group()
            out += [base] * (match.start() - at)
            at = match.end()
            counts = self._word(piece)
            if len(piece) > 1 and piece[0] == "'" and piece[1].isalpha():
                # a contraction is one pre-token only when whole; cut, its quote stands alone
                quote = self._word("'")[-1]
                counts = [quote, *(quote + n for n in self._word(piece[1:-1])), counts[-1]]
            out += [base + n for n in counts] if base else counts
            base = out[-1]
        return out + [base] * (len(text) - at)

    def _word(self, piece: str) -> list[int]:
        """Counts at each code point of one pre-token."""
        lower = _lower(piece)
        if lower.isascii() and lower.isprintable():
            return self._table(lower)
        counts = self._table(_symbols(piece))
        return [counts[e - 1] for e in accumulate(len(c.encode("utf-8", "replace")) for c in lower)]

    def _table(self, symbols: str) -> list[int]:
        """Counts of all prefixes; those that the word before begins with too are known."""
        known = 0
        for a, b in zip(symbols, self._last):
            if a != b:
                break
            known += 1
        states, ends, counts, closed = self._states, self._ends, self._counts, self._closed
        for column in (states, ends, counts, closed):
            del column[known + 1 :]
        follow, tokens, apart, state = self._endings.follow, self._endings.tokens, self._apart, states[-1]
        for i in range(known + 1, len(symbols) + 1):
            state = follow(state, ord(symbols[i - 1]))
            end = marked_end = None
            for length, plain, marked in tokens[state]:
                left = ends[i - length]
                if marked_end is None and marked is not None and (left < 0 or apart[left << 20 | marked]):
                    marked_end = counts[i - length] + 1
                    if end is not None:
                        break
                if end is None and plain is not None and (left < 0 or apart[left << 20 | plain]):
                    end, count = plain, counts[i - length] + 1
                    if marked_end is not None:
                        break
            states.append(state)
            ends.append(end)
            counts.append(count)
            closed.append(marked_end)
        self._last = symbols
        return closed[1:]


class _Endings:
    """Which tokens end at a place: a trie of all tokens, where each node also leads to the longest other one that it ends with."""

    def __init__(self, names: dict[str, tuple[int | None, int | None]]):
        self._next: dict[int, int] = {}  # node << 10 | character -> node
        self._shorter = [0]
        self.tokens: list[tuple[tuple[int, int | None, int | None], ...]] = [()]  # of each node: length, unmarked and marked id; the longest first
        own = [None]
        for name, ids in names.items():
            node = 0
            for character in name:
                key = node << 10 | ord(character)
                node = self._next.setdefault(key, len(own))
                if node == len(own):
                    own.append(None)
            own[node] = (len(name), *ids)
        self._shorter += [0] * (len(own) - 1)
        self.tokens += [()] * (len(own) - 1)
        # children come after their parents, nodes of one depth after all above: by length of the name
        order = sorted(self._next.items(), key=lambda item: item[1])
        depth = [0] * len(own)
        for key, node in order:
            depth[node] = depth[key >> 10] + 1
        for key, node in sorted(order, key=lambda item: depth[item[1]]):
            parent, character = key >> 10, key & 1023
            if parent:
                self._shorter[node] = self.follow(self._shorter[parent], character)
            shorter = self.tokens[self._shorter[node]]
            self.tokens[node] = (own[node], *shorter) if own[node] else shorter

    def follow(self, node: int, character: int) -> int:
        while True:
            found = self._next.get(node << 10 | character)
            if found is not None or not node:
                return found or 0
            node = self._shorter[node]


class _Apart(_Remembered):
    """left id << 20 | right id -> whether merging the symbols of both tokens together gives just these two."""

    def __init__(self, halves: dict[int, tuple[int, int, int]], rank: dict[tuple[int, int], int]):
        super().__init__()
        self._halves, self._rank = halves, rank

    def compute(self, key: int) -> bool:
        return self._holds(key >> 20, key & 0xFFFFF)

    def _holds(self, left: int, right: int) -> bool:
        """Undo the merges of both sides from the latest to the earliest. At each step the tokens that then meet
        at the border would have merged, had that merge come before the one undone last."""
        halves, rank = self._halves, self._rank
        limit = len(rank)
        while True:
            order = rank.get((left, right))
            if order is not None and order < limit:
                return False
            a, b = halves.get(left), halves.get(right)
            if a is None and b is None:
                return True
            # of equal merges the one further left goes first, so the right one is undone first
            if b is None or (a is not None and a[0] > b[0]):
                limit, left = a[0], a[2]
            else:
                limit, right = b[0] + 1, b[1]
