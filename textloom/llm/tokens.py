"""Token ids of whole texts with a public tokenizer, encoded word by word through a cache.

The tokenizer never joins characters across ASCII white space: it drops white space
and its pieces hold none.  So the ids of a text are the ids of its words in a row, and only
words that were not seen lately have to be encoded.  Words of plain ASCII are looked up in lower case, as the
tokenizer folds them; all others as they are.  Words are looked up for a whole block of texts at
once, in arrays: a word of up to 16 bytes is told exactly by its length, its first and its last eight bytes;
longer ones go through a dictionary.  The cache is bounded, and what it forgets changes no result.
"""

from __future__ import annotations

import os
import sys
import zlib
from array import array
from functools import lru_cache

import numpy as np

SLOTS = 1 << 20  # pairs of cache places
POOL_IDS = 12_000_000
LONG_WORDS = 100_000
TOKENIZER = "word_bpe_49k.json"
MARKS = b".,!?*#$%&|;:"

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
KEEP_BYTES = np.array([0, *((1 << 8 * n) - 1 for n in range(1, 9))], dtype=np.uint64)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def little_endian(ids: list[int]) -> array:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed


def _framed(texts: list[bytes]) -> bytes:
    return b" " * 8 + b"\n".join(texts) + b"\n" + b" " * 8


def _case_restored(lower: bytes, given: bytes, starts: np.ndarray) -> bytes:
    """``lower`` with the given case in words that are not plain ASCII.

    The tokenizer composes characters before it folds case: where only the lower-case letter has a composed
    form (h, j, t, w or y and a mark), the case decides the ids.
    """
    out, old = np.frombuffer(lower, dtype=np.uint8).copy(), np.frombuffer(given, dtype=np.uint8)
    wide = np.zeros(len(starts), dtype=bool)
    wide[np.searchsorted(starts, np.flatnonzero(out >= 0x80), side="right") - 1] = True
    folded = np.flatnonzero(out != old)
    back = folded[wide[np.searchsorted(starts, folded, side="right") - 1]]
    out[back] = old[back]
    return out.tobytes()


class WordEncoder:
    """Ids of texts as arrays of unsigned 32-bit numbers."""

    def __init__(self, path: str, slots: int = SLOTS, pool_ids: int = POOL_IDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.slots, self.pool_ids = slots, pool_ids
        self._reset()

    def _reset(self) -> None:
        n = 2 * self.slots
        self.low, self.high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        self.size = np.zeros(n, np.uint8)  # of the word in bytes; 0: the place is free
        self.at, self.count = np.zeros(n, np.int32), np.zeros(n, np.int16)
        self.pool = np.empty(self.pool_ids, dtype=self.kind)
        self.filled = 0
        self.long: dict[bytes, tuple[int, int]] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        # upper and lower case share a place, but a text that may name a special token keeps its case
        given = [(t or "").encode() for t in texts]
        data = [(raw if b"<|" in raw else raw.lower()) for raw in given]
        joined = _framed(data)
        whole = np.frombuffer(joined, dtype=np.uint8)
        space = SPACE[whole]
        starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
        ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        if not joined.isascii():
            joined = _case_restored(joined, _framed(given), starts)
        at, count = self._find(joined, starts, ends)
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self.pool[np.repeat(at - total[:-1], count) + np.arange(total[-1])].astype("<u4")
        text_ends = 8 + np.cumsum([len(d) + 1 for d in data])
        cuts = total[np.searchsorted(starts, text_ends)]
        return np.split(ids, cuts[:-1])

    def _find(self, joined: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the pool and number of ids of each word."""
        sizes = ends - starts
        eight = np.ndarray(len(joined) - 7, dtype="<u8", buffer=joined, strides=(1,))
        low = eight[starts] & KEEP_BYTES[np.minimum(sizes, 8)]
        high = np.where(sizes > 8, eight[ends - 8], np.uint64(0))
        mixed = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (high * np.uint64(0xC2B2AE3D27D4EB4F)) ^ sizes.astype(np.uint64)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        place = 2 * (mixed >> np.uint64(32)).astype(np.int64) % (2 * self.slots)
        short = sizes <= 16
        found = np.zeros(len(starts), dtype=bool)
        at, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        for side in (0, 1):
            here = place + side
            same = (self.low[here] == low) & (self.high[here] == high) & (self.size[here] == sizes) & short & ~found
            at[same], count[same] = self.at[here[same]], self.count[here[same]]
            found |= same
        missing = np.flatnonzero(~found)
        if not len(missing):
            return at, count
        names = [joined[s:e] for s, e in zip(starts[missing].tolist(), ends[missing].tolist(), strict=True)]
        todo = {w: None for w in names if w not in self.long}
        room = 8 * len(todo) + sum(map(len, todo))  # more ids than the words can have
        if self.filled + room > self.pool_ids:
            if self.filled:
                self._reset()
                return self._find(joined, starts, ends)
            self.pool_ids = room
            self.pool = np.empty(room, dtype=self.kind)
        if len(self.long) > LONG_WORDS:
            self.long = {}
            todo = dict.fromkeys(names)
        known = self._learn(list(todo))
        where = [known.get(w) or self.long[w] for w in names]
        at[missing], count[missing] = np.array(where, dtype=np.int64).T
        self.long.update((w, p) for w, p in known.items() if len(w) > 16)
        new = missing[short[missing]]
        side = new & 1  # either place of the pair, a free one first
        here = place[new] + np.where(self.size[place[new]] == 0, 0, np.where(self.size[place[new] + 1] == 0, 1, side))
        last = np.unique(here, return_index=True)[1]  # one word per place
        here, new = here[last], new[last]
        self.low[here], self.high[here], self.size[here] = low[new], high[new], sizes[new]
        self.at[here], self.count[here] = at[new], count[new]
        return at, count

    def _learn(self, words: list[bytes]) -> dict[bytes, tuple[int, int]]:
        """Encode words into the pool; marks at the end of a word of plain letters are a piece of their own."""
        parts: dict[bytes, array | None] = {}
        split = []
        for word in words:
            body = word.rstrip(MARKS) if word[-1] in MARKS else word
            if len(body) < len(word) and body.isalpha():
                split.append((body, word[len(body) :]))
                parts[body] = parts[word[len(body) :]] = None
            else:
                split.append((word, b""))
                parts[word] = None
        todo = list(parts)
        for start in range(0, len(todo), 4096):
            some = todo[start : start + 4096]
            encoded = self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)
            parts.update(zip(some, [little_endian(e.ids) for e in encoded], strict=True))
        parts[b""] = array("I")
        pieces = [parts[body] + parts[end] for body, end in split]
        sizes = [len(p) for p in pieces]
        begins = (self.filled + np.concatenate([[0], np.cumsum(sizes)])).astype(int).tolist()
        self.pool[self.filled : begins[-1]] = np.frombuffer(b"".join(p.tobytes() for p in pieces), dtype="<u4")
        self.filled = begins[-1]
        return dict(zip(words, zip(begins, sizes, strict=False), strict=True))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
