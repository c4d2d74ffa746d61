"""Words of whole Arrow text columns as arrays: their places in the bytes and hashes, without an object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
LANES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
LONG_WORD = 4096

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BY_SPACE = ~SPACE
# letters, digits and every byte of a character beyond ASCII
BY_MARK = np.zeros(256, dtype=bool)
for low, high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    BY_MARK[low:high] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20
_REST = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on each other."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column (null: empty) and the places where its texts begin; the last entry is the end."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if values is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(values, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def find_words(data: np.ndarray, offsets: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds): the maximal stretches of ``inner`` bytes within each text.

    The words of text ``i`` are those from ``bounds[i]`` up to ``bounds[i + 1]``.
    """
    inside = np.append(inner[data], False)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    opens[firsts] = inside[firsts]
    closes = ~inside
    closes[offsets] = True
    closes[1:] &= inside[:-1]
    closes[0] = False
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each word; the lanes are independent."""
    seed = LANES[lane]
    length = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    state = mix(length.astype(U64) + U64(seed))
    short = np.flatnonzero(length <= LONG_WORD)
    at, left = starts[short], length[short]
    while len(short):
        state[short] = mix((state[short] ^ (eight[at] & _REST[np.minimum(left, 8)])) + U64(seed))
        more = np.flatnonzero(left > 8)
        short, at, left = short[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length > LONG_WORD).tolist():
        state[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return state


def joined(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): the given words of each text with one blank between them; words are cut at white space."""
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    keep = np.cumsum(edge, dtype=np.int8).astype(bool)
    last = np.zeros(len(starts), dtype=bool)
    last[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
    gaps = ends[~last]
    out = data.copy()
    keep[gaps] = True
    out[gaps] = 0x20
    kept = np.concatenate([[0], np.cumsum(keep[:-1])])
    return out[keep[:-1]], kept[offsets]
