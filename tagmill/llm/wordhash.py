"""Words and windows of words as 64-bit hashes, for whole Arrow buffers at once.

A word is a run of bytes other than the space and bytes 9 to 13. Its hash takes eight bytes a step, each step
mixed with the one before, so words of up to eight bytes of one length never collide and longer ones only by
chance; two lanes with seeds of their own make 128 bits. A window of n words is a polynomial over its words'
hashes modulo the prime 2**61 - 1, taken as a difference of prefix sums (rolling, Rabin-Karp), then mixed.
Operators that must not err confirm equal hashes on the words themselves.
"""

from __future__ import annotations

import hashlib

import numpy as np

PRIME = np.uint64((1 << 61) - 1)
#: Words of a piece of text whose windows are hashed in one go.
PIECE = 1 << 19
_BASE = (0x16A09E667F3BCC90, 0x1BB67AE8584CAA73)
_SEED = (0x5851F42D4C957F2D, 0x14057B7EF767814F)
#: Longer words, in bytes, are hashed one by one.
_LONG = 256
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of numbers below the prime, modulo the prime."""
    low, shift = np.uint64(0xFFFFFFFF), np.uint64(32)
    ah, al, bh, bl = a >> shift, a & low, b >> shift, b & low
    middle, least = ah * bl + al * bh, al * bl
    # 2**64 is 8, and 2**61 is 1
    out = (ah * bh << np.uint64(3)) + (middle >> np.uint64(29)) + ((middle & np.uint64((1 << 29) - 1)) << shift)
    return _reduced(out + (least & PRIME) + (least >> np.uint64(61)))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo the prime."""
    have = _powers.get(base, np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, times(have, np.uint64(pow(base, len(have), int(PRIME))))])
    _powers[base] = have
    return have[:n]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n + 1 bounds of each text among them."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
    space = _SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    before, after = edge[:n].copy(), edge[1:].copy()
    before[0] = after[-1] = True
    before[1:] |= space[:-1]
    after[:-1] |= space[1:]
    word = ~space
    starts, ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return _FOLD[data]


def word_hashes(data: np.ndarray, bounds: np.ndarray, lower: bool, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and the bounds of each text among them; lower: A-Z count as a-z."""
    starts, ends, at = word_spans(data, bounds)
    return hashes_of(lowered(data) if lower else data, starts, ends, lane), at


def hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """The hashes of the strings data[starts:ends]."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # eight bytes from every place on
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    sizes = ends - starts
    out = mix64(sizes.astype(np.uint64) + np.uint64(_SEED[lane]))
    long = sizes > _LONG
    go, step = np.flatnonzero(~long & (sizes > 0)), 0
    while len(go):
        left = sizes[go] - 8 * step
        out[go] = mix64(out[go] ^ (eight[starts[go] + 8 * step] & _MASKS[np.minimum(left, 8)]))
        go, step = go[left > 8], step + 1
    for i in np.flatnonzero(long).tolist():
        word = data[starts[i] : ends[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=bytes([lane])).digest(), "little")
    return out


def sequence_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """The hashes of the sequences words[starts:ends] of words, by their definition; for short ones."""
    value, sizes = np.zeros(len(starts), np.uint64), ends - starts
    for j in range(int(sizes.max(initial=0))):
        go = np.flatnonzero(sizes > j)
        term = times(_reduced(words[starts[go] + j]), np.uint64(pow(_BASE[lane], j, int(PRIME))))
        value[go] = _reduced(value[go] + term)
    return mix64(value ^ (sizes.astype(np.uint64) << np.uint64(61)))


def window_hashes(words: np.ndarray, at: np.ndarray, size: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each window of `size` words inside one text, its first word, and the bounds of each text among them."""
    counts = np.maximum(np.diff(at) - size + 1, 0)
    to = np.concatenate([[0], np.cumsum(counts)])
    first = np.arange(to[-1]) + np.repeat(at[:-1] - to[:-1], counts)
    if not len(first):
        return np.empty(0, np.uint64), first, to
    every = [_rolling(words[a : a + PIECE + size - 1], size, lane) for a in range(0, len(words) - size + 1, PIECE)]
    return np.concatenate(every)[first], first, to


def _rolling(words: np.ndarray, size: int, lane: int) -> np.ndarray:
    """The hash of every window of `size` words."""
    n, half = len(words), np.uint64(31)
    term = times(_reduced(words), powers(_BASE[lane], n))
    low, high = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
    np.cumsum(term & np.uint64((1 << 31) - 1), out=low[1:])
    np.cumsum(term >> half, out=high[1:])
    high = _reduced(high)
    sums = _reduced(low + ((high & np.uint64((1 << 30) - 1)) << half) + (high >> np.uint64(30)))
    # sum over j in [s, s + size) of w_j * base**j, moved to position 0
    moved = times(_reduced(sums[size:] + PRIME - sums[:-size]), powers(pow(_BASE[lane], -1, int(PRIME)), n - size + 1))
    return mix64(moved ^ (np.uint64(size) << np.uint64(61)))
