"""Hashed words and word shingles in numpy, for the operators on word sequences."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes hashed at once.
PIECE = 1 << 20
#: Words of more bytes are hashed one by one, by another function: sums of powers modulo 2^64 are alike for some
#: long words that repeat two parts in the order of the Thue-Morse sequence.
SHORT = 32

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x5851F42D4C957F2B
_LETTER = np.random.default_rng(20240301).integers(0, 1 << 64, 256, dtype=np.uint64)
_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, up to n."""
    if len(_tables[0]) <= n:
        size = min(PIECE, 2 * n) + 1
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _tables[i] = np.multiply.accumulate(table)
    return _tables[0], _tables[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _piece_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word: random letters times powers of a base, from prefix sums."""
    n = len(raw)
    blank = np.ones(n + 2, bool)
    np.take(_BLANK, raw, out=blank[1:-1])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTER[raw] * power[:n], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > SHORT):
        hashes[i] = _long_word(raw[starts[i] : ends[i]])
    return hashes, starts, ends


def _long_word(raw: np.ndarray) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(raw.tobytes()))


def byte_words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash, the start and the end of each word of UTF-8 bytes."""
    whole = np.frombuffer(raw, np.uint8)
    if len(whole) <= PIECE:
        return _piece_words(whole)
    out, at = [], 0
    while at < len(whole):
        stop = min(len(whole), at + PIECE)
        if stop < len(whole):
            blanks = np.flatnonzero(_BLANK[whole[at:stop]])
            if not len(blanks):  # a word that fills the piece
                while stop < len(whole) and not _BLANK[whole[stop]]:
                    stop += 1
                value = np.array([_long_word(whole[at:stop])], np.uint64)
                out.append((value, np.array([at]), np.array([stop])))
                at = stop
                continue
            stop = at + int(blanks[-1]) + 1
        hashes, starts, ends = _piece_words(whole[at:stop])
        out.append((hashes, starts + at, ends + at))
        at = stop
    return tuple(np.concatenate(c) for c in zip(*out))


def encoded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def word_hashes(text: str, fold: bool = False) -> np.ndarray:
    """The hashes of a text's words, with ``fold`` of A to Z in lower case."""
    raw = encoded(text)
    return byte_words(raw.lower() if fold else raw)[0]


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` words; none if there are fewer."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:count].copy()
    for i in range(1, n):
        out *= _ODD
        out += hashes[i : count + i]
        out ^= out >> np.uint64(29)
    return mixed(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingles of ``n`` words; of fewer words the whole sequence is one, of none there is none."""
    if 0 < len(hashes) < n:
        return window_hashes(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return distinct(window_hashes(hashes, n))
