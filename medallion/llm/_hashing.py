"""64-bit hashes of words, word runs and byte runs of many texts at once.

Each byte gets a random 64-bit value; a run's hash is the polynomial of its
values modulo 2^64, from differences of prefix sums, then mixed. Equal runs
have equal hashes everywhere; different ones agree with a chance of about
2^-64. Callers verify or say so.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD6E8FEB86659FD93))
_LOWER = _VALUES.copy()
_LOWER[65:91] = _VALUES[97:123]
#: Word separators of the shingle and window contracts: space and \t to \r.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if len(_powers.get("up", ())) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            out = np.ones(size, np.uint64)
            have = 1
            while have < size:  # doubles: the next stretch is the first one times base**have
                out[have : 2 * have] = out[:have] * _U(pow(base, have, 1 << 64))
                have *= 2
            _powers[name] = out
    return _powers["up"], _powers["down"]


def prefix_sums(buffer: np.ndarray, lower: bool = False) -> np.ndarray:
    up, _ = _power(len(buffer) + 1)
    out = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _VALUES)[buffer] * up[: len(buffer)], out=out[1:])
    return out


def run_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of the byte runs [start, end)."""
    _, down = _power(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """Of the bytes [i, i + width) for each i."""
    n = max(0, len(sums) - width)
    _, down = _power(len(sums))
    return mix((sums[width:] - sums[:n]) * down[:n])


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, a separator after each, and where each begins (one more at the end)."""
    buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
    return buffer, begin


def words(buffer: np.ndarray, begin: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words, and the number of the first word of each text (one more at the end)."""
    edge = np.flatnonzero(np.diff(~SEPARATOR[buffer], prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    return starts, ends, run_hashes(prefix_sums(buffer, lower), starts, ends), np.searchsorted(starts, begin)


_ODD = [_U(int(x) | 1) for x in mix(np.arange(1000, 1064, dtype=np.uint64))]


def word_grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the words [i, i + width) for each i."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += hashes[k : k + n] * _ODD[k]
    return mix(out)
