"""64-bit hashes of words and word sequences, computed over flat numpy arrays inside tasks."""

from __future__ import annotations

import numpy as np

_M1, _M2, _G = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_G), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finisher)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _G)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, *range(9, 14)]] = False
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64, kept per worker."""
    if len(_powers["up"]) < n:
        size = max(n, 1 << 16, 2 * len(_powers["up"]))
        with np.errstate(over="ignore"):
            for name, base in (("up", _G), ("down", _INVERSE)):
                _powers[name] = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)])
    return _powers["up"][:n], _powers["down"]


def word_hashes(text: bytes | None) -> np.ndarray:
    """Hash of each word of a UTF-8 text, in order. Words are runs of bytes other than space and
    tab to carriage return; a word's hash is its part of a running polynomial over the bytes of the
    text, brought to the place of its first byte, with its length, mixed."""
    if not text:
        return np.empty(0, np.uint64)
    b = np.frombuffer(text, np.uint8)
    edges = np.flatnonzero(np.diff(np.r_[False, _IS_WORD[b], False]))
    lo, hi = edges[::2], edges[1::2]
    up, down = _power(len(b))
    run = np.zeros(len(b) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[b] * up, out=run[1:])
        return mix64((run[hi] - run[lo]) * down[lo] + (hi - lo).astype(np.uint64) * _M1)


def sequence_hashes(h: np.ndarray, k: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of each run of ``k`` consecutive values of ``h``, or of those that start at ``at``:
    a polynomial over the mixed values, mixed again."""
    n = max(0, len(h) - k + 1)
    m = mix64(h)
    out = np.zeros(n if at is None else len(at), np.uint64)
    if len(out):
        with np.errstate(over="ignore"):
            for i in range(k):
                out *= _G
                out += m[i:i + n] if at is None else m[at + i]
    return mix64(out)
