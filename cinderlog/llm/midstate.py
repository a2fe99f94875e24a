"""SHA-256 over whole blocks, many messages at once, with hash states that can be kept and resumed.

A digest as hex text is 64 bytes, which is exactly one block. The state of a hash after some digests is therefore eight
numbers, which a table can hold; hashing goes on from there without the digests before.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

_HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)


def _primes(n: int) -> list[int]:
    found: list[int] = []
    at = 2
    while len(found) < n:
        if all(at % p for p in found):
            found.append(at)
        at += 1
    return found


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= n else (low, mid - 1)
    return low


#: The first 32 bits behind the point of the square roots of the first primes, and of their cube roots.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
ROUNDS = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return x >> np.uint32(by) | x << np.uint32(32 - by)


def absorb(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states (n, 8) after one more block (n, 16) each."""
    w = np.empty((64, len(blocks)), np.uint32)
    w[:16] = blocks.T
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        w[t] = (
            w[t - 16] + w[t - 7] + (_turned(x, 7) ^ _turned(x, 18) ^ x >> np.uint32(3))
            + (_turned(y, 17) ^ _turned(y, 19) ^ y >> np.uint32(10))
        )
    a, b, c, d, e, f, g, h = states.T
    for t in range(64):
        high = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + (e & f ^ ~e & g) + ROUNDS[t] + w[t]
        low = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + (a & b ^ a & c ^ b & c)
        a, b, c, d, e, f, g, h = high + low, a, b, c, d + high, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h], 1)


def started(n: int) -> np.ndarray:
    """The states of n hashes that have read nothing."""
    return np.tile(START, (n, 1))


def finished(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests (n, 8) of messages that ended after so many blocks each."""
    last = np.zeros((len(states), 16), np.uint32)
    last[:, 0] = 1 << 31
    last[:, 15] = np.asarray(blocks, np.uint32) * np.uint32(512)
    return absorb(states, last)


def as_text(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 8) as hex text, (n, 64) bytes."""
    return _HEX[digests.astype(">u4").view(np.uint8).reshape(-1, 32)].reshape(-1, 64)


def as_blocks(text: np.ndarray) -> np.ndarray:
    """Hex texts (n, 64) as blocks (n, 16)."""
    return np.ascontiguousarray(text).view(">u4").astype(np.uint32)
