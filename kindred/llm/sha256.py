"""SHA-256 over many messages at once, with states that can be kept and resumed.

Children of a Merkle node are digests as hexadecimal text, 64 bytes each: exactly one block of the hash. So the state between two children is
eight numbers, which a table can hold. The digests are those of :mod:`hashlib`.
"""

from __future__ import annotations

from itertools import count, islice
from math import isqrt

import numpy as np


def _primes():
    return (n for n in count(2) if all(n % d for d in range(2, isqrt(n) + 1)))


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**3 <= n else (low, middle - 1)
    return low


# The standard's constants: fractional parts of square and cube roots of the first primes.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in islice(_primes(), 8)], dtype=np.uint32)
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in islice(_primes(), 64)], dtype=np.uint32)
HEX = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def _turned(x: np.ndarray, *places: int) -> np.ndarray:
    """Exclusive or of the words turned right by each number of places."""
    out = None
    for n in places:
        turned = (x >> np.uint32(n)) | (x << np.uint32(32 - n))
        out = turned if out is None else np.bitwise_xor(out, turned, out=out)
    return out


def resume(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The states ``(8, n)`` after one more block ``(16, n)`` each."""
    w = list(blocks)
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        w.append(w[t - 16] + (_turned(x, 7, 18) ^ (x >> np.uint32(3))) + w[t - 7] + (_turned(y, 17, 19) ^ (y >> np.uint32(10))))
    a, b, c, d, e, f, g, h = states
    for t in range(64):
        first = h + _turned(e, 6, 11, 25) + (g ^ (e & (f ^ g))) + ROUND[t] + w[t]
        second = _turned(a, 2, 13, 22) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h])


def start(n: int) -> np.ndarray:
    return np.repeat(START[:, None], n, axis=1)


def last_block(blocks_before: np.ndarray) -> np.ndarray:
    """The block ``(16, n)`` that ends a message of whole blocks."""
    out = np.zeros((16, len(blocks_before)), dtype=np.uint32)
    bits = blocks_before.astype(np.uint64) * np.uint64(512)
    out[0], out[14], out[15] = 0x80000000, bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return out


def as_bytes(states: np.ndarray) -> np.ndarray:
    """States ``(8, n)`` as bytes ``(n, 32)``; of the last state, these are the digest."""
    return np.ascontiguousarray(states.T).astype(">u4").view(np.uint8).reshape(-1, 32)


def as_states(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.ascontiguousarray(data).view(">u4").astype(np.uint32).T)


def hex_text(digests: np.ndarray) -> np.ndarray:
    """Digests ``(n, 32)`` as lowercase hexadecimal text ``(n, 64)``."""
    return HEX[np.stack([digests >> 4, digests & 15], axis=2).reshape(-1, 64)]


def as_blocks(text: np.ndarray) -> np.ndarray:
    """Text ``(n, 64)`` as blocks ``(16, n)``."""
    return np.ascontiguousarray(np.ascontiguousarray(text).view(">u4").astype(np.uint32).T)
