"""Keyed permutations of 0 .. size - 1: a Feistel network over the next even number of bits, with cycle-walking.

A value that the network sends outside the range is sent through again until it
lands inside; the range is at least a quarter of the network's domain, so four
passes are expected at most, and the result is a permutation of the range.
"""

from __future__ import annotations

import hashlib

import numpy as np

ROUNDS = 8


def _subkeys(key: bytes, tweak: bytes) -> list[bytes]:
    return [hashlib.blake2b(tweak, key=hashlib.sha256(key).digest(), salt=bytes([r])).digest() for r in range(ROUNDS)]


class Permutation:
    """Of integers of any size; used where values are few or long."""

    def __init__(self, key: bytes, tweak: bytes, size: int):
        self.size, self.half = size, max(1, ((size - 1).bit_length() + 1) // 2)
        self.keys, self.mask = _subkeys(key, tweak), (1 << self.half) - 1

    def _once(self, value: int) -> int:
        left, right, width = value >> self.half, value & self.mask, (self.half + 7) // 8
        for key in self.keys:
            mixed = int.from_bytes(hashlib.blake2b(right.to_bytes(width, "big"), key=key, digest_size=min(64, width)).digest(), "big")
            left, right = right, left ^ (mixed & self.mask)
        return left << self.half | right

    def __call__(self, value: int) -> int:
        if self.size == 1:
            return value
        value = self._once(value)
        while value >= self.size:
            value = self._once(value)
        return value


class Slots:
    """Of up to 2**62 integers, a NumPy array at a time, and back."""

    def __init__(self, key: bytes, size: int, tweak: bytes = b"slots"):
        if not 0 <= size <= 1 << 62:
            raise ValueError("size must lie between 0 and 2**62")
        self.size, half = size, max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.half, self.mask = np.uint64(half), np.uint64((1 << half) - 1)
        self.keys = [np.uint64(int.from_bytes(k[:8], "big")) for k in _subkeys(key, tweak)]

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = x + key
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        if back:
            for key in reversed(self.keys):
                left, right = right ^ self._mix(left, key), left
        else:
            for key in self.keys:
                left, right = right, left ^ self._mix(right, key)
        return left << self.half | right

    def _walk(self, values: np.ndarray, back: bool) -> np.ndarray:
        out = np.asarray(values).astype(np.uint64)
        open_ = np.arange(len(out)) if self.size > 1 else np.arange(0)
        while len(open_):
            out[open_] = self._once(out[open_], back)
            open_ = open_[out[open_] >= np.uint64(self.size)]
        return out.astype(np.int64)

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, False)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, True)
