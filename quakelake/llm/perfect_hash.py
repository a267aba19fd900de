"""A minimal perfect hash over 64-bit keys, with stored fingerprints, in numpy.

Keys are hashed into a bit array with room to spare; those that meet no other key claim their bit,
the rest go on to the next, smaller array with another hash. A key's slot is the number of bits set
before its own: the slots of n keys are 0 to n - 1. Keys never put in land on a slot too, so each
slot stores a fingerprint of its key, which rejects nearly all of them; the caller compares keys
where that is not enough.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

_ROOM = 2
_WORD = 64
_U = np.uint64


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Well-mixed 64-bit hashes of the keys; different seeds give unrelated ones."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + _U((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


@dataclass
class PerfectHash:
    sizes: list[int]
    words: np.ndarray
    before: np.ndarray
    prints: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """The hash of distinct keys (int64 or uint64)."""
        if len(np.unique(keys)) != len(keys):
            raise ValueError("keys must be distinct")
        rest = keys.view(np.uint64)
        sizes, arrays = [], []
        while len(rest):
            size = -(-len(rest) * _ROOM // _WORD) * _WORD
            places = (_mixed(rest, len(sizes)) % _U(size)).astype(np.int64)
            alone = np.bincount(places, minlength=size)[places] == 1
            bits = np.zeros(size, np.uint8)
            bits[places[alone]] = 1
            sizes.append(size)
            arrays.append(np.packbits(bits, bitorder="little"))
            rest = rest[~alone]
        words = np.concatenate(arrays).view("<u8") if arrays else np.zeros(0, "<u8")
        made = cls(sizes, words, cls._ranks(words), np.zeros(len(keys), np.uint32))
        slots, _ = made._slots(keys)
        made.prints[slots] = cls._prints(keys)
        return made

    @staticmethod
    def _ranks(words: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(words).astype(np.int64)
        return np.cumsum(ones) - ones

    @staticmethod
    def _prints(keys: np.ndarray) -> np.ndarray:
        return (_mixed(keys.view(np.uint64), 1 << 20) >> _U(32)).astype(np.uint32)

    def _slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots, found = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        rest, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(rest):
                break
            places = start + (_mixed(keys[rest].view(np.uint64), level) % _U(size)).astype(np.int64)
            word, bit = self.words[places // _WORD], (places % _WORD).astype(np.uint64)
            hit = (word >> bit) & _U(1) == 1
            below = np.bitwise_count(word & ((_U(1) << bit) - _U(1))).astype(np.int64)
            slots[rest[hit]] = (self.before[places // _WORD] + below)[hit]
            found[rest[hit]] = True
            rest, start = rest[~hit], start + size
        return slots, found

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no key has that fingerprint there."""
        slots, found = self._slots(keys)
        if len(self.prints):
            found &= self.prints[slots] == self._prints(keys)
        return np.where(found, slots, -1)

    def to_bytes(self) -> bytes:
        head = struct.pack(f"<II{len(self.sizes)}Q", len(self.sizes), len(self.prints), *self.sizes)
        return head + self.words.tobytes() + self.prints.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        levels, number = struct.unpack_from("<II", data)
        sizes = list(struct.unpack_from(f"<{levels}Q", data, 8))
        at = 8 + 8 * levels
        words = np.frombuffer(data, "<u8", sum(sizes) // _WORD, at)
        prints = np.frombuffer(data, "<u4", number, at + len(words) * 8)
        return cls(sizes, words, cls._ranks(words), prints)
