"""A counting quotient filter in numpy: a compact, lossless multiset of fixed-width keys.

A key of ``width`` bits is cut into a quotient (its high bits, the home slot) and a remainder (its
low bits, which the slot stores). Entries lie in order of their keys; those of one quotient form a
run that starts at its home slot or, if that is taken, at the next free one. One bit per quotient
says whether it has a run, one bit per slot marks a run's last slot, and one bit per slot marks a
slot that holds a digit of the count of the entry before it. Filters merge by walking their sorted
remainders side by side; no count is lost and none is made up.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

_HEAD = struct.Struct("<BBQQ")
# Home slots per entry, so that runs stay short.
_SPACE = 1.25


def _sum_by_key(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their counts added up."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


@dataclass
class CountingQuotientFilter:
    width: int
    quotient_bits: int
    occupied: np.ndarray
    run_end: np.ndarray
    is_digit: np.ndarray
    slots: np.ndarray

    @property
    def remainder_bits(self) -> int:
        return self.width - self.quotient_bits

    @classmethod
    def of(cls, keys: np.ndarray, width: int = 64, counts: np.ndarray | None = None) -> CountingQuotientFilter:
        """A filter of uint64 keys below 2 ** width, each as often as it comes (or as counted)."""
        counts = np.ones(len(keys), np.uint64) if counts is None else counts.astype(np.uint64)
        keys, counts = _sum_by_key(keys.astype(np.uint64), counts)
        bits = min(width - 1, max(1, int(np.ceil(np.log2(max(2, len(keys) * _SPACE))))))
        low = np.uint64(width - bits)
        quotients = (keys >> low).astype(np.int64)
        remainders = keys & np.uint64((1 << (width - bits)) - 1)
        # A count of one needs no digit; any other is written in digits as wide as a remainder.
        digits = np.zeros(len(keys), np.int64)
        rest = counts - np.uint64(1)
        while np.any(rest):
            digits += rest > 0
            rest = rest >> low
        before = np.cumsum(1 + digits) - (1 + digits)
        starts = before + np.maximum.accumulate(quotients - before) if len(keys) else before
        size = max(1 << bits, int(starts[-1] + 1 + digits[-1])) if len(keys) else 1 << bits
        made = cls(
            width,
            bits,
            np.zeros(1 << bits, bool),
            np.zeros(size, bool),
            np.zeros(size, bool),
            np.zeros(size, np.uint64),
        )
        made.occupied[quotients] = True
        made.slots[starts] = remainders
        rest = counts - np.uint64(1)
        mask = np.uint64((1 << (width - bits)) - 1)
        for place in range(1, int(digits.max(initial=0)) + 1):
            there = digits >= place
            made.is_digit[starts[there] + place] = True
            made.slots[starts[there] + place] = rest[there] & mask
            rest = rest >> low
        if len(keys):
            last = np.concatenate((quotients[1:] != quotients[:-1], [True]))
            made.run_end[(starts + digits)[last]] = True
        return made

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order, and their counts."""
        quotients = np.flatnonzero(self.occupied)
        ends = np.flatnonzero(self.run_end)
        if not len(quotients):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        starts = np.maximum(quotients, np.concatenate(([0], ends[:-1] + 1)))
        lengths = ends - starts + 1
        runs = np.repeat(np.arange(len(ends)), lengths)
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        used = starts[runs] + inside
        digit = self.is_digit[used]
        heads = np.flatnonzero(~digit)
        low = np.uint64(self.remainder_bits)
        keys = (quotients[runs[heads]].astype(np.uint64) << low) | self.slots[used[heads]]
        counts = np.ones(len(heads), np.uint64)
        place, more = 1, np.arange(len(heads))
        while len(more):
            at = heads[more] + place
            inside = at < len(used)
            more, at = more[inside], at[inside]
            going = digit[at]
            more, at = more[going], at[going]
            counts[more] += self.slots[used[at]] << np.uint64((place - 1) * self.remainder_bits)
            place += 1
        return keys, counts

    @classmethod
    def merged(cls, filters: Iterable[CountingQuotientFilter]) -> CountingQuotientFilter:
        """One filter with the counts of all; they must hold keys of one width."""
        filters = list(filters)
        parts = [each.entries() for each in filters]
        keys = np.concatenate([keys for keys, _ in parts])
        counts = np.concatenate([counts for _, counts in parts])
        return cls.of(keys, filters[0].width, counts)

    def to_bytes(self) -> bytes:
        whole = (self.remainder_bits + 7) // 8
        stored = self.slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :whole]
        return b"".join(
            (
                _HEAD.pack(self.width, self.quotient_bits, len(self.occupied), len(self.slots)),
                np.packbits(self.occupied).tobytes(),
                np.packbits(self.run_end).tobytes(),
                np.packbits(self.is_digit).tobytes(),
                stored.tobytes(),
            )
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        width, bits, homes, size = _HEAD.unpack_from(data)
        at = _HEAD.size

        def flags(number: int) -> np.ndarray:
            nonlocal at
            packed = np.frombuffer(data, np.uint8, (number + 7) // 8, at)
            at += len(packed)
            return np.unpackbits(packed, count=number).astype(bool)

        occupied, run_end, is_digit = flags(homes), flags(size), flags(size)
        whole = (width - bits + 7) // 8
        slots = np.zeros((size, 8), np.uint8)
        slots[:, :whole] = np.frombuffer(data, np.uint8, size * whole, at).reshape(size, whole)
        return cls(width, bits, occupied, run_end, is_digit, slots.view("<u8").reshape(-1).astype(np.uint64))
