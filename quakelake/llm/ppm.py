"""Prediction by partial matching: a context tree of bytes for each language, in numpy tables.

A tree counts, for every context of up to ``ORDER`` bytes, which byte followed. A byte that a context
has not seen costs an escape to the next shorter context; with n bytes seen, d of them different, a
seen byte of count c has probability c / (n + d) and the escape d / (n + d). Below the empty
context all byte values are equally likely. Contexts seen fewer than ``LEAST_SEEN`` times are cut,
so the order varies with what was seen. Statistics are frozen after training, so the cost of a byte
depends on its context alone and every cost is worked out before texts are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

ORDER = 3
LEAST_SEEN = 4
SYMBOLS = 256
# Bytes of a text that are scored at a time.
BYTES_AT_A_TIME = 1 << 20


def prepared(text: bytes) -> bytes:
    """ASCII letters lowered, runs of white space made one blank, a blank at both ends."""
    return b" " + b" ".join(text.lower().split()) + b" "


def symbols_of(text: bytes) -> np.ndarray:
    """Bytes of a prepared text, with ORDER blanks before it as the first context."""
    return np.frombuffer(b" " * (ORDER - 1) + prepared(text), np.uint8)


def contexts(symbols: np.ndarray) -> np.ndarray:
    """For each symbol from number ORDER on, its ORDER predecessors and itself as one number."""
    number = len(symbols) - ORDER
    code = np.zeros(max(0, number), np.int64)
    for i in range(ORDER + 1):
        code = (code << 8) | symbols[i : i + number]
    return code


def runs_of(text: bytes) -> Iterator[np.ndarray]:
    """The runs of a whole text, in parts of bounded size."""
    symbols = symbols_of(text)
    for at in range(0, len(symbols) - ORDER, BYTES_AT_A_TIME):
        yield contexts(symbols[at : at + BYTES_AT_A_TIME + ORDER])


@dataclass
class Counts:
    """How often each run of ORDER + 1 symbols came, in order of the runs."""

    runs: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, codes: np.ndarray) -> Counts:
        return cls(*np.unique(codes, return_counts=True))

    @classmethod
    def summed(cls, runs: np.ndarray, counts: np.ndarray) -> Counts:
        order = np.argsort(runs, kind="stable")
        runs, counts = runs[order], counts[order]
        if not len(runs):
            return cls(runs, counts)
        first = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
        return cls(runs[first], np.add.reduceat(counts, first))


class Tree:
    """Costs in nats of a symbol after its context, under one language's frozen counts.

    Only contexts that are kept have a row of costs. The row of a context of ORDER symbols is found
    in two steps: its first symbols name a page, and its last symbol a row there. Contexts whose
    first symbols were cut share the pages of the shorter context.
    """

    def __init__(self, counts: Counts) -> None:
        rows = [np.full((1, SYMBOLS), np.log(SYMBOLS), np.float32)]
        kept = [np.zeros(1, np.int64)]
        starts = [0]
        for order in range(ORDER + 1):
            found = self._costs(counts, order, kept[-1], rows[-1])
            if not len(found[0]):
                break
            starts.append(starts[-1] + len(kept[-1]))
            kept.append(found[0])
            rows.append(found[1])
        self._flat = np.concatenate(rows).reshape(-1)
        # Lists start with the row below the empty context; then come the contexts of 0, 1, ... symbols.
        empty = starts[min(1, len(starts) - 1)]
        pages = np.full((SYMBOLS, SYMBOLS), empty, np.int64)
        for order in range(1, min(ORDER, len(kept) - 1)):
            places = starts[order + 1] + np.arange(len(kept[order + 1]))
            if order == 1:
                pages[:, kept[2]] = places
            else:
                pages[kept[3] >> 8, kept[3] & 255] = places
        self._page = np.arange(SYMBOLS * SYMBOLS) & 255
        if len(kept) > ORDER + 1:
            longest = kept[ORDER + 1]
            first = np.unique(longest >> 8)
            self._page[first] = SYMBOLS + np.arange(len(first))
            pages = np.concatenate((pages, pages[first & 255]))
            pages[self._page[longest >> 8], longest & 255] = starts[ORDER + 1] + np.arange(len(longest))
        self._rows = pages.reshape(-1)

    @staticmethod
    def _costs(counts: Counts, order: int, shorter: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Kept contexts of one order and the costs after each, by symbol; ``above`` has those of ``shorter``."""
        runs = Counts.summed(counts.runs & ((1 << (8 * (order + 1))) - 1), counts.counts)
        context, symbol = runs.runs >> 8, runs.runs & 255
        every, place, kinds = np.unique(context, return_inverse=True, return_counts=True)
        seen = np.bincount(place, runs.counts, len(every))
        chosen = seen >= LEAST_SEEN
        kept, total = every[chosen], (seen + kinds)[chosen]
        # A context is seen at least as often without its first symbol, so that one is kept too.
        suffix = kept & ((1 << (8 * (order - 1))) - 1) if order else np.zeros(len(kept), np.int64)
        costs = above[np.searchsorted(shorter, suffix)] - np.log(kinds[chosen] / total)[:, None].astype(np.float32)
        held = chosen[place]
        row = (np.cumsum(chosen) - 1)[place[held]]
        costs[row, symbol[held]] = -np.log(runs.counts[held] / total[row])
        return kept, costs.astype(np.float32)

    def cost(self, codes: np.ndarray) -> float:
        """Code length of the symbols, given as runs with their contexts."""
        row = self._rows[(self._page[codes >> 16] << 8) | ((codes >> 8) & 255)]
        return float(self._flat[(row << 8) | (codes & 255)].sum(dtype=np.float64))
