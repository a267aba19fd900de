"""Sum-of-squares online packing of documents into windows of fixed length.

A document is cut into full windows and a rest. The rest goes where it makes the sum of squared
counts of partly filled windows, counted by fill level, smallest: into a window of some level, or
into a new one. Counts by level are an array, so a choice costs one look at the levels. Each task
packs its own documents: nothing is shuffled. Windows left over at a task's end, and whenever many
are open, fill each other up: all but one of them get full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakelake.llm.support import pick, settle, slices
from quakelake.llm.tokens import encoder, encoder_name, tokenizer_path

WINDOW = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
_BYTES = 4
# Open windows that a task holds, 32 MB of ids at most.
MOST_OPEN = 4096
# Pieces handed on at a time.
_BATCH_BYTES = 8 << 20

PIECES = (
    "doc_id LONG, start LONG, length LONG, doc_tokens LONG, sequence_id LONG, offset LONG, ids BINARY"
)

# (doc_id, start, doc_tokens, ids)
Piece = tuple[int | None, int, int, bytes]


class Packer:
    """Windows being filled; ``add`` and ``close`` return those that are done."""

    def __init__(self, window: int = WINDOW) -> None:
        self.window = window
        # Windows open at each fill level; none is open at level 0 or when full.
        self.counts = np.zeros(window + 1, np.int64)
        self._open: dict[int, list[list[Piece]]] = {}

    def level_for(self, length: int) -> int:
        """The level to fill from, 0 for a new window; of equally good ones the fullest."""
        last = self.window - length
        counts = self.counts
        grown = 2 * counts[length : self.window + 1] + 1
        grown[-1] = 0
        change = grown - 2 * counts[: last + 1] + 1
        change[0] = grown[0]
        allowed = counts[: last + 1] > 0
        allowed[0] = True
        change[~allowed] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def add(self, doc_id: int | None, ids: bytes) -> list[list[Piece]]:
        step = self.window * _BYTES
        number = len(ids) // _BYTES
        whole = number // self.window
        done = [[(doc_id, i * self.window, number, ids[i * step : (i + 1) * step])] for i in range(whole)]
        rest = number - whole * self.window
        if rest:
            level = self.level_for(rest)
            pieces = self._open[level].pop() if level else []
            pieces.append((doc_id, whole * self.window, number, ids[whole * step :]))
            if level:
                self.counts[level] -= 1
            if level + rest == self.window:
                done.append(pieces)
            else:
                self.counts[level + rest] += 1
                self._open.setdefault(level + rest, []).append(pieces)
                if self.counts.sum() > MOST_OPEN:
                    done += self.close()
        return done

    def close(self) -> list[list[Piece]]:
        """All open windows: the fullest take what they lack from the emptiest."""
        by_fill = [(level, pieces) for level in sorted(self._open) for pieces in self._open[level]]
        self._open.clear()
        self.counts[:] = 0
        done, emptiest = [], 0
        while by_fill[emptiest:]:
            level, pieces = by_fill.pop()
            while level < self.window and emptiest < len(by_fill):
                given = by_fill[emptiest][1]
                doc_id, start, number, ids = given.pop()
                lack = self.window - level
                taken, left = ids[: lack * _BYTES], ids[lack * _BYTES :]
                pieces.append((doc_id, start, number, taken))
                level += len(taken) // _BYTES
                if left:
                    given.append((doc_id, start + lack, number, left))
                if not given:
                    emptiest += 1
            done.append(pieces)
        return done


def _pack(path: str | None, name: str, window: int, end_id: int):
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = path or tokenizer_path(name)
        settle(encoder_name(file))
        own = encoder(file)
        end = end_id.to_bytes(_BYTES, "little")
        packer = Packer(window)
        next_id = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        size = 0

        def take(windows: list[list[Piece]]) -> None:
            nonlocal next_id, size
            for pieces in windows:
                offset = 0
                for doc_id, start, number, ids in pieces:
                    length = len(ids) // _BYTES
                    rows.append((doc_id, start, length, number, next_id, offset, ids))
                    offset += length
                    size += len(ids)
                next_id += 1

        def passed_on() -> pa.RecordBatch:
            nonlocal size
            kinds = [pa.int64()] * 6 + [pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            rows.clear()
            size = 0
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in slices(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), own.encode_all(batch.column("text"))):
                take(packer.add(doc_id, ids + end))
                if size >= _BATCH_BYTES:
                    yield passed_on()
        take(packer.close())
        own.rest()
        if rows:
            yield passed_on()

    return of_task


def pack(
    docs: DataFrame, window: int = WINDOW, tokenizer: str = TOKENIZER, end_id: int = END_ID, path: str | None = None
) -> DataFrame:
    """The pieces of all rows: (doc_id, start, length, doc_tokens, sequence_id, offset, ids).

    ``ids`` holds little-endian unsigned 32-bit ids; ``start`` counts the document's ids before the
    piece and ``offset`` those of the sequence. A null text is empty and has the end id alone. A
    null doc_id stays null. Repeated rows are packed each. A document longer than a window fills
    windows of its own and only its rest shares one. An empty table gives no rows. ``path`` names
    another tokenizer file, as the workers see it.
    """
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(_pack(path, tokenizer, window, end_id), PIECES)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids) with the ids of each sequence, padded to the window.

    A sequence that ends at a power of two is not padded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("n_tokens"))
    whole = F.aggregate("parts", F.lit(b""), lambda all_, part: F.concat(all_, part.ids))
    one_bit = F.bit_count("n_tokens") == 1
    filled = F.rpad(whole, F.lit(window * _BYTES), F.lit(pad_id.to_bytes(_BYTES, "little")))
    return joined.select("sequence_id", "n_tokens", F.when(one_bit, whole).otherwise(filled).alias("ids"))
