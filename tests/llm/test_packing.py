import zlib
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quakelake.llm import packing
from quakelake.llm.packing import Packer
from quakelake.llm.tokens import Encoder, tokenizer_path

TOKENIZERS = ("byte_bpe_50k.json", "word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoders():
    return {name: Encoder(tokenizer_path(name)) for name in TOKENIZERS}


@settings(max_examples=300, deadline=None)
@given(st.text("aZé.,!?;: \n\t\r'\"#<|>0٣́ßΣ-%&*×ñ  stdL", max_size=40))
def test_pieces_give_the_ids_of_the_whole(text):
    for name in TOKENIZERS:
        encoder = packing.encoder(tokenizer_path(name))
        assert encoder.encode(text) == encoder.whole(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|EndOfText|> b.", "x" * 50_000, "It's  'LL.\n\n\nno?", "Kİ ΟΔΟΣ."])
def test_special_strings_and_long_words(encoders, text):
    for encoder in encoders.values():
        assert encoder.encode(text) == encoder.whole(text)


def test_the_cache_forgets_and_stays_right(encoders, monkeypatch):
    from quakelake.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    encoder = Encoder(tokenizer_path(TOKENIZERS[0]))
    for i in range(30):
        text = f"word{i % 7} and word{i % 3}, again."
        assert encoder.encode(text) == encoders[TOKENIZERS[0]].whole(text)


def brute_level(counts, length, window):
    """The level whose use leaves the smallest sum of squared counts."""
    best = None
    for level in range(window - length, -1, -1):
        if level and not counts[level]:
            continue
        after = counts.copy()
        if level:
            after[level] -= 1
        if level + length < window:
            after[level + length] += 1
        total = (after.astype(object) ** 2).sum()
        if best is None or total < best[0]:
            best = (total, level)
    return best[1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_levels_are_chosen_by_the_sum_of_squares(lengths):
    packer = Packer(16)
    done = []
    for i, length in enumerate(lengths):
        rest = length % 16
        if rest:
            assert packer.level_for(rest) == brute_level(packer.counts, rest, 16)
        done += packer.add(i, np.full(length, i, "<u4").tobytes())
    done += packer.close()
    fills = [sum(len(piece[3]) // 4 for piece in pieces) for pieces in done]
    assert sum(fills) == sum(lengths)
    assert sum(fill < 16 for fill in fills) <= 1 and max(fills, default=0) <= 16


def test_all_ids_of_all_rows_are_packed_once(docs, clashing, encoders):
    texts = [None, "", " ", "A few words.", "many words " * 3000, "x" * 10_000, "é́\n", "A few words."]
    rows = [(i, text) for i, text in enumerate(texts)] + [(3, "A few words."), (None, "no id")]
    pieces = packing.pack(clashing(docs(*rows)).repartition(3)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for piece in pieces:
        by_doc[piece["doc_id"]].append(piece)
        by_sequence[piece["sequence_id"]].append(piece)
        assert piece["length"] * 4 == len(piece["ids"]) > 0
    for doc_id, text in rows:
        ids = encoders[packing.TOKENIZER].whole(text or "") + (1).to_bytes(4, "little")
        copies = rows.count((doc_id, text))
        starts = sorted(by_doc[doc_id], key=lambda piece: piece["start"])
        assert all(piece["doc_tokens"] * 4 == len(ids) for piece in starts)
        assert sum(len(piece["ids"]) for piece in starts) == copies * len(ids)
        for piece in starts:
            assert piece["ids"] == ids[piece["start"] * 4 :][: len(piece["ids"])]
    for held in by_sequence.values():
        at = 0
        for piece in sorted(held, key=lambda piece: piece["offset"]):
            assert piece["offset"] == at
            at += piece["length"]
        assert at <= packing.WINDOW


def test_sequences_are_padded_unless_a_power_of_two(docs):
    pieces = packing.pack(docs((1, "one two three"), (2, "four"), (3, "five six")).coalesce(1), window=6)
    found = packing.sequences(pieces, window=6).collect()
    assert sorted(row["n_tokens"] for row in found) == [3, 6]
    assert {len(row["ids"]) for row in found} == {24}
    alone = packing.sequences(packing.pack(docs((1, "one")), window=6)).first()
    assert alone["n_tokens"] == 2 and len(alone["ids"]) == 8


def test_an_empty_table(docs):
    assert packing.pack(docs()).count() == 0


def test_crc_is_that_of_the_ids(docs):
    row = packing.pack(docs((1, "one two"))).withColumn("crc", F.crc32("ids")).first()
    assert row["crc"] == zlib.crc32(row["ids"])


def test_open_windows_are_bounded(monkeypatch):
    """Documents of more than half a window, none of which fit together, fill each other up."""
    from quakelake.llm import packing

    monkeypatch.setattr(packing, "MOST_OPEN", 50)
    packer, done = packing.Packer(100), []
    for doc_id in range(1000):
        done += packer.add(doc_id, bytes([doc_id % 251]) * 4 * 60)
        assert packer.counts.sum() <= 50
    done += packer.close()
    fills = [sum(len(ids) // 4 for _, _, _, ids in pieces) for pieces in done]
    assert sum(fills) == 60_000 and sum(fill < 100 for fill in fills) <= 1000 // 50 + 1
    assert len(done) <= 60_000 // 100 + 1000 // 50 + 1


def test_long_words_are_not_kept(encoders):
    """Unspaced texts do not fill the cache."""
    for encoder in encoders.values() if isinstance(encoders, dict) else encoders:
        words = ["".join(chr(97 + (i * j) % 26) for j in range(200)) + str(i) for i in range(50)]
        text = " ".join(words)
        assert encoder.encode(text) == encoder.whole(text)
        kept = {word for cache in (encoder._bare, encoder._spaced) for word in (*cache._young, *cache._old)}
        assert not kept & set(words) and max(map(len, kept)) <= 64


def test_a_task_gives_up_what_other_operators_left():
    from quakelake.llm import support, tokens

    one, other = (tokenizer_path(name) for name in TOKENIZERS)
    first, second = packing.encoder(one), packing.encoder(other)
    support.settle(tokens.encoder_name(other))
    assert packing.encoder(other) is second and packing.encoder(one) is not first
    support.settle()
    assert not support._kept


def test_a_task_looks_up_distinct_words_alone(encoders, monkeypatch):
    """Each word of each text was looked up by itself, at over 400 CPU seconds a GB."""
    from quakelake.llm import tokens

    looked = []
    ids = tokens._Words.ids
    monkeypatch.setattr(tokens._Words, "ids", lambda self, words: looked.extend(words) or ids(self, words))
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [None, ""] + [f"Some words of text {i % 3}, again." for i in range(1000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    rows = [row for made in packing._pack(None, packing.TOKENIZER, 2048, 1)(iter([batch])) for row in made.to_pylist()]
    found = defaultdict(bytes)
    for row in sorted(rows, key=lambda row: (row["doc_id"], row["start"])):
        found[row["doc_id"]] += row["ids"]
    end = (1).to_bytes(4, "little")
    assert found == {i: encoders[packing.TOKENIZER].whole(text or "") + end for i, text in enumerate(texts)}
    assert len(looked) < 50
