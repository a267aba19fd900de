from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quakelake.llm import token_files, tokens
from quakelake.llm.perfect_hash import PerfectHash
from quakelake.llm.support import run_folder
from quakelake.llm.tokens import Encoder, tokenizer_path


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300), st.sets(st.integers(-(2**63), 2**63 - 1)))
def test_slots_are_minimal_and_strangers_nearly_all_rejected(keys, others):
    index = PerfectHash.from_bytes(PerfectHash.of(np.array(sorted(keys), np.int64)).to_bytes())
    slots = index.slots(np.array(sorted(keys), np.int64))
    assert sorted(slots.tolist()) == list(range(len(keys)))
    strangers = np.array(sorted(others - keys), np.int64)
    assert (index.slots(strangers) >= 0).sum() <= 1


def test_repeated_keys_are_refused():
    with pytest.raises(ValueError):
        PerfectHash.of(np.array([1, 1, 2]))


ROWS = [
    (5, "five"), (3, None), (3, "three again"), (-4, "minus four"), (9, ""), (8, "a b " * 3000), (None, "no id"),
    (None, None), (7, "five"), (5, "five"),
]


@pytest.fixture
def written(spark, docs, clashing):
    path = run_folder(spark, "test-tokens")
    token_files.write_tokens(clashing(docs(*ROWS)).repartition(4), path, shard_tokens=20)
    return path


def ids_of(text):
    return Encoder(tokenizer_path(token_files.TOKENIZER)).whole(text or "") + (0).to_bytes(4, "little")


def test_documents_are_read_back_in_order(spark, written):
    found = sorted(token_files.read_tokens(spark, written).collect(), key=lambda row: row["start"])
    keys = [row["doc_id"] for row in found]
    assert keys == sorted(keys, key=lambda key: (key is not None, key or 0))
    at = 0
    for row in found:
        assert row["start"] == at and row["n_tokens"] * 4 == len(row["ids"])
        at += row["n_tokens"]
    wanted = sorted(((key, ids_of(text)) for key, text in ROWS), key=repr)
    assert sorted(((row["doc_id"], row["ids"]) for row in found), key=repr) == wanted


def test_lookup_by_key(spark, written):
    found = token_files.lookup(spark, written, [3, 5, 8, 1000, -4]).collect()
    wanted = sorted(((key, ids_of(text)) for key, text in ROWS if key in (3, 5, 8, -4)), key=repr)
    assert sorted(((row["doc_id"], row["ids"]) for row in found), key=repr) == wanted
    assert token_files.lookup(spark, written, []).count() == 0


def test_an_empty_table(spark, docs):
    path = run_folder(spark, "test-tokens")
    token_files.write_tokens(docs(), path)
    assert token_files.read_tokens(spark, path).count() == 0


def test_ids_that_do_not_fit_are_refused():
    with pytest.raises(ValueError):
        token_files._narrow((1 << 16).to_bytes(4, "little"), 2)


def test_a_task_looks_up_distinct_words_alone(monkeypatch):
    """Each word of each text was looked up by itself, at over 400 CPU seconds a GB."""
    looked = []
    ids = tokens._Words.ids
    monkeypatch.setattr(tokens._Words, "ids", lambda self, words: looked.extend(words) or ids(self, words))
    monkeypatch.setattr(token_files, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [None, ""] + [f"Some words of text {i % 3}, again." for i in range(1000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    (shard,) = token_files._shards(None, token_files.TOKENIZER, 0, 2, 1 << 20)(iter([batch]))
    ids_by_text = {text: token_files._narrow(ids_of(text), 2) for text in set(texts)}
    wanted = b"".join(ids_by_text[text] for text in texts)
    assert shard.column("payload")[0].as_py() == wanted
    assert len(looked) < 50
