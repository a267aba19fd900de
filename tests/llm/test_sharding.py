from collections import Counter

import pytest

from quakelake.llm import sharding
from quakelake.llm.support import run_folder


def brute_table(shards, size):
    """Every shard's whole order of preference, and turns over them."""
    orders = []
    for shard in shards:
        start, step = sharding._order(shard, size)
        orders.append([(start + i * step) % size for i in range(size)])
        assert sorted(orders[-1]) == list(range(size))
    owner = {}
    while len(owner) < size:
        for shard, order in zip(shards, orders):
            if len(owner) < size:
                owner[next(slot for slot in order if slot not in owner)] = shard
    return [owner[slot] for slot in range(size)]


@pytest.mark.parametrize("number", [1, 3, 7])
def test_shards_claim_slots_in_turns(number):
    shards = [f"s{i}" for i in range(number)]
    assert sharding.build_table(shards, 101) == brute_table(shards, 101)


def test_shares_are_even_and_little_moves_when_a_shard_leaves():
    before = sharding.build_table()
    shares = Counter(before)
    assert max(shares.values()) - min(shares.values()) <= 1
    after = sharding.build_table(sharding.SHARDS[:-1])
    moved = sum(a != b and a != sharding.SHARDS[-1] for a, b in zip(before, after))
    assert moved < 0.05 * len(before)


def test_bad_tables_are_refused():
    for shards, size in (((), 7), (("a", "a"), 7), (("a", "b"), 8), (("a", "b"), 2)):
        with pytest.raises(ValueError):
            sharding.build_table(shards, size)


def test_placement(spark, docs, clashing):
    rows = docs(*((i, f"text {i}", None, f"s{i % 9}") for i in range(500)), (1, "text 1"), (None, None), (None, "x"))
    found = sharding.place(clashing(rows)).collect()
    owners = sharding.build_table()
    assert len(found) == 503
    places = {}
    for row in found:
        assert owners[row["slot"]] == row["shard"]
        assert places.setdefault(row["doc_id"], row["slot"]) == row["slot"]
    spread = sharding.place(docs(*((None, f"t{i}") for i in range(50))), else_by="text")
    assert spread.select("slot").distinct().count() > 40
    assert sharding.place(docs()).count() == 0


def test_written_shards_hold_every_row_once(spark, docs):
    path = run_folder(spark, "test-shards")
    rows = docs(*((i, f"text {i}") for i in range(300)))
    sharding.write_shards(rows, path, ("a", "b", "c"), files=2)
    back = spark.read.parquet(path)
    owners = {row["doc_id"]: row["shard"] for row in sharding.place(rows, ("a", "b", "c")).collect()}
    assert {row["doc_id"]: row["shard"] for row in back.collect()} == owners
    assert back.count() == 300
