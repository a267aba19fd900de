import random

import numpy as np
import pytest
import xxhash

from quakelake.llm import simhash
from quakelake.llm.components import connected


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_labels(ids, prints):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    labels = ids.copy()
    while True:
        lowest = np.array([labels[row].min() for row in near])
        if (lowest == labels).all():
            return labels
        labels = lowest


def texts():
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdeé") for _ in range(5)) for _ in range(300)]
    base = [[draw.choice(words) for _ in range(draw.randrange(150, 400))] for _ in range(30)]
    made = [None, "", " \n\t", "One", "one", "a b", "A\x0bB", "a b c d", "ONE\u00a0two", "x " * 20_000]
    for text in base:
        made.append(" ".join(text))
        for _ in range(4):
            changed = list(text)
            changed[draw.randrange(len(text))] = draw.choice(words)
            made.append(" ".join(changed))
    return made


def test_spark_hashes_alike(spark):
    hashed = spark.sql("SELECT xxhash64('a b c d')").first()[0]
    assert hashed & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("blocks", [None, 5, 6, 8])
def test_components_match_brute_force(docs, clashing, blocks):
    rows = list(enumerate(texts()))
    rows += [(0, None), (500, rows[12][1])]
    found = simhash.near_groups(clashing(docs(*rows)).repartition(5), blocks=blocks).collect()
    ids = np.array([i for i, _ in rows])
    prints = np.array([brute_fingerprint(text) for _, text in rows], np.uint64)
    labels = brute_labels(ids, prints)
    wanted = sorted(zip(ids.tolist(), prints.view(np.int64).tolist(), labels.tolist()))
    assert sorted((row["doc_id"], row["fp"], row["component_id"]) for row in found) == wanted


def test_a_hot_block_is_dealt_in_chunks_and_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 40)
    draw = random.Random(5)
    prints = {sum(1 << b for b in draw.sample(range(64), draw.randrange(7))) for _ in range(600)}
    values = np.array(sorted(prints), np.uint64)
    nodes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp LONG")
    found = simhash.links(nodes)
    pairs = {(row["a"] & (2**64 - 1), row["b"] & (2**64 - 1)) for row in found.collect()}
    assert all((a ^ b).bit_count() <= 64 for a, b in pairs)
    roots = {row["node"]: row["root"] for row in connected(found).collect()}
    labels = brute_labels(values.view(np.int64).copy(), values)
    groups = {}
    for value, label in zip(values.view(np.int64).tolist(), labels.tolist()):
        groups.setdefault(label, set()).add(value)
    got = {}
    for value in values.view(np.int64).tolist():
        got.setdefault(roots.get(value, value), set()).add(value)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_masks_cover_every_choice_of_blocks():
    for blocks in (5, 6, 7, 8):
        chosen = [mask & (2**64 - 1) for mask in simhash.masks(blocks)]
        draw = random.Random(blocks)
        for _ in range(300):
            change = sum(1 << bit for bit in draw.sample(range(64), 4))
            assert any(not change & mask for mask in chosen)
    assert simhash.blocks_for(1000) == 5
    assert simhash.blocks_for(10**10) >= 8


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(300, 301), (7, 7)], "a LONG, b LONG")
    roots = {row["node"]: row["root"] for row in connected(links).collect()}
    assert roots == {**{i: 0 for i in range(201)}, 300: 300, 301: 300}


def test_empty_tables(spark, docs):
    assert simhash.near_groups(docs()).count() == 0
    assert simhash.drop_near_copies(docs()).count() == 0
    assert connected(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_one_document_of_each_group_stays(docs, clashing):
    rows = list(enumerate(texts()))
    kept = simhash.drop_near_copies(clashing(docs(*rows)))
    labels = brute_labels(np.arange(len(rows)), np.array([brute_fingerprint(t) for _, t in rows], np.uint64))
    assert kept.columns[:2] == ["doc_id", "text"] and len(kept.columns) == 16
    assert sorted(row[0] for row in kept.collect()) == sorted(set(labels.tolist()))


def test_a_document_id_with_two_texts_loses_only_the_copy(docs, rows_of):
    rows = docs((0, "a b c d"), (1, "a b c d"), (1, "another text altogether here"))
    kept = simhash.drop_near_copies(rows).select("doc_id", "text")
    assert rows_of(kept) == [(0, "a b c d"), (1, "another text altogether here")]


def test_a_table_that_was_loaded_twice_keeps_one_row_of_each_group(docs, clashing):
    once = clashing(docs(*enumerate(texts()), (None, "no id here"), (None, "nor here, and other words")))
    kept = [sorted(map(repr, simhash.drop_near_copies(rows).collect())) for rows in (once, once.union(once))]
    assert kept[0] == kept[1]
    assert sum("doc_id=None" in row for row in kept[0]) == 2


def test_of_near_texts_of_one_document_id_one_stays(docs):
    rows = docs((1, "A b c d e"), (1, "a b c d e"), (1, "other words of this document"))
    assert simhash.drop_near_copies(rows).count() == 2
