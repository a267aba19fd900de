"""The registered queries, against their SQL or brute force over whole tables, and the pipeline."""

import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

import corpus_pipeline
from quakelake.llm import queries, sharding
from quakelake.llm.tokens import Encoder, tokenizer_path

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "conversations", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(database):
    return dict(database.sql("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def bag(table):
    names = sorted(table.column_names)
    rows = zip(*(table.column(name).to_pylist() for name in names))
    return names, sorted(repr(tuple(round(v, 6) if isinstance(v, float) else v for v in row)) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, database, name):
    found = queries.queries()[name](spark, SF_DIR).toArrow()
    assert found.num_rows > 0
    assert bag(found) == bag(database.sql(SQL[name]).to_arrow_table())


def fingerprint(text):
    words = text.encode().lower().split()
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))
    ] * bool(words)
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near_groups(texts):
    """Of each id its fingerprint and the smallest id that it is linked with."""
    ids = np.array(sorted(texts))
    prints = np.array([fingerprint(texts[i]) for i in ids.tolist()], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    labels, before = ids.copy(), None
    while before is None or (labels != before).any():
        before, labels = labels, np.array([labels[row].min() for row in near])
    return {i: (fp, label) for i, fp, label in zip(ids.tolist(), prints.tolist(), labels.tolist())}


def copies_of(rows):
    """How often the mix takes each (doc_id, source, text)."""
    sizes, of_source = {}, Counter()
    for doc_id, source, text in rows:
        sizes[doc_id] = len(re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()))
        of_source[source] += sizes[doc_id]
    ordered = sorted(of_source, key=lambda source: (source is None, (source or "").encode()))
    weight = {source: (3, 1, 2)[i % 3] for i, source in enumerate(ordered)}
    target, left = {}, 1.5 * sum(of_source.values())
    while True:
        unbound = [source for source in ordered if source not in target]
        level = left / sum(weight[source] for source in unbound) if unbound else 0
        full = [source for source in unbound if weight[source] * level >= 2 * of_source[source]]
        if not full:
            break
        for source in full:
            target[source] = 2 * of_source[source]
            left -= target[source]
    target |= {source: weight[source] * level for source in unbound}
    copies = {}
    for doc_id, source, _ in rows:
        rate = target[source] / of_source[source] if of_source[source] else 0
        chance = int(hashlib.md5(f"mix:{doc_id}".encode()).hexdigest()[:13], 16) / 16**13
        copies[doc_id] = int(rate) + (chance < rate - int(rate))
    return copies


def test_op4(spark, texts):
    found = {row["doc_id"]: row for row in queries.queries()["op4_simhash_near_dedup"](spark, SF_DIR).collect()}
    for i, (fp, label) in near_groups(texts).items():
        assert (found[i]["fingerprint"], found[i]["component_id"]) == (f"{fp:016x}", label)


def test_op9(spark, texts):
    encoder, start = Encoder(tokenizer_path("byte_bpe_50k.json")), 0
    found = sorted(queries.queries()["op9_token_files"](spark, SF_DIR).collect())
    for row, (doc_id, text) in zip(found, sorted(texts.items()), strict=True):
        ids = encoder.whole(text) + bytes(4)
        assert tuple(row) == (doc_id, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4


def test_op10(spark, texts):
    encoder, pieces = Encoder(tokenizer_path("word_bpe_49k.json")), {}
    found = queries.queries()["op10_packing"](spark, SF_DIR).collect()
    for row in found:
        pieces.setdefault(row["doc_id"], []).append(row)
    for doc_id, text in texts.items():
        ids, at = encoder.whole(text) + (1).to_bytes(4, "little"), 0
        for row in sorted(pieces[doc_id], key=lambda row: row["start"]):
            assert row["start"] == at and row["doc_tokens"] == len(ids) // 4
            assert row["ids_crc32"] == zlib.crc32(ids[at * 4 : (at + row["length"]) * 4])
            at += row["length"]
        assert at * 4 == len(ids)
    fills = {}
    for row in found:
        fills[row["sequence_id"]] = fills.get(row["sequence_id"], 0) + row["length"]
    assert sum(2048 - fill for fill in fills.values()) < 0.05 * sum(fills.values())


def test_op5_on_the_held_out_fold(spark, database):
    langs = dict(database.sql("SELECT doc_id, lang FROM documents").fetchall())
    held = [row for row in queries.queries()["op5_language_id"](spark, SF_DIR).collect() if row["held_out"]]
    assert sum(row["lang_pred"] == langs[row["doc_id"]] for row in held) >= 0.95 * len(held)


def test_op3_scores_every_text_alone(spark, texts):
    found = {row["doc_id"]: row for row in queries.queries()["op3_toxicity"](spark, SF_DIR).collect()}
    assert sorted(found) == sorted(texts)
    scores = {}
    for doc_id, row in found.items():
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert row["predicted"] == (row["score"] >= 0.5) and 0 <= row["score"] <= 1
        assert scores.setdefault(texts[doc_id], row["score"]) == row["score"]


def test_op8(spark, texts):
    owners = sharding.build_table()
    found = {row["doc_id"]: row for row in queries.queries()["op8_sharding"](spark, SF_DIR).collect()}
    assert sorted(found) == sorted(texts)
    for doc_id, row in found.items():
        slot = np.int64(np.uint64(xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), 42)).view(np.int64)) % len(owners)
        assert (row["slot"], row["shard"]) == (slot, owners[slot])


def test_the_pipeline_stage_by_stage(spark, database):
    """Each stage against what its method gives for the rows of the stage before."""
    labels = dict(database.sql("SELECT doc_id, toxic FROM labels").fetchall())
    toxic = {row["doc_id"] for row in queries.queries()["op3_toxicity"](spark, SF_DIR).collect() if row["predicted"]}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = docs.columns
    encoder = Encoder(tokenizer_path("word_bpe_49k.json"))
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(row) for row in docs.collect()]
        docs = stage(spark, docs, SF_DIR)
        after = [tuple(row) for row in docs.collect()]
        held = {row[names.index("doc_id")]: row for row in before}
        text_of = {i: row[names.index("text")] or "" for i, row in held.items()}
        if name == "toxicity":
            kept = [row for row in before if row[names.index("doc_id")] not in toxic]
            assert 0 < len(kept) < len(before)
            left = {row[names.index("doc_id")] for row in kept}
            clean = [i for i, label in labels.items() if not label and i in held]
            assert sum(i in left for i in clean) >= 0.9 * len(clean)
        elif name == "exact_dedup":
            keep = {}
            for i, text in text_of.items():
                keep[text] = max(i, keep.get(text, i))
            kept = [held[i] for i in keep.values()]
        elif name == "simhash_near_dedup":
            kept = [held[i] for i, (_, label) in near_groups(text_of).items() if i == label]
        elif name == "mixing":
            copies = copies_of([(i, row[names.index("source")], text_of[i]) for i, row in held.items()])
            kept = [row for i, row in held.items() for _ in range(copies[i])]
        else:
            assert_packed(docs, Counter(row[names.index("doc_id")] for row in before), text_of, encoder)
            continue
        assert docs.columns == names
        assert sorted(map(repr, after)) == sorted(map(repr, kept)), name


def assert_packed(pieces, copies, text_of, encoder):
    """All ids of every copy of a document lie in one piece each, gapless in sequences of 2048."""
    rows = pieces.collect()
    ids = {i: encoder.whole(text) + (1).to_bytes(4, "little") for i, text in text_of.items()}
    lengths, sequences = Counter(), {}
    for row in rows:
        whole = ids[row["doc_id"]]
        assert row["doc_tokens"] == len(whole) // 4
        assert row["ids"] == whole[4 * row["start"] : 4 * (row["start"] + row["length"])]
        lengths[row["doc_id"]] += row["length"]
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    assert lengths == {i: number * len(ids[i]) // 4 for i, number in copies.items()}
    for parts in sequences.values():
        parts.sort()
        assert [at for at, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048


def test_the_pipeline_as_a_query(spark):
    found = queries.queries()["pipeline"](spark, SF_DIR)
    assert found.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    assert found.count() > 0
