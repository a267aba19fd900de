import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quakelake.llm import resampling


def brute_features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(run.encode()) % 10_000 for run in runs]


def expected(rows, target, percent=5):
    found = [(doc_id, *brute_features(text)) for doc_id, text in rows]
    s = Counter(b for _, _, buckets in found for b in buckets)
    t = Counter(b for text in target for b in brute_features(text)[1])
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    scored = []
    for doc_id, words, buckets in found:
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in buckets)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = gain + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([doc_id, len(buckets), gain, score, None, words])
    able = [row for row in scored if row[5] >= 20]
    able.sort(key=lambda row: (-row[3], row[0] is None, row[0], row[1], row[2]))
    for rank, row in enumerate(able[: percent * len(able) // 100]):
        row[4] = rank + 1
    return sorted((tuple(row[:5]) for row in scored), key=repr)


@pytest.mark.parametrize(
    "text",
    ["", " \t", "one", "A-b c", "Ärger ÄRGER x×y", "a\x00b`c{d~e\x7ff", "9 lives, 10 more", "x" * 5000, "é " * 4000, "a b"],
)
def test_buckets_are_those_of_all_runs(text):
    words, buckets = resampling.buckets_of(text.encode())
    assert (words, Counter(buckets.tolist())) == (brute_features(text)[0], Counter(brute_features(text)[1]))


def corpus():
    draw = random.Random(8)
    words = [f"w{i}" for i in range(80)] + ["Straße", "naïve", "UPPER"]
    rows = [(i, " ".join(draw.choices(words, k=draw.choice((3, 19, 20, 21, 60))))) for i in range(300)]
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (None, "w1 " * 30), (400, None), (401, "")]
    rows += [(500 + i, "the same words again and again " * 5) for i in range(200)]
    return rows, [" ".join(draw.choices(words[:20], k=30)) for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("percent", [5, 0, 100])
def test_draws_match_brute_force(docs, clashing, rows_of, spark, percent):
    rows, target = corpus()
    items = spark.createDataFrame([(i, text, "x") for i, text in enumerate(target)], "item_id LONG, text STRING, doc_id STRING")
    found = resampling.resample(clashing(docs(*rows)).repartition(6), items, percent)
    assert rows_of(found) == expected(rows, target, percent)


def test_ranks_hold_over_many_partitions(docs, spark, rows_of):
    rows, target = corpus()
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        items = spark.createDataFrame([(i, text) for i, text in enumerate(target)], "item_id LONG, text STRING")
        assert rows_of(resampling.resample(docs(*rows), items, 60)) == expected(rows, target, 60)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])


def test_empty_tables(docs, spark, rows_of):
    nothing = spark.createDataFrame([], "item_id LONG, text STRING")
    assert resampling.resample(docs(), nothing).count() == 0
    rows, _ = corpus()
    assert rows_of(resampling.resample(docs(*rows), nothing)) == expected(rows, [])


def test_drawn_documents_keep_all_columns(docs, clashing, spark):
    rows, target = corpus()
    items = spark.createDataFrame([(i, text) for i, text in enumerate(target)], "item_id LONG, text STRING")
    kept = resampling.drawn_documents(clashing(docs(*rows)), items)
    drawn = {row[0] for row in expected(rows, target) if row[4]}
    assert kept.columns == clashing(docs(*rows)).columns
    assert {row[0] for row in kept.collect()} == drawn


def test_gains_round_down():
    corpus_counts, target = np.zeros(resampling.BUCKETS, np.int64), np.zeros(resampling.BUCKETS, np.int64)
    corpus_counts[0], target[1] = 3, 1
    gain = resampling.gains(corpus_counts, target)
    assert gain[0] == math.floor(1000 * math.log(10_003 / (4 * 10_001)))
    assert gain[1] == math.floor(1000 * math.log(2 * 10_003 / 10_001))
