import numpy as np
import pytest

from quakelake.llm import topk

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT"


def brute(rows, every, top):
    vectors = [
        (key, [int(np.floor(256 * float(np.float32(x)))) for x in vector])
        for key, vector in rows
        if key is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector)
    ]
    found = []
    for at, (query, vector) in enumerate(vectors):
        if query % every == 0:
            others = [(key, v) for i, (key, v) in enumerate(vectors) if i != at and len(v) == len(vector)]
            scores = sorted((-sum(a * b for a, b in zip(vector, v)), key) for key, v in others)[:top]
            found += [(query, i + 1, key, -score) for i, (score, key) in enumerate(scores)]
    return sorted(found)


def frame(spark, rows):
    return spark.createDataFrame([(key, vector, 0) for key, vector in rows], SCHEMA)


def drawn(number, width, seed=0):
    draw = np.random.default_rng(seed)
    return [(i, draw.normal(0, 0.2, width).astype(np.float32).tolist()) for i in range(number)]


@pytest.mark.parametrize("annulus", [16, 512])
def test_results_match_brute_force(spark, monkeypatch, clashing, annulus):
    monkeypatch.setattr(topk, "ANNULUS", annulus)
    rows = drawn(400, 16)
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [(-50, [0.0] * 16), (3000, [9.0] * 16)]
    found = topk.search(clashing(frame(spark, rows)).repartition(5), every=50)
    assert sorted(map(tuple, found.collect())) == brute(rows, 50, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = drawn(30, 3) + [(100, None), (150, [1.0, None, 0.0]), (200, [nan, 0.0, 0.0]), (250, [inf, 0.0, 0.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (4, [0.5, 0.5, 0.5]), rows[5], rows[20], (20, [0.1, 0.2, 0.3])]
    found = topk.search(frame(spark, rows), every=10, top=7)
    assert sorted(map(tuple, found.collect())) == brute(rows, 10, 7)


def test_every_length_is_searched(spark):
    rows = drawn(60, 3) + [(100 + i, v) for i, v in drawn(25, 5, seed=1)] + [(200, [1.0]), (201, [-2.0]), (250, [])]
    found = topk.search(frame(spark, rows), every=10)
    assert sorted(map(tuple, found.collect())) == brute(rows, 10, 5)
    assert {100, 110, 120, 200} <= {row["query_id"] for row in found.collect()}


@pytest.mark.parametrize("vector", [[1e30, 0.0], [8e6, 8e6]])
def test_vectors_without_whole_scores_fail_the_job(spark, vector):
    with pytest.raises(Exception, match="too large for whole scores: 7"):
        topk.search(frame(spark, [(50, [1.0, 2.0]), (7, vector)])).collect()


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(50, [1.0])], [(50, []), (1, [])]])
def test_tiny_tables(spark, rows):
    assert sorted(map(tuple, topk.search(frame(spark, rows)).collect())) == brute(rows, 50, 5)


def test_groups_meet_in_every_pair(spark, monkeypatch):
    monkeypatch.setattr(topk, "TASK_QUERIES", 3)
    monkeypatch.setattr(topk, "ANNULUS", 8)
    rows = drawn(200, 4, seed=3)
    assert sorted(map(tuple, topk.search(frame(spark, rows), every=10).collect())) == brute(rows, 10, 5)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(2**21 - 3 * i)]) for i in range(40)]
    assert sorted(map(tuple, topk.search(frame(spark, rows), every=10).collect())) == brute(rows, 10, 5)
