import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quakelake.llm import suffix_dedup


def covered(rows, threshold):
    """Spans of every row, by comparing all strings of threshold length."""
    texts = [(text or "").encode() for _, text in rows]
    seen = Counter(t[i : i + threshold] for t in texts for i in range(len(t) - threshold + 1))
    found = []
    for text in texts:
        spans = []
        for i in range(len(text) - threshold + 1):
            if seen[text[i : i + threshold]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + threshold
                else:
                    spans.append([i, i + threshold])
        found.append(spans)
    return texts, found


def expected(rows, threshold):
    found = []
    for (doc_id, _), text, spans in zip(rows, *covered(rows, threshold)):
        edges = zip([0, *(j for _, j in spans)], [*(i for i, _ in spans), len(text)])
        kept = b"".join(text[i:j] for i, j in edges)
        found.append((doc_id, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def made(seed, letters, sizes):
    draw = random.Random(seed)
    passages = ["".join(draw.choice(letters) for _ in range(draw.randrange(3, 40))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [draw.choice(passages) if draw.random() < 0.4 else draw.choice(letters) for _ in range(draw.randrange(*sizes))]
        rows.append((i, "".join(parts)))
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[5][1]), (70, None), (71, ""), (72, "ab" * 300), (73, "z" * 90)]
    return rows


@pytest.mark.parametrize(("threshold", "letters"), [(4, "ab"), (9, "abé"), (12, "abcdefgh"), (31, "ab ")])
def test_spans_match_brute_force(docs, clashing, rows_of, threshold, letters):
    rows = made(threshold, letters, (1, 60))
    found = suffix_dedup.repeats(clashing(docs(*rows)).repartition(5), threshold)
    assert rows_of(found) == expected(rows, threshold)


@pytest.mark.parametrize(("buffer", "held"), [(64, 50), (1000, 7)])
def test_pieces_of_long_texts_and_lots_of_rows(docs, rows_of, monkeypatch, buffer, held):
    monkeypatch.setattr(suffix_dedup, "BUFFER", buffer)
    monkeypatch.setattr(suffix_dedup, "HELD", held)
    rows = made(2, "abcd", (100, 200))
    texts = [text for _, text in rows]
    batches = [text.encode() for text in texts if text]
    places = [
        (owner, place)
        for lot in suffix_dedup.buffers(batches, 10)
        for owner, place in zip(lot.owner.tolist(), (lot.places + lot.shift).tolist())
    ]
    assert places == [(i, p) for i, text in enumerate(batches) for p in range(len(text) - 9)]
    assert rows_of(suffix_dedup.repeats(docs(*rows), 10)) == expected(rows, 10)


def test_a_bit_map_that_is_full_changes_nothing(docs, rows_of, monkeypatch):
    rows = made(5, "abcde", (1, 60))

    def full(names):
        return names.sparkSession.sparkContext.broadcast(np.full(suffix_dedup.MAP_BITS // 8, 255, np.uint8))

    monkeypatch.setattr(suffix_dedup, "_map_of", full)
    assert rows_of(suffix_dedup.repeats(docs(*rows), 11)) == expected(rows, 11)


def test_the_chosen_place_depends_on_the_string_alone():
    ranker, draw = suffix_dedup._Ranker(), random.Random(1)
    inner = bytes(draw.randrange(256) for _ in range(200))
    places = set()
    for _ in range(20):
        before = bytes(draw.randrange(256) for _ in range(draw.randrange(300)))
        after = bytes(draw.randrange(256) for _ in range(draw.randrange(300)))
        (lot,) = suffix_dedup.buffers([before + inner + after], 200)
        _, place, first, last = suffix_dedup.chosen(ranker, lot, 200)
        run = np.flatnonzero((lot.places[first] <= len(before)) & (lot.places[last] >= len(before)))
        places.add(int(place[run[0]]) - len(before))
    assert len(places) == 1 and 0 <= places.pop() <= 100


def test_a_passage_that_all_texts_share_costs_a_row_a_task(docs, spark):
    draw = random.Random(3)
    passage = "".join(draw.choice("abcdefghij ") for _ in range(600))
    rows = [(i, f"{draw.random()} {passage} {draw.random()}") for i in range(400)]
    texts = suffix_dedup._texts(docs(*rows).coalesce(1))
    repeated = suffix_dedup._map_of(texts.mapInArrow(suffix_dedup._run_names(200), "rank LONG, many BOOLEAN"))
    runs = texts.mapInArrow(suffix_dedup._runs(200, repeated), suffix_dedup._RUN)
    sent = runs.where("not sure")
    assert sent.where("many").count() > 0
    assert sent.count() < 3 * 400
    assert runs.where("sure").count() == 400


def test_what_is_left_keeps_all_columns(docs, clashing):
    rows = [(1, "a" + "0123456789" * 30), (2, "0123456789" * 30 + "é"), (3, None), (4, "short")]
    left = suffix_dedup.without_repeats(clashing(docs(*rows)))
    assert left.columns == [*clashing(docs(*rows)).columns, "kept"]
    assert {row[0]: bytes(row[-1]) for row in left.collect()} == {1: b"a", 2: "é".encode(), 3: b"", 4: b"short"}


def test_empty_tables_and_a_threshold_that_is_too_small(docs):
    assert suffix_dedup.repeats(docs()).count() == 0
    assert suffix_dedup.without_repeats(docs()).count() == 0
    with pytest.raises(ValueError, match="four bytes"):
        suffix_dedup.repeated_spans(docs(), 3)


def test_spans_that_touch_are_joined():
    key, size = np.array([5, 5, 1, 5, 5]), np.full(5, 9)
    found = suffix_dedup.merged_spans(key, size, np.array([4, 0, 2, 9, 1]), np.array([6, 4, 3, 12, 2]))
    assert [part.tolist() for part in found] == [[1, 5, 5], [9, 9, 9], [2, 0, 9], [3, 6, 12]]
