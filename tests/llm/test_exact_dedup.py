import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quakelake.llm import exact_dedup
from quakelake.llm.quotient import CountingQuotientFilter


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**12 - 1)), st.lists(st.integers(0, 2**12 - 1)), st.integers(1, 1000))
def test_filters_keep_every_count_through_bytes_and_merges(first, second, times):
    first = first + first[:1] * times
    parts = [CountingQuotientFilter.of(np.array(keys, np.uint64), 12) for keys in (first, second)]
    again = [CountingQuotientFilter.from_bytes(part.to_bytes()) for part in parts]
    keys, counts = CountingQuotientFilter.merged(again).entries()
    expected = np.unique(np.array(first + second, np.int64), return_counts=True)
    assert keys.tolist() == expected[0].tolist()
    assert counts.tolist() == expected[1].tolist()


def test_wide_keys_and_a_count_of_many_digits():
    keys = np.array([0, 2**63, 2**64 - 1, 5], np.uint64)
    made = CountingQuotientFilter.of(keys, 64, np.array([1, 2**40, 3, 1], np.uint64))
    found = CountingQuotientFilter.from_bytes(made.to_bytes()).entries()
    assert dict(zip(*(part.tolist() for part in found))) == {0: 1, 5: 1, 2**63: 2**40, 2**64 - 1: 3}


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    found = []
    for doc_id, text in rows:
        group = groups[text or ""]
        keep = max((i for i in group if i is not None), default=None)
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        found.append((doc_id, keep, len(group), doc_id == keep, digest))
    return sorted(found, key=repr)


CASES = [
    (1, "a"), (2, "a"), (3, "A"), (4, None), (5, ""), (6, "a "), (7, "ü" * 50_000), (8, "ü" * 50_000),
    (2, "a"), (None, "a"), (None, "alone"), (9, "\0"), *((100 + i, "hot") for i in range(300)),
]


def test_groups_match_brute_force(docs, clashing, rows_of):
    found = exact_dedup.exact_groups(clashing(docs(*CASES)).repartition(7))
    assert rows_of(found) == expected(CASES)


def test_an_empty_table(docs):
    assert exact_dedup.exact_groups(docs()).count() == 0
    assert exact_dedup.drop_copies(docs()).count() == 0


def test_dropping_keeps_all_columns_and_one_row_of_each_text(docs, clashing):
    rows = clashing(docs(*CASES))
    kept = exact_dedup.drop_copies(rows)
    assert kept.columns == rows.columns
    found = sorted((tuple(row[:2]) for row in kept.collect()), key=repr)
    wanted = {(i, t) for (i, t), (_, _, _, keeps, _) in zip(CASES, map(of_row, CASES)) if keeps}
    assert found == sorted(wanted, key=repr)


def of_row(row):
    return next(e for e in expected(CASES) if e[0] == row[0] and e[4] == hashlib.sha256((row[1] or "").encode()).hexdigest())


def test_a_table_that_was_loaded_twice_loses_its_second_rows(docs, clashing):
    once = clashing(docs(*CASES))
    rows = [tuple(row) for row in exact_dedup.drop_copies(once.union(once)).collect()]
    assert sorted(rows, key=repr) == sorted((tuple(row) for row in exact_dedup.drop_copies(once).collect()), key=repr)


def test_of_rows_that_differ_elsewhere_the_smallest_stays(docs, rows_of):
    rows = docs((1, "a", "fr", "x"), (1, "a", "en", "y"), (1, "b", "en", "z"))
    assert [row[:3] for row in rows_of(exact_dedup.drop_copies(rows))] == [(1, "a", "en"), (1, "b", "en")]


def test_a_document_id_with_two_texts_loses_only_the_copy(docs, rows_of):
    rows = docs((1, "a"), (1, "b"), (2, "a"))
    assert rows_of(exact_dedup.drop_copies(rows).select("doc_id", "text")) == [(1, "b"), (2, "a")]


def test_different_texts_of_one_fingerprint_stay_apart(docs, monkeypatch, rows_of):
    from pyspark.sql import functions as F

    def short(rows, text):
        whole = exact_dedup.text_of(text)
        return rows.withColumn("fp", F.length(whole).cast("long")).withColumn("sha", F.unhex(F.sha2(whole, 256)))

    monkeypatch.setattr(exact_dedup, "_fingerprinted", short)
    found = exact_dedup.exact_groups(docs((1, "ab"), (2, "cd"), (3, "ab")))
    assert [row[:3] for row in rows_of(found)] == [(1, 3, 2), (2, 2, 1), (3, 3, 2)]


@pytest.mark.parametrize(("rows", "partitions", "bits"), [(0, 1, 1), (10, 8, 3), (1 << 30, 8, 10)])
def test_ranges_grow_with_the_rows(rows, partitions, bits):
    assert exact_dedup._range_bits(rows, partitions) == bits
