import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quakelake.llm import spelling
from quakelake.llm.acceptor import Acceptor, OneEdit


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {word: n for word, n in counts.items() if len(word) >= 6 and n >= 5}


def brute_variants(counts):
    near = {w: [v for v in counts if one_edit(v, w)] for w in counts}
    best = {w: min(near[w], key=lambda v: (-counts[v], v)) for w in counts if near[w]}
    form = {w: v for w, v in best.items() if counts[v] >= 5 * counts[w]}

    def root(word):
        while word in form:
            word = form[word]
        return word

    return sorted(
        ((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()),
        key=repr,
    )


@settings(max_examples=80, deadline=None)
@given(st.sets(st.text("abé", min_size=0, max_size=6), max_size=40))
def test_an_acceptor_is_exact_and_minimal(words):
    machine = Acceptor(sorted(words))
    read, stack, rights = set(), [(0, "")], {}
    while stack:
        state, word = stack.pop()
        if machine.final[state]:
            read.add(word)
        rights.setdefault(state, set()).add(frozenset(w[len(word) :] for w in words if w.startswith(word)))
        stack.extend((after, word + letter) for letter, after in machine.arcs[state].items())
    assert read == words
    languages = [only for (only,) in rights.values()]
    assert len(set(languages)) == len(languages)


@settings(max_examples=80, deadline=None)
@given(st.sets(st.text("ab", min_size=4, max_size=5), max_size=30))
def test_the_composition_finds_each_pair_once(words):
    found = list(OneEdit(Acceptor(sorted(words)), 5).pairs())
    longer = [w for w in words if len(w) == 5]
    pairs = {frozenset((a, b)) for a in words for b in longer if one_edit(a, b)}
    assert len(found) == len(pairs)
    assert {frozenset(pair) for pair in found} == pairs


def corpus(seed, letters="abc", number=400):
    draw = random.Random(seed)
    rows = []
    for i in range(60):
        words = ["".join(draw.choice(letters) for _ in range(draw.choice((5, 6, 6, 7, 8)))) for _ in range(number)]
        rows.append((i, draw.choice(" -0\n").join(words)))
    word = "Überraschung"
    for i in range(30):
        rows.append((100 + i, f"{word} {word} {word} {word}s uberraschung ÃBERRASCHUNG {'x' * 90} {'x' * 91}"))
    return rows + [(None, "abcabc " * 20), (5, rows[5][1]), (200, None), (201, ""), (202, "a×b÷cc ÿÿÿÿÿÿ " * 9)]


@pytest.mark.parametrize("start_letters", [spelling.START_LETTERS, 40, 1])
def test_variants_match_brute_force(docs, clashing, rows_of, start_letters):
    rows = corpus(3)
    found = spelling.variants(clashing(docs(*rows)).repartition(4), start_letters)
    assert rows_of(found) == brute_variants(brute_counts(rows))


def test_a_hot_start_is_halved_and_costs_no_square(spark):
    draw = random.Random(5)
    words = {"common" + "".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(3000)}
    rows = spark.createDataFrame([(w, 5) for w in sorted(words)], "word STRING, n LONG")
    found = spelling.starts(rows, 400)
    sizes = found.groupBy("start").agg({"*": "count", "hi": "max", "lo": "min"}).collect()
    assert max(row["count(1)"] for row in sizes) <= 400
    assert found.count() < 40 * len(words)
    near = {(row["word"], row["near"]) for row in spelling.near_words(rows, 400).collect()}
    deletes = {}
    for word in words:
        for i in range(len(word)):
            deletes.setdefault((i, word[:i] + word[i + 1 :]), []).append(word)
    assert near == {(a, b) for group in deletes.values() for a in group for b in group if a != b}


def test_starts_of_one_hash_are_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(spelling, "_start", lambda: F.lit(1).cast("long"))
    words = ["abcdef", "abcdeg", "xbcdef", "qqqqqq", "abcdefg", "aabcdef"]
    rows = spark.createDataFrame([(w, 5) for w in words], "word STRING, n LONG")
    near = sorted((row["word"], row["near"]) for row in spelling.near_words(rows).collect())
    assert near == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_roots_follow_forms_to_the_end(spark):
    forms = [(f"w{i:02}", f"w{i + 1:02}") for i in range(20)]
    found = spelling.roots(spark.createDataFrame(forms, "word STRING, form STRING")).collect()
    assert sorted(map(tuple, found)) == [(f"w{i:02}", "w20") for i in range(20)]


def test_empty_tables_and_words_of_documents(docs, rows_of):
    assert spelling.variants(docs()).count() == 0
    assert spelling.variants(docs((1, None), (2, "ab"))).count() == 0
    rows = docs(*((i, "colour " * 30) for i in range(1, 9)), (9, "colours colours colours colours colours colour"))
    found = spelling.variants(rows)
    own = spelling.with_root_words(rows, found)
    assert rows_of(own) == [(9, "colours", "colour", 5)]
