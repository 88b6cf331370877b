"""Substring dedup against a dictionary of all windows."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from curbline.llm import fmindex, substrings
from curbline.llm.frames import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, size):
    """(id, words, removed, removed runs, kept text) of each row; an id is one document, no id comes last."""
    words = [WORD.findall(text or "") for _, text in rows]
    key = [(i is None, i or 0) for i, _ in rows]
    first = {}
    for own, found in zip(key, words):
        for at in range(len(found) - size + 1):
            window = tuple(found[at : at + size])
            first[window] = min(first.get(window, (own, at)), (own, at))
    result = []
    for (doc_id, _), own, found in zip(rows, key, words):
        gone = [False] * len(found)
        for at in range(len(found) - size + 1):
            if first[tuple(found[at : at + size])] < (own, at):
                gone[at : at + size] = [True] * size
        edges = [i for i in range(len(found) + 1) if (i < len(found) and gone[i]) != (i > 0 and gone[i - 1])]
        left = " ".join(w for w, g in zip(found, gone) if not g)
        result.append((doc_id, len(found), sum(gone), edges[::2], edges[1::2], left))
    return result


def ordered(rows):
    return sorted(rows, key=str)


def found(frame, size):
    return [tuple(r) for r in substrings.dedup(frame, size=size).collect()]


def passages(seed, count=120):
    """Documents over few words, with passages that repeat within and across them."""
    rng = np.random.default_rng(seed)
    draw = lambda n, of=40: [f"w{i}" for i in rng.integers(0, of, n)]
    shared = [draw(int(n)) for n in rng.integers(5, 60, 12)]
    rows = []
    for number in range(count):
        parts = []
        for _ in range(int(rng.integers(0, 5))):
            parts += draw(int(rng.integers(0, 25))) if rng.random() < 0.5 else shared[int(rng.integers(len(shared)))]
        rows.append((int(rng.permutation(count)[0]) if number % 10 == 0 else 1000 - number, " ".join(parts)))
    return rows + [(5000, " ".join(["ha"] * 100)), (4000, " ".join(["ha", "ho"] * 60)), (4001, " ".join(["ha"] * 30)), (None, rows[3][1]), (None, rows[3][1])]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 20, 50, 70])
def test_all_windows_are_judged(spark, size):
    rows = passages(size)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert ordered(found(frame, size)) == ordered(plain(rows, size))


@pytest.mark.parametrize("size", [4, 20])
def test_hot_anchors_change_no_result(spark, size, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_LEAST", 1)
    rows = passages(99)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert ordered(found(frame, size)) == ordered(plain(rows, size))


def test_many_surroundings_of_one_passage(spark, monkeypatch):
    """One passage in all documents, each time between other words; small shards and small hot share."""
    monkeypatch.setattr(substrings, "HOT_SHARE", 50)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, f"{' '.join(f'a{i}x{j}' for j in range(25))} {passage} {' '.join(f'b{i}x{j}' for j in range(25))}") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    got = found(frame, 20)
    assert ordered(got) == ordered(plain(rows, 20))
    assert {r[2] for r in got if r[0]} == {30}


def test_odd_rows(spark, odd_docs, odd_texts):
    for size in (2, 20):
        assert ordered(found(odd_docs, size)) == ordered(plain(odd_texts, size))


def test_no_rows(no_docs):
    assert found(no_docs, 20) == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.integers(1, 9))
def test_matching_statistics(values, most):
    text = np.array(values)
    index = fmindex.FMIndex(text, most)
    ends = np.arange(1, len(text) + 1)
    length, begin = index.statistics(text, ends, most)
    often = lambda p: sum(values[i : i + len(p)] == p for i in range(len(values) - len(p) + 1))
    expected = [max([n for n in range(min(most, e) + 1) if n == 0 or often(values[e - n : e]) >= 2]) for e in ends]
    assert length.tolist() == expected
    classes = defaultdict(set)
    for e, n, b in zip(ends, length, begin):
        classes[int(n), int(b) if n else 0].add(tuple(values[e - n : e]))
    assert all(len(c) == 1 for c in classes.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 200), min_size=1, max_size=300))
def test_wavelet_counts(values):
    symbols = np.array(values)
    known = fmindex.Wavelet(symbols, 8)
    at = np.arange(len(values) + 1)
    for symbol in {*values, 0, 255}:
        assert known.count(np.full(len(at), symbol), at).tolist() == [values[:i].count(symbol) for i in at]


def test_query_equals_all_windows(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    expected = [(i, n, gone, hashlib.sha256(left.encode()).hexdigest()) for i, n, gone, _, _, left in plain(rows, 20)]
    assert ordered(tuple(r) for r in entry.queries()["op12_substrings"](spark, sf_dir).collect()) == ordered(expected)
