"""The divergence audit against plain sums over all terms."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curbline.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=3, top=200):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    kept = {lang: sorted((t for t, n in c.items() if n >= least), key=str.encode) for lang, c in docs.items()}

    def chances(counts, lang):
        total = sum(counts[t] for t in kept[lang]) + len(kept[lang])
        return [1 + 10**9 * (counts[t] + 1) // total for t in kept[lang]]

    price = lambda p, q: (p - q) * (p - q) // q
    result = []
    for (lang, source), counts in groups.items():
        own, whole = chances(counts, lang), chances(sum((c for (l, _), c in groups.items() if l == lang), Counter()), lang)
        pairs = [(s, sum(map(price, own, chances(c, lang)))) for (l, s), c in groups.items() if l == lang and s != source]
        terms = [(t, price(p, q)) for t, p, q in zip(kept[lang], own, whole) if counts[t] > 0 and p > q]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            best = sorted(found, key=lambda f: (-f[1], f[0].encode()))[:most]
            result += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(best, 1)]
    return result


def ordered(rows):
    return sorted(rows, key=str)


def rows_of(seed=3, count=150):
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in ("Straße", "élan", "the", "OF", "漢字") for b in "abcdefghijk"]
    rows = []
    for _ in range(count):
        lang, source = str(rng.choice(["en", "de", "fr"])), str(rng.choice(["s1", "s2", "s3", "é", "S1"]))
        text = ", ".join(rng.choice(words[: 20 + 10 * len(lang + source)], int(rng.integers(0, 30))))
        rows.append((lang, source, text))
    return rows + [
        (None, None, "only nulls"), (None, "s1", None), ("", "", "only empty only"), ("xx", "a", "one two"), ("xx", "b", "1 2 3"), ("yy", "a", None),
        ("en", "quiet", ""), ("en", "s1", "word " * 3000), rows[0], rows[0],
    ]


@pytest.mark.parametrize("chunk, top", [(1, 3), (4, 200), (8192, 2), (8192, 200)])
def test_equals_plain_sums(spark, with_clashes, chunk, top):
    rows = rows_of()
    frame = with_clashes(spark.createDataFrame(rows, "lang string, source string, text string").repartition(4))
    got = divergence.audit(frame, chunk=chunk, top=top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert ordered(map(tuple, got.collect())) == ordered(plain(rows, top=top))


def test_small_cells_and_walks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CELL", 40)
    rows = rows_of(5)
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    assert ordered(map(tuple, divergence.audit(frame).collect())) == ordered(plain(rows))


def test_no_rows(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_large_counts_are_exact():
    counts, totals = np.array([2**33 - 1, 2**33, 2**40 + 7, 0]), np.full(4, 2**41 + 11)
    assert divergence.chances(counts, totals).tolist() == [1 + 10**9 * (int(c) + 1) // (2**41 + 11) for c in counts]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 20).flatmap(lambda n: st.lists(st.lists(st.integers(0, 2), min_size=n, max_size=n), min_size=2, max_size=5)))
def test_walks_meet_every_place(values):
    counts = np.array(values)
    trees = divergence.Trees(counts)
    a, b = np.arange(len(values) - 1), np.arange(1, len(values))
    got = Counter()
    for walk, left, right, often in zip(*trees.walk(a, b)):
        got[int(walk), int(trees.leaves[left]), int(trees.leaves[right])] += int(often)
    assert got == Counter((i, x, y) for i in range(len(a)) for x, y in zip(values[i], values[i + 1]))
    assert len(set(trees.roots.tolist())) == len({tuple(v) for v in values})


def test_equal_subtrees_are_one_node():
    trees = divergence.Trees(np.tile([[0, 0, 5, 1]], (3, 256)))
    assert [len(low) for low, _ in trees.kids] == [2] + [1] * 9
    assert len(trees.walk(np.array([0, 1]), np.array([1, 2]))[0]) == 2 * 3
