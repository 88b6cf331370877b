"""Near-duplicates and search against brute force, with hot groups worked in small cells."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curbline.llm import forest, graph, impact, setsketch


def least_reachable(nodes, links):
    found = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(found[a], found[b])
            changed |= found[a] != low or found[b] != low
            found[a] = found[b] = low
    return found


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for white in "\t\n\v\f\r":
        lowered = lowered.replace(white, " ")
    return [w for w in lowered.split(" ") if w]


def plain_sets(rows):
    found = []
    for doc_id, text in rows:
        words = words_of(text)
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        found.append((doc_id, grams))
    return found


def plain_duplicates(rows, percent):
    sets = plain_sets(rows)
    real = [(i, s) for i, s in sets if i is not None and s]
    links = [(i, j) for k, (i, s) in enumerate(real) for j, t in real[:k] if 100 * len(s & t) >= percent * len(s | t)]
    least = least_reachable({i for i, _ in sets if i is not None}, links)
    return sorted(((i, len(s), least.get(i), i is not None and least[i] == i) for i, s in sets), key=str)


def near_copies():
    pick = random.Random(5)
    words = [f"v{i}" for i in range(400)]
    base = [pick.choice(words) for _ in range(120)]
    passage = [pick.choice(words) for _ in range(60)]
    rows = []
    for i in range(140):  # one large group, its members one to four words apart from the base
        copy = base.copy()
        for _ in range(pick.randrange(5)):
            copy[pick.randrange(len(copy))] = pick.choice(words)
        rows.append((1000 - i, " ".join(copy)))
    for i in range(60):  # others that share a passage
        rows.append((2000 + i, " ".join(passage + [pick.choice(words) for _ in range(pick.randrange(1, 80))])))
    rows += [(3000 + i, rows[0][1].upper()) for i in range(40)]  # copies of one text
    chain = [pick.choice(words) for _ in range(200)]
    for i in range(8):  # each near the next one only
        chain = chain.copy()
        for k in range(3):
            chain[25 * i + 8 * k] = f"c{i}{k}"
        rows.append((4000 + i, " ".join(chain)))
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_brute_force(spark, odd_texts, with_clashes, monkeypatch, percent):
    monkeypatch.setattr(graph.links_in_groups, "__defaults__", (graph.links_in_groups.__defaults__[0], 16, 3000))
    rows = near_copies() + odd_texts
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = setsketch.near_duplicates(docs, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == plain_duplicates(rows, percent)


def test_near_duplicates_of_nothing(no_docs):
    assert setsketch.near_duplicates(no_docs).count() == 0


def test_registers_merge_by_maximum_and_tell_similarity():
    pick = np.random.default_rng(3)
    both, a, b = (pick.integers(0, 2**64, n, dtype=np.uint64) for n in (900, 50, 60))
    x, y = np.unique(np.concatenate((both, a))), np.unique(np.concatenate((both, b)))
    r, s = setsketch.registers(x), setsketch.registers(y)
    assert (setsketch.registers(np.union1d(x, y)) == np.maximum(r, s)).all()
    assert abs((r == s).mean() - 900 / 1010) < 0.12
    may = setsketch.likely(0.85)
    far = setsketch.registers(pick.integers(0, 2**64, 950, dtype=np.uint64))
    assert may(r, np.stack([s, r, far]), len(x), np.array([len(y), len(x), 950])).tolist() == [True, True, False]


def test_bands_follow_the_threshold(spark):
    assert setsketch.banding(85) == (25, 5)
    for percent in range(6, 101):
        bands, width = setsketch.banding(percent)
        assert (1 - (percent / 100) ** width) ** bands <= setsketch.MISSED and bands * width <= setsketch.MOST
    with pytest.raises(ValueError):
        setsketch.banding(0)
    rows = []
    for k in range(60):  # pairs that share half of their shingles
        common, own = [f"c{k}x{i}" for i in range(34)], [[f"{side}{k}x{i}" for i in range(15)] for side in "ab"]
        rows += [(2 * k + i, " ".join(common + o)) for i, o in enumerate(own)]
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 50).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i, _ in rows}


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, k) for k in range(1000, 1200)] + [(7, 7), (None, 3), (1199, 501), (501, 1199)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 500 for k in (500, 501, *range(1000, 1200))}}


def vectors():
    pick = np.random.default_rng(11)
    rows, centre = [], pick.standard_normal(16)
    for i in range(300):
        rows.append((i, pick.standard_normal(16).tolist()))
    for i in range(60):
        rows.append((1000 + i, (centre + 0.05 * pick.standard_normal(16)).tolist()))
    rows += [(2000 + i, rows[0][1]) for i in range(30)] + [(2100, [2 * x for x in rows[1][1]])]
    rows += [
        (3000, None), (3001, []), (3002, [0.0] * 16), (3003, [float("nan"), *[1.0] * 15]), (3004, [float("inf")] * 16), (3005, [None, *[1.0] * 15]),
        (3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (3008, [1e300] * 16), (3009, [1e-300] * 16), (None, rows[0][1]), (5, rows[7][1]), (5, rows[5][1]),
    ]
    return rows


def fit_vector(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


def test_near_vectors_match_brute_force(spark, with_clashes, monkeypatch):
    monkeypatch.setattr(forest, "CELL_ROWS", 24)
    monkeypatch.setattr(forest, "LEAF_ROWS", 64)
    rows = vectors()
    frame = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    got = forest.near_duplicates(frame, trees=8).collect()
    real = [(i, np.ldexp(np.array(v), -int(np.frexp(np.abs(v).max())[1]))) for i, v in rows if i is not None and fit_vector(v) and any(v)]
    counts, links = [0] * len(real), []
    for a, (i, v) in enumerate(real):
        for b, (j, w) in enumerate(real[:a]):
            if len(v) == len(w) and v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w)) >= 0.95:
                links.append((i, j))
                counts[a] += 1
                counts[b] += 1
    least = least_reachable({i for i, _ in rows if i is not None}, links)
    known = sorted((i, c) for (i, _), c in zip(real, counts))
    rest = [i for i, v in rows if i is None or not fit_vector(v) or not any(v)]
    expected = [(i, c, least[i], least[i] == i) for i, c in known] + [(i, 0, i, i is not None) for i in rest]
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == sorted(expected, key=str)


def hot_vectors(members, others, cosine, dimension=64):
    """One wide group of distinct near-copies, their cosines about ``cosine``, among isotropic vectors."""
    pick = np.random.default_rng(21)
    centre = pick.standard_normal(dimension)
    noise = pick.standard_normal((members, dimension)) * np.linalg.norm(centre) / dimension**0.5 * (1 / cosine - 1) ** 0.5
    return np.concatenate((centre + noise, pick.standard_normal((others, dimension))))


def test_a_wide_hot_group_loses_no_links_with_production_parameters(spark):
    matrix = hot_vectors(4000, 6000, 0.96)
    rows = [(i, v) for i, v in enumerate(matrix.tolist())]
    got = forest.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)).collect()
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    counts = [int(((matrix @ v) / (norms * n) >= 0.95).sum()) - 1 for v, n in zip(matrix, norms)]
    assert 0.9 * 4000**2 < sum(counts) < 4000**2  # the group lies about the threshold
    assert [r.n_links for r in sorted(got)] == counts


@pytest.mark.parametrize("members, cosine", [(17_000, 0.95), (17_000, 0.97), (17_000, 0.9), (40_000, 0.96)])
def test_split_nodes_keep_links_of_hot_groups_together(members, cosine):
    matrix = forest.unit(hot_vectors(members, 51_000 - members, cosine)).astype(np.float32)
    sample = matrix[np.random.default_rng(22).permutation(len(matrix))[: forest.SAMPLE]]
    a, b = np.nonzero(np.triu(matrix[:1500] @ matrix[:1500].T >= 0.95, 1))
    met = np.zeros(len(a), bool)
    for seed in range(forest.TREES):
        rows, leaves = (tree := forest.Tree(sample, len(matrix), seed, 0.95)).route(matrix[:1500])
        there = np.zeros((1500, len(tree.leaves)), bool)
        there[rows, leaves] = True
        for begin in range(0, len(a), 20_000):
            met[begin : begin + 20_000] |= (there[a[begin : begin + 20_000]] & there[b[begin : begin + 20_000]]).any(axis=1)
    assert len(a) > 100 and met.mean() > 0.999


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert forest.near_duplicates(frame).count() == 0
    assert impact.top_k(frame, F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("block_rows, group_rows, slice_rows", [(50, 5, 3), (16_384, 2_048, 128)])
def test_top_k_matches_brute_force(spark, with_clashes, monkeypatch, block_rows, group_rows, slice_rows):
    """Also impacts that doubles can't sum and that don't fit in a long, ties and repeated rows."""
    monkeypatch.setattr(impact, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(impact, "QUERY_ROWS", group_rows)
    monkeypatch.setattr(impact, "SLICE", slice_rows)
    pick = np.random.default_rng(8)
    rows = vectors() + [(5000 + i, (pick.standard_normal(16) * 10.0 ** pick.integers(3, 12)).tolist()) for i in range(40)]
    rows += [(6000, [300_000.0, 1.0]), (6005, [6.0, 1.0]), (6010, [-1e300, 2.0]), (6015, [2.0**40, 2.0**-6]), (6020, [2.0**40, 0.0])]
    frame = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    got = impact.top_k(frame, F.col("vec_id") % 5 == 0, k=7).collect()
    largest = np.finfo(np.float64).max
    real = [
        (i, [int(x) for x in np.clip(np.floor(64 * np.array(v, np.float64)), -largest, largest).tolist()]) for i, v in rows if i is not None and fit_vector(v)
    ]
    expected = []
    for a, (i, v) in enumerate(real):
        if i % 5 == 0:
            scores = [(-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(real) if b != a and len(v) == len(w)]
            expected += [(i, r, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(sorted(scores)[:7], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(expected)
    assert (6000, 1, 6020, 2**63 - 1) not in got and any(r.query_id == 6000 and r.vec_id == 6005 and r.score == 7_372_804_096 for r in got)


def test_the_search_stops_on_proof_and_stays_exact():
    pick = np.random.default_rng(2)
    matrix = np.floor(64 * pick.standard_normal((600, 8)) ** 3)
    index, ids = impact.Index(matrix), np.arange(600)
    looked = []
    for segment, unmet, limit in index.segments:
        looked.append(limit)
    assert looked == sorted(looked, reverse=True) and sum(s for s, _, _ in index.segments).tolist() == matrix.tolist()
    queries = np.concatenate((matrix[3:9], matrix[:1]))
    for own in (np.full(7, -1), np.array([3, 4, 5, 6, 7, 8, 0])):
        query, row, score = index.top(queries, 10, own, np.full(7, -np.inf))
        best = impact.best_of(query, row, score, ids, np.zeros(600, int), 10)
        for number in range(7):
            exact = matrix @ queries[number]
            order = [r for r in np.lexsort((ids, -exact)) if r != own[number]][:10]
            mine = best[query[best] == number]
            assert row[mine].tolist() == order and score[mine].tolist() == exact[order].tolist()


def test_few_rows_are_scored_when_impacts_differ_much():
    """Where some impacts are much larger than the rest, the proof comes after the first segments."""
    pick = np.random.default_rng(3)
    matrix = np.floor(pick.standard_normal((4000, 32)) * 2.0)
    for row in range(4000):
        matrix[row, pick.integers(0, 32, 4)] = np.floor(2000 * pick.standard_normal(4))
    index = impact.Index(matrix)
    query, row, _ = index.top(matrix[:50], 20, np.arange(50), np.full(50, -np.inf))
    assert len(row) < 0.2 * 50 * 4000
    for number in range(50):
        exact = matrix @ matrix[number]
        exact[number] = -np.inf
        assert set(np.argsort(-exact, kind="stable")[:20]) <= set(row[query == number])
