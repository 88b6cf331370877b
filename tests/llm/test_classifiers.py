"""The fitted operators: held-out accuracy, plain versions of their parts, and odd input."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curbline.llm import boosting, catalog, labelled, quality, toxicity
from curbline.llm.frames import table


def test_trees_equal_a_walk_from_node_to_node():
    pick = np.random.default_rng(4)
    rows = pick.standard_normal((500, 5))
    labels = ((rows[:, 0] > 0.2) ^ (rows[:, 3] > 0)).astype(float)
    model = boosting.fit(rows, labels, trees=20, depth=3)
    for row, score in zip(rows[:60], model.score(rows[:60])):
        total = model.prior
        for features, thresholds, values in zip(model.features, model.thresholds, model.values):
            node = 0
            while node < len(features):
                node = 2 * node + (2 if row[features[node]] > thresholds[node] else 1)
            total += values[node - len(features)]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((model.score(rows) >= 0.5) == labels).mean() > 0.95


def test_trees_without_labels_give_the_prior():
    model = boosting.fit(np.zeros((0, 3)), np.zeros(0))
    assert model.score(np.ones((2, 3))).tolist() == [0.5, 0.5]


def test_statistics_match_plain_counts():
    texts = ["", None, "a b a b\na b", "One two, two.\nOne two, two.\n!!", "é", "\n\n", "x" * 5000]
    got = dict(zip(quality.NAMES, quality.statistics(pa.array(texts)).T))
    for k, text in enumerate(texts):
        text = text or ""
        words, lines, size = text.split(), text.splitlines(), len(text.encode())
        pairs = list(zip(words, words[1:]))
        assert got["log_bytes"][k] == pytest.approx(np.log1p(size))
        assert got["log_words"][k] == pytest.approx(np.log1p(len(words)))
        assert got["distinct_words"][k] == pytest.approx(len(set(words)) / max(len(words), 1))
        assert got["distinct_pairs"][k] == pytest.approx(len(set(pairs)) / max(len(words) - 1, 1))
        assert got["log_lines"][k] == pytest.approx(np.log1p(len(lines)))
        assert got["shout"][k] == pytest.approx(text.count("!") / max(size, 1))


def accuracy(spark, scored, label):
    """Over the held-out rows: (of label 1 predicted 1, of label 0 predicted 0)."""
    joined = scored.where("held_out").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where(F.col(label).isNotNull())
    rows = joined.groupBy(label, "predicted").count().collect()
    count = {(r[0], r[1]): r[2] for r in rows}
    return [count.get((v, v), 0) / max(1, count.get((v, 0), 0) + count.get((v, 1), 0)) for v in (1, 0)]


def test_quality_of_held_out_rows(spark):
    good, poor = accuracy(spark, catalog.op4_quality(spark, "/root/testdata/sf0.01"), "quality")
    assert good > 0.95 and poor > 0.85


def test_toxicity_of_held_out_rows(spark):
    toxic, clean = accuracy(spark, catalog.op5_toxicity(spark, "/root/testdata/sf0.01"), "toxic")
    # A few dozen toxic texts teach the words of the most frequent language only.
    assert toxic > 0.7 and clean > 0.99


def test_no_held_out_row_is_learned_from(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "labels"))
    sample = labelled.fit_sample(docs, labels, "toxic", 3, 1)
    assert sample.count() > 0 and sample.where(labelled.held_out("doc_id", 3, 1)).count() == 0
    assert labelled.fit_sample(docs, labels, "toxic", 3, 1, rows=5).count() <= 5


GRAMMAR = toxicity.Grammar({"idiot": 1.0}, {"lowe": 2.0})


@pytest.mark.parametrize(
    "text, matches",
    [
        ("an idiot", ["plain 1"]), ("You are an IDIOT!", ["plain 1.25"]), ("he is not an idiot", ["negated 1.25"]),
        ("not that it matters much, idiot", [None, "plain 1"]), ("not so. idiot", [None, "plain 1"]), ("she said an idiot came", ["reported 1.25"]),
        ("they said so, an idiot came. idiot", [None, "reported 1", "plain 1"]), ("i will kill you", ["threat 1"]), ("kill the process", [None]),
        ("they attack. you are kind", [None, None]), ("we attack, you are kind", [None, None]), ("attack you and an idiot", ["threat 1", "plain 1"]),
        ("loweisch lowe und du idiot", ["plain 2", "plain 1.25"]), ("idiot idiot idiot", ["plain 1"]), ("not idiot, idiot", ["negated 1", "plain 1"]),
        ("ich werde töten dich", ["threat 1"]), ("il a dit idiot", ["reported 1"]), ("", []), ("nothing here", [None]),
    ],
)
def test_a_clause_has_one_match(text, matches):
    assert [m and f"{m[0]} {m[1]:g}" for m in GRAMMAR.clauses(text)] == matches


def test_length_alone_raises_no_score():
    clean = "Plain words stand here, and others there. " * 3000
    texts = [None, "", clean, "idiot. " + clean, "idiot. " * 3, "idiot. " * 300, "idiot " * 300, clean + "idiot. " * 3]
    table = toxicity.match_table(pa.array(texts, pa.string()), GRAMMAR)
    one, nothing = np.log1p(1.0), [0.0] * len(toxicity.FEATURES)
    assert table[:3].tolist() == [nothing] * 3
    assert table[3][:6].tolist() == [one, 0, 0, 0, 0, 0] and table[3][6] < 0.12
    assert table[4].tolist() == table[5].tolist() == [one, 0, 0, 0, one, one, 1.0]
    assert table[6].tolist() == [one, 0, 0, 0, 0, 0, 1.0]
    scores = GRAMMAR.score(table)
    assert scores[2] == scores[0] and scores[7] < scores[4] and scores[3] < scores[7]


def test_composed_machines_say_what_each_says():
    parts = (toxicity.INSULT, toxicity.TARGET, toxicity.THREAT, toxicity.NEGATION, toxicity.REPORTED)
    pick = np.random.default_rng(5)
    for _ in range(200):
        symbols = pick.choice(["other", "insult", "threat", "target", "negation", "report"], 8).tolist()
        expected = []
        for machine in parts:
            state = machine.start
            for symbol in symbols:
                state = machine.step(state, symbol)
            expected.append(state)
        assert toxicity.CLAUSE.run(symbols) == tuple(expected)


def test_toxicity_query_follows_its_parts(spark):
    """Scores, folds and predictions of the query are those of the fitted grammar, text by text."""
    sf = "/root/testdata/sf0.001"
    docs, labels = (table(spark, sf, t) for t in ("documents", "labels"))
    grammar = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in catalog.op5_toxicity(spark, sf).collect()}
    for row in docs.collect():
        score = float(grammar.score(grammar.features(row.text or "")[None])[0])
        own = got[row.doc_id]
        assert own.score == pytest.approx(score) and own.predicted == int(own.score >= 0.7)
        assert own.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)


def test_lexicon_needs_different_contexts(spark):
    word = lambda i: "w" + "".join(chr(97 + int(c)) for c in f"{i:03d}")
    bad = [(i, f"{word(i)} foul {word(i + 1)} filler gone here", 1) for i in range(30)]
    good = [(100 + i, f"{word(i)} fine {word(i + 2)} other", 0) for i in range(200)]
    terms, _ = toxicity.lexicon(spark.createDataFrame(bad + good, "doc_id long, text string, label int"))
    assert "foul" in terms and "gone" not in terms and "fine" not in terms


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows_are_scored(spark, odd_docs, odd_texts, module):
    labels = table(spark, "/root/testdata/sf0.001", "labels")
    model = module.fit(table(spark, "/root/testdata/sf0.001", "documents"), labels)
    rows = odd_docs.select("doc_id", "text", module.score(F.col("text"), model).alias("s")).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r.s <= 1 for r in rows)
    by_text = {}
    for r in rows:  # copies score alike, and no text like an empty one
        by_text.setdefault(r.text or "", set()).add(r.s)
    assert all(len(s) == 1 for s in by_text.values())


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_labels(spark, no_docs, odd_docs, module):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = module.fit(odd_docs, labels)
    assert no_docs.select(module.score(F.col("text"), model).alias("s")).count() == 0
    assert odd_docs.select(module.score(F.col("text"), model).alias("s")).where("s is not null").count() == odd_docs.count()
