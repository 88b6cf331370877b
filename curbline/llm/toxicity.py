"""Toxicity of whole texts: a weighted finite-state grammar over clauses.

Lexicon. From labelled rows, words and word beginnings are learned that occur in toxic
texts, in different contexts, and hardly in others. The contexts matter: a word that
stands in copies of one toxic text alone is no evidence. Verbs of threat, targets,
negations, verbs of saying and conjunctions are fixed lists in four languages.

Grammar. The unit is the clause: sentences end at marks and line breaks, clauses also at commas
and conjunctions. Five transducers read the classes of a clause's words: whether an
insult is uttered, whether someone is its target, whether a threat has a target behind
it, whether what is uttered stands in the reach of a negation, and whether it is reported (which
lasts to the end of the sentence). They are composed into one (``Composed``), whose last state
says what the clause is: nothing, or one match of a kind, with the weight of its
strongest insult, more if it is aimed at someone. Words outside of a matched clause count for nothing.

Score. A text is judged by its highest clauses and by the share of its clauses that match, not by sums,
so length alone raises no score. A logistic function of those gives the score; its
weights start at fixed values and are moved by the labelled sample.

Scoring is one pass without a shuffle: a block's distinct words are looked up, and only
texts with a word that may match go through the grammar. Null and empty texts, and those without a match,
have the score of no match; repeated rows score alike. Without labels, or with toxic rows alone, the lexicon is
empty, the weights are the fixed ones and only threats count. A score of exactly the caller's limit is the caller's to
judge; the query takes it as toxic. ``doc_id`` is no input of a score and may be null; columns other than the named ones are ignored.
An empty table gives an empty table. A text of any length is one row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.blocks import coded, text_blocks, text_bytes, words
from curbline.llm.frames import stored
from curbline.llm.labelled import fit_sample

#: Held out: documents whose crc32 modulo ``FOLDS`` is ``TEST_FOLD``.
FOLDS, TEST_FOLD = 3, 1

# The closed word classes of the grammar, in English, German, French and Spanish.
THREATS = frozenset(
    "kill hurt destroy punish shoot stab strangle hang burn crush beat attack murder"
    " töten umbringen schlagen verletzen erschießen erstechen verbrennen"
    " tuer frapper blesser détruire brûler étrangler"
    " matar golpear herir destruir quemar estrangular".split()
)
TARGETS = frozenset(
    "you your yours u he him his she her hers they them their we us our people everyone those these"
    " du dich dir dein deine ihr euch euer er ihn ihm sie ihnen wir uns"
    " tu te toi ton ta tes vous votre vos ils elles leur nous"
    " tú ti usted ustedes vosotros él ella ellos ellas nosotros".split()
)
NEGATIONS = frozenset(
    "not never neither nor without hardly isn aren wasn weren don doesn didn won wouldn can't cannot"
    " nicht nie niemals kein keine keinen ohne jamais pas sans ni nunca jamás tampoco sin".split()
)
REPORTS = frozenset(
    "said says say wrote writes called calls claimed claims quoted reported according asked shouted"
    " sagte sagt sagten schrieb schreibt behauptete behauptet nannte rief laut"
    " dit disait écrit écrivait affirme affirmait appelait selon"
    " dijo dice decía escribió escribe afirmó afirma llamó según".split()
)
CONJUNCTIONS = frozenset(
    "and but or because although while whereas though however"
    " und aber oder weil obwohl während sondern mais ou car donc pero porque aunque mientras sino".split()
)

NEGATION_REACH = 3
#: Beginnings of words that are tried, by their number of letters.
STEMS = (4, 5, 6)
#: A term needs so many different contexts in toxic texts, a beginning so many contexts and words.
LEAST_CONTEXTS, LEAST_STEM_CONTEXTS, LEAST_STEM_WORDS = 5, 5, 3
#: Contexts for each toxic text with the term, at least: what copies of one text share has few.
VARIETY = 0.3
#: Of the texts that have a term, or a beginning, so many may not be toxic.
IMPURE, STEM_IMPURE = 0.02, 0.005
#: An insult that is aimed at someone weighs so much more.
AIMED = 1.25
#: Letters of text that a fitting task takes apart at a time.
FIT_BYTES = 1 << 20

KINDS = ("plain", "negated", "reported", "threat")
#: What a text is judged by: the strongest clause of each kind, the next two plain or threatening ones, and their share.
FEATURES = (*KINDS, "second", "third", "share")
#: Bias, then a weight for each feature; the sample moves them.
START = np.array([-3.5, 2.5, 0.6, 0.8, 3.5, 1.0, 0.5, 2.0])

_LETTERS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_SENTENCES = re.compile(r"[.!?\n]+")
_CLAUSES = re.compile(r"[,;:()]+")


@dataclass(frozen=True)
class Machine:
    """A transducer over word classes: what it has seen is its state, and its last state is what it says."""

    start: str
    step: Callable[[str, str], str]


def _moves(table: Mapping[tuple[str, str], str]) -> Callable[[str, str], str]:
    return lambda state, symbol: table.get((state, symbol), state)


def _negate(state: str, symbol: str) -> str:
    """Counts down the words that a negation still reaches; what is uttered outside of its reach stays plain."""
    if state == "plain":
        return state
    if symbol in ("insult", "threat"):
        return "plain" if state == "off" else "denied"
    if state == "denied":
        return state
    if symbol == "negation":
        return str(NEGATION_REACH)
    return "off" if state in ("off", "1") else str(int(state) - 1)


INSULT = Machine("no", _moves({("no", "insult"): "yes"}))
TARGET = Machine("no", _moves({("no", "target"): "yes"}))
THREAT = Machine("no", _moves({("no", "threat"): "verb", ("verb", "target"): "yes"}))
NEGATION = Machine("off", _negate)
REPORTED = Machine("no", _moves({("no", "report"): "yes"}))


class Composed:
    """Several transducers that read the same symbols, as one: its states are numbers, its moves a table that grows with use."""

    def __init__(self, *machines: Machine):
        self.machines = machines
        self.states: list[tuple[str, ...]] = []
        self.numbers: dict[tuple[str, ...], int] = {}
        self.table: dict[tuple[int, str], int] = {}

    def number(self, state: tuple[str, ...]) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state]

    def run(self, symbols: Sequence[str], state: tuple[str, ...] | None = None) -> tuple[str, ...]:
        at = self.number(state or tuple(m.start for m in self.machines))
        for symbol in symbols:
            key = (at, symbol)
            if key not in self.table:
                self.table[key] = self.number(tuple(m.step(s, symbol) for m, s in zip(self.machines, self.states[at])))
            at = self.table[key]
        return self.states[at]


CLAUSE = Composed(INSULT, TARGET, THREAT, NEGATION, REPORTED)


@dataclass
class Grammar:
    """Weights of words and of word beginnings, and of the logistic function."""

    terms: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: START.copy())

    def weight(self, word: str) -> float:
        """How strongly a word in lower case insults; 0: not at all."""
        own = self.terms.get(word, 0.0)
        for size in STEMS:
            if len(word) > size:
                own = max(own, self.stems.get(word[:size], 0.0))
        return own

    def triggers(self, run: str) -> bool:
        """Whether anything between two blanks could be matched."""
        return any(w in THREATS or self.weight(w) > 0 for w in _LETTERS.findall(run.lower()))

    def symbol(self, word: str) -> tuple[str, float]:
        """The class of a word, and its weight as an insult."""
        own = self.weight(word)
        if own:
            return "insult", own
        if word in NEGATIONS or word.endswith("n't"):
            return "negation", 0.0
        for name, members in (("threat", THREATS), ("target", TARGETS), ("report", REPORTS)):
            if word in members:
                return name, 0.0
        return "other", 0.0

    def clauses(self, text: str) -> Iterator[tuple[str, float] | None]:
        """The match of each clause, as kind and weight; None for a clause without one."""
        for sentence in _SENTENCES.split(text.lower()):
            reported = "no"
            for part in _CLAUSES.split(sentence):
                for clause in _at_conjunctions(_LETTERS.findall(part)):
                    symbols = [self.symbol(w) for w in clause]
                    start = (*[m.start for m in CLAUSE.machines[:-1]], reported)
                    insult, target, threat, negation, reported = CLAUSE.run([s for s, _ in symbols], start)
                    if insult == "no" and threat != "yes":
                        yield None
                        continue
                    weight = max(w for _, w in symbols) * (AIMED if target == "yes" else 1.0)
                    kind = "negated" if negation == "denied" else "reported" if reported == "yes" else "threat" if threat == "yes" else "plain"
                    yield kind, max(weight, 1.0) if threat == "yes" else weight

    def features(self, text: str) -> np.ndarray:
        """What a text is judged by, see ``FEATURES``."""
        found, count = [], 0
        for match in self.clauses(text):
            count += 1
            if match:
                found.append(match)
        best = [max((w for k, w in found if k == kind), default=0.0) for kind in KINDS]
        direct = sorted((w for k, w in found if k in ("plain", "threat")), reverse=True)
        second, third, *_ = [*direct[1:3], 0.0, 0.0]
        # On a scale on which one clause of hundreds differs from one of a few.
        share = 1 / (1 + np.log(count / len(direct))) if direct else 0.0
        return np.array([*np.log1p([*best, second, third]), share])

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.weights[0] + features @ self.weights[1:])))


def _at_conjunctions(tokens: list[str]) -> Iterator[list[str]]:
    """The words between conjunctions; no words give no clause."""
    clause: list[str] = []
    for token in tokens:
        if token in CONJUNCTIONS:
            if clause:
                yield clause
            clause = []
        else:
            clause.append(token)
    if clause:
        yield clause


def match_table(texts: pa.Array, grammar: Grammar) -> np.ndarray:
    """The features of each text."""
    data, offsets = text_bytes(texts)
    found, edges = words(data, offsets)
    at, distinct = coded(found)
    hot = np.fromiter(map(grammar.triggers, distinct.to_pylist()), bool, len(distinct))
    totals = np.zeros((len(texts), len(FEATURES)))
    hits = np.concatenate(([0], np.cumsum(hot[at])))
    for row in np.flatnonzero(hits[edges[1:]] > hits[edges[:-1]]).tolist():
        totals[row] = grammar.features(texts[row].as_py())
    return totals


def scorer(grammar: Grammar):
    """An Arrow function of a text column: its scores."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        blocks = text_blocks([pa.RecordBatch.from_arrays([texts], names=["text"])], "text")
        found = [grammar.score(match_table(b.column("text"), grammar)) for b in blocks]
        return pa.array(np.concatenate(found) if found else np.empty(0))

    return score


def word_task(batches):
    """For each text its different words, each with its first neighbours as context; text by text, so
    that no block is held as Python objects."""
    for batch in text_blocks(batches, "text", FIT_BYTES):
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            tokens = _LETTERS.findall((text or "").lower())
            first: dict[str, str] = {}
            for before, word, after in zip(["", *tokens[:-1]], tokens, [*tokens[1:], ""]):
                if word not in first:
                    first[word] = f"{before} {after}"
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(first), pa.string()), pa.array(list(first.values()), pa.string()), pa.array([label] * len(first), pa.int32())],
                names=["word", "context", "toxic"],
            )


def lexicon(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings with their weights, from ``text`` and ``label``.

    All that are found are kept: there are no more than the sample, whose rows are bounded, has words.
    """
    texts = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    found = sample.mapInArrow(word_task, "word string, context string, toxic int")
    per_word = stored(
        found.groupBy("word").agg(
            F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good"),
            F.count_distinct(F.when(F.col("toxic") == 1, F.xxhash64("context"))).alias("contexts"),
        ),
        "words",
    )
    stem = F.explode(F.transform(F.array(*map(F.lit, STEMS)), lambda n: F.when(F.length("word") > n, F.substring(F.col("word"), F.lit(1), n))))
    per_stem = (
        per_word.select(stem.alias("term"), "bad", "good", "contexts").where("term is not null").groupBy("term").agg(
            F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.sum("contexts").alias("contexts"),
            F.count_if(F.col("bad") > 0).alias("words"),
        ).where((F.col("contexts") >= LEAST_STEM_CONTEXTS) & (F.col("words") >= LEAST_STEM_WORDS))
    )
    odds = F.log((F.col("bad") + 0.5) / (texts.get(1, 0) + 1)) - F.log((F.col("good") + 0.5) / (texts.get(0, 0) + 1))
    result = []
    per_term = per_word.withColumnRenamed("word", "term").where(F.col("contexts") >= LEAST_CONTEXTS)
    for frame, impure in ((per_term, IMPURE), (per_stem, STEM_IMPURE)):
        varied = frame.where(F.col("contexts") >= VARIETY * F.col("bad"))
        pure = varied.where(F.col("good") <= impure * (F.col("bad") + F.col("good"))).where(odds > 1)
        best = pure.select("term", (F.least(odds, F.lit(8.0)) / 4).alias("weight"))
        result.append({r.term: r.weight for r in best.collect()})
    return result[0], result[1]


def calibrated(sums: np.ndarray, labels: np.ndarray, hold: float = 0.3) -> np.ndarray:
    """Weights of the logistic function, by Newton's steps; ``hold`` keeps them near ``START``."""
    rows, weights = np.column_stack([np.ones(len(sums)), sums]), START.copy()
    for _ in range(25):
        chance = 1 / (1 + np.exp(-(rows @ weights)))
        slope = rows.T @ (labels - chance) - hold * (weights - START)
        bend = (rows * (chance * (1 - chance))[:, None]).T @ rows + hold * np.eye(len(weights))
        weights = weights + np.clip(np.linalg.solve(bend, slope), -1, 1)
    return weights


def fit(docs: DataFrame, labels: DataFrame, rows: int | None = None) -> Grammar:
    """The grammar, from at most ``rows`` labelled documents that aren't held out."""
    bound = {} if rows is None else {"rows": rows}
    sample = stored(fit_sample(docs, labels, "toxic", FOLDS, TEST_FOLD, **bound), "toxic-sample")
    grammar = Grammar(*lexicon(sample))

    def summed(batches):
        for batch in text_blocks(batches, "text"):
            table = match_table(batch.column("text"), grammar)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(table.ravel()), table.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column("label"), flat.cast(pa.list_(pa.float64()))], names=["label", "x"])

    found = sample.mapInArrow(summed, "label int, x array<double>").collect()
    # Toxic rows alone would only move the bias, until every text is toxic.
    if any(r.label == 0 for r in found):
        matrix = np.array([r.x for r in found]).reshape(len(found), len(FEATURES))
        order = np.lexsort(np.column_stack([matrix, [r.label for r in found]]).T)
        grammar.weights = calibrated(matrix[order], np.array([r.label for r in found], np.float64)[order])
    return grammar


def score(text: Column, grammar: Grammar) -> Column:
    return scorer(grammar)(text)
