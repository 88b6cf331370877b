"""Quality of whole texts: histogram gradient-boosted trees over document statistics.

The statistics are counts over bytes, words and lines of a block of texts at a time;
see ``NAMES``. The trees are fitted in numpy on a bounded sample of labelled rows
(``labelled.FIT_ROWS``), flattened into arrays, and applied where the texts are: one
pass, without a shuffle. Language, source and ids are no inputs.

Null and empty texts have all statistics 0 and the score that follows. Without labels
every score is 0.5. Rows are scored one by one, so repeated rows score alike. ``doc_id`` is no input of a score and
may be null; columns other than the named ones are ignored. What a score of exactly the caller's limit means is the
caller's to say; the query takes it as good. An empty table gives an empty table. A text of any length is one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm import boosting
from curbline.llm.blocks import coded, strings, sums, text_blocks, text_bytes, words
from curbline.llm.labelled import fit_sample

#: Held out: documents whose crc32 modulo ``FOLDS`` is ``TEST_FOLD``.
FOLDS, TEST_FOLD = 4, 2

_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
    "white": b" \t\n\v\f\r", "stop": b".?", "comma": b",;:", "shout": b"!", "quote": b"'\"()", "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~-", "far": bytes(range(128, 256)),
}
NAMES = (
    "log_bytes", "log_words", *_CLASSES, "word_bytes", "log_longest_word", "words_per_stop", "distinct_words", "distinct_pairs",
    "repeats", "log_repeats", "log_lines", "distinct_lines", "words_per_line", "lines_ended",
)


def _distinct(owner: np.ndarray, codes: np.ndarray, count: int) -> np.ndarray:
    """How many different codes each of ``count`` owners has."""
    if not len(codes):
        return np.zeros(count, np.int64)
    wide = np.int64(codes.max()) + 1
    return np.bincount(np.unique(owner * wide + codes) // wide, minlength=count)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``NAMES`` for each text."""
    data, offsets = text_bytes(texts)
    count, size = len(texts), np.diff(offsets)
    found, edges = words(data, offsets)
    at, distinct = coded(found)
    n_words = np.diff(edges)
    owner = np.repeat(np.arange(count), n_words)
    safe = lambda x: np.maximum(x, 1)
    columns = [np.log1p(size), np.log1p(n_words)]
    per_class = {}
    for name, members in _CLASSES.items():
        mask = np.zeros(256, bool)
        mask[list(members)] = True
        per_class[name] = sums(mask[data], offsets)
        columns.append(per_class[name] / safe(size))
    lengths = np.diff(np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1]) if len(found) else np.empty(0, np.int64)
    longest = np.zeros(count, np.int64)
    np.maximum.at(longest, owner, lengths)
    columns += [sums(lengths, edges) / safe(n_words), np.log1p(longest), np.log1p(n_words / safe(per_class["stop"]))]
    columns.append(_distinct(owner, at.astype(np.int64), count) / safe(n_words))
    pairs = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else np.empty(0, np.int64)
    # Pairs get new numbers, small enough to be combined with their owner's.
    both = at[pairs].astype(np.int64) * safe(len(distinct)) + at[pairs + 1]
    columns.append(_distinct(owner[pairs], np.unique(both, return_inverse=True)[1], count) / safe(n_words - 1))
    same = np.bincount(owner[pairs][at[pairs] == at[pairs + 1]], minlength=count)
    columns += [same / safe(n_words), np.log1p(same)]
    breaks = np.flatnonzero(data == 10) + 1
    line_edges = np.unique(np.concatenate((offsets, breaks)))
    lines, line_owner = strings(data, line_edges), np.searchsorted(offsets, line_edges[:-1], side="right") - 1
    n_lines = np.bincount(line_owner, minlength=count) if len(lines) else np.zeros(count, np.int64)
    line_codes = coded(lines)[0].astype(np.int64) if len(lines) else np.empty(0, np.int64)
    ended = np.isin(data[np.maximum(line_edges[1:] - 2, 0)], list(b".!?")) if len(lines) else np.empty(0, bool)
    columns += [
        np.log1p(n_lines), _distinct(line_owner, line_codes, count) / safe(n_lines), n_words / safe(n_lines),
        np.bincount(line_owner[ended], minlength=count) / safe(n_lines),
    ]
    return np.stack(columns, axis=1).astype(np.float64)


def scorer(model: boosting.Boosted):
    """An Arrow function of a text column: its scores."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        blocks = text_blocks([pa.RecordBatch.from_arrays([texts], names=["text"])], "text")
        found = [model.score(statistics(b.column("text"))) for b in blocks]
        return pa.array(np.concatenate(found) if found else np.empty(0))

    return score


def fit(docs: DataFrame, labels: DataFrame, rows: int | None = None) -> boosting.Boosted:
    """The trees, from at most ``rows`` labelled documents that aren't held out."""
    bound = {} if rows is None else {"rows": rows}
    sample = fit_sample(docs, labels, "quality", FOLDS, TEST_FOLD, **bound)

    def measured(batches):
        for batch in text_blocks(batches, "text"):
            table = statistics(batch.column("text"))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(table.ravel()), table.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), flat.cast(pa.list_(pa.float64()))], names=["doc_id", "label", "x"]
            )

    rows = sample.mapInArrow(measured, "doc_id long, label int, x array<double>").orderBy("doc_id").collect()
    matrix = np.array([r.x for r in rows]).reshape(len(rows), len(NAMES))
    return boosting.fit(matrix, np.array([r.label for r in rows], np.float64))


def score(text: Column, model: boosting.Boosted) -> Column:
    return scorer(model)(text)
