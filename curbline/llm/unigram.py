"""Token counts of a unigram vocabulary: the best segmentation's score and number of pieces, without its ids.

A text is taken as the metaspace convention has it: a ``▁`` is put before it, unless it
begins with one, blanks become ``▁``, and a word begins at each ``▁``. In a word,
Aho-Corasick finds every piece of the vocabulary at every place, and a dynamic programme
over character places carries the best score and its number of pieces.

Ties follow the usual tokenizer: places are visited from left to right, at a place
pieces from short to long, and only a strictly better score replaces what is known. So of equal segmentations that whose
last piece begins earlier stays. A character that no piece of one character covers is an
unknown piece: it scores ``UNKNOWN_PENALTY`` below the worst piece, and neighbouring
unknown pieces count as one.

Words repeat, so a block's distinct words are counted once, and a worker remembers a
bounded number of them. There is no shuffle. Null and empty texts have no pieces and
score 0. Repeated rows are counted each, and a null ``doc_id`` is kept. A text of any length is one row, and so is a
word of any length. An empty table gives an empty table. Columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.blocks import coded, text_blocks
from curbline.llm.frames import narrowed

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words that a worker remembers with their counts; beyond, it forgets those that the present block doesn't have.
REMEMBERED = 600_000


@cache
def vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    """Pieces and scores of a SentencePiece file: its ordinary pieces, taken as a unigram vocabulary."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    kept = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return tuple((model.id_to_piece(i), model.get_score(i)) for i in kept)


class Counter:
    def __init__(self, pieces: tuple[tuple[str, float], ...]):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.machine.add_word(piece, (len(piece), score))
        self.machine.make_automaton()
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY

    def word(self, word: str) -> tuple[int, float]:
        """Number of pieces and score of the best segmentation of one word."""
        size = len(word)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        for end, found in self.machine.iter(word):
            ending[end].append(found)
        best, count, last_unknown = [0.0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        for end in range(1, size + 1):
            score, from_, unknown = None, 0, False
            single = False
            # The longest piece begins first, so it has been seen first.
            for length, own in sorted(ending[end - 1], reverse=True):
                single |= length == 1
                reached = best[end - length] + own
                if score is None or reached > score:
                    score, from_ = reached, end - length
            if not single:
                reached = best[end - 1] + self.unknown
                if score is None or reached > score:
                    score, from_, unknown = reached, end - 1, True
            best[end], last_unknown[end] = score, unknown
            count[end] = count[from_] + (0 if unknown and last_unknown[from_] else 1)
        return count[size], best[size]

    def run(self, run: str) -> tuple[int, float]:
        """The same for what stands between two blanks, its mark included; further marks begin words."""
        count, score, begin = 0, 0.0, 0
        while begin < len(run):
            end = run.find(MARK, begin + 1)
            end = len(run) if end < 0 else end
            own, part = self.word(run[begin:end])
            count, score, begin = count + own, score + part, end
        return count, score


@cache
def counter(path: str) -> tuple[Counter, dict[str, tuple[int, float]]]:
    return Counter(vocabulary(path)), {}


def count_task(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting, known = counter(path)
        for batch in text_blocks(batches, "text"):
            texts = pc.replace_substring(pc.fill_null(batch.column("text"), ""), MARK, " ")
            # The mark that is put before a text, unless it has one.
            marked = pc.if_else(
                pc.or_(pc.starts_with(texts, " "), pc.equal(texts, "")), texts, pc.binary_join_element_wise(" ", texts, "")
            )
            runs = pc.split_pattern(marked, " ")
            at, words = coded(runs.flatten())
            words = words.to_pylist()
            new = [w for w in words if w not in known]
            if len(known) + len(new) > REMEMBERED:
                kept = {w: known[w] for w in words if w in known}
                known.clear()
                known.update(kept)
            known.update((w, counting.word(MARK + w)) for w in new)
            found = [known[w] for w in words]
            sizes = pc.list_value_length(runs).to_numpy(zero_copy_only=False)
            # What stands before the first blank is empty: no word.
            edges = np.concatenate(([0], np.cumsum(sizes)))
            real = np.ones(len(at), bool)
            real[edges[:-1]] = False
            totals = []
            for k, kind in ((0, np.int64), (1, np.float64)):
                values = np.array([f[k] for f in found], kind)[at] * real if found else np.empty(0, kind)
                totals.append(np.add.reduceat(values, edges[:-1]) if len(values) else np.zeros(batch.num_rows, kind))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals[0]), pa.array(totals[1])], names=["doc_id", "n_tokens", "score"]
            )

    return count


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``score`` (of the best segmentation) of each whole text."""
    rows = narrowed(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(count_task(path), "doc_id long, n_tokens long, score double")
