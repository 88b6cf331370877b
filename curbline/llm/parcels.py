"""Blocks of texts as rows of a written table, and what tasks find out about a block brought back to it.

A parcel is one block: the ids of its documents, its distinct words, and the number of
the word at each position. Its number is fixed once the table is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.blocks import BLOCK_BYTES, coded, narrow_kind, packed, strings, text_blocks, unpacked
from curbline.llm.frames import narrowed, stored

SCHEMA = "block long, doc_ids array<long>, sizes array<int>, distinct int, codes binary, lengths binary, letters binary"

#: Given a column of texts: their words, and for each text the number of words before it.
Cut = Callable[[pa.Array], tuple[pa.Array, np.ndarray]]


@dataclass
class Parcel:
    """A block read back: ``codes`` has the number of the word at each position."""

    block: int
    doc_ids: pa.Array
    edges: np.ndarray
    codes: np.ndarray
    words: pa.Array


#: Makes what is stored of each distinct word: as many binary values as there are words.
Translate = Callable[[pa.Array], pa.Array]


def pack_task(cut: Cut, limit: int, translate: Translate | None):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(text_blocks(batches, "text", limit)):
            found, edges = cut(batch.column("text"))
            codes, words = coded(found)
            if translate is not None:
                words = translate(words)
            places = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
            letters = words.buffers()[2].to_pybytes()[places[0] : places[-1]] if len(words) else b""
            row = {
                "block": first + number, "doc_ids": batch.column("doc_id").to_pylist(), "sizes": np.diff(edges).tolist(), "distinct": len(words),
                "codes": packed(codes.astype(narrow_kind(max(len(words) - 1, 0)))), "lengths": packed(np.diff(places).astype(np.uint32)),
                "letters": zstandard.compress(letters),
            }
            yield pa.RecordBatch.from_pylist([row], schema=ARROW)

    return pack


ARROW = pa.schema(
    [
        ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("distinct", pa.int32()),
        ("codes", pa.binary()), ("lengths", pa.binary()), ("letters", pa.binary()),
    ]
)


def write(
    docs: DataFrame, cut: Cut, doc_id: str = "doc_id", text: str = "text", limit: int = BLOCK_BYTES, translate: Translate | None = None
) -> DataFrame:
    """The table of parcels of all texts; ``translate`` says what is kept of a word in the word's stead."""
    rows = narrowed(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return stored(rows.mapInArrow(pack_task(cut, limit, translate), SCHEMA), "parcels")


def read(batch: pa.RecordBatch, row: int) -> Parcel:
    """The parcel in one row of a batch."""
    value = lambda name: batch.column(name)[row].as_py()
    sizes, distinct = batch.column("sizes")[row].values.to_numpy().astype(np.int64), value("distinct")
    edges = np.concatenate(([0], np.cumsum(sizes)))
    codes = unpacked(value("codes"), narrow_kind(max(distinct - 1, 0)), int(edges[-1])).astype(np.int64)
    lengths = unpacked(value("lengths"), np.uint32, distinct).astype(np.int64)
    letters = np.frombuffer(zstandard.decompress(value("letters")), np.uint8)
    words = strings(letters, np.concatenate(([0], np.cumsum(lengths))))
    return Parcel(value("block"), batch.column("doc_ids")[row].values, edges, codes, words)


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[Parcel]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield read(batch, row)


def with_parcels(parcels: DataFrame, *sides: DataFrame) -> DataFrame:
    """The rows of all sides and of the parcels, dealt by block: a block's parcel is the last of its rows."""
    both = parcels.withColumn("turn", F.lit(len(sides)))
    for turn, side in enumerate(sides):
        both = both.unionByName(side.withColumn("turn", F.lit(turn)), allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", "turn")


def visits(batches: Iterator[pa.RecordBatch], *sides: tuple[str, ...]) -> Iterator[tuple[Parcel, list[dict[str, np.ndarray]]]]:
    """For each parcel what every side has about it: its columns, by the names given for the side."""
    held: list[list[pa.RecordBatch]] = [[] for _ in sides]
    for batch in batches:
        turns = batch.column("turn").to_numpy()
        last = 0
        for row in [*np.flatnonzero(turns == len(sides)).tolist(), batch.num_rows]:
            for turn, names in enumerate(sides):
                begin, end = last + np.searchsorted(turns[last:row], [turn, turn + 1])
                if end > begin:
                    held[turn].append(batch.select(names).slice(begin, end - begin))
            if row < batch.num_rows:
                found = [
                    {n: np.concatenate([b.column(n).to_numpy(zero_copy_only=False) for b in own]) for n in names} if own else {}
                    for own, names in zip(held, sides)
                ]
                held = [[] for _ in sides]
                yield read(batch, row), found
            last = row + 1


def whole_keys(batches: Iterator[pa.RecordBatch], key: str, most: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of ``key`` in batches of some ``most`` bytes; no key is in two of them."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        held += batch.nbytes
        if held < most:
            continue
        whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        keys = whole.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if keys[0] != keys[-1] else 0
        if cut:
            yield whole.slice(0, cut)
        waiting = [whole.slice(cut)]
        held = waiting[0].nbytes if cut else 0
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
