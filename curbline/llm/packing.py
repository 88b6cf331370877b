"""Packing documents into training sequences of several permitted lengths, best fit first.

A document's length is its tokens and an end. What is longer than the largest length is
cut into full pieces of it, which fill sequences of their own, and a rest. Rests and short
documents are dealt into groups of about ``GROUP_TOKENS`` by a hash of their row, and each
group is packed in one task.

Best fit: from long to short, a piece goes into the open sequence that it leaves the
least room in. When none has room, a sequence is opened. Which length is the least cost
depends on what best fit can still put into it, so each permitted length is tried on the pieces that
are left: a trial fills it with the longest ones that fit, one after another, and its price is the cost of the sequence, cut to
its contents, for each token in it. A sequence costs its length and ``OVERHEAD``.

The lengths are chosen jointly: a group is packed under every mix of permitted lengths
(a piece longer than all of a mix opens the least length that holds it), each
sequence is cut to the least permitted length that holds its contents, and the mix with the
least total cost is kept; of equal ones the first, larger mixes first.

Equal lengths are in order of ``doc_id`` (none first), then of row. Null and empty texts
have the end alone. Rows that repeat a ``doc_id`` are packed each. No piece is dropped.
Without documents there is no sequence. Texts of any length are counted whole. Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.blocks import text_blocks
from curbline.llm.frames import narrowed, stored
from curbline.llm.graph import grouped
from curbline.llm.tokenfile import WordMemory, count_texts

LENGTHS = (1024, 2048, 4096, 8192)
OVERHEAD = 64
GROUP_TOKENS = 2_000_000


def lengths(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The written table of ``doc_id``, ``length`` (tokens and an end) and ``row``, a number for each row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordMemory()
        for batch in text_blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count_texts(batch.column("text"), path, memory) + 1)], names=["doc_id", "length"]
            )

    rows = narrowed(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return stored(rows.mapInArrow(count, "doc_id long, length long").withColumn("row", F.monotonically_increasing_id()), "lengths")


def mixes(permitted: Sequence[int]) -> list[tuple[int, ...]]:
    """All choices of permitted lengths, larger ones first."""
    return [m for n in range(len(permitted), 0, -1) for m in combinations(permitted, n)]


def cost(capacities: Sequence[int], overhead: int = OVERHEAD) -> int:
    return sum(capacities) + overhead * len(capacities)


def trial(sizes: Sequence[int], falling: Sequence[int], at: int, space: int) -> int:
    """Tokens in a sequence of ``space`` that is opened for piece ``at`` and filled with the longest later ones that fit."""
    room, filled = space - sizes[at], sizes[at]
    while room > 0:
        # The first of the later pieces that is no longer than the room.
        at = bisect_left(falling, -room, at + 1)
        if at == len(sizes):
            break
        room -= sizes[at]
        filled += sizes[at]
    return filled


def best_fit(
    sizes: Sequence[int], permitted: Sequence[int] = LENGTHS, overhead: int = OVERHEAD, mix: Sequence[int] | None = None
) -> tuple[list[int], list[int], list[int]]:
    """Sequence and place of each piece, pieces in descending order of size, and the length of each sequence.

    ``mix`` are the lengths that sequences are opened with.
    """
    mix = mix or permitted
    falling = [-s for s in sizes]
    down = lambda filled: next(c for c in permitted if c >= filled)
    room, bins, places, filled, opened = [], [], [], [], 0
    for at, size in enumerate(sizes):
        place = bisect_left(room, (size, -1))
        if place < len(room):
            space, number = room.pop(place)
        else:
            spaces = [c for c in mix if c >= size] or [down(size)]
            if len(spaces) > 1:
                tokens = [trial(sizes, falling, at, c) for c in spaces]
                # Of equal price, the longer one.
                space = min(zip(spaces, tokens), key=lambda c: ((down(c[1]) + overhead) / c[1], -c[0]))[0]
            else:
                space = spaces[0]
            number, opened = opened, opened + 1
            filled.append(0)
        bins.append(number)
        places.append(filled[number])
        filled[number] += size
        if space > size:
            insort(room, (space - size, number))
    return bins, places, [down(f) for f in filled]


def cheapest(sizes: Sequence[int], permitted: Sequence[int] = LENGTHS, overhead: int = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """The packing of least cost over all mixes."""
    found = (best_fit(sizes, permitted, overhead, mix) for mix in mixes(permitted))
    return min(found, key=lambda packed: cost(packed[2], overhead))


def pack_task(permitted: Sequence[int], overhead: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, "group"):
            ids = group.column("doc_id")
            size, row, piece, start, number = (group.column(c).to_numpy() for c in ("size", "row", "piece", "start", "group"))
            keys = ids.fill_null(0).to_numpy()
            order = np.lexsort((row, keys, ids.is_valid().to_numpy(zero_copy_only=False), -size))
            bins, places, capacity = cheapest(size[order].tolist(), permitted, overhead)
            bins = np.array(bins, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(order)), pa.array(piece[order]), pa.array(start[order]), pa.array(size[order]),
                    pa.array((number[order] << 32) + bins), pa.array(np.array(places, np.int64)),
                    pa.array(np.array(capacity, np.int64)[bins]),
                ],
                names=["doc_id", "piece", "start", "length", "bin", "place", "capacity"],
            )

    return pack


PACKED = "doc_id long, piece long, start long, length long, bin long, place long, capacity long"


def pack(items: DataFrame, permitted: Sequence[int] = LENGTHS, overhead: int = OVERHEAD, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """A row for each piece: its ``start`` in the document and ``length``, its ``bin``, ``place`` there and the bin's ``capacity``.

    ``items`` has ``doc_id``, ``length`` and ``row`` and should be a written table.
    """
    permitted = sorted(permitted)
    most = permitted[-1]
    full = F.floor(F.col("length") / most)
    total = items.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    groups = -(-total // group_tokens) or 1
    whole = items.where(F.col("length") >= most).select("doc_id", "row", F.explode(F.sequence(F.lit(0), full - 1)).alias("piece"))
    # Numbers below zero are apart from those of the groups, and each piece has its own.
    whole = whole.select(
        "doc_id", "piece", (F.col("piece") * most).alias("start"), F.lit(most).cast("long").alias("length"),
        (-1 - F.monotonically_increasing_id()).alias("bin"), F.lit(0).cast("long").alias("place"),
        F.lit(most).cast("long").alias("capacity"),
    )
    rest = items.where(F.col("length") % most > 0).select(
        "doc_id", "row", full.alias("piece"), (full * most).alias("start"), (F.col("length") % most).alias("size"),
        F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group"),
    )
    packed = rest.repartition("group").sortWithinPartitions("group").mapInArrow(pack_task(permitted, overhead), PACKED)
    return packed.unionByName(whole)
