"""Connected components, and links within groups of any size, as joins of written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.frames import stored

#: What a task holds of a group at a time; larger groups are cut into cells.
CELL_ROWS = 2048
CELL_WEIGHT = 400_000


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for all ends of ``a``, ``b``.

    Each round points every node at its smallest smaller neighbour, links its other
    smaller neighbours with that one, and goes one step further up. A round's tables are
    written, so both sides of its joins are plain scans and a hub's rows can be split.
    Only a count comes to the driver. Loops, repeated edges and nulls do no harm.
    """
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    links = stored(edges.where("a is not null and b is not null and a <> b").select(hi, lo).distinct(), "edges")
    while True:
        up = stored(links.groupBy("hi").agg(F.min("lo").alias("p"), F.count("*").alias("n")), "parents")
        several = up.where("n > 1").select("hi", "p")
        side = links.join(several, "hi").where("lo <> p").select(F.col("lo").alias("hi"), F.col("p").alias("lo"))
        above = up.select(F.col("hi").alias("p"), F.col("p").alias("top"))
        raised = up.select("hi", "p").join(above, "p", "left").select(
            "hi", F.coalesce("top", "p").alias("lo"), F.col("top").isNotNull().alias("moved")
        )
        both = raised.unionByName(side.withColumn("moved", F.lit(True)))
        links = stored(both.groupBy("hi", "lo").agg(F.max("moved").alias("moved")), "edges")
        if links.where("moved").isEmpty():
            nodes = links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            roots = links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
            return nodes.unionByName(roots)
        links = links.select("hi", "lo")


def walk(size: int, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[list[int]]:
    """The components of the rows 0 to ``size``.

    ``near(row, others)`` tells which of ``others`` it is linked with. A row that has
    been reached is compared with those only that haven't, so no pair of rows in
    different components is left out, and a large component costs little.
    """
    left = np.arange(size)
    while len(left):
        front, left = [int(left[0])], left[1:]
        reached = front.copy()
        while front and len(left):
            hit = near(front.pop(), left)
            found = left[hit].tolist()
            left = left[~hit]
            front += found
            reached += found
        yield reached


def to_smallest(nodes: np.ndarray, found: Iterator[list[int]]) -> np.ndarray:
    """For each row the smallest node of its component."""
    least = nodes.copy()
    for rows in found:
        least[rows] = nodes[rows].min()
    return least


#: Given the rows of one cell: the function for ``walk``.
Nearness = Callable[[pa.RecordBatch], Callable[[int, np.ndarray], np.ndarray]]


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Rows in order of ``key``: all rows of one key together."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_pylist()
        begin = 0
        for row, own in enumerate(keys):
            if own != last:
                if row > begin:
                    waiting.append(batch.slice(begin, row - begin))
                if waiting:
                    yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                waiting, begin, last = [], row, own
        waiting.append(batch.slice(begin))
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def cell_task(nearness: Nearness):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in grouped(batches, "cell"):
            if cell.num_rows < 2:
                continue
            nodes = cell.column("node").to_numpy(zero_copy_only=False)
            least = to_smallest(nodes, walk(cell.num_rows, nearness(cell)))
            there = np.flatnonzero(least != nodes)
            if len(there):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[there]), pa.array(least[there])], names=["a", "b"])

    return link


def links_in_groups(
    members: DataFrame,
    nearness: Nearness,
    payload: Callable[[DataFrame], DataFrame] = lambda frame: frame,
    rows: int = CELL_ROWS,
    weight: int = CELL_WEIGHT,
) -> DataFrame:
    """Edges ``a``, ``b`` that connect what ``nearness`` links within groups.

    ``members`` has ``key`` (long), ``node`` (long) and ``weight``, and ``payload`` adds
    the columns that ``nearness`` reads. It should be a written table. An edge leads from a
    node to the smallest one that its cell connects it with; links themselves aren't listed.

    A group of over ``rows`` rows or ``weight`` in all is dealt into cells, and its
    smallest node, the pivot, goes into each cell: what is linked with the pivot in any
    cell is in one component. Members that are outside of the pivot's component
    afterwards are compared with all cells of their group, in blocks of the same size.
    So every pair of a group has been compared or is connected; no task holds more than
    two blocks.
    """
    total = members.groupBy("key").agg(
        F.count("*").alias("size"), F.sum("weight").alias("all"), F.min("node").alias("pivot")
    )
    cells = F.greatest(F.ceil(F.col("size") / rows), F.ceil(F.col("all") / weight)).cast("int")
    groups = stored(total.where("size > 1").select("key", "pivot", cells.alias("cells")), "groups")
    placed = members.select("key", "node").join(groups, "key")
    dealt = F.pmod(F.xxhash64("node"), "cells").cast("int")
    first = placed.select(
        "node",
        F.explode(
            F.when((F.col("node") == F.col("pivot")) & (F.col("cells") > 1), F.sequence(F.lit(0), F.col("cells") - 1))
            .otherwise(F.array(dealt))
        ).alias("part"),
        "key",
    ).select("node", F.xxhash64("key", "part").alias("cell"))
    found = _linked(first, payload, nearness)
    large = groups.where("cells > 1")
    if large.isEmpty():
        return found
    found = stored(found, "links")
    own = components(found)
    inside = stored(
        members.join(large, "key")
        .join(own.select(F.col("node").alias("node"), "component"), "node", "left")
        .join(own.select(F.col("node").alias("pivot"), F.col("component").alias("main")), "pivot", "left")
        .withColumn("apart", ~F.coalesce(F.col("component"), F.col("node")).eqNullSafe(F.coalesce(F.col("main"), F.col("pivot"))))
        .select("key", "node", "weight", "cells", "apart"),
        "apart",
    )
    rest = inside.where("apart").groupBy("key").agg(F.count("*").alias("size"), F.sum("weight").alias("all"))
    blocks = stored(rest.select("key", cells.alias("blocks")), "blocks")
    if blocks.isEmpty():
        return found
    both = inside.join(blocks, "key")
    every = both.select("node", "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), dealt.alias("part"))
    aside = both.where("apart").select(
        "node", "key", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("part"),
    )
    second = every.unionByName(aside).select("node", F.xxhash64("key", F.lit(1), "block", "part").alias("cell")).distinct()
    return found.unionByName(_linked(second, payload, nearness))


def _linked(cells: DataFrame, payload, nearness: Nearness) -> DataFrame:
    return payload(cells).repartition("cell").sortWithinPartitions("cell").mapInArrow(cell_task(nearness), "a long, b long")
