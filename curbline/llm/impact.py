"""Exact top-k by integer inner product over an impact-ordered index, score at a time.

A component's impact is ``floor(scale * x)``. Candidates are cut into blocks by hash. A
block's index holds its postings in segments of descending size of impact: a segment has, for every
dimension, the rows whose impact lies between two limits. For a group of queries the segments are processed
one after another, and all queries of a slice at once, as a product of the segment with their components.
After a segment a row's score is known but for the dimensions in which it hasn't been met,
and each of those adds or takes at most the limit times the query's component. So scores have a lower and an upper
bound. The k-th best lower bound, of the block or of the leaders, is reached by k rows; a row whose upper bound
is below is out. When few rows are left by that proof, they are scored exactly, and the smaller impacts
are never looked at; where it excludes too few, the next segment is processed, and after the
last one all scores are exact. Nothing is left out without that proof.

Leaders are a bounded number of rows (``LEADER_BYTES``). Each query's k-th best exact score among
them goes with it to all blocks, which return no row below it. Queries are a stated set; they meet all
blocks, in groups. The best k of each cell (one group and one block) are merged by a window.

Numbers. Impacts are exact integers of any size. Rows with impacts beyond ``LARGE`` are in cells
of their own, so that all others can be computed in floating point without rounding: there every
sum is below 2**53. Cells with large impacts are computed in 64-bit integers, or in Python's where those
don't suffice. A score that doesn't fit in a long is shown as the nearest long; it is ranked by its own value.

Vectors that are null, empty, or hold a null or non-finite component take no part, and
neither do rows without ``vec_id``. Only vectors of a query's length are its candidates.
Rows that repeat a ``vec_id`` are rows of their own: each can be a result, and as queries each has its own results. A
query's own row is no candidate. Equal scores are in order of ``vec_id``. An empty table
gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.forest import rows_of
from curbline.llm.frames import narrowed, stored
from curbline.llm.graph import grouped

#: Candidates and queries of a cell, and queries that are processed at a time.
BLOCK_ROWS, QUERY_ROWS, SLICE = 16_384, 2_048, 128
#: Impacts beyond this are large.
LARGE = 1 << 20
#: Shares of a block's postings that the segments end at; the last one has the rest.
SEGMENTS = (0.5, 0.8)
#: Where no more than this share of the rows is left, they are scored exactly.
FEW = 0.04
#: Bytes of the leaders of each length of vector.
LEADER_BYTES, LEADERS = 4 << 20, 1_024


def packed(impacts: np.ndarray) -> bytes:
    """Whole numbers in the narrowest form that holds them; the first byte names it."""
    most = float(np.abs(impacts).max())
    kind = next((k for k in ("i1", "i2", "i4") if most <= np.iinfo(k).max), "f8")
    return kind[:2].encode() + impacts.astype("<" + kind).tobytes()


def unpacked(body: bytes) -> np.ndarray:
    return np.frombuffer(body, "<" + body[:2].decode(), offset=2).astype(np.float64)


def impact_task(scale: float):
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, starts, sizes = rows_of(batch.column("vector"))
            with np.errstate(invalid="ignore", over="ignore"):
                # A product beyond the largest double becomes that double.
                impacts = np.nan_to_num(np.floor(scale * values)) + 0.0
            own = [impacts[b : b + n] if n > 0 else None for b, n in zip(starts.tolist(), sizes.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("asked"), pa.array(sizes),
                    pa.array([None if v is None else bool(np.abs(v).max() > LARGE) for v in own], pa.bool_()),
                    pa.array([None if v is None else packed(v) for v in own], pa.binary()),
                ],
                names=["vec_id", "asked", "length", "large", "body"],
            )

    return convert


def whole(matrix: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers."""
    return np.array([[int(x) for x in row] for row in matrix.tolist()], object).reshape(matrix.shape)


def exact_scores(matrix: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """All inner products, exact: as doubles where nothing is rounded, else as integers."""
    bound = float(np.abs(matrix).max(initial=0)) * float(np.abs(queries).max(initial=0)) * matrix.shape[1]
    if bound < 2.0**53:
        return matrix @ queries.T
    if bound < 2.0**62:
        return matrix.astype(np.int64) @ queries.T.astype(np.int64)
    return whole(matrix) @ whole(queries).T


class Index:
    """The segments of one block: its postings by size of impact, the largest first."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, size = matrix, np.abs(matrix)
        self.limits = sorted({float(x) for x in np.quantile(size, [1 - s for s in SEGMENTS])}, reverse=True) if matrix.size else []
        self.segments, above = [], np.inf
        for limit in [*self.limits, 0.0]:
            # What is larger than the limit; the last segment has zeros too, which add nothing.
            there = (size > limit) & (size <= above)
            self.segments.append((np.where(there, matrix, 0.0), (size <= limit).astype(np.float64), limit))
            above = limit

    def top(self, queries: np.ndarray, k: int, own: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and score of all that may be among a query's best ``k``, without its ``own`` row (-1: none)
        and without what is below its ``bound``."""
        scores = np.zeros((len(self.matrix), len(queries)))
        mine = np.flatnonzero(own >= 0)
        for segment, unmet, limit in self.segments:
            scores += segment @ queries.T
            rest = limit * (unmet @ np.abs(queries).T) if limit else 0.0
            low = scores - rest
            low[own[mine], mine] = -np.inf
            known = bound
            if len(low) > k:
                known = np.maximum(bound, np.partition(low, len(low) - k, axis=0)[len(low) - k])
            possible = scores + rest >= known
            possible[own[mine], mine] = False
            if limit and possible.sum() <= FEW * possible.size:
                break
        query, row = np.nonzero(possible.T)
        if not limit:
            return query, row, scores[row, query]
        found = np.empty(len(row))
        for begin in range(0, len(row), 1 << 16):
            part = slice(begin, begin + (1 << 16))
            found[part] = np.einsum("ij,ij->i", self.matrix[row[part]], queries[query[part]])
        return query, row, found


def plain_top(matrix: np.ndarray, queries: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``Index.top``, for impacts too large for doubles: all rows, scored as integers."""
    scores = exact_scores(matrix, queries)
    possible = np.ones(scores.shape, bool)
    mine = np.flatnonzero(own >= 0)
    possible[own[mine], mine] = False
    query, row = np.nonzero(possible.T)
    return query, row, scores[row, query]


def best_of(query: np.ndarray, row: np.ndarray, score: np.ndarray, ids: np.ndarray, copies: np.ndarray, k: int) -> np.ndarray:
    """The places of the best ``k`` of each query; equal scores by id and copy."""
    down = -score if score.dtype != object else np.array([-s for s in score], object)
    if score.dtype == object:
        _, down = np.unique(down, return_inverse=True)
    order = np.lexsort((copies[row], ids[row], down, query))
    first = np.searchsorted(query[order], query[order])
    return order[np.arange(len(order)) - first < k]


def cell_top(cell: pa.RecordBatch, k: int) -> Iterator[pa.RecordBatch]:
    asked = cell.column("query").to_numpy(zero_copy_only=False).astype(bool)
    if asked.all() or not asked.any():
        return
    ids, copies = (cell.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "copy"))
    bodies, large = cell.column("body").to_pylist(), bool(cell.column("large")[0].as_py())
    rows, queries = np.flatnonzero(~asked), np.flatnonzero(asked)
    matrix, wanted = (np.stack([unpacked(bodies[i]) for i in at]) for at in (rows, queries))
    bound = np.nan_to_num(cell.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)[queries], nan=-np.inf)
    place = {key: row for row, key in enumerate(zip(ids[rows].tolist(), copies[rows].tolist()))}
    own = np.array([place.get(key, -1) for key in zip(ids[queries].tolist(), copies[queries].tolist())], np.int64)
    index = None if large else Index(matrix)
    for begin in range(0, len(queries), SLICE):
        part = slice(begin, begin + SLICE)
        if index is not None:
            query, row, score = index.top(wanted[part], k, own[part], bound[part])
        else:
            query, row, score = plain_top(matrix, wanted[part], own[part])
        best = best_of(query, row, score, ids[rows], copies[rows], k)
        query, row, score = queries[part][query[best]], rows[row[best]], score[best]
        whole_scores = [int(s) for s in score.tolist()]
        columns = [pa.array(x) for x in (ids[query], copies[query], ids[row], copies[row])]
        columns += [pa.array([max(-(2**63), min(2**63 - 1, s)) for s in whole_scores], pa.int64())]
        columns += [pa.array(list(map(as_double, whole_scores)), pa.float64()), pa.array(list(map(digits, whole_scores)), pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["query_id", "query_copy", "vec_id", "copy", "score", "value", "exact"])


def as_double(score: int) -> float:
    """The nearest double, which is in the order of the scores."""
    try:
        return float(score)
    except OverflowError:
        return np.inf if score > 0 else -np.inf


def digits(score: int) -> str | None:
    """What orders scores of the same double: digits of equal number. Doubles below 2**53 are exact."""
    return f"{score + 10**640:0642d}" if abs(score) >= 2**53 else None


def search_task(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in grouped(batches, "cell"):
            yield from cell_top(cell, k)

    return search


def bound_task(leaders: dict[int, tuple[np.ndarray, list[tuple[int, int]]]], k: int):
    """Each query with its k-th best score among the leaders, itself left out; null where there are too few."""

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[float | None] = [None] * batch.num_rows
            keys = list(zip(batch.column("vec_id").to_pylist(), batch.column("copy").to_pylist()))
            vectors = [unpacked(b) for b in batch.column("body").to_pylist()]
            large = batch.column("large").to_pylist()
            for row, (key, own) in enumerate(zip(keys, vectors)):
                matrix, known = leaders.get(len(own), (None, []))
                if matrix is None or large[row]:
                    continue
                scores = matrix @ own
                scores = scores[[i for i, other in enumerate(known) if other != key]] if key in known else scores
                if len(scores) >= k:
                    found[row] = float(np.partition(scores, len(scores) - k)[len(scores) - k])
            columns = [batch.column(c) for c in ("vec_id", "copy", "length", "large", "body")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], names=["vec_id", "copy", "length", "large", "body", "bound"])

    return bounds


def leaders_of(known: DataFrame) -> dict[int, tuple[np.ndarray, list[tuple[int, int]]]]:
    """Rows of each length, those of the smallest hash values; their number is bounded, by bytes too."""
    place = F.row_number().over(Window.partitionBy("length").orderBy(F.xxhash64("vec_id", "copy"), "vec_id", "copy"))
    most = F.least(F.lit(LEADERS), F.floor(F.lit(LEADER_BYTES) / (8 * F.col("length"))))
    taken = known.where("not large").withColumn("place", place).where(F.col("place") <= most).where(F.col("place") <= LEADERS)
    found: dict[int, list] = {}
    for row in taken.orderBy("length").limit(4 * LEADERS).collect():
        found.setdefault(row.length, []).append((unpacked(bytes(row.body)), (row.vec_id, row["copy"])))
    return {length: (np.stack([v for v, _ in rows]), [key for _, key in rows]) for length, rows in found.items()}


def top_k(
    vectors: DataFrame, asked: Column, k: int = 20, scale: float = 64.0, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the best ``k`` rows for each row where ``asked`` holds.

    ``asked`` is a condition on the columns of ``vectors``; null counts as false.
    """
    rows = narrowed(vectors.withColumn("__asked", asked), vec_id=vec_id, vector=embedding, asked="__asked")
    rows = rows.withColumn("vec_id", F.col("vec_id").cast("long")).withColumn("asked", F.coalesce("asked", F.lit(False)))
    ints = rows.mapInArrow(impact_task(scale), "vec_id long, asked boolean, length long, large boolean, body binary")
    copy = F.row_number().over(Window.partitionBy("vec_id").orderBy("body")).cast("long")
    known = stored(ints.where("vec_id is not null and body is not null").withColumn("copy", copy), "impacts")
    total, queries = known.agg(F.count("*"), F.count_if("asked")).first()
    blocks, groups = -(-total // BLOCK_ROWS) or 1, -(-queries // QUERY_ROWS) or 1
    hashed = F.xxhash64("vec_id", "copy")
    block, group = F.pmod(hashed, F.lit(blocks)), F.pmod(F.xxhash64(hashed, F.lit(1)), F.lit(groups))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    bounded = known.where("asked").select("vec_id", "copy", "length", "large", "body").mapInArrow(
        bound_task(leaders_of(known), k), "vec_id long, copy long, length long, large boolean, body binary, bound double"
    )
    # Large rows and large queries are apart: with any of them, each row and query goes to cells of both kinds.
    kinds = [F.lit(False)] if known.where("large").isEmpty() else [F.lit(False), F.lit(True)]

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        return frame.withColumnRenamed("large", own).withColumn(other, F.explode(F.array(*kinds)))

    candidates = dealt(known, "large_row", "large_query").withColumn("block", block).withColumn("group", every(groups))
    candidates = candidates.withColumn("query", F.lit(False)).withColumn("bound", F.lit(None).cast("double"))
    wanted = dealt(bounded, "large_query", "large_row").withColumn("group", group).withColumn("block", every(blocks)).withColumn("query", F.lit(True))
    columns = [
        "vec_id", "copy", "body", "query", "bound", (F.col("large_row") | F.col("large_query")).alias("large"),
        F.xxhash64("length", "block", "group", "large_row", "large_query").alias("cell"),
    ]
    cells = candidates.select(*columns).unionByName(wanted.select(*columns))
    found = cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        search_task(k), "query_id long, query_copy long, vec_id long, copy long, score long, value double, exact string"
    )
    place = Window.partitionBy("query_id", "query_copy").orderBy(F.desc("value"), F.desc("exact"), "vec_id", "copy")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
