"""Near-duplicates by word shingles: SetSketch registers, banded; then full sets.

Registers. A shingle has one exponential value for each register, and a
register keeps the least one of a set, as its exponent to the base ``BASE``, cut to 16
bits. So registers of a union are the larger ones of its parts, and equal registers
are about as likely as two sets are similar.

Candidates. Texts with equal sets are one class from here on, through an aggregation
alone. Classes that agree in all registers of a band meet in a bucket. There, pairs
whose sizes allow the similarity are compared by registers: the likelihood of the
numbers of larger, smaller and equal registers, given both set sizes, is taken over all
similarities, and a pair goes on unless those of at least the threshold fall behind the
best one by ``DOUBT``. The number of bands follows from the threshold, so that a pair
at it meets no bucket at most ``MISSED`` of the times, once in two million: 25 bands of 5
registers for 0.85, 37 for 0.80. For lower thresholds bands have fewer registers.

Verification. What is connected by such pairs is a group, so a set travels once to
its group and not to each bucket. There, links are decided on full sets, by 64-bit hash
values of the shingles. Large buckets and groups are worked in cells; see
``graph.links_in_groups``. No step makes all pairs of a group.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z is lower-cased. A text of fewer than five
words has one shingle, its whole sequence; one without words, null or empty, has none
and is linked with nothing. Rows of one ``doc_id`` are one document: its links are those
of all its texts, and each row is returned. A row without ``doc_id`` is linked with nothing and not kept. An
empty table gives an empty table. A text of any length is one row with its whole set; the block it is in and
the cell that its set is compared in grow to its size. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.blocks import coded, hashed, spread, text_blocks, text_bytes
from curbline.llm.blocks import words as split_words
from curbline.llm.frames import narrowed, parted_by_ids, stored
from curbline.llm.graph import components, links_in_groups

SHINGLE_WORDS = 5
#: Share of the pairs at the threshold that may meet no bucket.
MISSED = 5e-7
#: Bands, at least: registers also tell similarity.
LEAST_BANDS = 25
#: Registers of a band, at most; fewer where a sketch would have more than ``MOST`` registers.
BAND_REGISTERS, MOST = 5, 256
BASE, RATE, LIMIT = 1.001, 20.0, 2**16 - 1
#: Natural logarithm of how many times less likely the threshold may be than the best similarity.
DOUBT = 18.0

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def banding(percent: int) -> tuple[int, int]:
    """Bands and registers of each, so that a pair of this similarity misses all with probability ``MISSED`` at most."""
    if not 1 <= percent <= 100:
        raise ValueError(f"not a similarity in hundredths: {percent}")
    for width in range(BAND_REGISTERS, 0, -1):
        same = (percent / 100) ** width
        bands = max(LEAST_BANDS, math.ceil(math.log(MISSED) / math.log1p(-same)) if same < 1 else 1)
        if bands * width <= MOST:
            break
    return bands, width


@cache
def scrambles(count: int) -> tuple[np.ndarray, np.ndarray]:
    pick = np.random.default_rng(20240501)
    flip, times = (pick.integers(0, 2**32, (count, 1), dtype=np.uint32) for _ in range(2))
    return flip, times | np.uint32(1)


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each text the ascending hash values of its distinct shingles."""
    data, offsets = text_bytes(texts)
    found, edges = split_words(_LOWER[data], offsets)
    at, distinct = coded(found)
    hashes = hashed(distinct.to_pylist())[at]
    rolled = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for k in range(words):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(rolled)]
    rolled = mixed(rolled)
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if end - begin >= words:
            yield np.unique(rolled[begin : end - words + 1])
        elif end > begin:
            short = np.uint64(end - begin)
            with np.errstate(over="ignore"):
                for value in hashes[begin:end]:
                    short = mixed(short + value)
            yield np.array([short], np.uint64)
        else:
            yield np.empty(0, np.uint64)


def registers(shingles: np.ndarray, count: int = 125, step: int = 4096) -> np.ndarray:
    """The registers of a set that isn't empty."""
    flip, times = scrambles(count)
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(count, 2**32 - 1, np.uint32)
    for begin in range(0, len(low), step):
        values = (low[begin : begin + step] ^ flip) * times
        values ^= values >> np.uint32(15)
        values *= np.uint32(0x2C1B3C6D)
        np.minimum(least, values.min(axis=1), out=least)
    spent = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(spent) / np.log(BASE)), 0, LIMIT).astype(np.uint16)


def sketch_task(count: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        for batch in text_blocks(batches, "text"):
            sizes, digests, sketches = [], [], []
            for shingles in shingle_sets(batch.column("text")):
                sizes.append(len(shingles))
                digests.append(blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                sketches.append(registers(shingles, count).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())],
                names=["doc_id", "n", "digest", "sketch"],
            )

    return sketch


def likely(threshold: float):
    """Which pairs may reach ``threshold``, by registers and set sizes."""
    grid = np.linspace(0.0, 1.0, 51)[:, None]
    enough = grid[:, 0] >= threshold - 1e-9

    def part(x):
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def may(own: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
        result = np.minimum(size, sizes) >= threshold * np.maximum(size, sizes) - 1e-6
        at = np.flatnonzero(result)
        if not len(at):
            return result
        more, less = (own > others[at]).sum(axis=1), (own < others[at]).sum(axis=1)
        u = size / (size + sizes[at])
        v = 1 - u
        with np.errstate(divide="ignore", invalid="ignore"):
            p, q = part(np.clip(u - v * grid, 0, 1)), part(np.clip(v - u * grid, 0, 1))
            logs = [np.where(n > 0, n * np.log(np.maximum(x, 1e-300)), 0) for n, x in ((more, p), (less, q), (len(own) - more - less, 1 - p - q))]
        total = sum(logs)
        total[(u - v * grid < -1e-12) | (v - u * grid < -1e-12)] = -np.inf
        best = total.max(axis=0)
        # Sizes at the limit leave less than a step of the grid: such a pair goes on.
        reached = total[enough].max(axis=0)
        result[at] = (reached >= best - DOUBT) | ~np.isfinite(reached)
        return result

    return may


def by_registers(threshold: float, count: int):
    may = likely(threshold)

    def nearness(cell: pa.RecordBatch):
        sketches = np.frombuffer(b"".join(cell.column("sketch").to_pylist()), np.uint16).reshape(-1, count)
        sizes = cell.column("n").to_numpy(zero_copy_only=False)
        return lambda row, others: may(sketches[row], sketches[others], sizes[row], sizes[others])

    return nearness


def by_sets(percent: int):
    """Links of ``100 * intersection >= percent * union``, through an index from shingle to rows."""

    def nearness(cell: pa.RecordBatch):
        sets = [np.frombuffer(s, np.uint64) for s in cell.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        owners = np.repeat(np.arange(len(sets)), sizes)
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(number, kind="stable")
        places = np.concatenate(([0], np.cumsum(np.bincount(number))))
        edges = np.concatenate(([0], np.cumsum(sizes)))
        held = owners[order]

        def near(row: int, others: np.ndarray) -> np.ndarray:
            own = number[edges[row] : edges[row + 1]]
            if len(others) * 20 < len(sets):  # few are left: look at them alone
                marked = np.zeros(len(places) - 1, bool)
                marked[own] = True
                common = np.array([np.count_nonzero(marked[number[edges[o] : edges[o + 1]]]) for o in others.tolist()])
            else:
                common = np.bincount(held[spread(places[own], places[own + 1] - places[own])], minlength=len(sets))[others]
            return 100 * common >= percent * (sizes[row] + sizes[others] - common)

        return near

    return nearness


def set_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from hashlib import blake2b

    for batch in text_blocks(batches, "text"):
        found = [s.tobytes() for s in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node"),
                pa.array([blake2b(s, digest_size=16).digest() for s in found], pa.binary()),
                pa.array(found, pa.binary()),
            ],
            names=["node", "digest", "shingles"],
        )


def near_duplicates(docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for each row."""
    texts = narrowed(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    n_bands, band_registers = banding(percent)
    count = n_bands * band_registers
    sketches = stored(texts.mapInArrow(sketch_task(count), "doc_id long, n long, digest binary, sketch binary"), "sketches")
    real = sketches.where("doc_id is not null and n > 0")
    # One class for each set, named by its smallest document.
    classes = stored(real.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")

    width = 2 * band_registers
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(n_bands - 1)),
        lambda band: F.xxhash64(band, F.substring(F.col("sketch"), band * width + 1, F.lit(width))),
    )
    banded = classes.select(F.col("rep").alias("node"), F.explode(bands).alias("key"))
    # Most keys are one class's own: they are counted and gone before anything else is asked of a bucket.
    shared = banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    met = stored(banded.join(shared, "key"), "met")
    buckets = met.groupBy("key").agg(
        F.count("*").alias("size"), F.min("node").alias("pivot"), F.bit_xor(F.xxhash64("node")).alias("sum")
    )
    # Buckets of the same members are worked once.
    apart = stored(buckets.groupBy("size", "pivot", "sum").agg(F.min("key").alias("key")).select("key"), "buckets")
    members = stored(met.join(apart, "key").withColumn("weight", F.lit(1)), "members")
    of_class = classes.select(F.col("rep").alias("node"), "digest", "n", "sketch")
    candidates = links_in_groups(members, by_registers(percent / 100, count), lambda cells: cells.join(of_class, "node"))
    groups = stored(components(candidates), "candidates")

    wanted = stored(groups.join(of_class.drop("sketch"), "node"), "wanted")
    renamed = texts.select(F.col("doc_id").alias("node"), "text")
    ids = wanted.select("node").distinct()
    # Texts of other nodes don't leave their tasks.
    few, _ = parted_by_ids(renamed, "node", ids)
    sets = few.join(ids, "node", "left_semi").mapInArrow(set_task, "node long, digest binary, shingles binary")
    sets = stored(sets.join(wanted.select("node", "digest"), ["node", "digest"], "left_semi").dropDuplicates(["node", "digest"]), "sets")
    found = links_in_groups(
        wanted.select(F.col("component").alias("key"), "node", F.col("n").alias("weight")),
        by_sets(percent),
        lambda cells: cells.join(sets, "node"),
    )
    kind = F.xxhash64("digest")
    several = real.groupBy("doc_id").agg(F.min(kind).alias("x"), F.max(kind).alias("y")).where("x <> y").select("doc_id")
    also = real.join(several, "doc_id").join(classes.select("digest", "rep"), "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    reached = stored(components(found.unionByName(also)), "components")

    # Only classes of several rows need to be looked up; all others are their own.
    copied = stored(classes.where("copies > 1").select("digest", "rep"), "copies")
    named = sketches.select("doc_id", "n", "digest").join(copied, "digest", "left").withColumn("node", F.coalesce("rep", F.when(F.col("n") > 0, F.col("doc_id"))))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return named.join(reached, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )
