"""Source divergence audit: how far the sources of a language differ in their use of terms.

Terms are runs of letters, that is of A-Z, which is lowered, a-z and all characters beyond
ASCII. A language keeps the terms in at least ``least_docs`` of its documents. In a group (a
language and a source, or a whole language) a kept term of count ``c`` has the chance
``p = 1 + floor(UNIT * (c + 1) / (N + V))``; ``N`` is the group's sum of counts and ``V`` the number
of terms. The divergence of ``p`` from ``q`` is ``floor((p - q) ** 2 / q)``.

Trees. The kept terms of a language, in order, are cut into chunks. Each group has a segment
tree over the terms of a chunk, with its counts as leaves. Nodes are consed: a node has a
number, and subtrees with equal counts, within a group or of several, are one node (``Trees``).
Two groups are compared by walking down both trees at once. Equal pairs of nodes
that are met in one walk are one, with the number of times they were met, so each is expanded
and priced once (``Trees.walk``).

Sums over chunks are map-side sums. A group's best terms come from its walk against the
language's tree: a chunk hands on its best ``top`` and Spark ranks those.

Scale. Blocks of text count terms before anything is shuffled, so a source with a third of
the rows is a row for each block and term. A chunk has ``CHUNK`` terms, fewer where a language has many
sources, so a task holds ``CELL`` counts at a time. Pairs of sources are the result itself,
and are walked in slices of bounded size.

Defined cases: null text, lang and source are ''. A group without terms, or a
language that keeps none, still has its pairs, whose value is then 0 or follows from counts of 0.
Repeated rows are documents of their own. All numbers are exact: counts of 2**33 and more
are computed as Python integers. Columns other than the named ones are ignored, texts of any length
are whole, and an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.blocks import coded, runs, text_blocks, text_bytes
from curbline.llm.frames import narrowed, stored
from curbline.llm.graph import grouped

#: The unit of chances.
UNIT = 1_000_000_000
#: Terms of a chunk, and counts (terms times groups) that a task holds.
CHUNK, CELL = 1 << 13, 1 << 20
#: Pairs of leaves that a walk looks at together, at most.
WALK = 1 << 21
#: Counts below this are computed in 64 bits.
SMALL = 1 << 33

COUNTS = "lang string, source string, term string, n long, docs long"
FOUND = "lang string, source string, item string, value long, term boolean"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SOLID = np.zeros(256, bool)
_SOLID[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts, and for each text the number of those before it."""
    data, offsets = text_bytes(texts)
    return runs(_LOWER[data], offsets, _SOLID[data])


def count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block, group and term the occurrences and the documents."""
    for batch in text_blocks(batches, "text"):
        found, edges = terms(batch.column("text"))
        at, words = coded(found)
        langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        wide = max(len(words), 1)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(edges))
        own, often = np.unique(owner * wide + at, return_counts=True)
        key, place = np.unique(group[own // wide] * wide + own % wide, return_inverse=True)
        n = np.zeros(len(key), np.int64)
        np.add.at(n, place, often)
        chosen = key // wide
        yield pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(pa.array(chosen // len(sources.dictionary))), sources.dictionary.take(pa.array(chosen % len(sources.dictionary))),
                pc.cast(words.take(pa.array(key % wide)), pa.string()), pa.array(n), pa.array(np.bincount(place, minlength=len(key))),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def number_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms in order of language and term: the chunk and place of each. A chunk lies in one language and one task."""
    first = TaskContext.get().partitionId() << 32
    chunk, place, last = -1, 0, None
    for batch in batches:
        langs, sizes = batch.column("lang").to_pylist(), batch.column("chunk_terms").to_numpy()
        chunks, places = np.empty(len(langs), np.int64), np.empty(len(langs), np.int32)
        for row, (lang, size) in enumerate(zip(langs, sizes.tolist())):
            if lang != last or place == size:
                chunk, place, last = chunk + 1, 0, lang
            chunks[row], places[row] = first + chunk, place
            place += 1
        columns = [batch.column(c) for c in ("lang", "term", "total")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(chunks), pa.array(places)], names=["lang", "term", "total", "chunk", "pos"])


def chances(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The chances of counts in groups of ``N + V``."""
    if not len(counts) or counts.max() < SMALL:
        return 1 + UNIT * (counts + 1) // totals
    return np.array([1 + UNIT * (c + 1) // t for c, t in zip(counts.tolist(), totals.tolist())], np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Trees:
    """Segment trees over the rows of ``counts``, one for each group; equal subtrees are one node.

    ``roots`` has the node of each group. For each level, from the leaves up, ``kids``
    has the two nodes below each distinct node. ``leaves`` has the count of each leaf;
    -1 fills up the last places.
    """

    def __init__(self, counts: np.ndarray):
        groups, size = counts.shape
        wide = 1 << max(size - 1, 0).bit_length()
        filled = np.full((groups, wide), -1, np.int64)
        filled[:, :size] = counts
        self.leaves, nodes = np.unique(filled, return_inverse=True)
        nodes = nodes.reshape(groups, wide)
        self.codes = nodes
        self.kids: list[tuple[np.ndarray, np.ndarray]] = []
        below = len(self.leaves)
        while nodes.shape[1] > 1:
            both, up = np.unique(nodes[:, 0::2].astype(np.int64) * below + nodes[:, 1::2], return_inverse=True)
            self.kids.append((both // below, both % below))
            nodes, below = up.reshape(groups, -1), len(both)
        self.roots = nodes[:, 0].astype(np.int64)

    def walk(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Down the trees of groups ``a[i]`` and ``b[i]`` at once, for all ``i``: the different pairs of leaves
        that lie at one place, as the number of the walk, both leaves, and how often they do."""
        walk, left, right, often = np.arange(len(a)), self.roots[a], self.roots[b], np.ones(len(a), np.int64)
        for low, high in reversed(self.kids):
            wide = int(max(low.max(), high.max())) + 1
            key = np.concatenate([(walk * wide + kid[left]) * wide + kid[right] for kid in (low, high)])
            found, place = np.unique(key, return_inverse=True)
            again = np.zeros(len(found), np.int64)
            np.add.at(again, place, np.concatenate((often, often)))
            walk, left, right, often = found // wide // wide, found // wide % wide, found % wide, again
        real = self.leaves[left] >= 0
        return walk[real], left[real], right[real], often[real]


def cell_task(top: int):
    """Compares all groups of a chunk with each other and with their language."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in grouped(batches, "chunk"):
            for found in compared(cell, top):
                yield pa.RecordBatch.from_pydict(found, schema=FOUND_ARROW)

    return compare


FOUND_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64()), ("term", pa.bool_())])


def compared(cell: pa.RecordBatch, top: int) -> Iterator[dict]:
    """Rows of ``pair`` sums and of best terms. The language's own rows are those without a source."""
    lang = cell.column("lang")[0].as_py()
    named = cell.column("source").dictionary_encode(null_encoding="encode")
    names, group = named.dictionary.to_pylist(), named.indices.to_numpy()
    whole = names.index(None)
    # The rows without a place tell of a group and its total.
    told, counted = (cell.column("total").is_valid().to_numpy(zero_copy_only=False), cell.column("pos").is_valid().to_numpy(zero_copy_only=False))
    totals = np.zeros(len(names), np.int64)
    totals[group[told]] = cell.column("total").drop_null().to_numpy()
    place = cell.column("pos").drop_null().to_numpy()
    own = group[counted]
    counts = np.zeros((len(names), int(place.max()) + 1), np.int64)
    counts[own, place] = cell.column("n").drop_null().to_numpy()
    texts = np.empty(counts.shape[1], object)
    mine = np.flatnonzero((group == whole) & counted)
    texts[cell.column("pos").take(pa.array(mine)).to_numpy()] = cell.column("term").take(pa.array(mine)).to_pylist()
    trees, sources = Trees(counts), [g for g in range(len(names)) if g != whole]
    step = max(1, WALK // trees.codes.shape[1])
    for first in range(0, len(sources), step):
        yield from best_terms(trees, counts, totals, names, texts, lang, whole, np.array(sources[first : first + step]), top)
    yield from pair_sums(trees, totals, names, lang, np.array(sources), step)


def pair_sums(trees: Trees, totals, names, lang, sources: np.ndarray, step: int) -> Iterator[dict]:
    for row, group in enumerate(sources):
        others = sources[row + 1 :]
        for begin in range(0, len(others), step):
            b = others[begin : begin + step]
            a = np.full(len(b), group)
            walk, left, right, often = trees.walk(a, b)
            p = chances(trees.leaves[left], totals[a[walk]])
            q = chances(trees.leaves[right], totals[b[walk]])
            edges = np.searchsorted(walk, np.arange(len(b)))
            there, back = np.add.reduceat(often * price(p, q), edges), np.add.reduceat(often * price(q, p), edges)
            mine, theirs = [names[group]] * len(b), [names[g] for g in b]
            yield {
                "lang": [lang] * 2 * len(b), "source": mine + theirs, "item": theirs + mine,
                "value": np.concatenate((there, back)), "term": [False] * 2 * len(b),
            }


def best_terms(trees: Trees, counts, totals, names, texts, lang, whole: int, sources: np.ndarray, top: int) -> Iterator[dict]:
    """Each group's terms that it uses more than its language: the first ``top`` by value, then by term."""
    walk, left, right, _ = trees.walk(sources, np.full(len(sources), whole))
    p = chances(trees.leaves[left], totals[sources[walk]])
    q = chances(trees.leaves[right], np.full(len(right), totals[whole]))
    value = np.where((trees.leaves[left] > 0) & (p > q), price(p, q), -1)
    wide = len(trees.leaves)
    known = (walk * wide + left) * wide + right
    for number, group in enumerate(sources.tolist()):
        used = np.flatnonzero(counts[group] > 0)
        key = (number * wide + trees.codes[group, used]) * wide + trees.codes[whole, used]
        worth = value[np.searchsorted(known, key)]
        used, worth = used[worth >= 0], worth[worth >= 0]
        best = np.argsort(-worth, kind="stable")[:top]
        yield {
            "lang": [lang] * len(best), "source": [names[group]] * len(best), "item": texts[used[best]].tolist(),
            "value": worth[best], "term": [True] * len(best),
        }


def audit(
    docs: DataFrame, least_docs: int = 3, top: int = 200, text: str = "text", lang: str = "lang", source: str = "source", chunk: int = CHUNK
) -> DataFrame:
    """``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item``, ``value`` and ``rank``.

    ``pair`` has the other sources of the language, by the sum of the divergences over all kept
    terms; ``term`` the ``top`` terms that the group uses more than its language.
    """
    rows = narrowed(docs, lang=lang, source=source, text=text).select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = stored(
        rows.mapInArrow(count_task, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts"
    )
    sources = stored(rows.select("lang", "source").distinct(), "sources")
    # Fewer terms a chunk where there are many sources; one place at least.
    sizes = sources.groupBy("lang").agg(F.count("*").alias("groups")).select(
        "lang", F.least(F.lit(chunk), F.greatest(F.lit(1), F.floor(F.lit(CELL) / (F.col("groups") + 1)))).cast("int").alias("chunk_terms")
    )
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs)
    ordered = stored(kept.select("lang", "term", "total").join(sizes, "lang"), "kept-terms")
    numbered = stored(
        ordered.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
        .mapInArrow(number_task, "lang string, term string, total long, chunk long, pos int"),
        "numbered-terms",
    )
    placed = stored(counts.join(numbered.select("lang", "term", "chunk", "pos"), ["lang", "term"]).select("lang", "source", "chunk", "pos", "n"), "placed")
    whole = numbered.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n"))
    own = sources.join(placed.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
    totals = own.join(whole.select("lang", "v"), "lang").select("lang", "source", (F.coalesce("n", F.lit(0)) + F.col("v")).alias("total"))
    totals = totals.unionByName(whole.select("lang", F.lit(None).cast("string").alias("source"), (F.col("n") + F.col("v")).alias("total")))
    heads = numbered.select("lang", "chunk").distinct().join(totals, "lang")
    terms_of = numbered.select("lang", "chunk", "pos", F.col("total").alias("n"), "term")
    cells = heads.unionByName(placed, allowMissingColumns=True).unionByName(terms_of, allowMissingColumns=True)
    cells = cells.select("chunk", "lang", "source", "total", "pos", "n", "term").repartition("chunk").sortWithinPartitions("chunk")
    found = stored(cells.mapInArrow(cell_task(top), FOUND), "divergence")

    pairs = sources.join(sources.withColumnRenamed("source", "item"), "lang").where(F.col("source") != F.col("item"))
    values = found.where(~F.col("term")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.join(values, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank"]
    pairs = pairs.withColumn("rank", place).withColumn("part", F.lit("pair")).select(*columns)
    best = found.where("term").withColumn("rank", place).where(F.col("rank") <= top).withColumn("part", F.lit("term")).select(*columns)
    return pairs.unionByName(best)
