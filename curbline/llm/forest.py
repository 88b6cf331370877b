"""Near-duplicate vectors by a forest of random-projection trees with overlapping leaves.

Each tree splits the unit vectors again and again by a random direction, near the
median; vectors within ``SPILL`` standard deviations of the split go to both sides, and
those within ``NARROW`` of the width of a link, whatever the deviation. Of ``TRIES``
directions the first good one or else the best is taken, and a node that no direction
makes cheaper to compare stays whole: so a group about as narrow as a link is never
parted, and its pairs are all compared, which is quadratic work in its distinct vectors.
The trees are fitted on ``SAMPLE`` vectors (those of the smallest hash values), every
vector is sent through all of them, and vectors that share a leaf in any tree are
compared by cosine in double precision. A pair at the threshold of 0.95 is kept apart
by all trees about once in some thousand times; links below the threshold aren't made.

Vectors of equal components are one class from the start, with the number of its
rows, so copies are never compared with one another. A leaf of more than ``CELL_ROWS``
vectors is compared in blocks of that many, all of them. A pair that meets in several
leaves is counted in the one of the smallest number; so link counts are sums, and pairs
are never written. For components each vector names the smallest one that its block connects it with.

Null vectors, those with a null or non-finite component, empty ones and those of zeros
link with nothing. Vectors of different lengths are never linked. A row without
``vec_id`` takes no part and isn't kept. Rows that repeat a ``vec_id`` are vectors of
their own with a common component. An empty table gives an empty table. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.frames import narrowed, stored
from curbline.llm.graph import components, grouped, to_smallest, walk

TREES = 4
SPILL = 0.2
#: Least margin, as a part of the standard deviation that a link at the threshold has along a direction.
NARROW = 0.65
#: Directions that are tried for a split; the share of a node's pairs that a good one leaves, and that any may leave.
TRIES, GOOD, WHOLE = 8, 0.8, 0.95
LEAF_ROWS = 512
CELL_ROWS = 1024
#: Vectors that the trees are fitted on, at most; and the fewest of them in a node that is split.
SAMPLE, SAMPLE_LEAF = 16_384, 8


def rows_of(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All components in one array, the place where each vector begins, and its length (-1: takes no part)."""
    vectors = pc.cast(vectors, pa.large_list(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten()
    values = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    unfit = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    fit = (sizes > 0) & (unfit[edges[1:]] == unfit[edges[:-1]])
    return values, edges[:-1], np.where(fit, sizes, -1)


def scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that squares neither overflow nor vanish; cosines stay as they are."""
    _, exponent = np.frexp(np.abs(matrix).max(axis=1, keepdims=True))
    return np.ldexp(matrix, -exponent)


def valid_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from hashlib import blake2b

    for batch in batches:
        values, starts, sizes = rows_of(batch.column("vector"))
        digests, bodies = [], []
        for begin, size in zip(starts.tolist(), sizes.tolist()):
            own = values[begin : begin + size] + 0.0 if size > 0 else None
            if own is None or not own.any():
                digests.append(None)
                bodies.append(None)
                continue
            digests.append(blake2b(own.tobytes(), digest_size=16).digest())
            short = own.astype(np.float32)
            bodies.append(b"4" + short.tobytes() if (short == own).all() else b"8" + own.tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(digests, pa.binary()), pa.array(bodies, pa.binary())],
            names=["vec_id", "digest", "body"],
        )


def vector(body: bytes) -> np.ndarray:
    return np.frombuffer(body, "<f4" if body[:1] == b"4" else "<f8", offset=1).astype(np.float64)


def unit(matrix: np.ndarray) -> np.ndarray:
    matrix = scaled(matrix)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


class Tree:
    """Splits as (direction, place, margin), or a leaf where there is none; nodes are named by their path."""

    def __init__(self, sample: np.ndarray, rows: float, seed: int, least: float):
        self.narrow = NARROW * max(2 - 2 * least, 0.0) ** 0.5
        self.splits: dict[int, tuple[np.ndarray, float, float]] = {}
        self.leaves: dict[int, int] = {}
        self.random = np.random.default_rng(seed)
        self._fit(sample, rows / max(len(sample), 1), 1)

    def _fit(self, sample: np.ndarray, share: float, node: int) -> None:
        if len(sample) * share > LEAF_ROWS and len(sample) >= 2 * SAMPLE_LEAF:
            left, split, low, high = min(self._tries(sample), key=lambda found: found[0])
            if left < WHOLE:
                self.splits[node] = split
                self._fit(sample[low], share, 2 * node)
                self._fit(sample[high], share, 2 * node + 1)
                return
        self.leaves[node] = len(self.leaves)

    def _tries(self, sample: np.ndarray) -> Iterator[tuple[float, tuple[np.ndarray, float, float], np.ndarray, np.ndarray]]:
        """Splits with the share of pairs that they leave to compare and their two sides, as far as the first good one."""
        for _ in range(TRIES):
            direction = self.random.standard_normal(sample.shape[1]).astype(np.float32)
            along = sample @ direction
            place = float(np.quantile(along, self.random.uniform(0.45, 0.55)))
            margin = max(SPILL * float(along.std()), self.narrow * float(np.linalg.norm(direction)) / sample.shape[1] ** 0.5)
            low, high = along < place + margin, along >= place - margin
            left = (float(low.sum()) ** 2 + float(high.sum()) ** 2) / len(sample) ** 2
            yield left, (direction, place, margin), low, high
            if left < GOOD:
                return

    def route(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the leaves that they go to."""
        rows, leaves, todo = [], [], [(1, np.arange(len(matrix)))]
        while todo:
            node, own = todo.pop()
            if node in self.leaves:
                rows.append(own)
                leaves.append(np.full(len(own), self.leaves[node]))
            elif len(own):
                direction, place, margin = self.splits[node]
                along = matrix[own] @ direction
                todo += [(2 * node, own[along < place + margin]), (2 * node + 1, own[along >= place - margin])]
        return np.concatenate(rows), np.concatenate(leaves)


def fit(classes: DataFrame, least: float, trees: int = TREES) -> dict[int, list[Tree]]:
    """The trees for each length of vector that the sample has; where one is a single leaf, it alone."""
    total = classes.count()
    taken = classes.orderBy(F.xxhash64("digest"), "digest").limit(SAMPLE).select("body").collect()
    by_length: dict[int, list[np.ndarray]] = {}
    for row in taken:
        own = vector(bytes(row.body))
        by_length.setdefault(len(own), []).append(own)
    found = {}
    for length, vectors in by_length.items():
        sample = unit(np.stack(vectors)).astype(np.float32)
        grown = [Tree(sample, total * len(vectors) / len(taken), 1000 * length + t, least) for t in range(trees)]
        found[length] = [t for t in grown if not t.splits][:1] or grown
    return found


def route_task(forest: dict[int, list[Tree]]):
    """Each class with the sorted numbers of its leaves over all trees, and its length."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [vector(b) for b in batch.column("body").to_pylist()]
            lengths = np.array([len(v) for v in vectors], np.int64)
            leaves: list[list[int]] = [[] for _ in vectors]
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                matrix, before = unit(np.stack([vectors[i] for i in at])).astype(np.float32), 0
                for tree in forest.get(length, ()):
                    for row, leaf in zip(*tree.route(matrix)):
                        leaves[at[row]].append(before + int(leaf))
                    before += len(tree.leaves)
                if not before:  # no tree knows this length: one leaf
                    for row in at:
                        leaves[row].append(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), pa.array(lengths), pa.array([sorted(x) for x in leaves], pa.list_(pa.int32()))],
                names=["class", "length", "leaves"],
            )

    return route


def compare_task(least: float):
    """A cell's rows: each class with what it is linked with there, counted where this cell's leaf is theirs."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in grouped(batches, "cell"):
            classes, nodes = (cell.column(c).to_numpy(zero_copy_only=False) for c in ("class", "node"))
            copies = cell.column("copies").to_numpy(zero_copy_only=False)
            part = cell.column("part").to_numpy(zero_copy_only=False)
            leaf = cell.column("leaf")[0].as_py()
            across = part.min() != part.max()
            matrix = scaled(np.stack([vector(b) for b in cell.column("body").to_pylist()]))
            norms = np.sqrt((matrix * matrix).sum(axis=1))
            linked = (matrix @ matrix.T) / (norms[:, None] * norms[None, :]) >= least
            if across:  # blocks of two parts: pairs within a part are another cell's
                linked &= part[:, None] != part[None, :]
            np.fill_diagonal(linked, False)
            a, b = np.nonzero(np.triu(linked))
            if not len(a):
                continue
            sums = np.zeros(len(nodes), np.int64)
            theirs = padded(cell.column("leaves"))
            for begin in range(0, len(a), 20_000):
                x, y = a[begin : begin + 20_000], b[begin : begin + 20_000]
                own = first_common(theirs[x], theirs[y]) == leaf
                np.add.at(sums, x[own], copies[y[own]])
                np.add.at(sums, y[own], copies[x[own]])
            least_node = to_smallest(nodes, walk(len(nodes), lambda row, others: linked[row, others]))
            there = np.flatnonzero((sums > 0) | (least_node != nodes))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(classes[there]), pa.array(sums[there]), pa.array(nodes[there]),
                    pa.array(least_node[there]),
                ],
                names=["class", "links", "a", "b"],
            )

    return compare


def padded(lists: pa.Array) -> np.ndarray:
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    table = np.full((len(sizes), int(sizes.max())), -1, np.int32)
    table[np.arange(table.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return table


def first_common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of each two rows the smallest number in both; -1 pads."""
    found = np.full(len(x), np.iinfo(np.int32).max, np.int32)
    for k in range(x.shape[1]):
        same = ((x[:, k, None] == y).any(axis=1)) & (x[:, k] >= 0)
        found[same] = np.minimum(found[same], x[same, k])
    return found


def near_duplicates(
    vectors: DataFrame, least: float = 0.95, vec_id: str = "vec_id", embedding: str = "embedding", trees: int = TREES
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for each row."""
    rows = narrowed(vectors, vec_id=vec_id, vector=embedding).withColumn("vec_id", F.col("vec_id").cast("long"))
    known = stored(rows.mapInArrow(valid_task, "vec_id long, digest binary, body binary"), "vectors")
    real = known.where("vec_id is not null and digest is not null")
    # A class has a number of its own for counts, and its smallest id, the node, for components.
    classes = stored(
        real.groupBy("digest").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("body").alias("body"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    forest = fit(classes, least, trees)
    routed = stored(
        classes.select("class", "body").mapInArrow(route_task(forest), "class long, length long, leaves array<int>")
        .withColumn("cut", F.pmod(F.xxhash64("class"), F.lit(1 << 20))),
        "leaves",
    )
    members = routed.select("class", "length", "leaves", "cut", F.explode("leaves").alias("leaf"))
    sizes = members.groupBy("length", "leaf").agg(F.count("*").alias("size")).where("size > 1")
    cells = stored(sizes.select("length", "leaf", F.ceil(F.col("size") / CELL_ROWS).cast("int").alias("parts")), "leaf-sizes")
    part = F.pmod("cut", "parts").cast("int")
    placed = members.join(cells, ["length", "leaf"]).withColumn("part", part)
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(F.least("part", other).alias("i"), F.greatest("part", other).alias("j"))
    )
    dealt = placed.withColumn("pair", F.explode(pairs)).select(
        "class", "leaf", "leaves", "part", F.xxhash64("length", "leaf", "pair.i", "pair.j").alias("cell")
    )
    of_class = classes.select("class", "node", "copies", "body")
    compared = stored(
        dealt.join(of_class, "class").repartition("cell").sortWithinPartitions("cell")
        .mapInArrow(compare_task(least), "class long, links long, a long, b long"),
        "links",
    )
    kind = F.xxhash64("digest")
    several = real.groupBy("vec_id").agg(F.min(kind).alias("x"), F.max(kind).alias("y")).where("x <> y").select("vec_id")
    also = real.join(several, "vec_id").join(classes.select("digest", "node"), "digest").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    reached = components(compared.where("a <> b").select("a", "b").unionByName(also))
    counts = compared.groupBy("class").agg(F.sum("links").alias("links"))
    about = stored(
        classes.select("digest", "class", "node", "copies").join(counts, "class", "left").join(reached, "node", "left")
        .where("copies > 1 or links > 0 or component is not null")
        .select("digest", F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")),
        "classes-linked",
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    own = known.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest"))
    return own.join(about, "digest", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
