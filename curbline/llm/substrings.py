"""Substring dedup: words go that a window of words covers which also starts earlier in the corpus.

A window is ``size`` neighbouring words of one document. Earlier means a smaller
``doc_id``, or the same one and an earlier start. Windows are judged on the input.

Shards. Equal windows must meet, and few others. The anchor of a window is that of its
word runs of ``gram_size`` words with the smallest hash value, the leftmost of equal
ones. Windows next to each other mostly share their anchor: such a run of windows is a segment.
Equal windows have equal anchors, so they lie in segments of the same anchor, and a
shard takes all segments of some anchors. Of segments with equal words the
earliest is indexed; the windows of the others start earlier by that alone. Segments
whose anchor no other words share are in no shard, since nothing could match them.

Index. A shard is a compressed FM-index over its segments' words. Its segments stream
against it in order of the corpus: backward search over the wavelet levels gives for
every window's end how many words before it occur twice or more. Windows that reach
``size`` words are reported, but for the first one of each interval.

Hot anchors. A sample of the blocks shows anchors with more than a ``1 / HOT_SHARE`` part of all
segments. There are no more than that many. Their windows are segments of their own,
known by their words' hash value, so they spread over all tasks. Results are the same
whichever anchors are held to be hot. Other anchors hold a ``1 / HOT_SHARE`` part of
the segments at most, and that is what a task must hold.

Words are compared by 64-bit hash values, segments by two of them.

Defined cases: null and texts without words have none, and stay empty. All rows that
repeat a ``doc_id`` count as one document: an equal window at the same start of another
such row isn't earlier, so a row given twice stays twice. Rows without ``doc_id`` come
after all others, as one document. Texts of fewer than ``size`` words stay whole. A text
of any length is one row, and the block it is in grows to its size. Columns other than
the named ones are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm import parcels
from curbline.llm.blocks import hashed, spread, sums, text_bytes, words
from curbline.llm.fmindex import FMIndex
from curbline.llm.frames import stored

#: Words of an anchor, unless windows are long.
GRAM = 5
#: An anchor with more than one of so many segments is hot.
HOT_SHARE = 1 << 18
#: Hot anchors have at least so many segments in the sample.
HOT_LEAST = 64
#: Blocks that the sample has at least, and one of how many beyond.
SAMPLE_BLOCKS, SAMPLE_OF = 16, 64
#: Bytes of segments in a shard.
SHARD_BYTES = 8 << 20

ROWS = "fp long, cfp long, doc long, start int, block long, n int"
KNOWN = "block long, kind int, fps binary, cfps binary"
CONTENT = "fp long, cfp long, doc long, start int, block long, hashes binary"
MASKS = "block long, fp long, cfp long, mask long"
RESULT = "doc_id long, n_words long, n_removed long, removed_from array<int>, removed_to array<int>, text string"

COPY, LEADER, SHARED = 0, 1, 2


def gram_size(size: int) -> int:
    """Words of an anchor. A segment has no more windows than a mask has bits."""
    return max(min(GRAM, size), size - 61)


def mixed(values: np.ndarray) -> np.ndarray:
    """Numbers spread over all 64 bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15


@cache
def factors(count: int) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=np.uint64)) | np.uint64(1)


def powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


class Segments:
    """The segments of a block.

    ``text`` is the row of each segment's document, ``at`` the place of its first word in the
    block, ``start`` that in the document, ``windows`` its number of windows; ``fp`` and
    ``cfp`` are the hash values of its anchor and its words.
    """

    def __init__(self, hashes: np.ndarray, edges: np.ndarray, size: int, hot: np.ndarray):
        gram = gram_size(size)
        count = max(len(hashes) - size + 1, 0)
        if count:
            value, place = anchors(hashes, size, gram)
            owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[:count]
            whole = np.flatnonzero(np.arange(count) + size <= edges[owner + 1])
        else:
            value = place = owner = whole = np.empty(0, np.int64)
        value, place = value[whole], place[whole]
        single = np.isin(value.view(np.int64), hot) if len(hot) else np.zeros(len(whole), bool)
        first = np.ones(len(whole), bool)
        first[1:] = (np.diff(whole) != 1) | (np.diff(place) != 0) | single[1:]
        begins = np.flatnonzero(first)
        self.windows = np.diff(np.append(begins, len(whole)))
        self.at, self.text = whole[begins], owner[whole[begins]]
        self.start = self.at - edges[self.text]
        self.length = self.windows + size - 1
        ahead = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * powers(BASE, len(hashes)), out=ahead[1:])
        back = powers(pow(BASE, -1, 1 << 64), len(hashes))
        content = (ahead[self.at + self.length] - ahead[self.at]) * back[self.at] if len(begins) else np.empty(0, np.uint64)
        fp = value[begins].view(np.uint64)
        fp = np.where(single[begins], fp ^ mixed(content), fp)
        self.fp = fp.view(np.int64)
        self.cfp = mixed(content + self.length.astype(np.uint64) * np.uint64(BASE)).view(np.int64)


def anchors(hashes: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the smallest hash value of its runs of ``gram`` words, and the leftmost place of it."""
    runs = len(hashes) - gram + 1
    value = np.zeros(runs, np.uint64)
    for word, factor in enumerate(factors(gram)):
        value += hashes[word : word + runs] * factor
    value, place = mixed(value), np.arange(runs)
    wide, span = size - gram + 1, 1
    while span < wide:
        step = min(span, wide - span)
        less = value[step:] < value[:-step]
        value, place = np.where(less, value[step:], value[:-step]), np.where(less, place[step:], place[:-step])
        span += step
    return value, place


class Keyed:
    """The segments of a parcel, grouped by their hash values, and the earliest place of each group in the block."""

    def __init__(self, parcel: parcels.Parcel, size: int, hot: np.ndarray):
        self.word_hashes = hashed(parcel.words.to_pylist())
        self.hashes = self.word_hashes[parcel.codes] if len(parcel.codes) else np.empty(0, np.uint64)
        self.found = found = Segments(self.hashes, parcel.edges, size, hot)
        none = parcel.doc_ids.is_null().to_numpy(zero_copy_only=False)
        self.none = none[found.text]
        self.doc = pc.fill_null(parcel.doc_ids, 0).to_numpy(zero_copy_only=False)[found.text]
        self.order = order = np.lexsort((found.start, self.doc, self.none, found.cfp, found.fp))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(found.fp[order]) != 0) | (np.diff(found.cfp[order]) != 0)
        begins = np.flatnonzero(new)
        #: The earliest segment of each group, and the group of each segment.
        self.least = order[begins]
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.count = np.diff(np.append(begins, len(order)))

    def is_least(self) -> np.ndarray:
        """Whether a segment is at its group's earliest place; rows of one ``doc_id`` may share it."""
        own = self.least[self.group]
        same = (self.doc == self.doc[own]) & (self.none == self.none[own])
        return same & (self.found.start == self.found.start[own])

    def groups_of(self, fp: np.ndarray, cfp: np.ndarray) -> np.ndarray:
        """The groups with these hash values; there is one for each."""
        own = self.found.fp[self.least], self.found.cfp[self.least]
        here, there = len(self.least), len(fp)
        asked = np.concatenate((np.zeros(here, bool), np.ones(there, bool)))
        fps, cfps = np.concatenate((own[0], fp)), np.concatenate((own[1], cfp))
        order = np.lexsort((asked, cfps, fps))
        at = np.flatnonzero(asked[order])
        result = np.empty(there, np.int64)
        result[order[at] - here] = order[at - 1]
        if there and not ((fps[order[at]] == fps[order[at - 1]]) & (cfps[order[at]] == cfps[order[at - 1]])).all():
            raise ValueError("a block isn't the one that was searched")
        return result


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return words(*text_bytes(texts))


def row_task(size: int, hot: np.ndarray):
    """A row for each group of equal segments of a block."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parcel in parcels.each(batches):
            keyed = Keyed(parcel, size, hot)
            found, least = keyed.found, keyed.least
            columns = [
                pa.array(found.fp[least]), pa.array(found.cfp[least]), pa.array(keyed.doc[least], mask=keyed.none[least]),
                pa.array(found.start[least].astype(np.int32)), pa.array(np.full(len(least), parcel.block)),
                pa.array(keyed.count.astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["fp", "cfp", "doc", "start", "block", "n"])

    return rows


def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Given all rows of an anchor in order: which blocks have copies, leaders, and leaders that others may match in part."""
    for batch in parcels.whole_keys(batches, "fp", SHARD_BYTES):
        fp, cfp, start, block, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "cfp", "start", "block", "n"))
        none = batch.column("doc").is_null().to_numpy(zero_copy_only=False)
        doc = pc.fill_null(batch.column("doc"), 0).to_numpy(zero_copy_only=False)
        new_anchor = np.concatenate(([True], np.diff(fp) != 0))
        new = new_anchor | np.concatenate(([True], np.diff(cfp) != 0))
        begins, anchor = np.flatnonzero(new), np.cumsum(new_anchor) - 1
        content = np.cumsum(new) - 1
        first = begins[content]
        leads = (doc == doc[first]) & (none == none[first]) & (start == start[first])
        several = np.bincount(anchor[begins])[anchor] > 1
        total = np.add.reduceat(n.astype(np.int64), begins)[content]
        kind = np.where(leads, np.where(several, SHARED, LEADER), COPY)
        told = np.flatnonzero(several | (total > 1))
        # A row for each block and kind, with its hash values side by side: blocks are many rows otherwise.
        told = told[np.lexsort((kind[told], block[told]))]
        new = np.ones(len(told), bool)
        new[1:] = (np.diff(block[told]) != 0) | (np.diff(kind[told]) != 0)
        begins = np.flatnonzero(new)
        edges = np.append(begins, len(told))
        yield pa.RecordBatch.from_arrays(
            [pa.array(block[told[begins]]), pa.array(kind[told[begins]].astype(np.int32)), side_by_side(fp[told], edges), side_by_side(cfp[told], edges)],
            names=["block", "kind", "fps", "cfps"],
        )


def side_by_side(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The values between neighbouring edges as one column value each."""
    body = np.ascontiguousarray(values)
    return pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer((edges * 8).astype(np.int32)), pa.py_buffer(body)])


def told(known: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash values and kinds of the groups of a block that ``judge`` has told of."""
    if not known:
        return (np.empty(0, np.int64),) * 3
    fp, cfp = (np.frombuffer(b"".join(known[c]), np.int64) for c in ("fps", "cfps"))
    return fp, cfp, np.repeat(known["kind"], [len(b) // 8 for b in known["fps"]])


def content_task(size: int, hot: np.ndarray):
    """The words of the leaders that others may match in part."""

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parcel, (known,) in parcels.visits(batches, ("kind", "fps", "cfps")):
            fp, cfp, _ = told(known)
            if not len(fp):
                continue
            keyed = Keyed(parcel, size, hot)
            at = keyed.least[keyed.groups_of(fp, cfp)]
            found = keyed.found
            for begin in range(0, len(at), 20_000):
                own = at[begin : begin + 20_000]
                body = keyed.hashes[spread(found.at[own], found.length[own])]
                places = np.concatenate(([0], np.cumsum(found.length[own] * 8))).astype(np.int32)
                columns = [
                    pa.array(found.fp[own]), pa.array(found.cfp[own]), pa.array(keyed.doc[own], mask=keyed.none[own]),
                    pa.array(found.start[own].astype(np.int32)), pa.array(np.full(len(own), parcel.block)),
                    pa.BinaryArray.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(places), pa.py_buffer(body)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["fp", "cfp", "doc", "start", "block", "hashes"])

    return contents


def index_task(size: int):
    """Streams the segments of a shard against its index: the windows of each that start earlier in another."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in parcels.whole_keys(batches, "fp", SHARD_BYTES):
            shard = shard.take(pc.sort_indices(shard, [("doc", "ascending"), ("start", "ascending")], null_placement="at_end"))
            mask = earlier(shard.column("hashes"), shard.column("doc"), shard.column("start"), size)
            hit = np.flatnonzero(mask)
            yield pa.RecordBatch.from_arrays(
                [shard.column(c).take(pa.array(hit)) for c in ("block", "fp", "cfp")] + [pa.array(mask[hit])],
                names=["block", "fp", "cfp", "mask"],
            )

    return search


def earlier(bodies: pa.Array, doc: pa.Array, start: pa.Array, size: int) -> np.ndarray:
    """For each segment, in order of the corpus, a bit for every window of it that an earlier window equals."""
    lengths = pc.binary_length(bodies).to_numpy(zero_copy_only=False).astype(np.int64) // 8
    body = np.frombuffer(b"".join(bodies.to_pylist()), np.uint64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(len(body)) + owner  # a separator after each
    text = np.zeros(len(body) + len(lengths), np.int64)
    text[places] = np.unique(body, return_inverse=True)[1] + 1
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    windows = lengths - size + 1
    at, segment = spread(begins, windows), np.repeat(np.arange(len(lengths)), windows)
    matched, interval = FMIndex(text, size).statistics(text, at + size, size)
    hit = np.flatnonzero(matched == size)
    segment, at, interval = segment[hit], at[hit], interval[hit]
    none = doc.is_null().to_numpy(zero_copy_only=False)[segment]
    docs = pc.fill_null(doc, 0).to_numpy(zero_copy_only=False)[segment]
    offset = at - begins[segment]
    starts = start.to_numpy(zero_copy_only=False)[segment] + offset
    order = np.lexsort((starts, docs, none, interval))
    new = np.concatenate(([True], np.diff(interval[order]) != 0)) if len(order) else np.empty(0, bool)
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    same = (docs[order] == docs[first]) & (none[order] == none[first]) & (starts[order] == starts[first])
    late = order[~same]
    mask = np.zeros(len(lengths), np.int64)
    np.bitwise_or.at(mask, segment[late], np.int64(1) << offset[late])
    return mask


def finish_task(size: int, hot: np.ndarray):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parcel, (known, masks) in parcels.visits(batches, ("kind", "fps", "cfps"), ("fp", "cfp", "mask")):
            covered = np.zeros(len(parcel.codes), bool)
            if known:
                keyed = Keyed(parcel, size, hot)
                covered = covered_words(keyed, len(parcel.codes), known, masks, size)
            yield from kept_texts(parcel, covered)

    return finish


def covered_words(keyed: Keyed, count: int, known: dict, masks: dict, size: int) -> np.ndarray:
    found = keyed.found
    kind = np.full(len(keyed.least), -1)
    fp, cfp, kinds = told(known)
    kind[keyed.groups_of(fp, cfp)] = kinds
    some = np.zeros(len(keyed.least), np.int64)
    if masks:
        some[keyed.groups_of(masks["fp"], masks["cfp"])] = masks["mask"]
    kind, some, stays = kind[keyed.group], some[keyed.group], keyed.is_least()
    every = (kind == COPY) | ((kind > COPY) & ~stays)
    whole, part = np.flatnonzero(every), np.flatnonzero((kind == SHARED) & stays & (some != 0))
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, found.at[whole], 1)
    np.add.at(change, found.at[whole] + found.length[whole], -1)
    for window in range(size - gram_size(size) + 1):
        own = found.at[part[(some[part] >> window) & 1 == 1]] + window
        np.add.at(change, own, 1)
        np.add.at(change, own + size, -1)
    return np.cumsum(change)[:-1] > 0


def kept_texts(parcel: parcels.Parcel, covered: np.ndarray, most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Rows of the result, about ``most`` words at a time."""
    edges, row = parcel.edges, 0
    texts = len(edges) - 1
    text_of = np.repeat(np.arange(texts), np.diff(edges))
    change = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    cuts = np.zeros(len(covered) + 1, bool)
    cuts[edges] = True  # a run ends with its text
    inside = np.concatenate((covered, [False]))
    before = np.concatenate(([False], covered))
    begins = np.flatnonzero((change == 1) | (cuts & inside & before))
    ends = np.flatnonzero((change == -1) | (cuts & inside & before))
    runs = np.searchsorted(begins, edges)
    begin_at, end_at = begins - edges[text_of[begins]] if len(begins) else begins, ends - edges[text_of[begins]] if len(begins) else ends
    while row < texts:
        end = max(row + 1, int(np.searchsorted(edges, edges[row] + most, side="right")) - 1)
        low, high = edges[row], edges[end]
        kept = ~covered[low:high]
        left = sums(kept, edges[row : end + 1] - low)
        chosen = pc.cast(parcel.words.take(pa.array(parcel.codes[low:high][kept])), pa.string())
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(left))).astype(np.int32)), chosen)
        total = np.diff(edges[row : end + 1])
        spans = pa.array((runs[row : end + 1] - runs[row]).astype(np.int32))
        own = slice(runs[row], runs[end])
        yield pa.RecordBatch.from_arrays(
            [
                parcel.doc_ids.slice(row, end - row), pa.array(total), pa.array(total - left),
                pa.ListArray.from_arrays(spans, pa.array(begin_at[own].astype(np.int32))),
                pa.ListArray.from_arrays(spans, pa.array(end_at[own].astype(np.int32))),
                pc.binary_join(lists, " "),
            ],
            names=["doc_id", "n_words", "n_removed", "removed_from", "removed_to", "text"],
        )
        row = end


def hot_anchors(table: DataFrame, size: int) -> np.ndarray:
    """Anchors that hold more than their share of the segments of a sample of blocks; at most ``HOT_SHARE``."""
    blocks = table.count()
    # Few blocks are all looked at; of many, one in ``SAMPLE_OF``.
    of = max(1, min(SAMPLE_OF, blocks // SAMPLE_BLOCKS))
    sample = table.where(F.pmod(F.xxhash64("block"), F.lit(of)) == 0).mapInArrow(row_task(size, np.empty(0, np.int64)), ROWS)
    counts = stored(sample.groupBy("fp").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_LEAST), "anchors")
    # What lies below HOT_LEAST is left out of the sum, which only lets more anchors be hot; their number stays bounded.
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where((F.col("n") > HOT_LEAST) & (F.col("n") * HOT_SHARE >= total)).select("fp")
    return np.sort(np.array([r.fp for r in hot.collect()], np.int64))


def dedup(docs: DataFrame, size: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document ``n_words``, ``n_removed``, the places of the removed runs of words (``removed_from`` up to
    and without ``removed_to``), and ``text``, its kept words joined by one space."""
    table = parcels.write(docs, cut, doc_id, text)
    hot = hot_anchors(table, size)
    rows = table.mapInArrow(row_task(size, hot), ROWS).repartition("fp")
    ordered = rows.sortWithinPartitions("fp", "cfp", F.asc_nulls_last("doc"), "start", "block")
    known = stored(ordered.mapInArrow(judge, KNOWN), "segments")
    asked = known.where(F.col("kind") == SHARED)
    contents = parcels.with_parcels(table, asked).mapInArrow(content_task(size, hot), CONTENT).repartition("fp").sortWithinPartitions("fp")
    masks = stored(contents.mapInArrow(index_task(size), MASKS), "matches")
    return parcels.with_parcels(table, known, masks).mapInArrow(finish_task(size, hot), RESULT)
