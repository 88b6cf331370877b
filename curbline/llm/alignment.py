"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Tokenizer A is a byte-level BPE file and encodes a space and the text, tokenizer B a
SentencePiece file that puts this space in front itself. Special tokens' strings are
plain text for both.

Groups and links. The ends of all tokens, in bytes from the front, are kept as a
dictionary from end to index for each side. Its common keys, sorted, cut both lists of
ids into groups. Within a group a token of A and one of B are linked if their bytes overlap.

Pieces. Both tokenizers end a token before a single blank, at line breaks and between a
letter and a mark (``check_pieces`` looks through B's vocabulary; ``tokenfile.word_edges``
says where), so those are common ends, and a piece of text between two of them has the same
ids wherever it stands. Each block's distinct pieces are encoded once, and written as their
ids; both later steps read those. Documents are sums over their pieces.

Counts. Blocks add up their pairs of linked ids; pairs are summed over the corpus, and
the counts come back to the blocks that have the pair. One row for each block and pair
is shuffled, so a pair that is in every document costs one row a block.

Defined cases: null and empty texts have no tokens, and so have texts whose tokens' bytes,
joined, differ from a space and the text on either side (U+2581 is one cause). Such
texts have zeros and add nothing to the counts. Repeated rows count as often as they
occur; a null ``doc_id`` is kept. A text of any length is one row, and the block it is in grows
to its size. Columns other than the named ones are ignored. An empty table gives an
empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache, cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm import parcels
from curbline.llm.blocks import spread, strings, sums, text_bytes
from curbline.llm.frames import stored
from curbline.llm.tokenfile import word_edges

#: Pieces that are encoded at a time, and bytes of text in a block.
ENCODED, BLOCK = 20_000, 4 << 20

PAIRS = "block long, pair long, n long"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def letters_of_bytes() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes are
    their own letters, all others follow each other from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + place): b for place, b in enumerate(others)}


class Pair:
    """Two tokenizers, loaded once for each Python worker."""

    def __init__(self, a: str, b: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b)
        letters = letters_of_bytes()
        self.bytes_a = {
            number: bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
            for piece, number in self.a.get_vocab(with_added_tokens=True).items()
        }
        code = re.compile("<0x([0-9A-F]{2})>")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(code.fullmatch(p)[1], 16)]) if code.fullmatch(p) else p.replace("▁", " ").encode() for p in pieces]
        self.blank, self.line = self.b.piece_to_id("▁"), self.b.piece_to_id("<0x0A>")

    @cached_property
    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of each token of both sides, by id."""
        a = np.zeros(max(self.bytes_a) + 1, np.int64)
        for number, body in self.bytes_a.items():
            a[number] = len(body)
        return a, np.array([len(p) for p in self.bytes_b], np.int64)

    @cached_property
    def bodies(self) -> tuple[pa.Array, pa.Array]:
        """The bytes of each token of both sides, by id."""
        a = [self.bytes_a.get(i, b"") for i in range(max(self.bytes_a) + 1)]
        return pa.array(a, pa.large_binary()), pa.array(self.bytes_b, pa.large_binary())

    def check_pieces(self) -> None:
        """Whether B ends a token wherever pieces are cut."""
        joined = re.compile(rb"[^ ] |[A-Za-z][.,!?;:]|\n.|.\n", re.S)
        wrong = [p for p in self.bytes_b if joined.search(p)]
        blanks = b"".join(self.bytes_b[i] for i in self.b.encode("  x "))
        if wrong or self.b.encode("\nx")[:2] != [self.blank, self.line] or blanks != b"   x ":
            raise ValueError(f"pieces of text are not apart in the second tokenizer: {wrong[:5]}")

    def ids(self, pieces: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """For each side all ids, one piece after another, and the number of each piece's."""
        a = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        # A line break, which joins nothing, takes the blank that is put in front of a piece without one.
        b = self.b.encode([p[1:] if p.startswith(" ") else "\n" + p for p in pieces], num_threads=1) if pieces else []
        b = [ids if p.startswith(" ") else ids[2:] for p, ids in zip(pieces, b)]
        return flat(a), flat(b)


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


@cache
def pair(a: str, b: str) -> Pair:
    return Pair(a, b)


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of a space and each text; an empty text has none."""
    texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
    data, offsets = text_bytes(pc.if_else(pc.equal(texts, ""), texts, spaced))
    edges = word_edges(data, offsets)
    return strings(data, edges), np.searchsorted(edges, offsets)


def encoded(a: str, b: str):
    """What a parcel keeps of its pieces: the number of A's ids, A's ids and B's ids, 32 bits each; nothing
    for a piece whose tokens' bytes differ from it."""

    def translate(pieces: pa.Array) -> pa.Array:
        tools, parts = pair(a, b), []
        for begin in range(0, len(pieces), ENCODED):
            own = pieces.slice(begin, ENCODED)
            sides = tools.ids(own.to_pylist())
            whole = np.ones(len(own), bool)
            for (ids, sizes), bodies in zip(sides, tools.bodies):
                whole &= same_bytes(ids, sizes, bodies, own)
            (ids_a, n_a), (ids_b, n_b) = sides
            n_all = 1 + n_a + n_b
            body, first = np.empty(int(n_all.sum()), np.uint32), np.cumsum(n_all) - n_all
            body[first] = n_a
            body[spread(first + 1, n_a)] = ids_a
            body[spread(first + 1 + n_a, n_b)] = ids_b
            parts.append((body[np.repeat(whole, n_all)], np.where(whole, n_all, 0)))
        sizes = np.concatenate([np.empty(0, np.int64), *(s for _, s in parts)])
        body = np.concatenate([np.empty(0, np.uint32), *(x for x, _ in parts)])
        return strings(body.view(np.uint8), np.concatenate(([0], np.cumsum(sizes * 4))))

    return translate


def same_bytes(ids: np.ndarray, sizes: np.ndarray, bodies: pa.Array, pieces: pa.Array) -> np.ndarray:
    """Whether the bytes of each piece's tokens, joined, are the piece."""
    data, edges = text_bytes(pieces)
    joined = bodies.take(pa.array(ids))
    lengths = pc.binary_length(joined).to_numpy()
    found = sums(lengths, np.concatenate(([0], np.cumsum(sizes))))
    same = found == np.diff(edges)
    if not len(ids):
        return same
    # Of pieces as long as their tokens, the bytes are compared side by side.
    body = np.frombuffer(joined.buffers()[2], np.uint8)
    own = body[np.repeat(same, found)]
    given = data[np.repeat(same, np.diff(edges))]
    lies = np.flatnonzero(own != given)
    if len(lies):
        at = np.flatnonzero(same)
        same[at[np.searchsorted(np.cumsum(found[at]), lies, side="right")]] = False
    return same


class Block:
    """A parcel's distinct pieces, aligned.

    All pieces are taken as one text, piece after piece: the end of a piece is a common end.
    """

    def __init__(self, parcel: parcels.Parcel, a: str, b: str):
        self.parcel = parcel
        body = np.frombuffer(parcel.words.buffers()[2], np.uint32).astype(np.int64) if len(parcel.words) else np.empty(0, np.int64)
        edges = np.frombuffer(parcel.words.buffers()[1], np.int64)[: len(parcel.words) + 1] // 4
        size, whole = np.diff(edges), np.diff(edges) > 0
        first = edges[:-1]
        self.n_a = np.zeros(len(size), np.int64)
        self.n_a[whole] = body[first[whole]]
        self.n_b = np.where(whole, size - 1 - self.n_a, 0)
        self.ids_a = body[spread(first + 1, self.n_a)]
        self.ids_b = body[spread(first + 1 + self.n_a, self.n_b)]
        length_a, length_b = pair(a, b).lengths
        self.align(np.cumsum(length_a[self.ids_a]), np.cumsum(length_b[self.ids_b]))
        #: Whether each text has tokens.
        self.fine = (sums(~whole[parcel.codes], parcel.edges) == 0) & (np.diff(parcel.edges) > 0)

    def align(self, ends_a: np.ndarray, ends_b: np.ndarray) -> None:
        """Groups, links, and how many of them each piece has."""
        index_a, index_b = ({end: i for i, end in enumerate(ends.tolist())} for ends in (ends_a, ends_b))
        common = sorted(index_a.keys() & index_b.keys())
        #: The last token of each group on both sides.
        self.last_a = np.fromiter(map(index_a.__getitem__, common), np.int64, len(common))
        self.last_b = np.fromiter(map(index_b.__getitem__, common), np.int64, len(common))
        pieces_a = np.cumsum(self.n_a)
        self.group_edges = np.searchsorted(self.last_a, np.concatenate(([0], pieces_a)))
        # Each end, of either side, closes a stretch of bytes that one token of A and one of B share:
        # every link once, slice after slice.
        either = np.union1d(ends_a, ends_b)
        a, b = np.searchsorted(ends_a, either), np.searchsorted(ends_b, either)
        self.links = self.ids_a[a] << 32 | self.ids_b[b]
        self.link_edges = np.searchsorted(a, np.concatenate(([0], pieces_a)))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of linked ids and the number of their links."""
        sizes = np.diff(self.parcel.edges)
        used = self.parcel.codes[np.repeat(self.fine, sizes)]
        often = np.bincount(used, minlength=len(self.n_a))
        found, place = np.unique(self.links, return_inverse=True)
        n = np.zeros(len(found), np.int64)
        np.add.at(n, place, np.repeat(often, np.diff(self.link_edges)))
        return found[n > 0], n[n > 0]

    def group_texts(self) -> pa.Array:
        """The groups of each piece: ``a1,a2|b1;a3|b2,b3``."""
        sizes_a, sizes_b = (np.diff(np.concatenate(([-1], last))) for last in (self.last_a, self.last_b))
        # Ids stand group after group, A's before B's; each is followed by the sign that belongs behind it.
        at_a = np.arange(len(self.ids_a)) + np.repeat(np.cumsum(sizes_b) - sizes_b, sizes_a)
        at_b = np.arange(len(self.ids_b)) + np.repeat(np.cumsum(sizes_a), sizes_b)
        ids, sign = np.empty(len(at_a) + len(at_b), np.int64), np.zeros(len(at_a) + len(at_b), np.int64)
        ids[at_a], ids[at_b] = self.ids_a, self.ids_b
        sign[at_a[self.last_a]] = 1
        sign[at_b[self.last_b]] = 2
        closing = self.group_edges[1:][np.diff(self.group_edges) > 0] - 1
        sign[at_b[self.last_b[closing]]] = 3
        most = int(ids.max(initial=0)) + 1
        shown = pa.array([f"{i}{s}" for s in (",", "|", ";", "") for i in range(most)])
        edges = np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges), shown.take(pa.array(sign * most + ids))), "")

    def rows(self, counts: dict[str, np.ndarray], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
        """Rows of the result, about ``most`` pieces at a time."""
        own, edges, fine = self.parcel, self.parcel.edges, self.fine
        count, best = np.zeros(len(self.links), np.int64), np.zeros(len(self.links), np.int64)
        if counts:
            order = np.argsort(counts["pair"])
            known = counts["pair"][order]
            at = np.minimum(np.searchsorted(known, self.links), len(known) - 1)
            # Links of texts without tokens may be unknown; those texts have zeros.
            there = known[at] == self.links
            count[there] = counts["total"][order][at[there]]
            best[there] = counts["best"][order][at[there]]
        numbers = [self.n_a, self.n_b, np.diff(self.group_edges), np.diff(self.link_edges)]
        numbers += [sums(best, self.link_edges), sums(count, self.link_edges)]
        columns = [np.where(fine, sums(n[own.codes], edges), 0) for n in numbers]
        texts = self.group_texts()
        row = 0
        while row < len(fine):
            end = max(row + 1, int(np.searchsorted(edges, edges[row] + most, side="right")) - 1)
            sizes = np.where(fine[row:end], np.diff(edges[row : end + 1]), 0)
            chosen = texts.take(pa.array(own.codes[spread(edges[row:end], sizes)]))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), chosen)
            yield pa.RecordBatch.from_arrays(
                [own.doc_ids.slice(row, end - row), *[pa.array(c[row:end]) for c in columns], pc.binary_join(lists, ";")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
            )
            row = end


def pair_task(a: str, b: str):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parcel in parcels.each(batches):
            found, n = Block(parcel, a, b).pairs()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), parcel.block)), pa.array(found), pa.array(n)], names=["block", "pair", "n"]
            )

    return pairs


def row_task(a: str, b: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parcel, (counts,) in parcels.visits(batches, ("pair", "total", "best")):
            yield from Block(parcel, a, b).rows(counts)

    return rows


def counted(pairs: DataFrame) -> DataFrame:
    """``pair``, its ``total`` over the corpus, and ``best``: whether no pair of its B id has more."""
    totals = stored(pairs.groupBy("pair").agg(F.sum("n").alias("total")), "pair-counts")
    other = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = totals.groupBy(other.alias("b")).agg(F.max("total").alias("most"))
    return totals.withColumn("b", other).join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def align(docs: DataFrame, a: str, b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document its numbers of tokens, groups and links, of links with the highest count of their B id
    (``n_best``), the sum of the counts of its links, and its ``groups``: ``a1,a2|b1;a3|b2,b3``.

    ``a`` is a tokenizers file, ``b`` a SentencePiece file.
    """
    pair(a, b).check_pieces()
    table = parcels.write(docs, cut, doc_id, text, BLOCK, encoded(a, b))
    pairs = stored(table.mapInArrow(pair_task(a, b), PAIRS), "pairs")
    told = pairs.select("block", "pair").join(counted(pairs), "pair")
    return parcels.with_parcels(table, told).mapInArrow(row_task(a, b), RESULT)
