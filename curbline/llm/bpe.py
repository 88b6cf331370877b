"""BPE encoding and decoding of whole texts through one table of distinct words.

Encoding. Tasks cut blocks of documents into words, at ASCII white space and between a
letter and a mark. A block keeps the number of the word at each position and hands its
distinct words on, dealt by their hash, so a word that fills a third of a corpus occurs
once a block. A group of words (``parts`` of them) is encoded in one task, each distinct
word once, and the ids go back to the blocks, where they are put at their positions.

Texts are cut twice, once for the words and once for the positions, as that is cheaper
than writing the positions and reading them again. A block is known by a digest of its
distinct words, so blocks of the same words share their ids. A scan gives the same
blocks both times; one that differs the second time is an error and never a wrong
result. So ``docs`` should be a written table or a plain plan over one.

This needs a tokenizer that drops white space, keeps letters and marks apart and lowers
the case, but for its special tokens; the check in ``words_are_apart`` refuses others.

Decoding. Ids meet the vocabulary, the id-to-piece relation, inside the tasks. Its size
is that of the vocabulary file and doesn't grow with the data.

Null and empty texts have no ids and decode to the empty text. Rows are not merged: a
document that occurs twice comes out twice. A null ``doc_id`` is kept. An empty table
gives an empty table. Columns other than the named ones are ignored. A text of any
length is one row, and the block it is in grows to its size.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.blocks import (
    after_letters,
    coded,
    hashed,
    lists,
    narrow_kind,
    packed,
    spread,
    sums,
    text_blocks,
    text_bytes,
    unpacked,
)
from curbline.llm.blocks import words as words_of
from curbline.llm.frames import narrowed

#: Bytes of text for a group of words, and groups at least. A task encodes some whole groups and holds the
#: distinct words of one at a time, so groups follow the size of the input.
PART_BYTES, PARTS = 128 << 20, 512

WORDS = "block long, part int, start int, count int, body binary"
TEXTS = "block long, start int, count int, doc_ids array<long>, sizes array<int>, groups binary, body binary"
#: The row with a block's documents comes after all rows with its ids.
LAST = 2**31 - 1


@cache
def tokenizer(path: str):
    """The tokenizer, once for each Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def words_are_apart(path: str) -> bool:
    """Whether a text's ids are those of its words, as ``cut_words`` makes them."""
    known = tokenizer(path)
    parts = ["Ab", "c's", "<|endoftext|>", "é1", "..,", "<", "|", "9"]
    apart = [i for p in parts for i in known.encode(p, add_special_tokens=False).ids]
    together = [known.encode(s.join(parts), add_special_tokens=False).ids for s in " \n\t\r\v\f"]
    ids = lambda *texts: [i for t in texts for i in known.encode(t, add_special_tokens=False).ids]
    marked = all(ids(f"Ab{m}b") == ids("ab", f"{m}b") for m in (".", ",", "!", "?", ";", ":", ".)", "!!"))
    return marked and all(found == apart for found in [*together, ids(" \n".join(parts) + " ")])


def listed(words: list[str]) -> bytes:
    """Words, which hold no white space, as one compressed column value."""
    return zstandard.compress("\n".join(words).encode())


def unlisted(body: bytes) -> list[str]:
    return zstandard.decompress(body).decode().split("\n")


def cut_blocks(batches: Iterator[pa.RecordBatch], parts: int):
    """For each block of a task: its digest, its rows, the number of words in each text, the place of the word
    at each position, and the distinct words with their groups, in order of first use."""
    for batch in text_blocks(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        found, edges = words_of(data, offsets, after_letters(data))
        at, words = coded(found)
        # A word that may hold a special token stays as it is.
        lower = pc.if_else(pc.match_substring(words, "<"), words, pc.ascii_lower(words))
        same, words = coded(lower)
        at, listed_words = same[at], words.to_pylist()
        hashes = hashed(listed_words)
        digest = int.from_bytes(blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)
        yield digest, batch, np.diff(edges), at, listed_words, (hashes % np.uint64(parts)).astype(np.int64)


def cut_words(parts: int):
    """Rows of a block's words, one for each group."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, _, words, group in cut_blocks(batches, parts):
            order = np.argsort(group, kind="stable")
            edges = np.searchsorted(group[order], np.arange(parts + 1))
            there = np.flatnonzero(np.diff(edges))
            words = [words[i] for i in order]
            rows = [
                {
                    "block": block, "part": int(p), "start": int(edges[p]), "count": int(edges[p + 1] - edges[p]),
                    "body": listed(words[edges[p] : edges[p + 1]]),
                }
                for p in there
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=WORDS_ARROW)

    return cut


def cut_texts(parts: int):
    """A row for each block: its documents, and the number of the word at each position."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, batch, sizes, at, words, group in cut_blocks(batches, parts):
            row = {
                "block": block, "start": LAST, "count": len(words), "doc_ids": batch.column("doc_id").to_pylist(),
                "sizes": sizes.tolist(), "groups": packed(group.astype(narrow_kind(parts))),
                "body": packed(at.astype(narrow_kind(max(len(words) - 1, 0)))),
            }
            yield pa.RecordBatch.from_pylist([row], schema=TEXTS_ARROW)

    return cut


WORDS_ARROW = pa.schema(
    [
        ("block", pa.int64()), ("part", pa.int32()), ("start", pa.int32()), ("count", pa.int32()),
        ("body", pa.binary()),
    ]
)
TEXTS_ARROW = pa.schema(
    [
        ("block", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int32())), ("groups", pa.binary()), ("body", pa.binary()),
    ]
)
#: ``counts``: ids of each word, packed to as many bytes as the largest needs.
IDS = "block long, start int, count int, counts binary, body binary"
IDS_ARROW = pa.schema([("block", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("counts", pa.binary()), ("body", pa.binary())])


def packed_counts(sizes: list[int]) -> bytes:
    kind = narrow_kind(max(sizes))
    return bytes([kind.itemsize]) + packed(np.array(sizes, kind))


def unpacked_counts(data: bytes, count: int) -> np.ndarray:
    return unpacked(data[1:], f"<u{data[0]}", count).astype(np.int64)


def encode_words(path: str, kind: np.dtype):
    """Rows in order of ``part``: the ids of their words. A word is encoded where it is met first."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part = {}, None
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("block", "part", "start")]
            for block, own, start, words in zip(*columns, batch.column("body")):
                words = unlisted(words.as_py())
                if own != part:
                    known, part = {}, own
                new = [w for w in words if w not in known]
                for word, encoded in zip(new, tokenizer(path).encode_batch_fast(new, add_special_tokens=False)):
                    known[word] = np.array(encoded.ids, kind).tobytes()
                bodies = [known[w] for w in words]
                rows.append(
                    {
                        "block": block, "start": start, "count": len(words),
                        "counts": packed_counts([len(b) // kind.itemsize for b in bodies]),
                        "body": packed(np.frombuffer(b"".join(bodies), kind)),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=IDS_ARROW)

    return encode


def put_back(parts: int, kind: np.dtype):
    """The rows of a block in order of ``start``, its documents last: the ids of each document."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in ("block", "start", "count", "counts", "groups", "body")}
                if row["block"] != block:
                    block, held = row["block"], {}
                if row["start"] != LAST:
                    counts = unpacked_counts(row["counts"], row["count"])
                    held[row["start"]] = counts, unpacked(row["body"], kind, int(counts.sum()))
                    continue
                if sum(len(counts) for counts, _ in held.values()) != row["count"]:
                    raise ValueError("the documents came in another order the second time; write them first")
                each = np.concatenate([np.empty(0, np.int64), *(counts for counts, _ in held.values())])
                ids = np.concatenate([np.empty(0, kind), *(body for _, body in held.values())])
                # From the order of groups to that of first use, in which positions count.
                place = np.empty(len(each), np.int64)
                place[np.argsort(unpacked(row["groups"], narrow_kind(parts), row["count"]), kind="stable")] = np.arange(len(each))
                sizes = batch.column("sizes")[at].values.to_numpy().astype(np.int64)
                used = unpacked(row["body"], narrow_kind(max(row["count"] - 1, 0)), int(sizes.sum()))
                yield from documents(batch.column("doc_ids")[at].values, sizes, place[used], each, ids)

    return put


def documents(doc_ids, sizes, at, each, ids, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows with the ids of the words at ``at``, about a million ids at a time."""
    begins = np.cumsum(each) - each
    edges = np.concatenate(([0], np.cumsum(sizes)))
    lengths = np.concatenate(([0], np.cumsum(each[at])))[edges]
    row = 0
    while row < len(sizes):
        end = max(row + 1, int(np.searchsorted(lengths, lengths[row] + most, side="right")) - 1)
        own = at[edges[row] : edges[end]]
        values = ids[spread(begins[own], each[own])].astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [doc_ids.slice(row, end - row), lists(values, np.diff(lengths[row : end + 1]), pa.int32())],
            names=["doc_id", "ids"],
        )
        row = end


def with_ids(docs: DataFrame, path: str, doc_id: str, text: str, parts: int | None, finish, schema: str) -> DataFrame:
    """What ``finish`` makes of the batches of ``doc_id`` and ``ids``, in the tasks that put them together."""
    if not words_are_apart(path):
        raise ValueError(f"the ids of {path} aren't those of words")
    rows = narrowed(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    kind, parts = narrow_kind(tokenizer(path).get_vocab_size(with_added_tokens=True)), parts or parts_of(rows)
    words = rows.mapInArrow(cut_words(parts), WORDS).repartition("part").sortWithinPartitions("part")
    ids = words.mapInArrow(encode_words(path, kind), IDS)
    texts = rows.mapInArrow(cut_texts(parts), TEXTS)
    both = ids.unionByName(texts, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "start")
    put = put_back(parts, kind)
    return both.mapInArrow(lambda batches: finish(put(batches)), schema)


def parts_of(rows: DataFrame) -> int:
    """Groups of words for texts of this size, which is summed up wherever the rows come from."""
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(PARTS, min(size // PART_BYTES, 1 << 24))


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` (array<int>) of each document, as the tokenizer file at ``path`` has them."""
    return with_ids(docs, path, doc_id, text, parts, lambda batches: batches, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """``decode`` of ``encode``, joined in the same tasks: ``doc_id``, ``ids`` and the ``text`` that they decode to."""
    return with_ids(docs, path, doc_id, text, parts, join_pieces(*pieces(path)), "doc_id long, ids array<int>, text string")


def pieces(path: str) -> tuple[pa.Array, bool]:
    """The piece of each id, and whether decoding joins them by blanks (no decoder is set)."""
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    by_id = [None] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        by_id[number] = piece
    with open(path, encoding="utf-8") as file:
        plain = json.load(file).get("decoder") is None
    return pa.array(by_id, pa.string()), plain


def join_pieces(table: pa.Array, plain: bool):
    if not plain:
        raise ValueError("the tokenizer has a decoder of its own; its pieces aren't joined by blanks")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                yield joined_pieces(batch.slice(begin, 1000), table)

    return join


def joined_pieces(batch: pa.RecordBatch, table: pa.Array) -> pa.RecordBatch:
    ids = pc.fill_null(batch.column("ids").flatten(), -1).to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy(zero_copy_only=False)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    known = (ids >= 0) & (ids < len(table))
    found = table.take(pa.array(np.where(known, ids, 0), mask=~known))
    # Ids without a piece are left out, as the library does.
    left = sums(found.is_valid().to_numpy(zero_copy_only=False), edges)
    grouped = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(left))).astype(np.int32)), found.drop_null())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pc.cast(batch.column("ids"), pa.list_(pa.int32())), pc.binary_join(grouped, " ")],
        names=["doc_id", "ids", "text"],
    )


def decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id``, ``ids`` and their ``text``, special tokens included; no ids give the empty text."""
    rows = narrowed(encoded, doc_id=doc_id, ids=ids).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(join_pieces(*pieces(path)), "doc_id long, ids array<int>, text string")
