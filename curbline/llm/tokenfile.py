"""Token ids in binary files: every id in as many bits as the vocabulary needs.

A file is ``CTOK`` and its version, then blocks of bits, then a footer: the places of the
blocks and, for each document, its id, whether that is null, and its number of ids. The
last eight bytes give the footer's length. All numbers are little-endian.

Ids are taken ``BLOCK_IDS`` at a time. Bit ``i`` of id ``n`` of a block is bit
``(n * width + i) mod 8`` of byte ``(n * width + i) div 8``, so a block of ids unpacks
in a few numpy operations. As each full block holds equally many ids, the block and
bit of any id follow from its number: ``TokenFile.ids`` reads only the blocks it needs.

Texts are put in ascending order of ``doc_id`` (nulls first; equal ids by text) by a
range shuffle, so a task writes one file of neighbouring documents and file names
ascend with the ids. Files are written under a name of their own and then renamed: a
task that is run again, or twice, leaves the same file.

The encoder cuts texts before single blanks between other characters, where the
byte-level pattern always ends a word, so a block's distinct words are encoded once and
kept in a memory of the task that is bounded by bytes. Null and empty texts have the end id only. An
empty table gives no document and no error. Other columns are ignored. A text of any
length is one document; the block of text it is in grows to its size.
"""

from __future__ import annotations

import posixpath
import struct
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbline.llm.blocks import after_letters, coded, spread, strings, sums, text_blocks, text_bytes
from curbline.llm.bpe import tokenizer
from curbline.llm.frames import a_task_each, attempt_path, narrowed, open_fs, put_in_place, stored

MAGIC, VERSION = b"CTOK", 1
HEAD = struct.Struct("<4sHHQ")  # magic, version, bits of an id, ids in a block
BLOCK_IDS = 1 << 16
#: Bytes of words and ids that a task remembers; beyond, it forgets all but those of the present block.
REMEMBERED_BYTES = 32 << 20
#: Words that are encoded as one text, and words whose ids are Python lists at a time.
JOINED, AT_ONCE = 64, 4096


def bits_for(vocabulary: int) -> int:
    """The fewest bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """The ids, ``width`` bits each, lowest bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint64)[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    """``count`` ids from ``pack``."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little").reshape(count, width)
    return (bits.astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1).astype(np.uint32)


class Writer:
    """One file, written front to back; it holds less than a block of ids and the documents' sizes."""

    def __init__(self, out, width: int, block_ids: int = BLOCK_IDS):
        self.out, self.width, self.block_ids = out, width, block_ids
        self.at = out.write(HEAD.pack(MAGIC, VERSION, width, block_ids)) or HEAD.size
        self.places, self.doc_ids, self.sizes = [], [], []
        self.rest = np.empty(0, np.uint32)

    def add(self, doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.sizes += sizes.tolist()
        self.rest = np.concatenate((self.rest, ids.astype(np.uint32)))
        whole = len(self.rest) // self.block_ids * self.block_ids
        for begin in range(0, whole, self.block_ids):
            self._block(self.rest[begin : begin + self.block_ids])
        self.rest = self.rest[whole:].copy()

    def _block(self, ids: np.ndarray) -> None:
        body = pack(ids, self.width)
        self.places.append(self.at)
        self.out.write(body)
        self.at += len(body)

    def close(self) -> tuple[int, int]:
        """Documents and ids in the file."""
        if len(self.rest):
            self._block(self.rest)
        footer = b"".join(
            [
                struct.pack("<QQ", len(self.places), len(self.sizes)),
                np.array(self.places, "<u8").tobytes(),
                np.array([d or 0 for d in self.doc_ids], "<i8").tobytes(),
                np.array([d is None for d in self.doc_ids], np.uint8).tobytes(),
                np.array(self.sizes, "<u8").tobytes(),
            ]
        )
        self.out.write(footer + struct.pack("<Q", len(footer)))
        return len(self.sizes), int(sum(self.sizes))


class TokenFile:
    """A file opened for reading. ``source`` has read, seek and size."""

    def __init__(self, source):
        self.source = source
        _, _, self.width, self.block_ids = HEAD.unpack(self._read(0, HEAD.size))
        end = source.size() - 8
        (length,) = struct.unpack("<Q", self._read(end, 8))
        footer = self._read(end - length, length)
        blocks, documents = struct.unpack_from("<QQ", footer)
        at = 16
        columns = []
        for kind, count in (("<u8", blocks), ("<i8", documents), ("<u1", documents), ("<u8", documents)):
            columns.append(np.frombuffer(footer, kind, count, at))
            at += columns[-1].nbytes
        self.places, ids, null, sizes = columns
        self.doc_ids = [None if n else i for i, n in zip(ids.tolist(), null.tolist())]
        self.starts = np.concatenate(([0], np.cumsum(sizes.astype(np.int64))))

    def _read(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids numbered ``begin`` to ``end`` of the file, from their blocks alone."""
        found, step, total = [], self.block_ids, int(self.starts[-1])
        for block in range(begin // step, -(-end // step) if end > begin else 0):
            count = min(step, total - block * step)
            ids = unpack(self._read(int(self.places[block]), -(-count * self.width // 8)), self.width, count)
            found.append(ids[max(begin - block * step, 0) : end - block * step])
        return np.concatenate(found) if found else np.empty(0, np.uint32)

    def document(self, row: int) -> np.ndarray:
        return self.ids(int(self.starts[row]), int(self.starts[row + 1]))


#: A table over byte values: 1 for ASCII white space and the separators that some libraries count in.
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: First bytes of the UTF-8 forms of all other white space.
_DOUBT = np.zeros(256, bool)
_DOUBT[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def word_edges(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words begin: at each text, at a single blank between two characters that aren't white space, on
    both sides of such a line break, and between an ASCII letter and one of ``.,!?;:``.

    The byte-level pattern ends a word at all of these. Where a neighbour might be white
    space outside ASCII there is no edge; the word is longer then, and its ids are the same.
    """
    if len(data) < 3:
        return np.unique(offsets)
    at = np.flatnonzero((data[1:-1] == 32) | (data[1:-1] == 10)) + 1
    before, after = data[at - 1], data[at + 1]
    fine = ~(_BLANK[before] | _BLANK[after] | _DOUBT[after])
    tail = (before & 0xC0) == 0x80
    fine &= ~(tail & (_DOUBT[data[at - 2]] | _DOUBT[data[np.maximum(at - 3, 0)]]))
    at = at[fine]
    edge = after_letters(data)
    edge[at] = True
    edge[at[data[at] == 10] + 1] = True
    edge = np.append(edge, True)
    edge[offsets] = True
    return np.flatnonzero(edge)


@cache
def mark_between(path: str) -> tuple[str, int] | None:
    """A text that ends a word on either side and has an id of its own, with that id; none if the file has no such token."""
    known = tokenizer(path)
    added = known.get_added_tokens_decoder()
    if len(added) != 1 or known.normalizer is not None:
        return None
    ((number, token),) = added.items()
    # One that could begin within another would be found in its neighbour.
    whole = not any(token.content.startswith(token.content[k:]) for k in range(1, len(token.content)))
    apart = not (token.lstrip or token.rstrip or token.single_word or token.normalized)
    return (token.content, number) if whole and apart else None


def encode_words(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one after another, and the number of each word's.

    Words are encoded ``JOINED`` at a time with a mark between them, as most of a short
    text's time goes into what is done once for each text. Where a word has the mark's
    id itself, there are too many of them, and each word is encoded alone.
    """
    known, mark = tokenizer(path), mark_between(path)
    if mark is not None:
        content, number = mark
        texts = [content.join(words[k : k + JOINED]) for k in range(0, len(words), JOINED)]
        ids = listed_ids([e.ids + [number] for e in known.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(ids == number)
        if len(ends) == len(words):
            return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1
    found = [e.ids for e in known.encode_batch_fast(words, add_special_tokens=False)]
    return listed_ids(found), np.fromiter(map(len, found), np.int64, len(found))


def listed_ids(found: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(found), np.uint32)


class WordMemory:
    """Words with their ids. It belongs to one task and goes with it, and is bounded by bytes."""

    #: What Python needs for an entry besides the letters and ids.
    ENTRY = 200

    def __init__(self, limit: int = REMEMBERED_BYTES):
        self.limit, self.held = limit, 0
        self.known: dict[str, int] = {}
        #: The ids of all known words, one after another, and the number of each word's.
        self.ids, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64)

    def numbers(self, words: list[str], path: str) -> np.ndarray:
        """The number of each of these distinct words, which holds until the next call."""
        if self.held > self.limit:
            self._forget([w for w in words if w in self.known])
        new = [w for w in words if w not in self.known]
        ids, sizes = [self.ids], [self.sizes]
        for begin in range(0, len(new), AT_ONCE):
            found = encode_words(new[begin : begin + AT_ONCE], path)
            ids.append(found[0])
            sizes.append(found[1])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.held += self._bytes(new) + sum(part.nbytes for part in ids[1:])
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        return np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))

    def _forget(self, wanted: list[str]) -> None:
        """Leave these alone: those of the present block, which are likely to be in the next one too."""
        at = np.fromiter(map(self.known.__getitem__, wanted), np.int32, len(wanted))
        self.ids, self.sizes = self.of(at), self.sizes[at]
        self.known = dict(zip(wanted, range(len(wanted))))
        self.held = self._bytes(wanted) + self.ids.nbytes

    def _bytes(self, words: list[str]) -> int:
        return self.ENTRY * len(words) + sum(map(len, words))

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of words by their numbers, one after another."""
        begins = np.cumsum(self.sizes) - self.sizes
        return self.ids[spread(begins[numbers], self.sizes[numbers])]


def known_words(texts: pa.Array, path: str, memory: WordMemory) -> tuple[np.ndarray, np.ndarray]:
    """The number in ``memory`` of the word at each place, and the first place of each text."""
    data, offsets = text_bytes(texts)
    edges = word_edges(data, offsets)
    at, words = coded(strings(data, edges))
    numbers = memory.numbers(words.to_numpy(zero_copy_only=False).tolist(), path)
    # A text may be empty, so edges are looked up, not counted.
    return numbers[at], np.searchsorted(edges, offsets)


def encode_texts(texts: pa.Array, path: str, memory: WordMemory | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one after another, and the number of each text's."""
    memory = memory or WordMemory()
    at, places = known_words(texts, path, memory)
    return memory.of(at), sums(memory.sizes[at], places)


def count_texts(texts: pa.Array, path: str, memory: WordMemory | None = None) -> np.ndarray:
    """The number of each text's ids."""
    memory = memory or WordMemory()
    at, places = known_words(texts, path, memory)
    return sums(memory.sizes[at], places)


def write_task(path: str, folder: str, end_id: int, width: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = out = None
        memory = WordMemory()
        name = f"part-{TaskContext.get().partitionId():06d}.ctok"
        for batch in text_blocks(batches, "text"):
            if writer is None:
                filesystem, where = open_fs(folder)
                filesystem.create_dir(where, recursive=True)
                written = attempt_path(where, name)
                out = filesystem.open_output_stream(written)
                writer = Writer(out, width)
            ids, sizes = encode_texts(batch.column("text"), path, memory)
            ends = np.cumsum(sizes)
            writer.add(batch.column("doc_id").to_pylist(), sizes + 1, np.insert(ids, ends, end_id))
        if writer is not None:
            documents, total = writer.close()
            out.close()
            put_in_place(filesystem, written, posixpath.join(where, name))
            yield pa.RecordBatch.from_pydict(
                {"file": [f"{folder}/{name}"], "documents": pa.array([documents], pa.int64()), "ids": pa.array([total], pa.int64())}
            )

    return write


def write_ids(docs: DataFrame, path: str, folder: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Files of the ids below ``folder``; returns their table: ``file``, ``documents``, ``ids``."""
    width = bits_for(tokenizer(path).get_vocab_size(with_added_tokens=True))
    rows = narrowed(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    # Rows of one id, or of none, are cut by the beginnings of their texts.
    ordered = rows.repartitionByRange("doc_id", F.left("text", F.lit(64))).sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(write_task(path, folder, end_id, width), "file string, documents long, ids long"), "token-files")


def read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
            filesystem, where = open_fs(name)
            with filesystem.open_input_file(where) as source:
                file = TokenFile(source)
                yield from file_rows(file, base)


def file_rows(file: TokenFile, base: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    starts, row = file.starts, 0
    while row < len(file.doc_ids):
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + most, side="right")) - 1)
        ids = file.ids(int(starts[row]), int(starts[end])).astype("<u4")
        places = ((starts[row : end + 1] - starts[row]) * 4).astype(np.int32)
        body = pa.BinaryArray.from_buffers(pa.binary(), end - row, [None, pa.py_buffer(places), pa.py_buffer(ids)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(file.doc_ids[row:end], pa.int64()), pa.array(base + starts[row:end]), pa.array(np.diff(starts[row : end + 1])), body],
            names=["doc_id", "start", "n_tokens", "ids"],
        )
        row = end


def read_ids(spark: SparkSession, files: DataFrame) -> DataFrame:
    """All documents of the files: ``doc_id``, ``start`` (ids in documents before it), ``n_tokens`` and
    ``ids`` (little-endian, 32 bits each).

    The running sum is over one row for each file.
    """
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return a_task_each(placed).mapInArrow(read_task, "doc_id long, start long, n_tokens long, ids binary")
