"""Arrow text columns as byte arrays, cut into blocks of bounded size, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task holds as arrays at a time; a longer document is a block of its own.
BLOCK_BYTES = 8 << 20


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, and where each text starts and the last one ends.

    A null counts as an empty text.
    """
    texts = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    if not len(offsets):
        return whole[:0], np.zeros(1, np.int64)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_blocks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in batches of at most ``limit`` bytes of text.

    Small batches are put together and large ones cut; a row is never cut.
    """
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        begin = 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                if row > begin:
                    waiting.append(batch.slice(begin, row - begin))
                yield joined(waiting)
                waiting, held, begin = [], 0, row
            held += size
        if begin < batch.num_rows:
            waiting.append(batch.slice(begin))
    if waiting:
        yield joined(waiting)


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    whole = pa.Table.from_batches(batches).combine_chunks().to_batches()
    return whole[0] if whole else batches[0]


def strings(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The pieces of ``data`` between neighbouring ``edges``, as strings, without a copy of the bytes."""
    return pa.LargeStringArray.from_buffers(
        len(edges) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )


WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def words(data: np.ndarray, offsets: np.ndarray, also: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """The runs without ASCII white space of all texts, and for each text the number of those before it.

    ``also`` marks bytes at which another word begins.
    """
    return runs(data, offsets, ~WHITE[data], also)


def runs(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray, also: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """The runs of ``solid`` bytes of all texts, and for each text the number of those before it."""
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[begins] = solid[begins]
    if also is not None:
        first |= solid & also
    starts = np.flatnonzero(first)
    # A start's place among the bytes that stay: its number less those that go before it.
    blanks = np.flatnonzero(~solid)
    places = starts - np.searchsorted(blanks, starts)
    return strings(data[solid], np.append(places, len(data) - len(blanks))), np.searchsorted(starts, offsets)


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,!?;:")] = True


def after_letters(data: np.ndarray) -> np.ndarray:
    """Where an ASCII letter is followed by one of ``.,!?;:``."""
    found = np.zeros(len(data), bool)
    found[1:] = _MARK[data[1:]] & _LETTER[data[:-1]]
    return found


def coded(pieces: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each piece the number of its text, and the distinct texts in order of first use."""
    found = pieces.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def hashed(words: list[str]) -> np.ndarray:
    """64-bit hash values of texts, the same in every process."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of all runs ``starts[i] .. starts[i] + sizes[i]``, one run after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


def sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The sum of ``values`` between neighbouring ``edges``."""
    if values.dtype == bool:
        return np.diff(np.searchsorted(np.flatnonzero(values), edges))
    running = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return running[edges[1:]] - running[edges[:-1]]


def lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    edges = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(values, kind))


def packed(values: np.ndarray) -> bytes:
    """Numbers as one compressed column value: first all their lowest bytes, then the next ones, and so on."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, kind, count: int) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(pa.decompress(data, count * kind.itemsize, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, count).T).view(kind).ravel()


def narrow_kind(largest: int) -> np.dtype:
    """The smallest unsigned type that holds ``largest``."""
    return next(np.dtype(k) for k in (np.uint8, np.uint16, np.uint32, np.uint64) if largest <= np.iinfo(k).max)
