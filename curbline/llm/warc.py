"""WARC archives from and to chunked record tables.

A record is rows of (record, chunk number, bytes), the last of which carries its length
and SHA-1 digest. The digest grows chunk by chunk, and so do the archive's
compressed bytes: writer and reader hold one chunk of ``CHUNK_BYTES`` and not a record.

Writing. Records of equal payloads of at least ``REVISIT_BYTES`` are found by an
aggregation over digests and lengths: the one with the largest id is the response,
all others are revisits of it. Where a record goes is a row that sorts before its
chunks, so each task streams its records to one archive, a gzip member a record. A
revisit's chunks end there: an archive has its HTTP head alone, with the length that the
payload has, as crawlers write it. Archives get their names when they are complete; a
task that is run again leaves the same archive.

Reading. Tasks stream their archives and yield chunk rows, or, from ``read_records``, one
row for each record with the digest that its bytes have.

A null payload is an empty one; a null url leaves out the address. Rows that repeat an id
are records of their own. Of equal payloads with one largest id several times, one is the response.
Rows without id are records without id; they are responses only where no equal payload has an id. An empty table gives no archive and
an empty table. Other columns are ignored. A payload of any length is one value of its
row, but is never copied as a whole.
"""

from __future__ import annotations

import base64
import posixpath
import zlib
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm.frames import a_task_each, attempt_path, narrowed, open_fs, put_in_place, stored

CHUNK_BYTES = 1 << 18
REVISIT_BYTES = 1000
#: Chunk number of the row that says what a record is; all chunks come after it.
DECISION = -1
END = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = "record long, chunk int, page_id long, url string, data binary, length long, digest string"
CHUNKS_ARROW = pa.schema(
    [
        ("record", pa.int64()), ("chunk", pa.int32()), ("page_id", pa.int64()), ("url", pa.string()), ("data", pa.binary()),
        ("length", pa.int64()), ("digest", pa.string()),
    ]
)
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
RECORDS_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ]
)
#: Bytes of chunks that a task gives out at a time.
BATCH_BYTES = 8 << 20


def batched(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    waiting, held = [], 0
    for row in rows:
        waiting.append(row)
        held += 200 + len(row.get("data") or b"")
        if held > BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(waiting, schema=schema)
            waiting, held = [], 0
    if waiting:
        yield pa.RecordBatch.from_pylist(waiting, schema=schema)


def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """A record's chunks in order; the last one has the digest that has grown until then."""
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        payloads = pc.cast(batch.column("payload"), pa.binary())
        for page_id, url, payload in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), payloads):
            body = memoryview(payload.as_buffer() or b"")
            digest, number = sha1(), number + 1
            for chunk, begin in enumerate(range(0, len(body) or 1, CHUNK_BYTES)):
                data = bytes(body[begin : begin + CHUNK_BYTES])
                digest.update(data)
                last = begin + CHUNK_BYTES >= len(body)
                yield {
                    "record": number, "chunk": chunk, "page_id": page_id, "url": url, "data": data,
                    "length": len(body) if last else None, "digest": digest.hexdigest() if last else None,
                }


def chunk_table(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """The written table of all chunks. Strings are chunks of their UTF-8 bytes."""
    rows = narrowed(pages, page_id=page_id, url=url, payload=payload).withColumn("page_id", F.col("page_id").cast("long"))
    return stored(rows.mapInArrow(lambda batches: batched(chunk_rows(batches), CHUNKS_ARROW), CHUNKS), "chunks", compression="zstd")


def decisions(chunks: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``record``, its ``digest`` and ``length``, and for revisits ``refers_to``, the id of the response.

    A payload with a third of all records is one row of the aggregation for each task.
    """
    whole = chunks.where("digest is not null").select("record", "page_id", "digest", "length")
    # Ids before none, then large before small ids; of one id the first record.
    best = F.max(F.struct(F.col("page_id").isNotNull(), F.coalesce("page_id", F.lit(0)), -F.col("record")))
    found = whole.where(F.col("length") >= least).groupBy("digest", "length").agg(best.alias("best"), F.count("*").alias("n"))
    several = stored(
        found.where("n > 1").select("digest", "length", (-F.col("best.col3")).alias("first"), F.when(F.col("best.col1"), F.col("best.col2")).alias("to")),
        "payloads",
    )
    return whole.join(several, ["digest", "length"], "left").select(
        "record", "digest", "length", (F.col("record") != F.col("first")).alias("revisit"), F.col("to").alias("refers_to")
    )


def record_name(page_id: int | None, record: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{record if record is not None else ''}>"


def head(fields: list[tuple[str, str]], first: str) -> bytes:
    return END.join([first.encode(), *(f"{k}: {v}".encode() for k, v in fields)]) + END + END


def http_head(length: int) -> bytes:
    return head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(length))], "HTTP/1.1 200 OK")


class Archive:
    """An archive that is written record by record, each a gzip member, from chunks."""

    def __init__(self, out):
        self.out, self.records = out, 0

    def begin(self, row: dict) -> None:
        self.member = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.revisit = bool(row["revisit"])
        http = http_head(row["length"])
        fields = [
            ("WARC-Type", "revisit" if self.revisit else "response"),
            ("WARC-Record-ID", record_name(row["page_id"], row["record"])),
            ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(http) + (0 if self.revisit else row["length"]))),
        ]
        if row["url"] is not None:
            fields.append(("WARC-Target-URI", " ".join(row["url"].split())))
        if self.revisit:
            fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_name(row["refers_to"], None))]
        self.out.write(self.member.compress(head(fields, "WARC/1.1") + http))

    def chunk(self, data: bytes) -> None:
        if not self.revisit:
            self.out.write(self.member.compress(data))

    def end(self) -> None:
        self.out.write(self.member.compress(END + END) + self.member.flush())
        self.records += 1


def write_task(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, known, open_record = None, None, None
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in ("record", "chunk", "page_id", "url", "length", "digest", "revisit", "refers_to")}
                if row["chunk"] == DECISION:
                    known = row
                    continue
                if archive is None:
                    filesystem, where = open_fs(folder)
                    filesystem.create_dir(where, recursive=True)
                    written = attempt_path(where, name)
                    archive = Archive(filesystem.open_output_stream(written))
                if open_record != row["record"]:
                    if open_record is not None:
                        archive.end()
                    open_record = row["record"]
                    archive.begin({**known, "page_id": row["page_id"], "url": row["url"]})
                archive.chunk(batch.column("data")[at].as_buffer())
        if archive is not None:
            archive.end()
            archive.out.close()
            put_in_place(filesystem, written, posixpath.join(where, name))
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "records": pa.array([archive.records], pa.int64())})

    return write


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Archives below ``folder`` from a table of chunks; returns their table: ``file``, ``records``."""
    what = decisions(chunks).withColumn("chunk", F.lit(DECISION))
    parts = chunks.select("record", "chunk", "page_id", "url", "data")
    rows = parts.unionByName(what, allowMissingColumns=True).repartition("record").sortWithinPartitions("record", "chunk")
    return stored(rows.mapInArrow(write_task(folder), "file string, records long"), "archives")


class Stream:
    """The uncompressed bytes of an archive, a bounded part at a time."""

    def __init__(self, source):
        self.source, self.member, self.held, self.rest = source, zlib.decompressobj(31), bytearray(), b""

    def _more(self) -> bool:
        while True:
            if self.member.eof:
                self.rest, self.member = self.member.unused_data, zlib.decompressobj(31)
            data = self.rest or self.source.read(CHUNK_BYTES)
            if not data:
                return False
            # Small input may be large output; what doesn't fit is given again.
            found = self.member.decompress(data, CHUNK_BYTES)
            self.rest = self.member.unconsumed_tail
            if found:
                self.held += found
                return True

    def line(self) -> bytes | None:
        while (at := self.held.find(END)) < 0:
            if not self._more():
                return None
        found = bytes(self.held[:at])
        del self.held[: at + 2]
        return found

    def part(self, most: int) -> bytes:
        if not self.held and not self._more():
            raise EOFError("an archive ends within a record")
        found = bytes(self.held[:most])
        del self.held[:most]
        return found

    def fields(self) -> dict[str, str]:
        found = {}
        while line := self.line():
            name, _, value = line.decode().partition(":")
            found[name.lower()] = value.strip()
        return found


def records(source) -> Iterator[tuple[dict[str, str], int, Iterator[bytes]]]:
    """The records of an archive: WARC fields, the payload's full length, and the chunks of what is there of it."""
    stream = Stream(source)
    while (line := stream.line()) is not None:
        if not line:
            continue
        fields = stream.fields()
        left = int(fields["content-length"])
        first = stream.line()
        http = stream.fields()
        left -= len(first) + 2 + sum(len(f"{k}: {v}".encode()) + 2 for k, v in http.items()) + 2

        def body(left=left):
            while left > 0:
                data = stream.part(min(left, CHUNK_BYTES))
                left -= len(data)
                yield data

        chunks = body()
        yield fields, int(http["content-length"]), chunks
        for _ in chunks:  # what the caller left
            pass


def named_page(name: str) -> int | None:
    number = name.strip("<>").split(":")[2]
    return int(number) if number else None


def record_rows(files: list[str]) -> Iterator[dict]:
    for name in files:
        filesystem, where = open_fs(name)
        with filesystem.open_input_stream(where, compression=None) as source:
            for fields, length, chunks in records(source):
                revisit, digest, there = fields["warc-type"] == "revisit", sha1(), 0
                for data in chunks:
                    digest.update(data)
                    there += len(data)
                stated = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                if not revisit and (digest.hexdigest(), there) != (stated, length):
                    raise ValueError(f"{name}: {fields['warc-record-id']} isn't what its head says")
                yield {
                    "page_id": named_page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
                    "refers_to": named_page(fields["warc-refers-to"]) if revisit else None, "payload_bytes": length, "payload_digest": stated,
                }


def read_records(files: DataFrame) -> DataFrame:
    """One row for each record of the archives; a response that differs from its digest is an error."""
    def read(batches):
        for batch in batches:
            yield from batched(record_rows(batch.column("file").to_pylist()), RECORDS_ARROW)

    return a_task_each(files.select("file")).mapInArrow(read, RECORDS)


def read_chunks(files: DataFrame) -> DataFrame:
    """The chunks of all responses: ``page_id``, ``file``, ``place`` of the record in it, ``chunk`` and ``data``."""
    def rows(names):
        for name in names:
            filesystem, where = open_fs(name)
            with filesystem.open_input_stream(where, compression=None) as source:
                for place, (fields, _, chunks) in enumerate(records(source)):
                    for chunk, data in enumerate(chunks):
                        yield {"page_id": named_page(fields["warc-record-id"]), "file": name, "place": place, "chunk": chunk, "data": data}

    schema = pa.schema([("page_id", pa.int64()), ("file", pa.string()), ("place", pa.int64()), ("chunk", pa.int32()), ("data", pa.binary())])

    def read(batches):
        for batch in batches:
            yield from batched(rows(batch.column("file").to_pylist()), schema)

    return a_task_each(files.select("file")).mapInArrow(read, "page_id long, file string, place long, chunk int, data binary")
