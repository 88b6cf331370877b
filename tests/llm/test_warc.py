"""Archives: what is written comes back, with plain rules for revisits."""

import gzip
import hashlib

import pytest

from curbline.llm import warc
from curbline.llm.frames import open_fs
from curbline.session import new_work_dir

BIG = "long é " * 200_000
PAGES = [
    (1, "u", BIG), (2, "u", BIG), (2, "u", BIG), (3, None, "é" * 500), (4, "http://a b\nc", "é" * 500), (5, "", "x" * 999), (6, "", "x" * 999),
    (7, None, None), (8, None, ""), (None, "n", "q" * 2000), (None, "m", "q" * 2000), (9, "k", "r" * 1000), (None, "k", "r" * 1000),
    (10, "w", "\r\n\r\nWARC/1.1\r\n" * 100),
]


def expected(pages):
    groups, found = {}, []
    for page, _, html in pages:
        groups.setdefault((html or "").encode(), []).append(page)
    for body, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        for place, page in enumerate(ids):
            again = place > 0 and len(body) >= 1000
            found.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", ids[0] if again else None))
    return sorted(found, key=str)


@pytest.fixture
def archives(spark, with_clashes):
    pages = with_clashes(spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3))
    return warc.write_archives(warc.chunk_table(pages), new_work_dir(spark, "warc"))


def test_records_come_back(archives):
    rows = warc.read_records(archives).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == expected(PAGES)
    assert "http://a b c" in {r.url for r in rows}


def test_chunks_are_bounded_and_whole(archives):
    bodies = {}
    for r in warc.read_chunks(archives).orderBy("file", "place", "chunk").collect():
        assert len(r.data) <= warc.CHUNK_BYTES
        bodies[r.file, r.place] = bodies.get((r.file, r.place), b"") + bytes(r.data)
    there = sorted((d for _, n, d, kind, _ in expected(PAGES) if kind == "response" and n))
    assert sorted(hashlib.sha1(b).hexdigest() for b in bodies.values()) == there


def content(uri):
    store, where = open_fs(uri)
    with store.open_input_stream(where, compression=None) as file:
        return file.read()


def test_archives_are_gzip_members_of_plain_records(archives):
    for row in archives.collect():
        text = gzip.decompress(content(row.file))
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")


def test_a_changed_payload_is_an_error(archives, tmp_path):
    text = gzip.decompress(content(archives.orderBy("file").first().file))
    whole, changed = tmp_path / "whole.warc.gz", tmp_path / "changed.warc.gz"
    whole.write_bytes(gzip.compress(text))
    assert list(warc.record_rows([str(whole)]))
    at, response = 0, None
    for part in text.split(b"WARC/1.1\r\n")[1:]:  # the first record with a payload
        at = text.index(part, at)
        if b"WARC-Type: response" in part and b"Content-Length: 0\r\n" not in part.split(b"HTTP/1.1")[1][:200]:
            response = text.index(b"\r\n\r\n", text.index(b"HTTP/1.1", at)) + 4
            break
    changed.write_bytes(gzip.compress(text[:response] + bytes([text[response] ^ 1]) + text[response + 1 :]))
    with pytest.raises(ValueError):
        list(warc.record_rows([str(changed)]))


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    files = warc.write_archives(warc.chunk_table(pages), new_work_dir(spark, "warc"))
    assert files.count() == 0 and warc.read_records(files).count() == 0 and warc.read_chunks(files).count() == 0
