"""Alignment of two tokenizers against the libraries and a walk over all bytes."""

import hashlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as entry
from curbline.llm import alignment, parcels
from curbline.llm.frames import table

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@cache
def tools():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    known = alignment.Pair(A, B)
    return a, b, known.bytes_a, known.bytes_b


def tokens(text):
    """Ids and bytes of both sides, or nothing."""
    a, b, bytes_a, bytes_b = tools()
    if not text:
        return [], [], [], []
    own, other = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    parts, others = [bytes_a[i] for i in own], [bytes_b[i] for i in other]
    if {b"".join(parts), b"".join(others)} != {(" " + text).encode()}:
        return [], [], [], []
    return own, other, parts, others


def walk(text):
    """Ids, linked ids (in order) and groups, from the token over each byte."""
    a, b, parts, others = tokens(text)
    over = [[i for i, part in enumerate(side) for _ in part] for side in (parts, others)]
    links = list(dict.fromkeys(zip(*over)))
    groups, last = [], 0
    for at in range(len(over[0])):
        if at + 1 == len(over[0]) or (over[0][at] != over[0][at + 1] and over[1][at] != over[1][at + 1]):
            own = [list(dict.fromkeys(side[last : at + 1])) for side in over]
            groups.append("|".join(",".join(str(ids[i]) for i in side) for ids, side in zip((a, b), own)))
            last = at + 1
    return a, b, [(a[i], b[j]) for i, j in links], groups


def plain(rows):
    found = [(i, *walk(text)) for i, text in rows]
    counts = Counter(link for *_, links, _ in found for link in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (i, len(a), len(b), len(groups), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), ";".join(groups))
        for i, a, b, links, groups in found
    ]


def ordered(rows):
    return sorted(rows, key=str)


def test_odd_rows(spark, odd_docs, odd_texts):
    got = alignment.align(odd_docs, A, B).collect()
    assert ordered(map(tuple, got)) == ordered(plain(odd_texts))


def test_mismatching_texts_have_no_tokens(spark):
    rows = [(1, "a ▁ b"), (2, "fine text"), (3, "fine text"), (4, "▁"), (5, " "), (6, "  x  "), (7, "\n"), (8, "<|endoftext|> <s>"), (9, "\x00 nul")]
    got = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()
    assert ordered(map(tuple, got)) == ordered(plain(rows))
    assert {r.doc_id for r in got if r.n_a == 0} == {1, 4}


def test_no_rows(no_docs):
    assert alignment.align(no_docs, A, B).count() == 0


def test_joining_tokenizers_are_refused(monkeypatch):
    known = alignment.Pair(A, B)
    known.bytes_b = [*known.bytes_b, b"two words"]
    with pytest.raises(ValueError):
        known.check_pieces()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcZé .,!?\n\t\r'<|>s  　\u0085́漢ß9▁\x00\U0001f600")), max_size=50))
@example("word.Next,one\nline  two \n\n x")
def test_pieces_have_the_ids_of_the_text(text):
    a, b, parts, others = tokens(text)
    pieces, edges = alignment.cut(pa.array([text, None, ""]))
    assert edges.tolist() == [0, len(pieces), len(pieces), len(pieces)]
    kept = alignment.encoded(A, B)(pieces)
    block = alignment.Block(parcels.Parcel(0, pa.array([1, None, 3]), edges, np.arange(len(pieces)), kept), A, B)
    own, other, links, groups = walk(text)
    assert block.fine.tolist() == [bool(own), False, False]
    if own:
        assert ";".join(block.group_texts().to_pylist()) == ";".join(groups)
        assert block.links.tolist() == [x << 32 | y for x, y in links]
        assert (block.ids_a.tolist(), block.ids_b.tolist(), len(block.last_a)) == (own, other, len(groups))


def test_query_equals_the_walk(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    expected = [(*row, hashlib.sha256(groups.encode()).hexdigest() if groups else "") for *row, groups in plain(rows)]
    assert ordered(tuple(r) for r in entry.queries()["op13_alignment"](spark, sf_dir).collect()) == ordered(expected)
