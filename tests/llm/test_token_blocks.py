import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tickloom.llm import token_blocks as tb
from tickloom.llm.registry import QUERIES, WORD_BPE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORD_BPE)
    t.encode_special_tokens = True
    return t


def expected(library, rows):
    start, out = 0, []
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(40_000, 40_010), max_size=700), st.integers(0, 600))
def test_blocks_round_trip(ids, at):
    ids = np.array(ids, np.uint32)
    segment = tb.pack([5, None], np.array([1, max(0, ids.size - 1)], np.uint32), ids)
    docs, back = tb.unpack(segment)
    assert back.tolist() == ids.tolist() and docs["null"].tolist() == [0, 1]
    assert tb.seek(segment, at, 130).tolist() == ids[at : at + 130].tolist()


def test_outliers_are_exceptions():
    ids = np.full(128, 7, np.uint32)
    ids[[3, 99]] = 49_000
    docs, n, index, patches, body = tb._parts(tb.pack([1], np.array([128]), ids))
    assert index["width"].tolist() == [0] and patches["at"].tolist() == [3, 99] and body.size == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n'stmdrevlİéÀ²½ªſ\x1c\x85\xa0\xad_9."), st.characters(codec="utf-8"), st.characters(max_codepoint=0x24F)), max_size=60))
def test_equals_the_library_on_any_text(library, text):
    assert tb.encoder(WORD_BPE).encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_every_latin_character(library):
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}b", f"1{c} .{c}'", f"{c}{c} Σ{c}"):
            assert tb.encoder(WORD_BPE).encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids, hex(ord(c))


def test_awkward_rows(spark, awkward, no_rows, library, tmp_path):
    tb.write(awkward, str(tmp_path / "a"), WORD_BPE, 2)
    got = [tuple(r) for r in tb.digests(tb.read(spark, str(tmp_path / "a"))).orderBy("start").collect()]
    rows = sorted(((r.doc_id, r.text) for r in awkward.collect()), key=lambda r: (r[0] is not None, r[0]))
    assert got == expected(library, rows)
    tb.write(no_rows, str(tmp_path / "b"), WORD_BPE, 2)
    assert tb.read(spark, str(tmp_path / "b")).count() == 0


def test_query_equals_the_library(spark, library):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted(tuple(r) for r in QUERIES["op9_token_blocks"](spark, SF).collect())
    assert got == expected(library, rows)


def test_ascii_texts_are_not_searched_by_the_pattern(library, monkeypatch):
    class Refuses:
        def search(self, text):
            raise AssertionError("the pattern was asked for an ASCII text")

    monkeypatch.setattr(tb, "_RARE", Refuses())
    some = ["plain words, it's 2", "a\x1cb \x1f c", ""]
    assert [x.tolist() for x in tb.encoder(WORD_BPE).encode(some)] == [library.encode(t, add_special_tokens=False).ids for t in some]
