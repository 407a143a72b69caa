import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from tickloom.llm import bpe
from tickloom.llm.registry import BPE_RANKS, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coder():
    return bpe.Codec(BPE_RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.replay.ranks, special_tokens={})


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r'aAé1.ſ\x1c\x85 ́"), st.characters(codec="utf-8")), max_size=60))
def test_equals_the_library_on_any_text(coder, library, text):
    ids = coder.encode([text])[0].tolist()
    assert ids == library.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


def test_every_assigned_character(coder, library):
    for start in range(0, 0x20000, 64):
        text = "a".join(chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert coder.encode([text])[0].tolist() == library.encode_ordinary(text), hex(start)


@pytest.mark.parametrize("few", [0, 12])
def test_lower_rank_arising_from_a_merge_goes_first(monkeypatch, few):
    monkeypatch.setattr(bpe, "_FEW", few)
    ranks = {bytes([b]): 10 + b for b in range(256)} | {b"bcd": 0, b"bc": 1, b"ab": 2}
    toy = tiktoken.Encoding("toy", pat_str=r"[a-d]+", mergeable_ranks=ranks, special_tokens={})
    replay = bpe.MergeReplay(ranks)
    for _ in range(300):
        words = ["".join(random.choices("abcd", k=random.randint(1, 24))) for _ in range(9)]
        ids, counts = replay.encode([w.encode() for w in words])
        ends = counts.cumsum()
        assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [toy.encode_ordinary(w) for w in words]


def test_long_text_is_cut_without_a_trace(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "_STRETCH", 7)
    for text in ("one two  three \n four five six seven", " lead and trail ", "nospacesatallinhere"):
        assert coder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_awkward_rows(awkward, no_rows, library):
    got = sorted(map(tuple, bpe.digests(bpe.round_trip(awkward, BPE_RANKS, P.PATTERN)).collect()), key=str)
    assert got == sorted([(r.doc_id, *expected(library, r.text)) for r in awkward.collect()], key=str)
    assert bpe.round_trip(no_rows, BPE_RANKS, P.PATTERN).count() == 0
    separate = bpe.decode(bpe.encode(awkward, BPE_RANKS, P.PATTERN), BPE_RANKS, P.PATTERN)
    assert sorted(map(tuple, bpe.digests(separate).collect()), key=str) == got


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op6_bpe"](spark, SF).collect()}
    assert got == {i: expected(library, t) for i, t in texts.items()}


def test_table_of_known_words_shrinks_without_a_trace(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "_KNOWN", 40)
    monkeypatch.setattr(bpe, "_KNOWN_CHARACTERS", 300)
    monkeypatch.setattr(bpe, "_FREQUENT", 9)
    rng = random.Random(3)
    for _ in range(60):
        texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 20) + str(rng.randint(0, 30)) for _ in range(rng.randint(0, 30))) for _ in range(3)]
        assert [x.tolist() for x in coder.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_few_places_need_no_array_operations(monkeypatch):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"cd": 258}
    replay = bpe.MergeReplay(ranks)

    def refuse(*_):
        raise AssertionError("an array operation for a few places")

    monkeypatch.setattr(bpe.np, "unique", refuse)
    monkeypatch.setattr(replay, "_merge_at_once", refuse)
    ids, counts = replay.encode([b"abcd", b"xabab", b"cdcd"])
    assert ids.tolist() == [257, 100, 120, 256, 256, 258, 258] and counts.tolist() == [2, 3, 2]
