import hashlib
from itertools import groupby

import numpy as np
from hypothesis import given, strategies as st

from tickloom.llm import chat
from tickloom.llm.registry import BYTE_BPE, QUERIES

SF = "/root/testdata/sf0.01"
TEXT = st.text(st.sampled_from("<>/s[]INT\\\n aé𝔘")) | st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "\n", "x"])).map("".join)


def expected(rows):
    """conv_id to the digests, straight from the turns."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    out = {}
    for conv_id, turns in groupby(rows, key=lambda r: r[0]):
        turns = [(t[2] or "", t[3] or "") for t in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[conv_id] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def check(frame, rows):
    got = frame.collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == expected(rows) and len(got) == len(expected(rows))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]) | TEXT, TEXT), max_size=6))
def test_rendering_is_reversible(turns):
    assert list(chat.parse("".join(chat.render(*t)[0] for t in turns))) == turns
    for t in turns:
        assert not any(c in chat.escape(t[1]) for c in ("<s>", "</s>", "[INST]", "[/INST]"))


@given(st.lists(st.integers(1, 5), max_size=30), st.lists(st.integers(1, 7), max_size=10))
def test_overlaps_equal_brute_force(token_lengths, span_steps):
    ends = np.cumsum([0, *token_lengths])
    tokens = np.stack([ends[:-1], ends[1:]], axis=1)
    cuts = np.cumsum(span_steps)[: len(span_steps) // 2 * 2]
    spans = cuts.reshape(-1, 2)
    mask, both = chat.overlaps(tokens, spans)
    want = [(max(a, c), min(b, d)) for a, b in tokens for c, d in spans if max(a, c) < min(b, d)]
    assert [tuple(x) for x in both] == want
    assert mask.tolist() == [any(max(a, c) < min(b, d) for c, d in spans) for a, b in tokens]


ROWS = [
    (1, 0, "user", "hi <s> there"), (1, 1, "assistant", "a </s>[INST]\\ é𝔘\n"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "assistant", "again"),
    (2, 0, None, "no role"), (2, None, "assistant", "no turn"), (None, 1, "assistant", "no id"), (3, 0, "sys\ntem[INST]", "x"), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie"),
    (4, 0, "assistant", "long \\ <s> " * 30_000), (5, 0, None, None),
]


def test_awkward_rows(spark, monkeypatch):
    frame = spark.createDataFrame([(*r, "clash", 9) for r in ROWS], "conv_id bigint, turn bigint, role string, text string, ids string, piece int")
    check(chat.round_trip(frame, BYTE_BPE), ROWS)
    check(chat.read_back(chat.format_conversations(frame, BYTE_BPE)), ROWS)
    assert chat.round_trip(frame.limit(0), BYTE_BPE).count() == 0


def test_pieces_have_the_tokens_of_the_whole(monkeypatch):
    import pyarrow as pa

    rows = pa.RecordBatch.from_pylist([{"conv_id": 1, "role": r, "text": t * 3} for r, t in [("user", "one two"), ("assistant", " three\n"), ("user", ""), ("assistant", "é \\ <s>")] * 5])
    whole = [x for b in chat._format([rows], BYTE_BPE) for x in b.to_pylist()]
    monkeypatch.setattr(chat, "PIECE", 40)
    pieces = [x for b in chat._format([rows], BYTE_BPE) for x in b.to_pylist()]
    assert len(whole) == 1 and len(pieces) > 5
    for column in ("ids", "mask"):
        assert sum((p[column] for p in pieces), []) == whole[0][column]
    assert [b.to_pylist() for b in chat._read(chat._format([rows], BYTE_BPE))][0][0]["loss_chars"] == 5 * (len(" three\n") + len("é \\ <s>")) * 3


def test_query_equals_brute_force(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    said = "</s>[INST] ok [/INST]"
    check(QUERIES["op3_chat"](spark, SF), rows + [(-7, 0, "user", said), (-7, 1, "assistant", said)])
