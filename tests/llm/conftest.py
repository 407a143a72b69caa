"""Small documents with every awkward shape."""

import pytest

AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog."),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "  two  spaces \n\n and\ttabs \r\n end  "),
    (6, "naïve Ünïcödé 𝔘𝔫𝔦 漢字かな العربية é é \x1c\x1d\x85\xa0 x"),
    (7, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"),
    (8, "word " * 40_000),
    (9, "The quick brown fox jumps over the lazy dog."),
    (9, "The quick brown fox jumps over the lazy dog."),
    (None, "no id here, but some text"),
    (10, "it's we've I'll 'tis 12345 3.14 <|endoftext|> \x00 ___ ...!!! İΣΑΣ"),
    (11, "x" * 100_000),
]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(i, t, "en", None, -1, "clash", i) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, _keep bigint").repartition(3)


@pytest.fixture(scope="session")
def no_rows(awkward):
    return awkward.limit(0)
