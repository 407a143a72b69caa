import gzip
import re

import duckdb
import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from tickloom.llm import warc
from tickloom.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    assert not differences(QUERIES["op10_warc"](spark, SF), connect(SF), ORACLES["op10_warc"])


@pytest.mark.parametrize(
    "html,text",
    [
        ('<p>a<!-- <p>no</p> --><script>var t="</p>";</script>b</p><style>p{}</style>c', "a b\nc"),
        ("<div>x &lt;b&gt; &amp;lt; y</div>\n\n  <br/>z", "x <b> &lt; y\nz"),
        ("1 < 2 and <i>3</i> > 2", "1 < 2 and 3 > 2"),
        ("<!-- never closed <p>a", "<!-- never closed\na"),
        ("", ""),
        ("a &eacute; &#8217; &#x1F600; &bogus; &#0; &#xD800; &#1114112; & &amp;lt; x&nbsp;&nbsp;y &", "a é ’ 😀 &bogus; &#0; &#xD800; &#1114112; & &lt; x y &"),
    ],
)
def test_plain_text(spark, html, text):
    assert spark.range(1).select(warc.plain_text(F.lit(html))).first()[0] == text


def test_awkward_rows(spark):
    rows = [
        (1, "http://a/", "<title>T &amp; U</title><a href=\"/x\">x</a>", "clash"),
        (2, None, None, None),
        (None, "http://b/\r\nWARC-Type: evil", "", ""),
        (1, "http://a/", "<title>T &amp; U</title><a href=\"/x\">x</a>", "clash"),
        (4, "u", "<p>" * 200_000, "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, block string")
    found = warc.serialized(warc.derive(warc.responses(pages, "2020-01-01T00:00:00Z"), "page_id")).collect()
    assert len(found) == 2 * len(rows)
    for r in found:
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        assert body == r.block.encode() + b"\r\n\r\n" and f"Content-Length: {len(r.block.encode())}".encode() in head
        assert head.count(b"WARC-Type:") == 1 + (b"evil" in head) and re.search(rb"^WARC-Refers-To: <urn:uuid:[0-9a-f-]{36}>", head, re.M)
        assert sum(x.startswith(b"WARC-Type:") for x in head.split(b"\r\n")) == 1
    meta = next(r.block for r in found if r.page_id == 1 and r.warc_type == "metadata")
    assert "title: T & U\r\n" in meta and "outlink: /x\r\n" in meta and "source-header: HTTP/1.1 200 OK" in meta
    assert {r.refers_to for r in found if r.page_id == 1} == {next(r.refers_to for r in found if r.page_id == 1)}
    assert warc.derive(warc.responses(pages.limit(0), "d")).count() == 0


def test_response_without_header_end(spark):
    raw = spark.createDataFrame([("r", "u", "d", "no header end here")], "record_id string, target_uri string, date string, block string")
    assert [r.block for r in warc.derive(raw).collect() if r.warc_type == "conversion"] == [""]


LINKS = """<HTML class='x' lang=de><a href='/one'>1</a><a href=/two>2</a><A
 title="t" HREF = "/three?a=1&amp;b=2">3</A><area href='/four'><a data-href="/no">no</a><a title='x'href=/five>5</a><a href="">e</a><abbr href="/no">"""


def outlinks(block):
    return [x.removeprefix("outlink: ") for x in block.split("\r\n") if x.startswith("outlink: ")]


def test_links_of_all_forms(spark):
    page = spark.createDataFrame([(1, "http://a/", LINKS)], "page_id bigint, url string, html string")
    meta = warc.derive(warc.responses(page, "d")).where("warc_type = 'metadata'").first().block
    assert outlinks(meta) == ["/one", "/two", "/three?a=1&b=2", "/four", "/five", ""] and "language: de\r\n" in meta


def test_awkward_pages_equal_sql(spark, tmp_path):
    entities = "a &eacute; &#8217; &#x1F600; &bogus; &#0; &#xD800; &#1114112; &#10; & &amp;lt; x&nbsp;&nbsp;y &"
    htmls = [LINKS, entities, f"<title>{entities}</title><a href='{entities}'>", None, "", "&", "<a href=", "<a " * 1_000, "<html lang='a&#10;b'>"]
    rows = [(i, "http://a/", h) for i, h in enumerate(htmls)] + [(None, None, "x"), (0, "http://a/", "other"), (0, "http://a/", LINKS)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    pages = spark.read.parquet(f"{tmp_path}/pages.parquet")
    base = duckdb.connect()
    base.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert not differences(warc.derive(warc.responses(pages, "d"), "page_id"), base, warc.sql("d"))


def test_other_content_has_other_ids(spark):
    rows = [(1, "http://a/", "x"), (1, "http://a/", "y"), (1, "http://a/", "x")]
    got = warc.derive(warc.responses(spark.createDataFrame(rows, "page_id bigint, url string, html string"), "d"), "page_id").collect()
    assert len(got) == 6 and len({r.record_id for r in got}) == 4 and len({r.refers_to for r in got}) == 2


def record(kind, n, body, length=None):
    block = b"HTTP/1.1 200 OK\r\nX: 1\r\n\r\n" + body
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{n}>\r\nWARC-Target-URI: http://h/{n}\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: {length or len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def test_reader(spark, tmp_path):
    records = [record("warcinfo", 0, b"info"), record("response", 1, "<p>é</p>\r\n\r\n".encode()), record("response", 2, b""), record("response", 3, b"a\xffb"), record("request", 4, b"x"), record("response", 5, b"WARC/1.1\r\n")]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    for name in ("a.warc", "b.warc.gz"):
        got = {r.record_id: r for r in warc.read(spark, f"{tmp_path}/{name}").collect()}
        assert {i: r.whole for i, r in got.items()} == {"<urn:x:1>": True, "<urn:x:2>": True, "<urn:x:3>": True, "<urn:x:5>": False}
        assert got["<urn:x:1>"].block.endswith("<p>é</p>\r\n\r\n") and got["<urn:x:2>"].target_uri == "http://h/2"
        assert warc.read(spark, f"{tmp_path}/{name}").where("hex(block) LIKE '%61FF62'").count() == 1
        made = warc.derive(warc.read(spark, f"{tmp_path}/{name}")).where("warc_type = 'conversion'").collect()
        assert {r.refers_to: r.block for r in made}["<urn:x:1>"] == "é"
