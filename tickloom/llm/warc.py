"""Derived records of a web archive: each response becomes a metadata and a plain-text conversion record.

Both name the response in ``WARC-Refers-To``, keep its target and date, and carry its digests: the metadata record
lists the source's HTTP headers, payload digest, title, language and links as ``application/warc-fields``, the
conversion record holds the text of the page. Record ids follow from the response's id, so a repeated task or run
gives the same records. ``read`` takes responses from WARC files; ``responses`` makes them of a table of pages, each with
an id that follows from number, URL and content, so only rows alike in all three share one.

Text: comments, scripts and styles go, block elements end a line, other tags go, character entities (numbers and the
names of HTML 4) are decoded once, others stay as they are, white space is collapsed. Attributes may be in double, single or no quotes. Everything is
DataFrame functions on one row at a time; nothing is shuffled. NULL fields are empty, so a response without body gives an empty
conversion record; repeated rows give repeated records; other columns are ignored.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm.common import let

NAMES = {"apos": "'", **{name: chr(code) for name, code in name2codepoint.items()}}
# Elements that end a line.
BLOCKS = "address article aside blockquote br caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr legend li main nav ol p pre section table td th title tr ul".split()

_HIDDEN = r"(?is)<!--.*?-->|<script(?:[ \t\r\n][^>]*)?>.*?</script[ \t\r\n]*>|<style(?:[ \t\r\n][^>]*)?>.*?</style[ \t\r\n]*>"
_BLOCK = rf"(?i)</?(?:{'|'.join(BLOCKS)})(?:[ \t\r\n/][^>]*)?>"
_TAG = r"(?s)</?[A-Za-z!?][^>]*>"
_TITLE = r"(?is)<title[^>]*>(.*?)</title"
_VALUE = r"[ \t\r\n]*=[ \t\r\n]*(\"[^\"]*\"|'[^']*'|[^ \t\r\n\"'<>]+)"
_ATTRIBUTE = r"(?is)<(?:{0})[ \t\r\n](?:[^<>]*?[ \t\r\n\"'])?{1}" + _VALUE
_LANGUAGE = _ATTRIBUTE.format("html", "lang")
_LINK = _ATTRIBUTE.format("a|area", "href")
_ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{0,31});"
_END = "\r\n\r\n"


def _code(name: Column) -> Column:
    """The code point that ``#...`` names; NULL for none, or one that is no character."""
    code = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(F.substring(name, 2, 7)).try_cast("int")
    return F.when(((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000)), code)


def _entities(text: Column) -> Column:
    """Decoded once: what an entity gives is not read again."""
    names = F.create_map(*[F.lit(x) for pair in sorted(NAMES.items()) for x in pair])

    def decoded(part: Column, name: Column) -> Column:
        number = F.decode(F.unhex(F.lpad(F.hex(_code(name)), 8, "0")), "UTF-32")
        character = F.when(F.startswith(name, F.lit("#")), number).when(name != "", F.try_element_at(names, name))
        return F.coalesce(F.concat(character, F.substring(part, F.length(name) + 2, F.length(part))), F.concat(F.lit("&"), part))

    named = lambda part: let(F.regexp_extract(part, _ENTITY, 1), lambda name: decoded(part, name))
    parts = F.transform(F.split(text, "&"), lambda part, i: F.when(i == 0, part).otherwise(named(part)))
    return F.when(F.contains(text, F.lit("&")), F.array_join(parts, "")).otherwise(text)


def _bare(value: Column) -> Column:
    """An attribute's value without its quotes, decoded, on one line."""
    quoted = F.substring(value, 1, 1).isin('"', "'")
    return _line(_entities(F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)))


def plain_text(html: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, _HIDDEN, " "), _BLOCK, "\n"), _TAG, "")
    spaced = F.regexp_replace(_entities(bare), "[ \t\r\u00a0]+", " ")
    return F.trim(F.regexp_replace(spaced, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def _id(*parts) -> Column:
    """A record id as a URN, the same for the same parts."""
    digest = F.md5(F.concat_ws("|", *parts))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]), F.lit(">"))


def _digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def _line(text: Column) -> Column:
    """A value that cannot start a header line of its own."""
    return F.regexp_replace(text, r"[\r\n]+", " ")


def responses(pages: DataFrame, date: str) -> DataFrame:
    """Response records (record_id, target_uri, date, block) of fetched pages (page_id, url, html)."""
    body = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(_END))
    number, uri = F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit(""))
    return pages.select("page_id", _id(F.lit("response"), number, uri, F.sha2(body, 256)).alias("record_id"), uri.alias("target_uri"), F.lit(date).alias("date"), F.concat(head, body).alias("block"))


def read(spark: SparkSession, path: str, version: str = "WARC/1.1") -> DataFrame:
    """Response records (record_id, target_uri, date, block, whole) of WARC files, plain or gzipped.

    Files are cut at the version line by Spark's reader, so a plain file is read by many tasks; bytes that are no UTF-8 stay as they
    are. ``whole`` says whether the block has the length that its header states: not so where a block holds the version line itself.
    """
    rows = spark.read.text(path, lineSep=f"{version}\r\n").where(F.contains("value", F.lit(_END)))
    head = F.concat(F.substring_index("value", _END, 1), F.lit("\r\n"))
    field = lambda name: F.regexp_extract("head", rf"(?i)(?:^|\n){name}:[ \t]*([^\r\n]*)", 1)
    rows = rows.select(head.alias("head"), F.expr(f"substring(value, length(substring_index(value, '{_END}', 1)) + 5)").alias("rest"))
    block = F.when(F.endswith("rest", F.lit(_END)), F.expr("substring(rest, 1, length(rest) - 4)")).otherwise(F.col("rest"))
    found = rows.where(F.lower(field("WARC-Type")) == "response").select(
        field("WARC-Record-ID").alias("record_id"), field("WARC-Target-URI").alias("target_uri"), field("WARC-Date").alias("date"), block.alias("block"), field("Content-Length").try_cast("bigint").alias("size")
    )
    return found.select("record_id", "target_uri", "date", "block", F.coalesce(F.octet_length("block") == F.col("size"), F.lit(False)).alias("whole"))


def derive(records: DataFrame, *keep: str) -> DataFrame:
    """Two records for every response; ``keep`` names columns to carry along."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    source = records.select(
        *keep, text("record_id").alias("refers_to"), _line(text("target_uri")).alias("target_uri"), text("date").alias("date"), F.substring_index(text("block"), _END, 1).alias("http"), text("block").alias("block")
    )
    source = source.select(*keep, "refers_to", "target_uri", "date", "http", F.expr("substring(block, length(http) + 5)").alias("payload"), _digest(F.col("block")).alias("source_block_digest"))
    source = source.select("*", _digest(F.col("payload")).alias("source_payload_digest"))
    links = F.transform(F.regexp_extract_all("payload", F.lit(_LINK), F.lit(1)), lambda x: F.concat(F.lit("outlink: "), _bare(x), F.lit("\r\n")))
    headers = F.transform(F.split("http", "\r\n"), lambda x: F.concat(F.lit("source-header: "), x, F.lit("\r\n")))
    fields = F.concat(
        F.array_join(headers, ""),
        F.lit("source-payload-digest: "), F.col("source_payload_digest"),
        F.lit("\r\ntitle: "), F.trim(_line(_entities(F.regexp_extract("payload", _TITLE, 1)))),
        F.lit("\r\nlanguage: "), _bare(F.regexp_extract("payload", _LANGUAGE, 1)), F.lit("\r\n"),
        F.array_join(links, ""),
    )
    kinds = [("metadata", "application/warc-fields", fields), ("conversion", "text/plain; charset=utf-8", plain_text(F.col("payload")))]
    made = F.array(*[F.struct(F.lit(k).alias("warc_type"), F.lit(t).alias("content_type"), b.alias("block")) for k, t, b in kinds])
    rows = source.select(*keep, "refers_to", "target_uri", "date", "source_block_digest", "source_payload_digest", F.inline(made))
    return rows.select(
        *keep, "warc_type", _id("warc_type", "refers_to").alias("record_id"), "refers_to", "target_uri", "date", "content_type",
        "source_block_digest", "source_payload_digest", F.octet_length("block").cast("bigint").alias("content_length"), _digest(F.col("block")).alias("block_digest"), "block",
    )


def serialized(derived: DataFrame) -> DataFrame:
    """Adds ``record``: the record's bytes as they stand in a WARC 1.1 file."""
    names = [("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"),
             ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length")]
    lines = [F.concat(F.lit(f"{name}: "), F.col(column).cast("string"), F.lit("\r\n")) for name, column in names]
    return derived.withColumn("record", F.encode(F.concat(F.lit("WARC/1.1\r\n"), *lines, F.lit("\r\n"), "block", F.lit(_END)), "UTF-8"))


def sql(date: str) -> str:
    """``derive(responses(pages))`` in DuckDB's SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    end = "chr(13) || chr(10)"

    names = "MAP {" + ", ".join(f"{quote(name)}: {quote(character)}" for name, character in sorted(NAMES.items())) + "}"

    def entities(text: str) -> str:
        name = f"regexp_extract(x, {quote(_ENTITY)}, 1)"
        code = f"CASE WHEN {name}[2:2] IN ('x', 'X') THEN TRY_CAST('0x' || {name}[3:] AS INTEGER) ELSE TRY_CAST({name}[2:] AS INTEGER) END"
        number = f"CASE WHEN {code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111 THEN chr({code}) END"
        character = f"CASE WHEN {name}[1:1] = '#' THEN {number} WHEN {name} <> '' THEN names[{name}] END"
        decoded = f"coalesce({character} || x[len({name}) + 2:], '&' || x)"
        return f"array_to_string(list_transform(string_split({text}, '&'), lambda x, i: CASE WHEN i = 1 THEN x ELSE {decoded} END), '')"

    replaced = lambda text, pattern, by: f"regexp_replace({text}, {quote(pattern)}, {by}, 'g')"
    line = lambda text: replaced(text, r"[\r\n]+", "' '")
    uuid = lambda text: f"'<urn:uuid:' || regexp_replace(md5({text}), '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '\\1-\\2-\\3-\\4-\\5') || '>'"
    value = lambda x: line(entities(f"CASE WHEN {x}[1:1] IN (chr(34), chr(39)) THEN {x}[2:len({x}) - 1] ELSE {x} END"))
    bare = replaced(replaced(replaced("payload", _HIDDEN, "' '"), _BLOCK, "chr(10)"), _TAG, "''")
    plain = f"trim({replaced(replaced(entities(bare), '[ \\t\\r\u00a0]+', chr(39) + ' ' + chr(39)), ' ?\\n[ \\n]*', 'chr(10)')}, ' ' || chr(10))"
    return f"""
WITH r AS (SELECT page_id, {uuid("'response|' || coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '') || '|' || sha256(coalesce(html, ''))")} AS refers_to, {line("coalesce(url, '')")} AS target_uri,
    coalesce(html, '') AS payload, {names} AS names FROM pages),
h AS (SELECT *, ['HTTP/1.1 200 OK', 'Content-Type: text/html; charset=utf-8', 'Content-Length: ' || strlen(payload)] AS http FROM r),
s AS (SELECT *, 'sha256:' || sha256(payload) AS source_payload_digest,
    'sha256:' || sha256(array_to_string(http, {end}) || {end} || {end} || payload) AS source_block_digest FROM h),
m AS (SELECT *, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
    array_to_string(list_transform(http, lambda x: 'source-header: ' || x || {end}), '') || 'source-payload-digest: ' || source_payload_digest || {end}
    || 'title: ' || trim({line(entities(f"regexp_extract(payload, {quote(_TITLE)}, 1)"))}) || {end}
    || 'language: ' || {value(f"regexp_extract(payload, {quote(_LANGUAGE)}, 1)")} || {end}
    || coalesce(array_to_string(list_transform(regexp_extract_all(payload, {quote(_LINK)}, 1), lambda y: 'outlink: ' || {value("y")} || {end}), ''), '') AS block FROM s
    UNION ALL SELECT *, 'conversion', 'text/plain; charset=utf-8', {plain} FROM s)
SELECT page_id, warc_type, {uuid("warc_type || '|' || refers_to")} AS record_id, refers_to, target_uri, '{date}' AS date, content_type, source_block_digest, source_payload_digest,
    CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest, block FROM m"""
