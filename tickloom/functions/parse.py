"""Text-to-typed-value expressions. Bad input becomes NULL, never a task failure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Accepted timestamp spellings, tried in this order before Spark's own default parse (fixed values).
TIMESTAMP_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssXXX")
FETCHED_AT_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss'Z'",)

# Kline array layout: position -> (column, type) (fixed values).
KLINE_LAYOUT = {
    0: ("open_time", "epoch_ms"),
    1: ("open", "double"),
    2: ("high", "double"),
    3: ("low", "double"),
    4: ("close", "double"),
    5: ("volume", "double"),
    6: ("close_time", "epoch_ms"),
    7: ("quote_volume", "double"),
    8: ("trades", "bigint"),
}

# Hours per interval unit (fixed values).
UNIT_HOURS = {"week": 168.0, "day": 24.0, "hour": 1.0, "minute": 1.0 / 60, "second": 1.0 / 3600}


def parse_timestamp(text: Column | str, formats=TIMESTAMP_FORMATS) -> Column:
    """First format that fits wins; the last resort is Spark's default cast. NULL when none fits."""
    text = F.col(text) if isinstance(text, str) else text
    attempts = [F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats]
    return F.coalesce(*attempts, F.try_to_timestamp(text))


def format_timestamp(ts: Column | str) -> Column:
    """ISO-8601 text with a literal ``Z``, the spelling the landing files use."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def kline_fields(json_array: Column | str) -> list[Column]:
    """Typed columns of a positional kline array held as JSON text."""
    cells = F.from_json(json_array, "array<string>")
    out = []
    for position, (name, kind) in KLINE_LAYOUT.items():
        cell = F.get(cells, F.lit(position))
        typed = F.timestamp_millis(cell.try_cast("bigint")) if kind == "epoch_ms" else cell.try_cast(kind)
        out.append(typed.alias(name))
    return out


def interval_hours(text: Column | str) -> Column:
    """Length in hours of texts such as ``interval 1 week 2 days``; NULL if any part is not understood.

    Singular and plural units are both accepted.
    """
    text = F.col(text) if isinstance(text, str) else text
    clean = F.lower(F.regexp_replace(F.trim(text), r"^['\"]+|['\"]+$", ""))
    part = r"(\d+(?:\.\d+)?)\s+(" + "|".join(UNIT_HOURS) + r")s?"
    body = F.regexp_replace(clean, r"^interval", "")
    amounts = F.regexp_extract_all(body, F.lit(part), F.lit(1))
    units = F.regexp_extract_all(body, F.lit(part), F.lit(2))
    hours_per_unit = F.create_map(*[F.lit(x) for pair in UNIT_HOURS.items() for x in pair])
    terms = F.zip_with(amounts, units, lambda n, u: n.cast("double") * F.element_at(hours_per_unit, u))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, term: acc + term)
    understood = clean.rlike(r"^interval(\s*" + part + r")+\s*$")
    return F.when(understood, total)


def any_match(name: Column, prefixes) -> Column:
    """True when ``name`` starts with any of the prefixes (one anchored regular expression)."""
    return name.rlike("^(" + "|".join(prefixes) + ")")


def first_true(cases: list[tuple[Column, Column]], default: Column) -> Column:
    """``CASE`` built from (condition, value) pairs, first hit wins."""
    if not cases:
        return default
    head, *rest = cases
    chain = reduce(lambda acc, case: acc.when(*case), rest, F.when(*head))
    return chain.otherwise(default)
