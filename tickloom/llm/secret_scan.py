"""Secrets in text: three fixed forms, and strings that a battery of randomness tests finds.

Fixed forms (``FORMS``) are taken leftmost and without overlap per form; a match that is too short is consumed and dropped.

Candidates of the battery are long runs of letters, digits and ``+ / _ -`` with up to two ``=`` behind. Their encoding is inferred:
the smallest alphabet that holds all symbols, provided that each of its digits, small and capital letters occurs; other strings
are not tested. Over the symbols' places in that alphabet:

1. chi-squared against equal frequencies (cube-root normal approximation, upper side),
2. the number of runs above and below the middle of the alphabet (two-sided),
3. the serial correlation of neighbours (two-sided).

A string stays if none of the three rejects randomness at ``LEVEL`` / 3. Short strings pass such tests by having too few symbols, so
the opposite is tested too: how low the chi-squared value is for a string of that length whose symbols come as
often as in the corpus, which is counted over all documents. Those p-values (a Chernoff bound) go through Benjamini and Hochberg's
step-up rule at rate ``FALSE_RATE``, separately for every encoding and class of lengths, over the distinct candidates of the
corpus: many clear long secrets do not lower the bar for short strings. P-values are rounded up to steps of
1/100 standard deviation, so the rule needs counts per step, not an order of all candidates.

Everything is DataFrame functions; a text is read once for the symbol counts and once for the spans, no text is shuffled. Positions
are code points, ends exclusive. A NULL text is empty; every row is judged on its own, whatever its id; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import let, stored, texts

# Pattern and least length per form, the length of group 1 where there is one, in the order of equal starts.
FORMS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    "access": (r"AKIA[A-Z0-9]+", 16),
    "hex": (r"[0-9a-f]+", 32),
}
# Where a short match cannot swallow a longer one, the least length is part of the search.
_SEARCH = {"assign": FORMS["assign"][0], "access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}
KINDS = (*FORMS, "random")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
LEVEL, FALSE_RATE = 0.001, 0.01

_DIGITS, _SMALL = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_CAPITAL = _SMALL.upper()
# Smaller alphabets first.
ALPHABETS = {
    "hex": _DIGITS + _SMALL[:6],
    "HEX": _DIGITS + _CAPITAL[:6],
    "base32": _CAPITAL + _DIGITS[2:8],
    "base36": _DIGITS + _SMALL,
    "BASE36": _DIGITS + _CAPITAL,
    "base62": _CAPITAL + _SMALL + _DIGITS,
    "base64": _CAPITAL + _SMALL + _DIGITS + "+/",
    "base64url": _CAPITAL + _SMALL + _DIGITS + "-_",
}
SYMBOLS = ALPHABETS["base64"] + "-_"
# Classes of length per encoding, steps of a standard deviation, and the step of strings that the battery rejected.
CLASSES, STEPS = 64, 100
_FARTHEST, _REJECTED = 40 * STEPS, 40 * STEPS + 1
# Matches whose positions are added up in one list before the lists are put together.
_PART = 256


def _spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, said>> of all matches."""
    said = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(said: Column) -> Column:
        pieces = F.slice(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), said.alias("said")), F.lit(1), F.size(said))
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(said) - 1) / _PART).cast("int")), lambda c: F.slice(pieces, c * _PART + 1, F.lit(_PART)))
        none = F.array().cast("array<struct<start:bigint,end:bigint,said:string>>")

        def one(state: Column, piece: Column) -> Column:
            start = state["at"] + F.char_length(piece["gap"])
            end = start + F.char_length(piece["said"])
            span = F.struct(start.alias("start"), end.alias("end"), piece["said"].alias("said"))
            return F.struct(end.alias("at"), state["done"].alias("done"), F.concat(state["part"], F.array(span)).alias("part"))

        def part(state: Column, pieces: Column) -> Column:
            begun = F.struct(state["at"].alias("at"), state["done"].alias("done"), none.alias("part"))
            return F.aggregate(pieces, begun, one, lambda s: F.struct(s["at"].alias("at"), F.concat(s["done"], F.array(s["part"])).alias("done")))

        begun = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<array<struct<start:bigint,end:bigint,said:string>>>").alias("done"))
        return F.when(F.size(said) > 0, F.flatten(F.aggregate(parts, begun, part, lambda s: s["done"]))).otherwise(none)

    return let(said, placed)


def _of_kind(kind: int):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> of the fixed forms, in order."""
    found = []
    for kind, (form, (pattern, least)) in enumerate(FORMS.items()):
        spans = _spans(text, _SEARCH[form])
        if form == "assign":
            spans = F.filter(spans, lambda s: F.char_length(F.regexp_extract(s["said"], pattern, 1)) >= least)
        found.append(F.transform(spans, _of_kind(kind)))
    return F.array_sort(F.concat(*found))


# -- the battery ----------------------------------------------------------------------------------


def symbol_counts(docs: DataFrame) -> dict[str, int]:
    """How often each symbol stands in the corpus."""
    text = F.col("text")
    counts = [F.sum((F.char_length(text) - F.char_length(F.replace(text, F.lit(c), F.lit("")))).cast("bigint")) for c in SYMBOLS]
    row = texts(docs).agg(*[n.alias(f"n{i}") for i, n in enumerate(counts)]).first()
    return {c: row[i] or 0 for i, c in enumerate(SYMBOLS)}


def moments(counts: dict[str, int], alphabet: str) -> tuple[float, float]:
    """Sums of squares and of cubes of the symbols' shares; as in a corpus that has each once more."""
    total = sum(counts[c] + 1 for c in alphabet)
    shares = [(counts[c] + 1) / total for c in alphabet]
    return sum(x**2 for x in shares), sum(x**3 for x in shares)


def encoding(body: Column) -> Column:
    """Number of the inferred alphabet, or NULL."""
    found = F.lit(None).cast("int")
    for i, alphabet in reversed(list(enumerate(ALPHABETS.values()))):
        parts = [p for p in (_DIGITS, _SMALL, _CAPITAL) if set(p) & set(alphabet)]
        held = [body.rlike(f"[{''.join(c for c in p if c in alphabet)}]") for p in parts]
        inside = body.rlike(f"^[{alphabet.replace('-', '')}{'-' if '-' in alphabet else ''}]+$")
        found = F.when(reduce(lambda a, b: a & b, [inside, *held]), F.lit(i)).otherwise(found)
    return found


def _pick(values: list, encoding: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), encoding)


def statistics(body: Column, code: Column, counts: dict[str, int]) -> Column:
    """Struct of n, chi (upper side), runs, serial and ordinary, each but n in standard deviations."""
    sizes = [len(a) for a in ALPHABETS.values()]
    known = [moments(counts, a) for a in ALPHABETS.values()]
    number = lambda x: x.cast("double")
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda s, x: s + x)

    def tests(places: Column) -> Column:
        n, k = number(F.size(places)), number(_pick(sizes, code))
        middle = k / 2
        neighbours = lambda use: F.zip_with(F.slice(places, F.lit(1), F.size(places) - 1), F.slice(places, F.lit(2), F.size(places) - 1), use)
        # Equal frequencies.
        held = F.transform(F.sequence(F.lit(1), _pick(sizes, code)), lambda p: F.size(F.filter(places, lambda x: x == p)).cast("bigint"))
        chi = k / n * number(total(F.transform(held, lambda x: x * x))) - n
        spread = F.lit(2.0) / (F.lit(9.0) * (k - 1))
        # Runs.
        above = number(F.size(F.filter(places, lambda x: x > middle)))
        runs = number(total(neighbours(lambda a, b: ((a > middle) != (b > middle)).cast("bigint")))) + 1
        mean = F.lit(2.0) * above * (n - above) / n + 1
        deviation = F.sqrt((mean - 1) * (mean - 2) / (n - 1))
        # Serial correlation, about -1/n in random strings.
        average = number(total(places)) / n
        ends = number(F.element_at(places, 1) + F.element_at(places, -1))
        together = number(total(neighbours(lambda a, b: a * b))) - average * (F.lit(2.0) * average * n - ends) + (n - 1) * average * average
        around = number(total(F.transform(places, lambda x: x * x))) - n * average * average
        # Frequencies as in the corpus.
        s2, s3 = (_pick([m[i] for m in known], code) for i in (0, 1))
        expected = k * ((n - 1) * s2 + 1) - n
        wide = k / n * F.sqrt(F.lit(2.0) * n * (n - 1) * (s2 + F.lit(2.0) * (n - 2) * s3 - (F.lit(2.0) * n - 3) * s2 * s2))
        return F.struct(
            F.size(places).alias("n"),
            ((F.pow(chi / (k - 1), F.lit(1 / 3)) - (F.lit(1.0) - spread)) / F.sqrt(spread)).alias("chi"),
            F.when(deviation > 0, F.abs(runs - mean) / deviation).alias("runs"),
            F.when(around > 0, F.abs((together / around + F.lit(1.0) / n) * F.sqrt(n))).alias("serial"),
            F.try_divide(chi - expected, wide).alias("ordinary"),
        )

    symbols = F.regexp_extract_all(body, F.lit("."), F.lit(0))
    return let(F.transform(symbols, lambda c: F.instr(_pick(list(ALPHABETS.values()), code), c).cast("bigint")), tests)


def judged(text: Column, counts: dict[str, int]) -> Column:
    """array<struct<start, end, class, step, key>>: every tested candidate, with its class of encoding and length, the step of its
    p-value, and a hash that stands for the string."""
    one, two = (NormalDist().inv_cdf(1 - LEVEL / 3 / sides) for sides in (1, 2))

    def verdict(span: Column, code: Column, s: Column) -> Column:
        random = (s["chi"] <= one) & (s["runs"] <= two) & (s["serial"] <= two)
        step = F.greatest(F.least(F.floor(s["ordinary"] * STEPS), F.lit(_FARTHEST)), F.lit(-_FARTHEST)).cast("int")
        length = F.least(F.floor(F.log2(s["n"]) * 4).cast("int"), F.lit(CLASSES - 1))
        return F.struct(
            span["start"].alias("start"),
            span["end"].alias("end"),
            (code * CLASSES + length).alias("class"),
            F.coalesce(F.when(random, step), F.lit(_REJECTED)).alias("step"),
            F.xxhash64(span["said"]).alias("key"),
        )

    def tested(span: Column) -> Column:
        body = F.rtrim(span["said"], F.lit("="))
        with_code = lambda c: F.when(c.isNotNull(), let(statistics(body, c, counts), lambda s: verdict(span, c, s)))
        return let(encoding(body), with_code)

    return F.filter(F.transform(_spans(text, CANDIDATE), tested), lambda x: x.isNotNull())


def thresholds(found: DataFrame) -> dict[int, int]:
    """Largest step that the step-up rule admits, by class; classes without any are left out.

    ``found`` has the arrays of ``judged``. At most one row for each of ``CLASSES`` lengths and encoding comes back.
    """
    strings = found.select(F.inline("judged")).select("class", "step", "key").distinct()
    steps = strings.groupBy("class", "step").agg(F.count("*").alias("strings"))
    every = Window.partitionBy("class")
    upper = (F.col("step") + 1) / F.lit(float(STEPS))
    p = F.when(upper < 0, F.exp(-upper * upper / 2) / 2).otherwise(F.lit(1.0))
    so_far = F.sum("strings").over(every.orderBy("step"))
    ranked = steps.select("class", "step", (F.sum("strings").over(every) * p <= so_far * FALSE_RATE).alias("admitted"))
    rows = ranked.where(F.col("admitted") & (F.col("step") < _REJECTED)).groupBy("class").agg(F.max("step").alias("step")).collect()
    return {r["class"]: r["step"] for r in rows}


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, and spans: array<struct<start, kind, end>> in order, ``kind`` by its place in ``KINDS``; one row per row of ``docs``.

    A random string that overlaps a fixed form is not named again.
    """
    text = texts(docs)
    found = stored(text.select("doc_id", base_spans(F.col("text")).alias("base"), judged(F.col("text"), symbol_counts(docs)).alias("judged")))
    admitted = thresholds(found)
    cuts = F.create_map(*[F.lit(x) for pair in (admitted or {-1: -_FARTHEST}).items() for x in pair])
    random = F.filter("judged", lambda x: (x["step"] <= F.try_element_at(cuts, x["class"])) & ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    more = F.transform(random, _of_kind(len(FORMS)))
    return found.select("doc_id", F.array_sort(F.concat("base", more)).alias("spans"))


def _said(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts per fixed form, the digest of their spans, and all spans as one string."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"] < len(FORMS))
    counts = [of(i).alias(f"n_{kind}") for i, kind in enumerate(FORMS)]
    return found.select("doc_id", *counts, F.sha2(_said(base), 256).alias("base_sha256"), _said(F.col("spans")).alias("spans"))
