"""Row rules for bars. A rule is a named condition that is true when the row is bad."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PRICES = ("open", "high", "low", "close")
SIZES = ("volume", "quote_volume", "trades")


def bar_rules(strict: bool = False, signs: bool = True) -> dict[str, Column]:
    """The 14 rules of a parsed bar.

    Comparisons with NULL are unknown and do not fire, so a bar with a missing price passes unless
    ``strict`` adds the ``null_*`` rules. ``signs=False`` leaves out the rules on signs, for series whose
    values are no prices and may be zero or less.
    """
    c = F.col
    rules = {
        "close_time_missing": c("close_time").isNull(),
        "close_time_not_after_open_time": c("close_time") <= c("open_time"),
        **{f"non_positive_{p}": c(p) <= 0 for p in PRICES},
        "high_below_others": c("high") < F.greatest("open", "low", "close"),
        "low_above_others": c("low") > F.least("open", "high", "close"),
        **{f"negative_{s}": c(s) < 0 for s in SIZES},
        "symbol_missing": c("symbol").isNull(),
        "interval_missing": c("interval").isNull(),
        "fetched_at_missing": c("fetched_at").isNull(),
    }
    if not signs:
        rules = {name: bad for name, bad in rules.items() if not name.startswith(("non_positive_", "negative_"))}
    if strict:
        rules.update({f"null_{p}": c(p).isNull() for p in PRICES})
    return rules


def batch_rules() -> dict[str, Column]:
    """Coarser rules for freshly fetched arrays, one message per kind of fault."""
    c = F.col
    return {
        "parse_error": F.greatest(
            *[c(n).isNull() for n in ("open_time", "close_time", *PRICES, *SIZES)]
        ),
        "close_time_not_after_open_time": c("close_time") <= c("open_time"),
        "non_positive_price": F.least(*PRICES) <= 0,
        "high_below_ohlc": c("high") < F.greatest("open", "low", "close"),
        "low_above_ohlc": c("low") > F.least("open", "high", "close"),
        "negative_volume_or_trades": (c("volume") < 0) | (c("quote_volume") < 0) | (c("trades") < 0),
    }


def broken_rules(rules: dict[str, Column]) -> Column:
    """Array with the names of the rules a row breaks, in rule order."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
