"""Ordered pattern lists as Catalyst expressions (Java syntax)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

ANY_CASE, LINES = "(?iU)", "(?imdU)"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once: an expression that use names several times would be computed as often."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def any_of(patterns: Sequence[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def matches(text: Column, patterns: Sequence[str], flags: str = ANY_CASE) -> Column:
    return F.coalesce(text.rlike(flags + any_of(patterns)), F.lit(False))


def has_word(text: Column, words: Sequence[str]) -> Column:
    """Whether the lower-cased text holds one of the (lower-case) words."""

    def any_word(low: Column) -> Column:
        out = None
        for w in words:
            hit = F.contains(low, F.lit(w))
            out = hit if out is None else out | hit
        return out

    return bound(F.lower(text), any_word)


def first_match(text: Column, patterns: Sequence[str], flags: str = ANY_CASE) -> Column:
    """What the first pattern of the list that matches anywhere matched, else null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, flags + p, 0), F.lit("")) for p in patterns])


def first_reason(text: Column, rules: Sequence[tuple[str, str]], flags: str = ANY_CASE) -> Column:
    """The reason of the first pattern that matches, else null."""
    out = None
    for pattern, reason in rules:
        hit = text.rlike(flags + pattern)
        out = F.when(hit, reason) if out is None else out.when(hit, reason)
    return out


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def title_case(name: Column) -> Column:
    """A capital after every character that is no letter, as in O'Reilly and L3Harris."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(name), F.lit(r"(\p{L}+|\P{L}+)"), 1), lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.substring(x, 2, 1 << 30))), "")
