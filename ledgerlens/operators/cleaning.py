"""Raw filings: primary document, block removal, HTML to text, normalisation, junk lines, sections, routes."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.patterns import LINES, bound, matches
from ..functions.rows import in_small_batches, with_once
from ..rules import filings as R


def longest(texts: Column) -> Column:
    """The first of the longest, null if there is none."""
    return F.aggregate(texts, F.lit(None).cast("string"), lambda best, x: F.when(best.isNull() | (F.length(x) > F.length(best)), x).otherwise(best))


def primary_document(raw: Column) -> Column:
    """The longest annual report of a wrapped filing, else its longest document, else all; of that the text block."""
    kind = lambda d: F.upper(F.trim(F.regexp_extract(d, r"(?i)<TYPE>\s*([^\n\r<]+)", 1)))
    is_main = lambda d: bound(kind(d), lambda k: k.startswith("10-K") | k.isin(*R.PRIMARY_TYPES))
    block = lambda d: F.coalesce(bound(F.regexp_extract(d, r"(?is)<TEXT>(.*?)</TEXT>", 1), lambda t: F.nullif(t, F.lit(""))), d)
    docs = F.regexp_extract_all(raw, F.lit(r"(?is)<DOCUMENT>(.*?)</DOCUMENT>"), 1)
    return bound(bound(docs, lambda ds: F.coalesce(longest(F.filter(ds, is_main)), longest(ds), raw)), block)


def strip_blocks(raw: Column) -> Column:
    """Attachments and XBRL blocks become a blank."""
    out = F.regexp_replace(raw, r"(?is)<(pdf|excel|zip)>.*?</\1>", " ")
    for tag in R.BLOCKS:
        out = F.regexp_replace(out, rf"(?is)<{tag}\b.*?</{tag}>", " ")
    return F.regexp_replace(out, r"(?is)<link:(?:schemaref|linkbaseref)\b[^>]*?/?>", " ")


def html_to_text(raw: Column) -> Column:
    """Text of a page by patterns: dropped tags with their content, block tags as line ends, entities resolved."""
    out = F.regexp_replace(raw, r"(?s)<!--.*?-->", " ")
    for tag in R.DROPPED_TAGS:
        if tag not in ("meta", "link", "img"):
            out = F.regexp_replace(out, rf"(?is)<{tag}\b.*?</{tag}\s*>", " ")
    out = F.regexp_replace(out, rf"(?i)</?(?:{'|'.join(R.BLOCK_TAGS)})\b[^>]*>", "\n")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    for entity, text in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(text))
    return out


def normalize_space(text: Column) -> Column:
    out = F.translate(text, "\xa0\f\r\u200b\u200c\u200d\u2060\u2061\u2062\u2063\ufeff\xad", " \n\n")
    out = F.regexp_replace(out, r"(\w)-\n(\w)", "$1$2")
    out = F.regexp_replace(F.regexp_replace(out, r"[ \t]*\n[ \t]*", "\n"), r"[ \t]+", " ")
    return F.btrim(F.regexp_replace(out, r"\n{3,}", "\n\n"), F.lit(" \n"))


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility form; Spark SQL has no such function."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


@F.pandas_udf(T.StringType())
def decode_text(content: pd.Series) -> pd.Series:
    """UTF-8, with or without mark, else code page 1252, else Latin-1."""

    def one(b: bytes | None) -> str | None:
        for name in ("utf-8-sig", "cp1252"):
            try:
                return None if b is None else b.decode(name)
            except UnicodeDecodeError:
                continue
        return b.decode("latin-1")

    return content.map(one)


_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))


class _PageText(HTMLParser):
    """Text nodes of a page; those below dropped, hidden or taxonomy elements are left out, block elements stand between line ends."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.open: list[tuple[str, bool]] = []

    def _unseen(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        named = {k: (v or "").lower() for k, v in attrs}
        style = named.get("style", "").replace(" ", "")
        hidden = "display:none" in style or "visibility:hidden" in style or named.get("hidden") in ("hidden", "true") or named.get("aria-hidden") == "true"
        gone = self._unseen() or hidden or tag in R.DROPPED_TAGS or tag.startswith(("xbrli:", "xbrldi:", "link:"))
        if tag in R.BLOCK_TAGS and not gone:
            self.pieces.append("\n")
        if tag not in _VOID:
            self.open.append((tag, gone))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        if not any(t == tag for t, _ in self.open):
            return
        if tag in R.BLOCK_TAGS and not self._unseen():
            self.pieces.append("\n")
        while self.open.pop()[0] != tag:
            pass

    def handle_data(self, data: str) -> None:
        if not self._unseen():
            self.pieces.append(data)


_BREAKS = [re.compile(p, re.I) for p in R.BROKEN_BEFORE]


def plain_text(raw: str | None) -> str | None:
    """Text of a page, entities resolved, in compatibility form, words joined over line ends, parts and items on lines of their own."""
    if raw is None:
        return None
    page = _PageText()
    page.feed(raw)
    page.close()
    text = unicodedata.normalize("NFKC", html.unescape(" ".join(page.pieces)))
    text = text.translate({0xA0: " ", 0x200B: None, 0xFEFF: None, 0xAD: None, 0x0C: "\n", 0x0D: "\n"})
    text = re.sub(r"(?<=\w)-\s*\n\s*(?=\w)", "", text)
    text = re.sub(r"[ \t]*\n[ \t]*", "\n", text)
    text = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]{2,}", " ", text))
    for pattern in _BREAKS:
        text = pattern.sub(r"\n\1", text)
    return text.strip()


@F.pandas_udf(T.StringType())
def page_text(raw: pd.Series) -> pd.Series:
    """plain_text of each page: nesting, every entity and the compatibility form are beyond patterns and Spark's functions."""
    return raw.map(plain_text)


def is_junk_line(line: Column) -> Column:
    line = F.trim(line)
    odd = lambda t: t.rlike(R.ODD_TOKENS[0]) | t.rlike(R.ODD_TOKENS[1]) | t.rlike(R.ODD_TOKENS[2])
    mostly_odd = lambda tokens: (F.size(tokens) >= 6) & (F.size(F.filter(tokens, odd)) / F.greatest(F.size(tokens), F.lit(1)) >= 0.55)
    return matches(line, R.JUNK_LINES) | line.rlike(R.PAGE_NUMBER) | bound(F.filter(F.split(line, r"\s+"), lambda t: t != ""), mostly_odd)


def rebuild_paragraphs(text: Column) -> Column:
    """Lines joined to paragraphs; a blank line, a heading or an end of sentence closes one; junk lines go; headings in capitals."""
    heading = lambda s: s.rlike(R.HEADING_LINE)
    lines = F.filter(F.transform(F.split(text, "\n"), lambda s: F.trim(s)), lambda s: ~is_junk_line(s))
    marked = F.transform(lines, lambda s: F.when(s == "", F.lit("\x02")).when(heading(s), F.concat(F.lit("\x02"), F.upper(s), F.lit("\x02"))).when(s.rlike(r"[.!?:;]$"), F.concat(s, F.lit("\x02"))).otherwise(s))
    parts = F.filter(F.transform(F.split(F.array_join(marked, " "), "\x02"), lambda s: F.trim(s)), lambda s: s != "")
    return F.array_join(parts, "\n\n")


def trim_preamble(text: Column) -> Column:
    """From the earliest of the first matches that begin after 1000 characters, if there is one."""
    late = lambda at: F.when(at > 1001, at)
    start = lambda t: F.least(*[bound(F.regexp_instr(t, F.lit("(?is)" + p)), late) for p in R.PREAMBLE])
    return bound(text, lambda t: F.coalesce(F.substr(t, start(t)), t))


def clean_filing(raw: Column) -> Column:
    return trim_preamble(rebuild_paragraphs(page_text(strip_blocks(primary_document(raw)))))


_ENDS = [re.compile(p, re.I | re.M) for p in R.SECTION_END]
_CONTENTS = re.compile(r"\.{3,}|\t\d{1,3}\s*$", re.I)


def find_section(text: str | None, starts: Sequence[str], length: tuple[int, int]) -> str | None:
    """The longest slice from a start to the nearest end heading after it, of the first start pattern with one of allowed length.

    Every start is tried. One in a table of contents (dots, or a tab and a page number, around it) doesn't count; slices that are too
    long are left out, not cut.
    """
    for start in starts if text else ():
        best = None
        for m in re.finditer(start, text, re.I | re.M):
            if _CONTENTS.search(text, max(0, m.start() - 5), m.end() + 20):
                continue
            ends = [e.start() for e in (p.search(text, m.end() + 1) for p in _ENDS) if e]
            found = text[m.start() : min(ends, default=len(text))].strip()
            if length[0] <= len(found) <= length[1] and (best is None or len(found) > len(best)):
                best = found
        if best is not None:
            return best
    return None


def section(text: Column, starts: Sequence[str], length: tuple[int, int]) -> Column:
    """find_section of each text, in Arrow batches."""

    @F.pandas_udf(T.StringType())
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: find_section(t, starts, length))

    return of(text)


@F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in ("business", "competition", "header_only")]))
def sections(texts: pd.Series) -> pd.DataFrame:
    """Business and competition sections, and a business section too short to be one, of each text."""
    kinds = {"business": (R.BUSINESS_START, R.BUSINESS_LENGTH), "competition": (R.COMPETITION_START, R.COMPETITION_LENGTH), "header_only": (R.BUSINESS_START, R.HEADER_ONLY_LENGTH)}
    return pd.DataFrame({k: [find_section(t, *rule) for t in texts] for k, rule in kinds.items()}, dtype=object)


def route_features(filings: DataFrame, text: str = "text") -> DataFrame:
    """Adds what routes are decided by: has_business_header, has_competition_header, has_term and the struct sections."""
    t = F.col(text)
    return with_once(in_small_batches(filings), "sections", sections(t)).withColumns({"has_business_header": matches(t, R.BUSINESS_START, LINES), "has_competition_header": matches(t, R.COMPETITION_START, LINES), "has_term": t.rlike("(?iU)" + R.COMPETITION_TERM)})


def route(filings: DataFrame, mode: str = "canonical", text: str = "text") -> DataFrame:
    """Adds sections, section_source, section_text and route. mode: canonical, strict (competition-only filings are isolated) or lenient.

    filings may have the columns of route_features already. A null text has no headers, no term and no section.
    """
    rows = filings if "sections" in filings.columns and "has_term" in filings.columns else route_features(filings, text)
    business, competition, term = (F.coalesce(F.col(c), F.lit(False)) for c in ("has_business_header", "has_competition_header", "has_term"))
    own, other = F.col("sections.business"), F.col("sections.competition")
    use_competition = own.isNull() & other.isNotNull() & (F.lit(mode != "strict") | business)
    rows = rows.withColumn("section_source", F.when(own.isNotNull(), "business").when(use_competition, "competition").otherwise("none"))
    rows = rows.withColumn("section_text", F.when(F.col("section_source") == "business", own).when(F.col("section_source") == "competition", other))
    nothing = F.col("section_source") == "none"
    in_section = F.col("section_text").rlike("(?iU)" + R.COMPETITION_TERM)
    alone = {"canonical": "isolated/business_header_only", "strict": "isolated/no_business_header_has_competition_term", "lenient": "none"}[mode]
    no_header = "none" if mode == "lenient" else "isolated/no_business_header_has_competition_term"
    decided = (
        F.when(~business & ~competition & ~term, "isolated/missing_both_no_competition_term").when(~business & ~competition, no_header)
        .when(~business & nothing, alone).when(nothing, "isolated/business_header_only")
    )
    if mode != "lenient":
        decided = decided.when((F.col("section_source") == "business") & ~competition & ~in_section, "no_outgoing_edges")
    return rows.withColumn("route", decided.otherwise("business"))


def append_status(cleaned: DataFrame, business: DataFrame) -> DataFrame:
    """cleaned: stem, text; business: stem, content, one row a stem. stem, status and reason of appending the competition section.

    A text without both sections, without a business file, or whose file has the mark already is skipped, for the first reason that holds.
    """
    found = with_once(in_small_batches(cleaned), "__s", sections("text"))
    both = found["__s.business"].isNotNull() & found["__s.competition"].isNotNull()
    joined = found.select("stem", both.alias("__both")).join(business.select("stem", F.col("content").alias("__content")), "stem", "left")
    reason = F.when(~F.col("__both"), "missing_section").when(F.col("__content").isNull(), "no_business_file").when(F.contains("__content", F.lit(R.APPEND_MARK.strip())), "already_appended")
    return joined.select("stem", F.when(reason.isNull(), "appended").otherwise("skipped").alias("status"), F.coalesce(reason, F.lit("")).alias("reason"))


def append_competition(business: Column, competition: Column) -> Column:
    """The competition section after the business text, under a mark; a text that has the mark stays as it is."""
    ok = business.isNotNull() & F.length(competition).between(*R.APPENDED_LENGTH) & ~F.contains(business, F.lit(R.APPEND_MARK.strip()))
    return F.when(ok, F.concat(F.rtrim(business), F.lit(R.APPEND_MARK), F.trim(competition))).otherwise(business)


def competition_only(text: Column) -> Column:
    head = F.left(text, F.lit(R.HEAD_CHARS))
    business = head.rlike("(?iU)" + R.BUSINESS_HEAD)
    return (head.rlike("(?iU)" + R.COMPETITION_HEAD) & ~business) | (head.rlike("(?iU)" + R.COMPETITION_WORD) & ~business & ~F.contains(F.lower(F.left(head, F.lit(300))), F.lit("business")))
