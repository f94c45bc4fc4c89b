"""Patterns of the ingest, section, manifest and node operators."""

# Section starts and ends.
BUSINESS_START = (
    r"^\s*item\s*1\s*[.\-–—:]\s*business\b", r"^\s*item\s*1\s*[.\-–—:]?\s*(our|the|company's)?\s*business\b", r"^\s*item\s+(one|1st)\s*[.\-–—:]?\s*business\b",
    r"^\s*item\s*1\s*[.\-–—:]?\s*description\s+of\s+(?:our\s+)?business\b", r"^\s*item\s*1\s*[.\-–—:]\s*general\s*$", r"^\s*item\s*1\s*[.\-–—:]\s*overview\s*$", r"^\s*our\s+business\s*$",
    r"^\s*business\s+overview\s*$", r"^\s*company\s+overview\s*$", r"^\s*overview\s+of\s+(?:our\s+)?business\s*$", r"^\s*business\s*$",
)
COMPETITION_START = (r"^\s*item\s*1\s*[.\-–—:]?\s*(our\s+)?competition\b", r"^\s*our\s+competition\s*$", r"^\s*competition\s*$")
SECTION_END = (r"^\s*item\s*1\s*a\s*[.\-–—:]?", r"^\s*item\s*1\s*b\s*[.\-–—:]?", r"^\s*item\s*1\s*c\s*[.\-–—:]?", r"^\s*item\s*2\s*[.\-–—:]", r"^\s*item\s*3\s*[.\-–—:]", r"^\s*part\s*(?:ii|2)\s*[.\-–—]?")
COMPETITION_TERM = r"\b(competition|competitor|competitors|competitive|compete|competes|competing)\b"
# Least and most characters of a section.
BUSINESS_LENGTH, COMPETITION_LENGTH, APPENDED_LENGTH = (500, 500_000), (300, 500_000), (200, 50_000)
APPEND_MARK = "\n\n--- ITEM 1 – COMPETITION (appended) ---\n\n"
# Lines that are dropped, blocks and tags that are taken out.
JUNK_LINES = (
    r"^<PAGE>$", r"^<TYPE>.*$", r"^<SEQUENCE>.*$", r"^<FILENAME>.*$", r"^<DESCRIPTION>.*$", r"^accession number\b.*$", r"^conformed period of report\b.*$", r"^accepted\b.*$",
    r"^public document count\b.*$", r"^central index key\b.*$", r"^standard industrial classification\b.*$", r"^irs number\b.*$", r"^state of incorporation\b.*$", r"^fiscal year end\b.*$",
    r"^commission file number\b.*$", r"^company conformed name\b.*$", r"^table of contents$", r"^index to financial statements$", r"^part\s+[ivx]+\s+\.{2,}\s*\d+\s*$",
    r"^item\s+\d+[a-z]?(?:\.[^.]*)?\.{2,}\s*\d+\s*$",
)
BLOCKS = ("ix:header", "ix:hidden", "ix:references", "ix:resources", "xbrli:context", "xbrli:unit", "xbrli:entity", "xbrli:period", "xbrldi:explicitmember", "xbrldi:typedmember")
DROPPED_TAGS = ("script", "style", "noscript", "head", "meta", "link", "svg", "img", "object", "iframe", "footer", "nav", "form")
BLOCK_TAGS = ("br", "p", "div", "li", "tr", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6")
PREAMBLE = (r"\bform\s+10-k\b", r"\bannual\s+report\s+pursuant\s+to\s+section\s+13\s+or\s+15\s*\(d\)\b", r"\bpart\s+i\b")
PRIMARY_TYPES = ("10K", "10-K405", "10-KT", "10KSB")
# Names that are no company nodes.
EXCLUDED_NAMES = (
    r"\btrustee\b", r"\btrust(?:\s+of\s+)?(?:account|fund|estate)?\b", r"\b(?:mutual|index|exchange-traded|closed-end|open-end|money market|hedge|pension|private)?(\s+)fund\b",
    r"\bfund\s+of\s+funds\b", r"nasdaq(?:\s*-?\s*(?:100|composite|composite|global|capital market))?(?:\s+index)?$", r"^nasdaq\b", r"\bindex\s+fund\b", r"\bclosed[\s-]?end\b", r"\blagged\s+trust\b",
)
COMPETITION_HEAD, BUSINESS_HEAD, COMPETITION_WORD = r"\bitem\s*1\s*[^\n]{0,80}\bcompetition\b", r"\bitem\s*1\s*[^\n]{0,80}\bbusiness\b", r"\b(competition|competitive|competitor|compete)\b"
LARGE_CHARS, HEAD_CHARS = 200_000, 8000
HEADER_ONLY_LENGTH, CONTENT_HEAD_CHARS = (20, 499), 4096
# A section type named in a text's head, and headings that tell it.
NAMED_SECTION = r"(?:section[_\s]*type|section)\s*[:\-]\s*(\w+)"
HEAD_SECTIONS = ((r"^\s*item\s*1\s*[.\-:]?\s*business\b", "business"), (r"^\s*item\s*1\s*[.\-:]?\s*(our\s+)?competition\b", "competition"))
# Columns that may name a file, first to last; folders of cleaned filings by year.
FILE_COLUMNS = ("business_file", "business_path", "file_path", "extracted_file", "cleaned_file", "cleaned_path", "source_file", "source_path")
CLEANED_FOLDER = r"^(\d{4})_10k_cleaned$"
# Tokens of taxonomies, members and addresses; page numbers; headings of parts and items; line breaks before these.
ODD_TOKENS = (r"(?i)\b(?:us-gaap|dei|xbrli|xbrldi|ix|ixt|srt|stpr|iso4217|country|ecd):[A-Za-z0-9_.#/-]+\b", r"\b[A-Za-z][A-Za-z0-9_.-]*Member\b", r"https?://\S+")
PAGE_NUMBER, HEADING_LINE = r"^(?:-\s*)?\d{1,4}(?:\s*-)?$", r"(?i)^(part\s+[ivx]+|item\s+\d+[a-z]?)\b"
BROKEN_BEFORE = (r"(?<!\n)\b(PART\s+[IVX]+)\b", r"(?<!\n)\b(ITEM\s+\d+[A-Z]?)\b")
