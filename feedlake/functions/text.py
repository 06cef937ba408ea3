"""String column functions (built-in Spark expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import vocab

# Python's notion of white space (str.isspace) spelled out as a regex class.
# Java's \s is ASCII-only, so the Unicode members are listed one by one.
WS_CLASS = (r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
TAG_RE = r"<[^>]+>"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Python ``str.strip()``: remove Unicode white space at both ends."""
    return F.regexp_replace(_c(col), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


# The members of WS_CLASS outside Java's ASCII \s, one character each.
_EXTRA_WS = ("\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
             + "\u2028\u2029\u202f\u205f\u3000")


def collapse_ws(col) -> Column:
    """Each run of white space becomes one space, then strip.

    Non-ASCII white space is first mapped to a plain space with ``translate``
    (a per-character table, no regex), so the run-collapsing regex is the
    fast ASCII white-space regex; the result is the same as one Unicode-class
    regex.
    """
    ascii_ws = F.translate(_c(col), _EXTRA_WS, " " * len(_EXTRA_WS))
    return F.trim(F.regexp_replace(ascii_ws, r"\s+", " "))


def clean_html(col, max_chars: int = vocab.SUMMARY_MAX_CHARS) -> Column:
    """Tags become a space, white space collapsed, cut to ``max_chars`` code points.

    Entities are not decoded (same as the original cleaner).
    """
    no_tags = F.regexp_replace(_c(col), TAG_RE, " ")
    return F.substring(collapse_ws(no_tags), 1, max_chars)


def non_empty(col) -> Column:
    """NULL for NULL or empty strings (Python falsiness of a string)."""
    c = _c(col)
    return F.when(c != F.lit(""), c)


def summary_fallback(summary, description) -> Column:
    """First non-empty of summary, description, ''."""
    return F.coalesce(non_empty(summary), non_empty(description), F.lit(""))


def item_hash(link) -> Column:
    """Identity hash: SHA-256 hex of the link's UTF-8 bytes."""
    return F.sha2(_c(link), 256)


def display_title(translated_title, title) -> Column:
    return F.coalesce(non_empty(translated_title), _c(title))


def clip_text(col, limit: int) -> Column:
    """Cut to ``limit`` characters: ``limit-1`` characters plus an ellipsis."""
    c = _c(col)
    return F.when(F.length(c) > limit,
                  F.concat(F.substring(c, 1, limit - 1), F.lit("…"))).otherwise(c)


def escape_brackets(col) -> Column:
    """Square brackets become parentheses (keeps link syntax intact)."""
    return F.translate(_c(col), "[]", "()")


def default_text(col, default: str) -> Column:
    """Stripped text, or ``default`` when empty/NULL."""
    return F.coalesce(non_empty(strip_ws(col)), F.lit(default))


def archive_link(base, rel_path, branch_path: str = "blob/main") -> Column:
    """Public link of an archived report; NULL when no base URL is configured."""
    b = _c(base)
    return F.when(b.isNotNull() & (b != F.lit("")),
                  F.concat(F.regexp_replace(b, "/+$", ""), F.lit(f"/{branch_path}/"),
                           F.regexp_replace(_c(rel_path), r"\\", "/")))


def capitalize(col) -> Column:
    """Python ``str.capitalize()``: first letter upper, the rest lower."""
    c = _c(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def url_is_secure(col) -> Column:
    """Scheme https (case-insensitive) and a non-empty network location."""
    return F.coalesce(_c(col).rlike(r"^(?i)https://[^/?#]+"), F.lit(False))
