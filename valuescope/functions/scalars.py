"""Scalar column functions: slugs, lenient integer parsing, term-URI shortening."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS

# Runs of non-word characters or underscores become one "_" (ASCII word class).
SLUG_PATTERN = "[\\W_]+"
_SLUG_RE = re.compile(r"[\W_]+", re.ASCII)

# Namespace URI -> short prefix of Darwin Core archive terms
# (public vocabularies), in their usual listing order. They are applied longest
# URI first (see ``namespace_table``) so that the overlapping pair resolves to the
# more specific prefix. The symbiota prefix has no colon; it is kept as given.
# Project-specific namespaces are passed in with ``extra``.
NAMESPACE_PREFIXES: tuple[tuple[str, str], ...] = (
    ("http://rs.tdwg.org/dwc/terms/", "dwc:"),
    ("http://purl.org/dc/terms/", "dcterms:"),
    ("http://rs.tdwg.org/ac/terms/", "ac:"),
    ("http://ns.adobe.com/xap/1.0/rights/", "xmpRights:"),
    ("http://ns.adobe.com/xap/1.0/", "xmp:"),
    ("http://iptc.org/std/Iptc4xmpExt/1.0/xmlns/", "Iptc4xmpExt:"),
    ("http://symbiota.org/terms/", "symbiota"),
)

# An integer literal with optional sign, surrounded by optional whitespace (the
# str.isspace set, as Python's int() accepts); group 1 is the literal.
INT_LITERAL = "^" + WS + "*([+-]?[0-9]+)" + WS + "*\\z"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def slug(s: Column | str) -> Column:
    """Column form of :func:`slug_text`."""
    return F.regexp_replace(_as_col(s), F.lit(SLUG_PATTERN), F.lit("_"))


def slug_text(s: str) -> str:
    """Driver-side slug of a field name, used for output folder names."""
    return _SLUG_RE.sub("_", s)


def to_int(s: Column | str, bits: int = 32) -> Column:
    """String -> integer, 0 for anything that is not a plain integer literal.

    Blanks around the number are allowed, a sign is allowed, leading zeros are
    allowed; decimals, exponents, separators, non-ASCII digits, NULL and values
    outside the integer range give 0.
    """
    target = "int" if bits == 32 else "bigint"
    literal = F.regexp_extract(_as_col(s), INT_LITERAL, 1)  # "" when not an integer literal
    return F.coalesce(literal.try_cast(target), F.lit(0)).cast(target)


def namespace_table(extra: Sequence[tuple[str, str]] = ()) -> list[tuple[str, str]]:
    """Built-in plus ``extra`` (uri, prefix) pairs, longest URI first."""
    return sorted([*NAMESPACE_PREFIXES, *extra], key=lambda p: -len(p[0]))


def shorten_term(term: str, extra: Sequence[tuple[str, str]] = ()) -> str:
    """Driver-side: replace a known namespace URI prefix by its short form."""
    for uri, prefix in namespace_table(extra):
        if term.startswith(uri):
            return prefix + term[len(uri):]
    return term


def shorten_term_col(term: Column | str, extra: Sequence[tuple[str, str]] = ()) -> Column:
    """Column form of :func:`shorten_term` (first matching URI, longest first)."""
    c = _as_col(term)
    out = None
    for uri, prefix in namespace_table(extra):
        branch = F.concat(F.lit(prefix), F.substring(c, F.lit(len(uri) + 1), F.length(c)))
        cond = c.startswith(uri)
        out = F.when(cond, branch) if out is None else out.when(cond, branch)
    return out.otherwise(c)


# Characters a text line (or a CSV line reader) cannot hold, as two-character codes.
# The backslash itself comes first, so that no other code can arise by accident.
LINE_CODES = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\z"), ("\ufeff", "\\b"))


def escape_line(value: Column) -> Column:
    """``value`` on one line: reversible by ``unescape_line``; NULL stays NULL."""
    for raw, code in LINE_CODES:
        value = F.replace(value, F.lit(raw), F.lit(code))
    return value


def unescape_line(value: Column) -> Column:
    """The text ``escape_line`` was given."""
    for raw, code in reversed(LINE_CODES):
        value = F.replace(value, F.lit(code), F.lit(raw))
    return value
