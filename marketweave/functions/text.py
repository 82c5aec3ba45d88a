"""Text cleaning as built-in column expressions (no Python workers).

Words and whitespace are Unicode notions here.  Java's ``\\s`` and ``\\w`` are
ASCII-only, so the classes are spelled out: letters and numbers by category, and
whitespace as ASCII space characters, the information separators, NEL and every
Unicode separator.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WS = r"\s\x1c-\x1f\x85\p{Z}"
_NOT_WORD_OR_SPACE = rf"[^\p{{L}}\p{{N}}_{WS}]+"
_NOT_WORD = r"[^\p{L}\p{N}_]+"
_SPACES = rf"[{WS}]+"
_OUTER_SPACES = rf"^[{WS}]+|[{WS}]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_words(c: Column | str) -> Column:
    """Delete everything but words and whitespace, lower-case, collapse whitespace."""
    kept = F.lower(F.regexp_replace(_col(c), _NOT_WORD_OR_SPACE, ""))
    return F.trim(F.regexp_replace(kept, _SPACES, " "))


def normalize_query(category: Column | str, subcategory: Column | str) -> Column:
    """Search words of a listing: ``"pet food", "Dry & Wet"`` -> ``pet food dry wet``."""
    return clean_words(F.concat(_col(category), F.lit(" "), _col(subcategory)))


def slug(c: Column | str) -> Column:
    """Cleaned words joined by ``_`` (underscores inside words stay)."""
    return F.translate(clean_words(c), " ", "_")


def safe_key(c: Column | str) -> Column:
    """Each run of non-word characters becomes one ``_``; usable as a path segment."""
    return F.regexp_replace(_col(c), _NOT_WORD, "_")


def strip_text(c: Column | str) -> Column:
    """Trim Unicode whitespace at both ends."""
    return F.regexp_replace(_col(c), _OUTER_SPACES, "")


def compose_description(bullets: Column | str, long_text: Column | str) -> Column:
    """Bullets and long text on separate lines, lower-cased and trimmed; never null."""
    whole = F.concat(
        F.coalesce(_col(bullets), F.lit("")),
        F.lit("\n"),
        F.coalesce(_col(long_text), F.lit("")),
    )
    return strip_text(F.lower(whole))

