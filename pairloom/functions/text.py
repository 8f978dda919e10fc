"""Text expressions: strip, boundary test and word split."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# The code points that Python's str.strip removes.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Whitespace pre-tokenizer: runs of word characters, or runs of characters
# that are neither word characters nor whitespace.
WORD_PATTERN = r"(?U)\w+|[^\w\s]+"
# Lines starting with this mark are article headings and end a document.
HEADING_MARK = "="
# --- end of fixed values ----------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c) -> Column:
    """``str.strip()`` semantics on a string column, in linear time."""
    return F.btrim(_col(c), F.lit(STRIP_CHARS))


def strip_start(c) -> Column:
    """``str.lstrip()`` semantics: enough to tell a boundary, and the row's end is not searched."""
    return F.ltrim(_col(c), F.lit(STRIP_CHARS))


def required(c, what: str) -> Column:
    """The column; a NULL in it ends the job with an error."""
    return F.coalesce(_col(c), F.raise_error(F.lit(f"{what} must not be NULL")))


def is_boundary(stripped) -> Column:
    """A stripped row ends the current document if empty or a heading."""
    s = _col(stripped)
    return (s == F.lit("")) | s.startswith(HEADING_MARK)


def split_words(c) -> Column:
    """Whitespace/punctuation word split into ``array<string>``."""
    return F.regexp_extract_all(_col(c), F.lit(WORD_PATTERN), 0)


def split_keeping(literals: Iterable[str]) -> Callable[[Column], Column]:
    """``split_words`` that keeps each of ``literals`` whole wherever it stands, also inside a
    run of punctuation or between letters; of two that start at one place, the longer."""
    literals = sorted(set(literals), key=lambda t: (-len(t), t))
    if not literals or "" in literals:
        raise ValueError("literals must not be empty")
    whole = "|".join("".join(f"\\x{{{ord(ch):x}}}" for ch in t) for t in literals)
    # a run of word characters meets no literal that starts with ASCII punctuation
    plain = all(t[0] in string.punctuation and t[0] != "_" for t in literals)
    words = r"\w+" if plain else rf"(?:(?!{whole})\w)+"
    pattern = rf"(?U){whole}|{words}|(?:(?!{whole})[^\w\s])+"
    return lambda c: F.regexp_extract_all(_col(c), F.lit(pattern), 0)
