"""Column expressions on document text.

A token is a run of characters other than space, tab, CR, LF and FF. Text
without such separators, Japanese for one, is a single token; use characters
(Unicode code points) there.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[ \t\n\r\f]"
WORD = r"[^ \t\n\r\f]"


def has_text(text: Column) -> Column:
    """True unless the text is null or empty."""
    return F.coalesce(F.octet_length(text) > 0, F.lit(False))


def has_token(text: Column) -> Column:
    """True if the text has a token; stops at the first."""
    return F.coalesce(text.rlike(WORD), F.lit(False))


def _leading_tokens(text: Column, n: int) -> Column:
    # Possessive quantifiers: one pass, no backtracking, no recursion for large
    # n, and the scan stops after n tokens however long the text is.
    return F.regexp_extract(text, rf"^{SPACE}*+(?:{WORD}++{SPACE}*+){{0,{n}}}+", 0)


def first_tokens(text: Column, n: int) -> Column:
    """The first ``n`` tokens, joined by one space."""
    head = _leading_tokens(text, n)
    for space in "\t\n\r\f":
        head = F.replace(head, F.lit(space), F.lit(" "))
    # Runs are rare, so look for one before the slower pattern.
    single = F.when(head.contains("  "), F.regexp_replace(head, " {2,}", " ")).otherwise(head)
    return F.trim(single)


def more_tokens_than(text: Column, n: int) -> Column:
    """True if the text has more than ``n`` tokens."""
    return F.octet_length(_leading_tokens(text, n)) < F.octet_length(text)


def token_count(text: Column) -> Column:
    """Number of tokens in the whole text."""
    return F.array_size(F.array_remove(F.split(text, f"{SPACE}+"), ""))


def first_chars(text: Column, n: int) -> Column:
    """The first ``n`` code points, spacing kept."""
    return F.substring(text, 1, n)


def more_chars_than(text: Column, n: int) -> Column:
    """True if the text has more than ``n`` code points."""
    return F.length(text) > n


def char_count(text: Column) -> Column:
    """Number of code points in the whole text."""
    return F.length(text)
