"""Cap document text at a maximum length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..settings import MAX_LENGTH, check_length


def truncate_documents(
    df: DataFrame, max_length: int = MAX_LENGTH, unit: str = "token", text_col: str = "text"
) -> DataFrame:
    """Add ``truncated_text``, ``n_units`` and ``was_truncated``.

    ``unit="token"`` counts runs of characters between spaces, tabs, CR, LF and
    FF, and joins what it keeps by single spaces. ``unit="char"`` counts code
    points and keeps the spacing; choose it for text written without spaces.
    Short text is not padded. Null text gives nulls. ``n_units`` is the length
    of the whole text; where it is not selected, it is not computed, and a
    token cut then reads only the head of each text.
    """
    check_length(max_length, unit)
    text = F.col(text_col)
    if unit == "token":
        added = {
            "truncated_text": X.first_tokens(text, max_length),
            "n_units": X.token_count(text),
            "was_truncated": X.more_tokens_than(text, max_length),
        }
    else:
        added = {
            "truncated_text": X.first_chars(text, max_length),
            "n_units": X.char_count(text),
            "was_truncated": X.more_chars_than(text, max_length),
        }
    return df.withColumns(added)
