"""Column expressions; all run inside whole-stage code generation."""

from .category import category_name, is_known_category
from .split import split_mark
from .text import (
    char_count,
    first_chars,
    first_tokens,
    has_text,
    has_token,
    more_chars_than,
    more_tokens_than,
    token_count,
)

__all__ = [
    "category_name",
    "char_count",
    "first_chars",
    "first_tokens",
    "has_text",
    "has_token",
    "is_known_category",
    "more_chars_than",
    "more_tokens_than",
    "split_mark",
    "token_count",
]
