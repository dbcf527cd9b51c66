"""Column expressions on the closed category domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import check_categories


def is_known_category(category: Column, categories) -> Column:
    """True for a name of the domain, false for any other and for null."""
    return F.coalesce(category.isin(*check_categories(categories)), F.lit(False))


def category_name(label: Column, categories) -> Column:
    """The name at position ``label``; null outside the domain."""
    names = F.array(*(F.lit(name) for name in check_categories(categories)))
    return F.get(names, label.cast("int"))
