"""Document classification into a closed set of categories, on Spark."""

from .settings import CATEGORY_LIST, MAX_LENGTH, Settings

__all__ = ["CATEGORY_LIST", "MAX_LENGTH", "Settings"]
