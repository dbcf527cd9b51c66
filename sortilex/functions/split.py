"""Column expression that marks a row as train or test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import SPLIT_THRESHOLD, check_threshold


def split_mark(keys: list[Column], threshold: str = SPLIT_THRESHOLD) -> Column:
    """``train`` if the md5 of the key starts below ``threshold``, else ``test``.

    Equal keys get equal marks on every run and every cluster. Several keys are
    hashed one by one first, so that ("ab", "c") and ("a", "bc") stay apart. A
    null in any key gives null.
    """
    check_threshold(threshold)
    if not keys:
        raise ValueError("a split needs at least one key column")
    digests = [F.md5(key.cast("string")) for key in keys]
    digest = digests[0] if len(digests) == 1 else F.md5(F.concat(*digests))
    prefix = F.substring(digest, 1, len(threshold))
    return F.when(prefix < threshold, "train").when(prefix.isNotNull(), "test")
