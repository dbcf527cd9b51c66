"""Mix sources to target weights: whole repeats plus one seeded draw per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import free_name

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_REPEATS = 2
WORD = r"[^\x20\x09-\x0D]+"
_DRAW_DIGITS = 13


# What separates words but is not a single space.
_GAP = r"[\x09-\x0D][\x20\x09-\x0D]*+|\x20[\x20\x09-\x0D]++"


def word_count(text: Column) -> Column:
    """Words of a text as a long; null has none.

    With gaps made single spaces, words are the spaces between them and one;
    this is faster than collecting each word.
    """
    even = F.trim(F.regexp_replace(text, _GAP, " "))
    spaces = F.octet_length(even) - F.octet_length(F.replace(even, F.lit(" "), F.lit("")))
    return F.when(even != "", spaces + 1).otherwise(0).cast("long")


PLAN = ("size", "source_size", "target", "copies")


def source_targets(sizes: DataFrame, weights=WEIGHTS, percent: int = SHARE_PERCENT) -> DataFrame:
    """Rows ``(source, source_size, target)`` from rows ``(source, source_size)``.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``percent`` of all sizes. A target stops at twice its source's size, and the
    others share what is left by weight. With sources ordered by the level at
    which they stop, the level of the rest follows from running sums, so no
    loop is needed. The windows see one row per source.
    """
    every, by_name = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    cap = MAX_REPEATS * F.col("source_size")
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    rows = (
        sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
        .withColumn("level", cap / F.col("weight"))
        .withColumn("place", F.row_number().over(by_level))
        .withColumn(
            "left",
            percent * F.sum("source_size").over(every)
            - 100 * MAX_REPEATS * F.coalesce(F.sum("source_size").over(before), zero),
        )
        .withColumn(
            "left_weight",
            F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), zero),
        )
        .withColumn("share", F.col("left") / (100 * F.col("left_weight")))
    )
    fits = F.when(F.col("share") <= F.col("level"), F.struct("place", "share"))
    rows = rows.withColumn("first_fit", F.min(fits).over(every))
    stopped = F.col("place") < F.coalesce(F.col("first_fit.place"), F.lit(2**31 - 1))
    target = F.when(stopped, cap.cast("double")).otherwise(
        F.col("weight") * F.col("first_fit.share")
    )
    return rows.select("source", "source_size", target.alias("target"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), doc_id.cast("string")))
    number = F.conv(F.substring(digest, 1, _DRAW_DIGITS), 16, 10).cast("double")
    return number / float(16**_DRAW_DIGITS)


def _planned(documents: DataFrame, names: dict[str, str], seed: str, weights) -> DataFrame:
    """``documents`` with the plan's columns under the given ``names``, which it has not."""
    size, source_size, target, copies = (names[n] for n in PLAN)
    given = free_name(documents, "mix_source")
    sized = documents.withColumn(size, word_count(F.col("text").cast("string")))
    sizes = sized.groupBy("source").agg(F.sum(size).alias("source_size"))
    targets = source_targets(sizes, weights).select(
        F.col("source").alias(given),
        F.col("source_size").alias(source_size),
        F.col("target").alias(target),
    )
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col(given)), "left").drop(given)
    rate = F.col(target) / F.when(F.col(source_size) > 0, F.col(source_size))
    rate = F.coalesce(rate, F.lit(0.0))
    extra = draw(F.col("doc_id"), seed) < rate - F.floor(rate)
    return joined.withColumn(copies, (F.floor(rate) + extra.cast("long")).cast("long"))


def plan_mix(documents: DataFrame, seed: str = "mix", weights=WEIGHTS) -> DataFrame:
    """``documents`` with ``size``, ``source_size``, ``target`` and ``copies``.

    A document's rate is its source's target over its source's size. It is taken
    floor(rate) times, and once more if its seeded draw lies below the fraction,
    so a rerun agrees and no document is taken more than twice. A null source is
    a source of its own, a null text has size 0, rows that repeat a doc_id share
    one draw and a null doc_id draws as the empty one. A source without words
    has target 0 and is not taken. Columns of these four names are replaced.
    An empty table gives no rows. Sizes are summed per source before the
    shuffle; the table of sources, one row each, joins back by Spark's choice.
    """
    return _planned(documents.drop(*PLAN), {n: n for n in PLAN}, seed, weights)


def mix_sources(documents: DataFrame, seed: str = "mix", weights=WEIGHTS) -> DataFrame:
    """The mix itself: each document as often as ``plan_mix`` takes it.

    ``copy`` counts a document's repeats from 0; a column of that name is replaced,
    all others come back as they are.
    """
    given = documents.drop("copy")
    names = {n: free_name(given, f"mix_{n}") for n in PLAN}
    planned = _planned(given, names, seed, weights).filter(F.col(names["copies"]) > 0)
    repeats = F.explode(F.sequence(F.lit(0).cast("long"), F.col(names["copies"]) - 1))
    return planned.select(*(f"`{c}`" for c in given.columns), repeats.alias("copy"))
