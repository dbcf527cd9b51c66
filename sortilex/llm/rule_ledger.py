"""Quality rules: every rule once per document, then policies over the stored bits.

The ledger holds the measurements and one bit per failed rule. Policies are bit
masks with a version; a verdict, a change of policy or an ablation reads the
ledger alone and never a text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mixing import WORD

WINDOW = 5
SYMBOLS = "#*$%&|<>"

# Bit of each rule, in order, with the test of the measurements that fails it.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "many_symbols": "100 * n_symbols > 5 * word_chars",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 25 * n_words",
    "shouting": "2 * n_upper > word_chars",
    "exclamations": "10 * n_exclaims > 3 * n_words",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]
POLICIES = {
    "base": BASE,
    "v1": BASE | BIT["many_symbols"] | BIT["repeated_lines"] | BIT["word_length"],
    "v2": sum(BIT.values()),
}


def _beside(array: str, join) -> Column:
    """Each element of a column of arrays joined to the one after it."""
    n = F.size(array) - 1
    return F.zip_with(F.slice(array, F.lit(1), n), F.slice(array, F.lit(2), n), join)


def _pairs(left: str, right: str, skip: int) -> Column:
    """Hashes of ``left`` joined to those of ``right`` that stand ``skip`` later."""
    n = F.greatest(F.size(right) - skip, F.lit(0))
    ahead = F.slice(right, skip + 1, n)
    return F.zip_with(F.slice(left, F.lit(1), n), ahead, lambda a, b: F.xxhash64(a, b))


def ledger(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, the measurements, and ``failures``, one bit per failed rule.

    A null or empty text has no words and fails ``few_words``. Rows that repeat
    a doc_id are measured one by one; a null doc_id stays null. Everything is
    local to the row: no shuffle. Of the other columns none is read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    rows = documents.select("doc_id", text.alias("text"), words.alias("words"))
    drop = lambda pattern: F.length(F.regexp_replace("text", pattern, ""))
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        drop(f"[^{SYMBOLS}]+").cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))).cast("long").alias("n_exclaims"),
        (F.length("text") - drop(r"\p{Lu}+")).cast("long").alias("n_upper"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("one"),
    )
    # Windows of five words as two, four and five.
    rows = rows.withColumn("two", _pairs("one", "one", 1))
    rows = rows.withColumn("four", _pairs("two", "two", 2))
    rows = rows.withColumn("windows", _pairs("four", "one", WINDOW - 1))
    # Sorting puts equal windows side by side, so a long text costs n log n; texts
    # without a repeat stop here. Each step is a column of its own, as Spark
    # would work out a nested step once for each mention.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    rows = rows.withColumn("placed", F.when(repeats, placed))
    rows = rows.withColumn("same", _beside("placed", lambda a, b: a.h == b.h))
    none = F.array(F.lit(False))
    either = F.zip_with(F.concat(none, "same"), F.concat("same", none), lambda a, b: a | b)
    taken = F.zip_with("placed", either, lambda p, r: F.when(r, p.i))
    starts = F.sort_array(F.filter(taken, lambda i: i.isNotNull()))
    rows = rows.withColumn("starts", starts)
    gaps = _beside("starts", lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda total, step: total + step)
    measured = rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_exclaims",
        "n_upper",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    bits = [F.when(F.expr(failed), F.lit(BIT[name])).otherwise(0) for name, failed in RULES.items()]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    return measured.withColumn("failures", failures)


def passes(policy: str, failures: str = "failures") -> Column:
    """Whether a ledger row fails no rule of the policy."""
    return F.col(failures).bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(ledger_rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and more.

    ``failed`` counts rows that fail the rule, ``only`` those that no other rule
    of the policy would catch, ``kept_without`` what the policy keeps with the
    rule left out, and ``seen_with`` has the bits of all rules that fail beside
    it somewhere. One pass; each task sends one row per distinct bit pattern.
    """
    mask = POLICIES[policy]
    patterns = ledger_rows.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count("*").alias("n")
    )
    rules = F.explode(
        F.array(
            *(
                F.struct(F.lit(name).alias("rule"), F.lit(bit).alias("bit"))
                for name, bit in BIT.items()
                if bit & mask
            )
        )
    ).alias("r")
    has = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    others = F.col("bits").bitwiseAND(F.lit(mask) - F.col("r.bit"))
    count = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    return (
        patterns.select("bits", "n", rules)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            count(has).alias("failed"),
            count(has & (others == 0)).alias("only"),
            count(others == 0).alias("kept_without"),
            F.coalesce(F.bit_or(F.when(has, others)), F.lit(0)).alias("seen_with"),
        )
    )
