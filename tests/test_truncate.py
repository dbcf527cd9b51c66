import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sortilex.operators import truncate_documents

TEXTS = "text string"


def cut(spark, texts, n, unit):
    df = spark.createDataFrame([(t,) for t in texts], TEXTS)
    rows = truncate_documents(df, n, unit).collect()
    return [(r.truncated_text, r.n_units, r.was_truncated) for r in rows]


def test_tokens_by_hand(spark):
    got = cut(
        spark,
        [
            "a b c",
            "a b",
            "  a\t\tb\n",
            "a\r\nb\fc d",
            "",
            "   ",
            None,
            "吾輩は猫である",
            "吾輩は　猫",
            "x y z w",
            "a\vb c d",
        ],
        2,
        "token",
    )
    assert got == [
        ("a b", 3, True),
        ("a b", 2, False),
        ("a b", 2, False),
        ("a b", 4, True),
        ("", 0, False),
        ("", 0, False),
        (None, None, None),
        ("吾輩は猫である", 1, False),
        ("吾輩は　猫", 1, False),
        ("x y z", 3, True),
        ("a\vb c", 3, True),
    ]


def test_chars_by_hand(spark):
    got = cut(
        spark,
        ["吾輩は猫である", "𠮷野家𠮷", "éá", " a b ", "", None, "👩‍👩‍👧"],
        3,
        "char",
    )
    assert got == [
        ("吾輩は", 7, True),
        ("𠮷野家", 4, True),
        ("éa", 4, True),
        (" a ", 5, True),
        ("", 0, False),
        (None, None, None),
        ("👩‍👩", 5, True),
    ]


def test_exact_limit_is_not_truncated(spark):
    exact = " ".join(["w"] * 128)
    assert cut(spark, [exact, exact + " ", exact + " w"], 128, "token") == [
        (exact, 128, False),
        (exact, 128, False),
        (exact, 129, True),
    ]


def test_long_limits_and_long_texts(spark):
    text = " ".join(str(i) for i in range(50_000))
    ((head, count, was_cut),) = cut(spark, [text], 20_000, "token")
    assert head == " ".join(str(i) for i in range(20_000))
    assert (count, was_cut) == (50_000, True)


def test_cutting_twice_changes_nothing(spark):
    df = spark.createDataFrame([(" a  b\tc d\n",), ("a",), ("",)], TEXTS)
    once = truncate_documents(df, 3).select("truncated_text")
    twice = truncate_documents(once, 3, text_col="truncated_text")
    assert [r.truncated_text for r in twice.collect()] == [r.truncated_text for r in once.collect()]


SPACES = " \t\n\r\f"
ALPHABET = SPACES * 3 + "ab猫𠮷́　 \v.$\\"


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=20, max_size=80), st.integers(1, 6))
def test_against_plain_python(spark, texts, n):
    tokens = [re.findall(r"[^ \t\n\r\f]+", t) for t in texts]
    assert cut(spark, texts, n, "token") == [
        (" ".join(t[:n]), len(t), len(t) > n) for t in tokens
    ]
    assert cut(spark, texts, n, "char") == [(t[:n], len(t), len(t) > n) for t in texts]


@pytest.mark.parametrize("n,unit", [(0, "token"), (-1, "char"), (5, "byte")])
def test_bad_limits_are_refused(spark, n, unit):
    with pytest.raises(ValueError):
        truncate_documents(spark.createDataFrame([("a",)], TEXTS), n, unit)
