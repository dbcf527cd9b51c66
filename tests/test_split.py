import hashlib

import pytest

from sortilex.operators import split_examples


def mark(text, threshold="cd"):
    digest = hashlib.md5(text.encode()).hexdigest()
    return "train" if digest[: len(threshold)] < threshold else "test"


def test_marks(spark):
    texts = [f"text {i}" for i in range(500)] + ["", "吾輩は猫である", "𠮷"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: r.split for r in split_examples(df, "text").collect()}
    assert got == {t: mark(t) for t in texts}
    assert 0.7 < sum(v == "train" for v in got.values()) / len(got) < 0.9


def test_known_digest(spark):
    # md5("a") is 0cc175b9..., md5("b") is 92eb5ffe...
    df = spark.createDataFrame([("a",), ("b",)], "text string")
    assert [r.split for r in split_examples(df, "text", "90").collect()] == ["train", "test"]


def test_copies_fall_on_one_side(spark):
    df = spark.range(1000).selectExpr("'same text' as text", "id")
    assert split_examples(df, ["text"]).select("split").distinct().count() == 1


def test_null_key_gets_no_mark(spark):
    df = spark.createDataFrame([(None, "x"), ("a", None), ("a", "x")], "a string, b string")
    assert [r.split is None for r in split_examples(df, ["a", "b"]).collect()] == [True, True, False]


def test_keys_are_not_glued(spark):
    """The hashed key of two columns keeps the border between them."""
    pairs = [(f"a{'b' * i}", f"{'b' * (8 - i)}c") for i in range(9)]
    df = spark.createDataFrame(pairs, "x string, y string")
    got = [r.split for r in split_examples(df, ["x", "y"], "8").collect()]
    digest = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert got == [mark(digest(x) + digest(y), "8") for x, y in pairs]
    assert len(set(got)) == 2


@pytest.mark.parametrize("threshold", ["", "CD", "xy", "c" * 33])
def test_bad_thresholds_are_refused(spark, threshold):
    with pytest.raises(ValueError):
        split_examples(spark.range(1), "id", threshold)


def test_a_split_needs_a_key(spark):
    with pytest.raises(ValueError):
        split_examples(spark.range(1), [])
