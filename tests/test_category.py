import pytest

from sortilex import CATEGORY_LIST
from sortilex.operators import (
    category_domain,
    decode_category,
    encode_category,
    reject_unknown_category,
)

ROWS = [(1, "peachy"), (2, "smax"), (3, "Peachy"), (4, None), (5, ""), (6, "peachy ")]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, "id int, name string")


def test_domain(spark):
    domain = category_domain(spark)
    assert domain.dtypes == [("label", "int"), ("category", "string")]
    got = [tuple(r) for r in domain.orderBy("label").collect()]
    assert got == list(enumerate(CATEGORY_LIST))
    assert got[5] == (5, "peachy")


@pytest.mark.parametrize("bad", [[], ["a", "a"], ["a", None]])
def test_bad_domains_are_refused(spark, bad):
    with pytest.raises(ValueError):
        category_domain(spark, bad)


EXPECTED = {1: 5, 2: 6, 3: None, 4: None, 5: None, 6: None}


def test_encode(docs):
    got = encode_category(docs, "name")
    assert got.columns == ["id", "name", "label"]
    assert {r.id: r.label for r in got.collect()} == EXPECTED


def test_a_large_domain_is_not_broadcast(docs, plan):
    """At default settings; Spark puts a row of the domain at 16 bytes."""
    names = [f"c{i}" for i in range(800_000)] + ["peachy"]
    got = encode_category(docs, "name", names)
    assert "Broadcast" not in plan(got)
    assert {r.id: r.label for r in got.collect()} == {**dict.fromkeys(EXPECTED), 1: 800_000}
    assert "BroadcastHashJoin" in plan(encode_category(docs, "name"))


def test_encode_without_broadcast(docs, plan):
    """The same rows come from a join that shuffles."""
    docs.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = encode_category(docs, "name")
        assert "Broadcast" not in plan(got)
        assert {r.id: r.label for r in got.collect()} == EXPECTED
    finally:
        docs.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_encode_keeps_an_existing_label(docs):
    with pytest.raises(ValueError):
        encode_category(docs, "name", label_col="id")


def test_decode(spark):
    ids = spark.createDataFrame([(0,), (8,), (9,), (-1,), (None,)], "label int")
    got = [(r.label, r.category) for r in decode_category(ids, "label").collect()]
    assert got == [(0, "dokujo-tsushin"), (8, "topic-news"), (9, None), (-1, None), (None, None)]


def test_decode_takes_ml_predictions(spark):
    ids = spark.createDataFrame([(5.0,)], "prediction double")
    assert decode_category(ids, "prediction").first().category == "peachy"


def test_reject(docs):
    valid, rejected = reject_unknown_category(docs, "name")
    assert sorted(r.id for r in valid.collect()) == [1, 2]
    assert sorted(r.id for r in rejected.collect()) == [3, 4, 5, 6]
