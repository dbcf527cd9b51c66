from sortilex.operators import class_metrics, confusion_matrix, long_metrics

NAMES = ("a", "b", "c", "d")
SCHEMA = "label int, prediction int"
# (label, prediction): class a 2 hits of 3; b 1 hit of 2; c has no prediction;
# d neither; one null label, one null prediction, one label outside the domain.
ROWS = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 0), (2, 0), (None, 1), (2, None), (7, 0)]


def test_confusion_matrix(spark):
    got = confusion_matrix(spark.createDataFrame(ROWS, SCHEMA))
    assert {(r.label, r.prediction): r.n for r in got.collect()} == {
        (0, 0): 2, (0, 1): 1, (1, 1): 1, (1, 0): 1, (2, 0): 1, (None, 1): 1, (2, None): 1, (7, 0): 1,
    }


def test_class_metrics_by_hand(spark):
    got = class_metrics(spark.createDataFrame(ROWS, SCHEMA), NAMES).orderBy("label").collect()
    assert [tuple(r) for r in got] == [
        (0, "a", 3, 5, 2, 2 / 5, 2 / 3, 4 / 8),
        (1, "b", 2, 3, 1, 1 / 3, 1 / 2, 2 / 5),
        (2, "c", 2, 0, 0, None, 0.0, 0.0),
        (3, "d", 0, 0, 0, None, None, None),
    ]


def test_no_rows_still_gives_every_class(spark):
    got = class_metrics(spark.createDataFrame([], SCHEMA), NAMES).collect()
    assert sorted(r.category for r in got) == list(NAMES)
    assert all(r.support == 0 and r.f1 is None for r in got)


def test_predictions_of_a_model_are_doubles(spark):
    scored = spark.createDataFrame([(1.0, 1.0)], "label double, prediction double")
    by_name = {r.category: r for r in class_metrics(scored, NAMES).collect()}
    assert by_name["b"].precision == 1.0 and by_name["a"].precision is None


def test_long_metrics(spark):
    scored = spark.createDataFrame([(0, 0), (0, 1)], SCHEMA)
    got = {(r.category, r.metric): r.value for r in long_metrics(class_metrics(scored, ("a", "b"))).collect()}
    assert got == {
        ("a", "support"): 2.0, ("a", "predicted"): 1.0, ("a", "true_positive"): 1.0,
        ("a", "precision"): 1.0, ("a", "recall"): 0.5, ("a", "f1"): 2 / 3,
        ("b", "support"): 0.0, ("b", "predicted"): 1.0, ("b", "true_positive"): 0.0,
        ("b", "precision"): 0.0, ("b", "recall"): None, ("b", "f1"): 0.0,
    }
