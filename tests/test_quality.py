from conftest import rows
from millrace.operators import quality
from millrace.schema import ACTIVITY_RULES

DATA = [(1, None), (None, None), (2, "{}"), (None, "{}"), (3, None)]
SCHEMA = "customer_number int, _rescued_data string"


def test_rows_that_break_a_rule_are_dropped(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert rows(quality.expect_or_drop(df, ACTIVITY_RULES), "customer_number") == [(1,), (3,)]


def test_counts_per_rule(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    assert rows(quality.rule_counts(df, ACTIVITY_RULES)) == [("_rescued_data", 3, 2), ("customer_number", 3, 2)]


def test_a_condition_that_is_null_is_not_met(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    rules = {"positive": "x > 0"}
    assert rows(quality.rule_counts(df, rules)) == [("positive", 1, 1)]
    assert quality.expect_or_drop(df, rules).count() == 1


def test_counts_of_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert rows(quality.rule_counts(df, ACTIVITY_RULES)) == [("_rescued_data", 0, 0), ("customer_number", 0, 0)]
