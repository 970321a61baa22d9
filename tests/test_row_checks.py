"""Row-local tests P1-P9, P11 and the failing-row projection P17."""

import pytest

from tessera.plans.engine import ObjectRun, validate
from tests.fixtures import CLOCK, customers, mapping, orders


def failures(spark, df, logic, column, pk="customer_id"):
    r = validate(spark, ObjectRun(1, "customers", pk, df, [mapping(1, column, logic, pk=pk)], CLOCK))
    errs = r.rule_errors.collect()
    assert not errs, errs
    return sorted(((row["Primary_Key_Value_s_"], row["Actual_Value"]) for row in r.detailed.collect()),
                  key=lambda t: tuple("" if v is None else v for v in t))


def test_not_null(spark):
    assert failures(spark, customers(spark), '{"is_nullable": "NO"}', "email") == [("3", None)]


def test_not_null_multi_column_any_part(spark):
    got = failures(spark, customers(spark), '{"is_nullable": "NO"}', "customer_id, region")
    assert got == [(None, None), ("3", None)]


def test_regex_unanchored_find_and_null_skipped(spark):
    got = failures(spark, customers(spark), '{"regex": "@x\\\\.com"}', "email")
    assert got == [("2", "bad-email")]


def test_min_max_numeric_boundaries(spark):
    assert failures(spark, customers(spark), '{"min": 0}', "score") == [("3", "-1.0")]
    assert failures(spark, customers(spark), '{"max": 100}', "score") == [(None, "100.5")]


def test_min_on_text_column_reads_numbers_only(spark):
    # 'not a date' cannot be read as a number: not a failure of min
    df = customers(spark).selectExpr("customer_id", "CAST(score AS STRING) AS s")
    assert failures(spark, df, '{"min": "0"}', "s") == [("3", "-1.0")]


def test_lengths(spark):
    assert failures(spark, customers(spark), '{"min_length": 2}', "name") == [("3", "C")]
    assert failures(spark, customers(spark), '{"max_length": 2}', "name") == [(None, "Eve"), ("1", "Ann"),
                                                                             ("6", "Fay")]


def test_dates_on_text_with_unparseable_value(spark):
    got = failures(spark, customers(spark), '{"min_date": "2020-01-01"}', "signup")
    assert got == [("2", "2019-12-31")]
    got = failures(spark, customers(spark), '{"max_date": ["2024-06-30", "yyyy-MM-dd"]}', "signup")
    assert got == [(None, "2024-07-01")]


def test_current_date_is_the_run_day(spark):
    got = failures(spark, orders(spark), '{"max_date": "CURRENT_DATE"}', "order_date", pk="order_id")
    assert got == [("12", "2024-06-02 00:00:00")]


def test_allowed_and_forbidden_lists(spark):
    got = failures(spark, customers(spark), '{"allowed": ["Active", "Pending", "Closed", null]}', "status")
    assert got == [("3", "Deleted")]
    got = failures(spark, customers(spark), '{"forbidden": ["Deleted", "N/A"]}', "status")
    assert got == [("3", "Deleted")]


def test_allowed_numbers_on_int_column(spark):
    got = failures(spark, customers(spark), '{"allowed": [1, 2, 3, "6"]}', "customer_id")
    assert got == []


def test_two_tests_in_one_rule_report_a_row_twice(spark):
    got = failures(spark, customers(spark), '{"min": 0, "max": -0.5}', "score")
    assert got.count(("3", "-1.0")) == 1 and len(got) == 5


@pytest.mark.parametrize("logic", ['{"min": "2020-01-01"}', '{"min_length": "x"}', '{"regex": 5}'])
def test_unusable_values_become_rule_errors(spark, logic):
    r = validate(spark, ObjectRun(1, "customers", "customer_id", customers(spark),
                                  [mapping(1, "score", logic)], CLOCK))
    assert r.rule_errors.count() == 1 and r.detailed.count() == 0


def test_boolean_lists(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "customer_id int, flag boolean")
    assert failures(spark, df, '{"allowed": [true]}', "flag") == [("2", "false")]
    assert failures(spark, df, '{"forbidden": [true, "false"]}', "flag") == [("1", "true"), ("2", "false")]
