import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lossledger.functions import coerce, numeric
from lossledger.operators import cleaning, contracts
from lossledger.sources import columns as c


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def read(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_numbers(spark):
    df = texts(spark, "1.5", " 7 ", "-2e3", "1.5d", "1.5f", "0x1p3", "n/a", "", None, "inf",
               "-Infinity", " INF", "1.5D ", "infd", "1d\n")
    assert read(df, coerce.number("t")) == [
        1.5, 7.0, -2000.0, None, None, None, None, None, None, math.inf,
        -math.inf, math.inf, None, None, None]


def test_percent_and_integers(spark):
    assert read(texts(spark, " 13.56%", "55%", "%", None), coerce.percent("t")) == [
        13.56, 55.0, None, None]
    assert read(texts(spark, " 36 months", "none", "99999999999"),
                coerce.first_integer("t")) == [36, None, None]


def test_employment_years(spark):
    df = texts(spark, "< 1 year", "10+ years", "1 year", "9 years", "n/a", None)
    assert read(df, coerce.employment_years("t")) == [0, 10, 1, 9, None, None]


def test_month_stamps(spark):
    df = texts(spark, "Dec-2015", " jan-1999", "DEC-2015", "2015-12", "Dec-15", None)
    assert read(df, coerce.month_stamp("t")) == [
        datetime(2015, 12, 1), datetime(1999, 1, 1), datetime(2015, 12, 1), None, None, None]


def test_months_count_boundaries(spark):
    df = spark.sql("select timestamp'2020-01-31' a, timestamp'2020-03-01' b")
    assert read(df, coerce.months_between("a", "b")) == [2]


def test_missing_values_stay_missing(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.4,), (2.0,)], "x double")
    assert read(df, numeric.unit_clip(F.col("x"))) == [None, 0.0, 0.4, 1.0]
    assert read(df, numeric.cap_at_one(F.col("x"))) == [None, -1.0, 0.4, 1.0]
    assert read(df, numeric.ratio(F.lit(1.0), F.col("x") + 1.0))[1] is None


def test_blank_difference(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (None, None), (3.0, 1.0)],
                               "a double, b double")
    assert read(df, numeric.blank_minus(F.col("a"), F.col("b"))) == [1.0, -1.0, None, 2.0]


def raw(spark, **overrides):
    row = {name: "1" for name in c.RAW} | {
        "id": "7", "loan_amnt": "1000", "funded_amnt": "1000", "issue_d": "Mar-2016",
        "earliest_cr_line": "Jan-2004", "loan_status": "Charged Off", "total_rec_prncp": "400",
        "recoveries": "100", "collection_recovery_fee": "50", "annual_inc": "0",
        "installment": "50"} | overrides
    return spark.createDataFrame([tuple(row.values())],
                                 ", ".join(f"{name} string" for name in row))


def test_one_loan(spark):
    loan = cleaning.clean_loans(raw(spark)).first()
    assert loan["vintage"] == "2016Q1" and loan["credit_history_months"] == 146
    assert loan["default_flag"] == 1
    assert loan["actual_lgd"] == pytest.approx(0.55)
    assert loan["installment_to_income"] is None


@pytest.mark.parametrize("override, lgd", [
    ({"recoveries": "n/a"}, 0.0), ({"total_rec_prncp": "5000"}, 0.0),
    ({"recoveries": "-900"}, 1.0), ({"loan_status": "Fully Paid"}, None),
    ({"loan_status": "Current"}, None), ({"funded_amnt": "0"}, 0.0)])
def test_realized_lgd(spark, override, lgd):
    assert cleaning.clean_loans(raw(spark, **override)).first()["actual_lgd"] == lgd


@pytest.mark.parametrize("override", [
    {"id": None}, {"loan_amnt": "Total amount funded"}, {"issue_d": "n/a"}])
def test_rows_that_are_no_loans(spark, override):
    assert cleaning.clean_loans(raw(spark, **override)).count() == 0


def test_contracts_find_what_is_broken(spark):
    df = spark.createDataFrame(
        [("1", 1, 0.5, 10.0), ("1", 0, 0.5, -1.0), (None, 2, 1.5, 1.0), ("4", None, None, None)],
        "id string, default_flag int, actual_lgd double, ead double")
    found = {r["check"]: r["n_bad"] for r in contracts.clean_contracts(df).collect()}
    assert found == {"id_missing": 1, "id_repeated": 1, "flag_outside_domain": 1,
                     "lgd_outside_unit_range": 1, "lgd_without_default": 2, "ead_negative": 1}
