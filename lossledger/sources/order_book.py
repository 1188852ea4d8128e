"""A raw, all-text loan table derived from the order tables: one loan per order.

The order tables are the only given input, so loans are derived from them with integer arithmetic
that any SQL engine repeats exactly. Amounts pass through integer cents, because engines differ
in how they round a double to a decimal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _decimal_text(whole: str, digits: int) -> str:
    """Non-negative integer ``whole`` times 10^-digits, as text with exactly that many digits."""
    unit = 10 ** digits
    return f"concat(({whole}) div {unit}, '.', lpad(({whole}) % {unit}, {digits}, '0'))"


def _pick(by: int, *texts: str) -> str:
    """One text per remainder of the order key, NULL for the remainders beyond."""
    arms = " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(texts))
    return f"CASE k % {by} {arms} END"


def _pattern(times: int, modulus: int, plus: int = 0) -> str:
    return f"(k * {times}) % {modulus} + {plus}"


# How each text column of a loan follows from its order key k, its order's price in cents, the
# digit g of its priority, and the totals of its lines.
_COUNTS = {
    "delinq_2yrs": (3, 4, 0), "inq_last_6mths": (37, 9, 0), "open_acc": (11, 18, 2),
    "pub_rec": (17, 3, 0), "total_acc": (23, 35, 5), "mort_acc": (19, 5, 0),
    "pub_rec_bankruptcies": (29, 2, 0), "num_actv_bc_tl": (41, 10, 0),
    "num_tl_90g_dpd_24m": (43, 3, 0), "mo_sin_old_rev_tl_op": (47, 288, 12),
    "acc_open_past_24mths": (53, 10, 0)}
_BALANCES = {
    "revol_bal": 4000000, "tot_cur_bal": 20000000, "total_bal_ex_mort": 10000000,
    "total_bc_limit": 5000000, "tot_hi_cred_lim": 30000000, "avg_cur_bal": 3000000,
    "bc_open_to_buy": 2000000, "total_rec_late_fee": 5000, "last_pymnt_amnt": 100000}
_LOAN = {
    "id": "string(k)",
    "loan_amnt": _decimal_text("cents", 2),
    "funded_amnt": _decimal_text("cents", 2),
    "term": "if(k % 3 = 0, ' 60 months', ' 36 months')",
    "int_rate": f"concat({_decimal_text('500 + 300 * g + ' + _pattern(7, 251), 2)}, '%')",
    "installment": _decimal_text("cents * 4", 4),
    "grade": "letter",
    "sub_grade": "concat(letter, o_custkey % 5 + 1)",
    "emp_length": _pick(5, "< 1 year", "10+ years", "n/a", "3 years"),
    "home_ownership": "c_mktsegment",
    "addr_state": "n_name",
    "verification_status": _pick(3, "Verified", "Source Verified", "Not Verified"),
    "initial_list_status": _pick(2, "w", "f"),
    "purpose": _pick(4, "debt_consolidation", "credit_card", "home_improvement", "other"),
    "application_type": "'Individual'",
    "annual_inc": f"if(balance < 0, '0', {_decimal_text('balance * 10', 2)})",
    "issue_d": "date_format(o_orderdate, 'MMM-yyyy')",
    "earliest_cr_line": "concat('Jan-', 1970 + k % 20)",
    "loan_status": "status",
    "dti": "coalesce(string(quantity), 'n/a')",
    "revol_util": "concat(discounts, '%')",
    "bc_util": f"if(k % 11 <> 0, {_decimal_text(_pattern(31, 1000), 1)}, NULL)",
    "percent_bc_gt_75": _decimal_text(_pattern(59, 1000), 1),
    **{name: f"string({_pattern(*how)})" for name, how in _COUNTS.items()},
    **{name: _decimal_text(_pattern(7919, top), 2) for name, top in _BALANCES.items()},
    "out_prncp": f"if(status = 'Current', {_decimal_text('cents * 5', 3)}, '0')",
    "total_pymnt": _decimal_text("cents * (k % 110 + 10)", 4),
    "total_rec_prncp": _decimal_text("cents * (k % 50 + 5)", 4),
    "total_rec_int": _decimal_text("cents * (k % 18 + 2)", 4),
    "recoveries": _decimal_text("cents * taxes", 4),
    "collection_recovery_fee": "'0'",
}
_STATUS = """CASE WHEN o_orderkey % 97 = 0 THEN 'Does not meet credit policy: Status Charged Off'
    WHEN o_orderstatus = 'F' THEN 'Fully Paid'
    WHEN o_orderstatus = 'P' AND (o_orderkey * 13) % 7 < int(left(o_orderpriority, 1))
        THEN 'Charged Off'
    WHEN o_orderstatus = 'P' THEN 'Fully Paid' ELSE 'Current' END AS status"""


def raw_loans(spark: SparkSession, folder: str) -> DataFrame:
    """Raw loans, all text, with three rows of export noise that cleaning must drop."""
    lines = _table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.expr("sum(bigint(round(l_discount * 100))) AS discounts"),
        F.expr("sum(bigint(round(l_tax * 100))) AS taxes"),
        F.expr("sum(bigint(l_quantity)) AS quantity"))
    orders = _table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderkey AS k",
        "int(left(o_orderpriority, 1)) AS g", "bigint(round(o_totalprice * 100)) AS cents",
        "substr('ABCDE', int(left(o_orderpriority, 1)), 1) AS letter", _STATUS)
    customers = _table(spark, folder, "customer").selectExpr(
        "c_custkey", "c_nationkey", "c_mktsegment",
        "bigint(round(c_acctbal * 100)) AS balance")
    nations = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    # Orders and their line totals grow alike, so neither is ever the small side of a join.
    loans = (
        orders.join(lines.hint("merge"), orders.o_orderkey == lines.l_orderkey, "left")
        .join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, customers.c_nationkey == nations.n_nationkey)
        .selectExpr(*(f"{how} AS {name}" for name, how in _LOAN.items()))
    )
    noise = spark.range(3).selectExpr(
        "CASE id WHEN 1 THEN 'footer' WHEN 2 THEN 'undated' END AS id",
        "if(id = 1, 'Total amount funded', '100.00') AS loan_amnt",
        "if(id = 2, 'n/a', 'Jan-1999') AS issue_d")
    return loans.unionByName(noise, allowMissingColumns=True)


def fixture_scores(clean: DataFrame) -> DataFrame:
    """Adds pd, lgd and expected loss by plain arithmetic on the loan's own columns.

    It stands in for fitted models wherever a query must agree with another engine to the digit.
    """
    return clean.selectExpr(
        "*",
        "least(int_rate / 40D + coalesce(credit_utilization, 0.5D) / 10D, 0.95D) AS pd",
        "least(greatest(0.9D - term_months / 200D + coalesce(dti, 0D) / 2000D, 0D), 1D) AS lgd",
    ).selectExpr("*", "pd * lgd * ead AS expected_loss")
