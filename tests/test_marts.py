import pytest
from pyspark.sql import functions as F

from lossledger import session
from lossledger.operators import contracts, scenarios, star
from lossledger.plans import measures, registry, reports


@pytest.fixture(scope="module")
def mart(spark):
    """Grade B is absent in the second quarter; one loan has no grade."""
    rows = [("1", 2020, 1, "A", 0.1, 100.0, 1), ("2", 2020, 1, "B", 0.3, 300.0, 0),
            ("3", 2020, 2, "A", 0.2, 100.0, None), ("4", 2020, 3, "A", 0.4, 50.0, 0),
            ("5", 2020, 3, "B", 0.5, 50.0, 1), ("6", 2020, 3, None, 0.5, 50.0, 1)]
    df = spark.createDataFrame(
        rows, "id string, issue_year long, issue_quarter long, grade string, pd double, "
              "ead double, default_flag int")
    texts = ["home_ownership", "verification_status", "addr_state", "purpose",
             "application_type", "loan_status"]
    numbers = ["emp_length_years", "annual_inc", "dti", "loan_amnt", "term_months", "int_rate",
               "installment"]
    scored = df.withColumns({
        "vintage": F.concat("issue_year", F.lit("Q"), "issue_quarter"),
        "sub_grade": F.concat("grade", F.lit("1")), "lgd": F.lit(0.5),
        "funded_amnt": F.col("ead"), "expected_loss": F.col("pd") * 0.5 * F.col("ead"),
        "actual_lgd": F.when(F.col("default_flag") == 1, 0.6),
        **{t: F.lit("x") for t in texts}, **{n: F.lit(1.0) for n in numbers}})
    return star.build_star(scored)


def test_keys_are_dense_and_ordered(mart):
    assert [tuple(r) for r in mart.vintages.orderBy("vintage_key").collect()] == [
        (1, 2020, 1, "2020Q1"), (2, 2020, 2, "2020Q2"), (3, 2020, 3, "2020Q3")]
    grades = mart.grades.orderBy("credit_grade_key").collect()
    assert [r["grade"] for r in grades] == ["A", "B", None]


def test_loan_without_grade_drops_out(mart):
    assert mart.fact.count() == 5
    assert contracts.row_parity(mart.fact, mart.borrowers).first().asDict() == {
        "n_fact": 5, "n_borrower": 6, "n_dropped": 1}


def test_orphans_and_repeats(spark, mart):
    lost = mart.vintages.where("vintage_key <> 3")
    assert contracts.orphans(mart.fact, lost, "vintage_key").first()["n_orphans"] == 2
    assert contracts.orphans(mart.fact, mart.vintages, "vintage_key").first()["n_orphans"] == 0
    doubled = mart.vintages.unionByName(lost)
    assert contracts.repeated_keys(doubled, "vintage_key").first()["n_repeated"] == 2


def test_prior_vintage_on_sparse_cells(mart):
    found = {(r["vintage"], r["grade"]): r for r in
             measures.pd_migration(mart.loans, mart.vintages, ["grade"]).collect()}
    assert found["2020Q1", "A"]["pd_delta"] == pytest.approx(0.1)
    assert found["2020Q1", "A"]["pd_delta_share"] is None
    assert not found["2020Q1", "A"]["has_prior"]
    vanished = found["2020Q2", "B"]
    assert vanished["weighted_pd"] is None and vanished["pd_delta"] == pytest.approx(-0.3)
    returned = found["2020Q3", "B"]
    assert not returned["has_prior"] and returned["pd_delta"] == pytest.approx(0.5)
    assert ("2020Q4", "A") not in found and len(found) == 6


def test_grade_mix(mart):
    found = {(r["vintage"], r["grade"]): r["mix_shift_pp"] for r in
             measures.grade_mix_shift(mart.loans, mart.vintages).collect()}
    assert found == pytest.approx({
        ("2020Q1", "A"): 50.0, ("2020Q1", "B"): 50.0, ("2020Q2", "A"): 50.0,
        ("2020Q2", "B"): -50.0, ("2020Q3", "A"): -50.0, ("2020Q3", "B"): 50.0})


def test_ungrouped_prior_is_the_second_last_vintage(mart):
    row = measures.latest_migration(mart.loans, mart.vintages).first()
    assert row["prior_weighted_pd"] == pytest.approx(0.2)
    assert row["weighted_pd"] == pytest.approx((10 + 90 + 20 + 20 + 25) / 600)


def test_measures_of_an_empty_slice_are_blank(mart):
    row = measures.evaluate(mart.loans, list(measures.MEASURES), where=F.lit(False)).first()
    assert set(row.asDict().values()) == {None}
    assert reports.kpis(mart.loans, F.lit(False)).first()["el_rate"] == 0.0


def test_default_rate_without_resolved_loans(mart):
    rows = {r["vintage"]: tuple(r)[1:] for r in
            reports.default_rate_by_vintage(mart.loans).collect()}
    assert rows == {"2020Q1": (1, 2, 0.5), "2020Q2": (0, 0, None), "2020Q3": (1, 2, 0.5)}


def test_slice_predicate(mart):
    sliced = mart.loans.where(measures.in_slice(["A1"], "2020Q2", "2020Q3"))
    assert sorted(r["loan_id"] for r in sliced.collect()) == ["3", "4"]


def test_registered_views(spark, mart):
    mart.register("t_")
    assert spark.sql("select count(*) from t_loans where grade = 'A'").first()[0] == 3


def test_scenarios(spark, mart):
    undrawn = F.lit(10.0)
    rows = scenarios.scenario_fact(mart.fact, undrawn).where("loan_id = '5'").collect()
    by_name = {r["scenario"]: r for r in rows}
    assert by_name["Adverse"]["pd"] == pytest.approx(0.625)
    assert by_name["Severely Adverse"]["ead"] == pytest.approx(52.0)
    assert by_name["Baseline"]["expected_loss"] == pytest.approx(12.5)
    unknown = mart.fact.withColumn("pd", F.lit(None).cast("double"))
    assert scenarios.scenario_fact(unknown).where("pd is not null").count() == 0


def test_increments(mart):
    totals = scenarios.scenario_totals(scenarios.scenario_fact(mart.fact))
    rows = sorted(scenarios.scenario_increment(totals).collect(), key=lambda r: r["sort_order"])
    assert rows[0]["vs_baseline"] == 0 and rows[0]["vs_previous"] == 0
    assert rows[2]["vs_baseline"] == pytest.approx(
        rows[1]["vs_previous"] + rows[2]["vs_previous"])


def test_what_if_caps_at_one(mart):
    row = scenarios.what_if(mart.loans.where("loan_id = '5'"), 3.0, 2.0).first()
    assert (row["pd_after"], row["el_after"], row["el_delta"]) == (1.0, 50.0, 37.5)
    same = measures.evaluate(mart.loans, ["stress_el_delta"],
                             extra=measures.stress_measures()).first()
    assert same[0] == 0.0


def test_bucketed_tables_join_without_a_shuffle(spark, mart, tmp_path):
    star.save_bucketed(mart, str(tmp_path), 4, "bucketed_")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        joined = spark.table("bucketed_fact_loans").join(
            spark.table("bucketed_dim_borrower"), "borrower_key")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 5
    finally:
        spark.conf.set(threshold, before)


def test_plans_prune_and_push_down(spark, mart, tmp_path):
    star.write_star(mart, str(tmp_path))
    tables = [spark.read.parquet(f"{tmp_path}/{name}") for name in
              ["fact_loans", "dim_borrower", "dim_vintage", "dim_credit_grade"]]
    loans = star.Star(*tables).loans
    plan = reports.loss_by_grade(loans, measures.in_slice(["A1"]) & (F.col("ead") > 60)) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    scans = {line.split("ReadSchema: ")[1]: line for line in plan.splitlines()
             if "ReadSchema: " in line}
    fact = next(line for schema, line in scans.items() if "lgd" in schema)
    assert "GreaterThan(ead,60.0)" in fact
    for unread in ["installment", "int_rate", "loan_status", "default_flag", "borrower_key:x"]:
        assert f"{unread}:" not in fact.split("ReadSchema: ")[1]
    grades = next(line for schema, line in scans.items() if "sub_grade" in schema)
    assert "EqualTo(sub_grade,A1)" in grades or "In(sub_grade, [A1])" in grades


def test_status_matrix_shows_every_status(spark):
    rows = [("A", s) for s in ["Current", "Late", "Default", "Fully Paid"]] + [("B", None)]
    loans = spark.createDataFrame(rows, "grade string, loan_status string")
    found = {r["grade"]: r.asDict() for r in reports.status_matrix(loans, "grade").collect()}
    assert found["A"] == {"grade": "A", "Current": 25.0, "Late": 25.0, "Default": 25.0,
                          "Fully Paid": 25.0, "unknown": 0.0}
    assert found["B"]["unknown"] == 100.0
    many = spark.range(reports.MOST_STATUSES + 1).selectExpr(
        "'A' as grade", "string(id) as loan_status")
    with pytest.raises(ValueError, match="statuses"):
        reports.status_matrix(many, "grade")
    assert len(reports.status_matrix(many, "grade", ["1"]).columns) == 3
    listed = {r["grade"]: r.asDict() for r in reports.status_matrix(
        loans, "grade", ["Current", "Fully Paid"]).collect()}
    assert listed["A"] == {"grade": "A", "Current": 25.0, "Fully Paid": 25.0, "other": 50.0}


def test_latest_migration_takes_the_vintage_from_the_dimension(spark):
    loans = spark.createDataFrame([(1, 0.5, 10.0), (2, 0.7, 10.0)],
                                  "vintage_key int, pd double, ead double")
    vintages = spark.createDataFrame([(1, "2020Q1"), (2, "2020Q2"), (3, "2020Q3")],
                                     "vintage_key int, vintage string")
    row = measures.latest_migration(loans, vintages).first()
    assert row["prior_weighted_pd"] == 0.7
    assert measures.latest_migration(loans, vintages.where("vintage_key < 3")).first()[1] == 0.5


def test_grade_mix_of_a_slice_is_a_share_of_all_loans(mart):
    rows = measures.grade_mix_shift(mart.loans, mart.vintages,
                                    where=F.col("grade") == "B").collect()
    found = {(r["vintage_key"], r["grade"]): r["grade_mix"] for r in rows}
    assert found[1, "B"] == 0.5 and all(g == "B" for _, g in found)


def test_sums_do_not_depend_on_order_and_rounding_is_plain(spark):
    from lossledger.functions.numeric import exact_avg, exact_sum
    from lossledger.plans.registry import rounded

    assert rounded(spark.sql("select 0.004995D as x"), x=2).first()[0] == 0.0
    values = [0.1] * 10 + [1e9, 0.2, -1e9]
    totals = {spark.createDataFrame([(v,) for v in order], "x double").coalesce(1).agg(
        exact_sum(F.col("x"))).first()[0] for order in (values, values[::-1], sorted(values))}
    assert totals == {1.2}
    assert spark.sql("select cast(null as double) as x").agg(exact_avg(F.col("x"))).first()[0] is None


@pytest.fixture
def few_orders(spark, tmp_path):
    """A folder of the order tables, 60 orders of their own."""
    tables = {
        "nation": spark.range(2).selectExpr("id AS n_nationkey", "concat('n', id) AS n_name"),
        "customer": spark.range(6).selectExpr(
            "id AS c_custkey", "id % 2 AS c_nationkey", "concat('s', id % 3) AS c_mktsegment",
            "id * 10.5 - 9 AS c_acctbal"),
        "orders": spark.range(60).selectExpr(
            "id AS o_orderkey", "id % 6 AS o_custkey",
            "date_add(date'1996-01-01', int(id * 9)) AS o_orderdate",
            "concat(id % 5 + 1, '-X') AS o_orderpriority", "id * 3.25 + 7 AS o_totalprice",
            "substr('FPO', int(id % 3) + 1, 1) AS o_orderstatus"),
        "lineitem": spark.range(90).selectExpr(
            "id % 50 AS l_orderkey", "0.05D AS l_discount", "0.02D AS l_tax",
            "double(id % 7) AS l_quantity")}
    for name, table in tables.items():
        table.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


ONE_PASS = ["dim_borrower", "dim_credit_grade", "dim_vintage", "load_audit", "clean_contracts",
            "lgd_error", "rate_vs_pd_sample"]


@pytest.mark.parametrize("name", ONE_PASS)
def test_what_reads_loans_once_stages_no_raw_or_cleaned_table(spark, few_orders, name):
    alone = sorted(map(tuple, registry.QUERIES[name](spark, few_orders).collect()))
    assert session.built(spark, "raw", few_orders) is None
    assert session.built(spark, "clean", few_orders) is None
    assert alone
    registry.scored_loans(spark, few_orders)
    registry.portfolio(spark, few_orders)
    assert session.built(spark, "clean", few_orders) is not None
    assert sorted(map(tuple, registry.QUERIES[name](spark, few_orders).collect())) == alone


def test_the_star_of_few_columns_is_that_of_all(spark, few_orders):
    narrow = registry.portfolio(spark, few_orders)
    whole = star.build_star(registry.scored_loans(spark, few_orders))
    for name in ("fact", "borrowers", "vintages", "grades"):
        one, two = getattr(narrow, name), getattr(whole, name)
        assert one.dtypes == two.dtypes
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
