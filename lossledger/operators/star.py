"""The star schema: loan fact, scenario fact and their dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossledger.session import stage
from lossledger.sources import files

VINTAGE_COLUMNS = ["issue_year", "issue_quarter", "vintage"]
GRADE_COLUMNS = ["grade", "sub_grade"]
BORROWER_COLUMNS = ["home_ownership", "verification_status", "addr_state", "purpose",
                    "application_type", "emp_length_years", "annual_inc", "dti"]
FACT_COLUMNS = ["loan_amnt", "funded_amnt", "term_months", "int_rate", "installment", "ead", "pd",
                "lgd", "expected_loss", "default_flag", "actual_lgd", "loan_status"]
# What the four tables read of the loans.
COLUMNS = ["id", *VINTAGE_COLUMNS, *GRADE_COLUMNS, *BORROWER_COLUMNS, *FACT_COLUMNS]


def _keyed(df: DataFrame, key: str, columns: list[str], order: list[str]) -> DataFrame:
    """Distinct ``columns``, numbered densely in ``order``.

    The distinct rows are a calendar of quarters or a rating scale, some tens of rows, whatever
    the number of loans; numbering them in one task is safe.
    """
    numbered = Window.orderBy(*(F.col(o).asc_nulls_last() for o in order))
    return df.select(*columns).distinct().select(
        F.row_number().over(numbered).cast("bigint").alias(key), *columns)


def dim_vintage(scored: DataFrame) -> DataFrame:
    return _keyed(scored, "vintage_key", VINTAGE_COLUMNS, ["issue_year", "issue_quarter"])


def dim_credit_grade(scored: DataFrame) -> DataFrame:
    return _keyed(scored, "credit_grade_key", GRADE_COLUMNS, GRADE_COLUMNS)


def dim_borrower(scored: DataFrame) -> DataFrame:
    """One row per loan: the extract has no customer that recurs."""
    return scored.select(F.col("id").alias("borrower_key"), *BORROWER_COLUMNS)


def fact_loans(scored: DataFrame, vintages: DataFrame, grades: DataFrame) -> DataFrame:
    """Loan grain. Loans without a grade or vintage drop out, as in any inner join.

    The dimensions carry no broadcast hint: staged tables have a known size, and Spark's own
    threshold decides.
    """
    return (
        scored.join(vintages, VINTAGE_COLUMNS).join(grades, GRADE_COLUMNS)
        .select(
            F.col("id").alias("loan_id"), F.col("id").alias("borrower_key"),
            "vintage_key", "credit_grade_key", *FACT_COLUMNS)
    )


def describe(fact: DataFrame, vintages: DataFrame, grades: DataFrame) -> DataFrame:
    """A fact with the vintage and grade attributes beside its keys."""
    return fact.join(vintages, "vintage_key").join(grades, "credit_grade_key")


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    borrowers: DataFrame
    vintages: DataFrame
    grades: DataFrame

    @property
    def loans(self) -> DataFrame:
        return describe(self.fact, self.vintages, self.grades)

    def register(self, prefix: str = "") -> None:
        """Named views for SQL users."""
        for name, table in [("fact_loans", self.fact), ("dim_borrower", self.borrowers),
                            ("dim_vintage", self.vintages), ("dim_credit_grade", self.grades),
                            ("loans", self.loans)]:
            table.createOrReplaceTempView(prefix + name)


def build_star(scored: DataFrame, stage_fact: bool = False) -> Star:
    """The four tables. The small dimensions are staged once, since fact and views reuse them;
    ``stage_fact`` does the same for the fact where reports follow without a written mart."""
    vintages = stage(dim_vintage(scored), "dim_vintage")
    grades = stage(dim_credit_grade(scored), "dim_credit_grade")
    fact = fact_loans(scored, vintages, grades)
    return Star(stage(fact, "fact_loans") if stage_fact else fact, dim_borrower(scored),
                vintages, grades)


def write_star(star: Star, folder: str) -> None:
    for name, table in [("fact_loans", star.fact), ("dim_borrower", star.borrowers),
                        ("dim_vintage", star.vintages), ("dim_credit_grade", star.grades)]:
        files.write_table(table, f"{folder}/{name}")


TABLES = ["fact_loans", "dim_borrower", "dim_vintage", "dim_credit_grade"]


def publish_star(star: Star, folder: str) -> None:
    """Writes the four tables as a version of their own, which replaces the one before as a whole:
    a run that stops between two tables leaves the old star readable."""
    spark = star.fact.sparkSession
    version = files.new_version(folder)
    write_star(star, version)
    files.publish(spark, folder, version)


def published_star(spark: SparkSession, folder: str) -> Star:
    """The star that was published last; all four tables are of one version."""
    version = files.current(spark, folder, "star schema")
    return Star(*(spark.read.parquet(f"{version}/{name}") for name in TABLES))


def save_bucketed(star: Star, folder: str, buckets: int, prefix: str = "") -> None:
    """Fact and borrowers as catalogue tables bucketed alike by borrower_key.

    The borrower dimension has a row per loan, so it never broadcasts at scale; bucketed alike,
    the two join without a shuffle.
    """
    for name, table in [("fact_loans", star.fact), ("dim_borrower", star.borrowers)]:
        (table.repartition(buckets, "borrower_key").write.mode("overwrite")
         .bucketBy(buckets, "borrower_key").sortBy("borrower_key")
         .option("path", f"{folder}/{prefix}{name}").saveAsTable(prefix + name))
