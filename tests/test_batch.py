"""Stages of the batch that write: audit while writing, refusal, publishing, staged tables."""

import os

import pytest
from pyspark.sql import functions as F
from scales import SMALL

from lossledger.operators import cleaning, contracts, star
from lossledger.plans import additive, batch, measures, registry
from lossledger.session import leaves_nothing, shared_folder, stage
from lossledger.sources import files


@pytest.fixture(scope="module")
def raw(spark):
    return registry.raw_extract(spark, SMALL)


def report(spark, layout):
    rows = spark.read.option("header", True).csv(f"{layout.reports}/clean_contracts").collect()
    return {r["check"]: int(r["n_bad"]) for r in rows}


def test_audit_is_observed_while_writing(spark, raw, tmp_path):
    layout = batch.Layout(str(tmp_path))
    counts = batch.run_cleaning(raw, layout)
    loans = batch.cleaned(spark, layout)
    assert counts == cleaning.load_audit(loans).first().asDict() and counts["n_rows"] > 0
    told = {r["check"]: r["n_bad"] for r in contracts.clean_contracts(loans).collect()}
    assert report(spark, layout) == told and set(told.values()) == {0}


def test_broken_loans_do_not_replace_sound_ones(spark, raw, tmp_path):
    layout = batch.Layout(str(tmp_path))
    sound = batch.run_cleaning(raw, layout)
    one = raw.where("id is not null and issue_d <> 'n/a' and id <> 'footer'").limit(1)
    broken = raw.unionByName(one).unionByName(one.withColumns(
        {"id": F.lit("negative"), "funded_amnt": F.lit("-5")}))
    with pytest.raises(contracts.BrokenContract, match="id_repeated"):
        batch.run_cleaning(broken, layout)
    assert report(spark, layout)["id_repeated"] == 1
    assert report(spark, layout)["ead_negative"] == 1
    assert batch.cleaned(spark, layout).count() == sound["n_rows"]
    folders = [f for f in os.listdir(layout.clean_loans) if f.startswith("v-")]
    assert len(folders) == 1
    assert batch.run_cleaning(broken, layout, strict=False)["n_rows"] == sound["n_rows"] + 2
    assert batch.cleaned(spark, layout).count() == sound["n_rows"] + 2


def test_no_rows(spark, raw, tmp_path):
    layout = batch.Layout(str(tmp_path / "out"))
    raw.where("false").write.parquet(str(tmp_path / "raw"))
    counts = batch.run_cleaning(spark.read.parquet(str(tmp_path / "raw")), layout, ())
    assert set(counts.values()) == {0} and batch.cleaned(spark, layout).count() == 0


def test_a_stop_between_tables_leaves_the_old_star(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "marts")
    whole = registry.portfolio(spark, SMALL)
    star.publish_star(whole, folder)
    old = star.published_star(spark, folder)
    n = old.fact.count()
    few = star.Star(whole.fact.where("vintage_key = 1"), whole.borrowers, whole.vintages,
                    whole.grades)
    write = files.write_table

    def fails(df, path, partition_by=()):
        if path.endswith("dim_vintage"):
            raise RuntimeError("stopped")
        write(df, path, partition_by)

    monkeypatch.setattr(files, "write_table", fails)
    with pytest.raises(RuntimeError):
        star.publish_star(few, folder)
    monkeypatch.undo()
    assert star.published_star(spark, folder).fact.count() == n
    star.publish_star(few, folder)
    assert star.published_star(spark, folder).fact.count() < n
    assert old.fact.count() == n  # a reader that began before goes on


def test_old_versions_go(spark, tmp_path):
    folder = str(tmp_path / "t")
    paths = []
    with pytest.raises(FileNotFoundError):
        files.current(spark, folder, "table")
    for i in range(12):
        paths.append(files.new_version(folder))
        spark.range(i).write.parquet(paths[-1])
        files.publish(spark, folder, paths[-1])
        assert files.current(spark, folder, "table") == paths[-1]
    assert [files.exists(spark, p) for p in paths] == [False] * 10 + [True] * 2


def test_scenarios_belong_to_their_star(spark, tmp_path):
    layout = batch.Layout(str(tmp_path))
    star.publish_star(registry.portfolio(spark, SMALL), layout.marts)
    batch.run_scenarios(spark, layout)
    batch.run_scenarios(spark, layout)
    n = batch.load_star(spark, layout).fact.count()
    assert batch.load_scenarios(spark, layout).count() == 3 * n
    star.publish_star(registry.portfolio(spark, SMALL), layout.marts)
    assert batch.load_scenarios(spark, layout) is None


def test_steps_leave_nothing(spark):
    app = spark.sparkContext.applicationId

    def staged():
        folder = f"{shared_folder(spark)}/lossledger-{app}".removeprefix("file:")
        return {f for f in os.listdir(folder)} if os.path.exists(folder) else set()

    @leaves_nothing
    def step(spark, fail):
        out = stage(spark.range(5), "five").count()
        if fail:
            raise ValueError
        return out

    before = staged()
    assert step(spark, False) == 5 and staged() == before
    with pytest.raises(ValueError):
        step(spark, True)
    assert staged() == before


def test_mart_answers_as_the_loans_do(spark):
    """Not rounded: regrouped decimals give the same doubles."""
    assert set(additive.MEASURES) == set(measures.MEASURES)
    whole = registry.portfolio(spark, SMALL)
    loans = whole.loans.join(whole.borrowers.select("borrower_key", "purpose", "addr_state"),
                             "borrower_key")
    cells = registry.measure_mart(spark, SMALL)
    names = list(measures.MEASURES)
    for by, where in [([], None), (["purpose", "grade"], None), ([], F.lit(False)),
                      (["addr_state"], F.col("loan_status").isin("Fully Paid", "Charged Off"))]:
        told = additive.evaluate(cells, names, by, where).collect()
        expected = measures.evaluate(loans, names, by, where).collect()
        assert sorted(map(tuple, told), key=repr) == sorted(map(tuple, expected), key=repr)


def test_cells_of_missing_attributes(spark):
    scored = registry.scored_loans(spark, SMALL).withColumns({
        "purpose": F.lit(None).cast("string"), "pd": F.lit(None).cast("double"),
        "grade": F.when(F.col("id").cast("bigint") % 2 == 0, F.col("grade"))})
    cells = additive.measure_mart(scored, star.dim_vintage(scored))
    row = additive.evaluate(cells, ["loan_count", "weighted_pd", "average_pd", "total_ead"]).first()
    assert row["loan_count"] == scored.where("grade is not null").count()
    assert row["weighted_pd"] is None and row["average_pd"] is None and row["total_ead"] > 0
    assert cells.where("purpose is null").count() == cells.count()
    none = additive.measure_mart(scored.where("false"), star.dim_vintage(scored))
    assert none.count() == 0 and additive.evaluate(none, ["loan_count"]).first()[0] is None
