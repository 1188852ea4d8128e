import pytest

from lossledger.sources import files, quoted


def test_csv_skips_malformed_rows_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'id,note,amount\n1,plain,5\n2,"two\nlines, ""quoted""",6\n3,short\n4,a,b,c\n5,,\n')
    df = files.read_text_csv(spark, str(tmp_path / "a.csv"), multiline=True)
    assert dict(df.dtypes) == {"id": "string", "note": "string", "amount": "string"}
    assert df.count() == 3
    rows = {r["id"]: tuple(r)[1:] for r in df.collect()}
    assert rows == {"1": ("plain", "5"), "2": ('two\nlines, "quoted"', "6"), "5": (None, None)}
    assert sorted(r[0] for r in df.select("id").collect()) == ["1", "2", "5"]
    assert files.csv_to_parquet(spark, str(tmp_path / "a.csv"), str(tmp_path / "p"), True) == 3


def test_csv_keeps_line_breaks_in_quotes_by_default(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note,amount\n1,plain,5\n2,"two\nlines, ""quoted""",6\n3,x,7\n')
    rows = {r["id"]: tuple(r)[1:] for r in files.read_text_csv(spark, str(tmp_path / "a.csv")).collect()}
    assert rows == {"1": ("plain", "5"), "2": ('two\nlines, "quoted"', "6"), "3": ("x", "7")}
    assert files.csv_to_parquet(spark, str(tmp_path / "a.csv"), str(tmp_path / "p")) == 3


@pytest.mark.parametrize("line,opened,ends", [
    ("a,b", False, False), ("a,b", True, True), ('a,"b', False, True), ('b",c', True, False),
    ('a 5" pipe,b', False, False), ('"a ""x"" b",c', False, False), ('"a ""x', False, True),
    ('","', False, False), ('","', True, True), ('"', False, True), ('"', True, False),
    ('""', False, False), ('x"",y', True, True), ("", True, True), ("", False, False)])
def test_state_after_a_line(line, opened, ends):
    assert quoted.ends_open(line, opened) is ends


def test_line_breaks_in_quotes_are_read_by_several_tasks(spark, tmp_path):
    import random

    dice = random.Random(5)
    notes = ["plain", "", 'say "x"', "two\nlines", "a,b", "\n\n", '5" pipe', "x" * 300 + "\n" * 40,
             '"\n,"\n,', "long\n" * 900]
    want = []
    for name in ("a", "b"):
        rows = [(f"{name}{i}", dice.choice(notes), str(i)) for i in range(1500)]
        want += rows
        body = "".join('{},"{}",{}\n'.format(k, v.replace('"', '""'), n) if v != '5" pipe'
                       else f"{k},{v},{n}\n" for k, v, n in rows)
        (tmp_path / f"{name}.csv").write_text("id,note,amount\n" + body + "short\n1,2,3,4\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = files.read_text_csv(spark, str(tmp_path))
        tasks = quoted._lines(spark, str(tmp_path)).rdd.getNumPartitions()
        begins = quoted.open_splits(quoted._lines(spark, str(tmp_path)))
        got = {r["id"]: (r["note"] or "", r["amount"]) for r in df.collect()}
        bad = sorted(r["record"] for r in files.malformed_records(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks > 20 and 5 < len(begins) < tasks
    assert got == {k: (v, n) for k, v, n in want}
    assert bad == ["1,2,3,4", "1,2,3,4", "short", "short"]


def test_large_csv_is_read_by_several_tasks(spark, tmp_path):
    lines = "".join(f"{i},{'x' * 90}\n" for i in range(60_000))
    (tmp_path / "a.csv").write_text("id,note\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        df = files.read_text_csv(spark, str(tmp_path / "a.csv"))
        assert df.rdd.getNumPartitions() > 4 and df.count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_local_folder_is_refused_on_a_cluster(spark):
    from types import SimpleNamespace

    from lossledger import session

    def cluster(named):
        context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context,
                               conf=SimpleNamespace(get=lambda key, default: named))

    with pytest.raises(RuntimeError):
        session.shared_folder(cluster("file:/tmp/x"))
    with pytest.raises(RuntimeError):
        session.shared_folder(cluster(None))
    assert session.shared_folder(cluster("hdfs://x/y/")) == "hdfs://x/y"


def test_pick_source(spark, tmp_path):
    for name in ["b/accepted_2.csv", "a/accepted_1.csv.gz", "a/other.csv"]:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    assert files.pick_source(spark, str(tmp_path), "accepted_*.csv*").endswith(
        "a/accepted_1.csv.gz")
    with pytest.raises(FileNotFoundError):
        files.pick_source(spark, str(tmp_path), "missing*")


def test_params_round_trip(spark, tmp_path):
    path = str(tmp_path / "params")
    assert files.load_params(spark, path) is None
    files.save_params(spark, {"num_leaves": 98, "learning_rate": 0.028}, path)
    assert files.load_params(spark, path) == {"num_leaves": 98, "learning_rate": 0.028}


def test_missing_input_names_itself(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="raw loans"):
        files.require(spark, str(tmp_path / "none"), "raw loans")


def test_report_csv(spark, tmp_path):
    files.write_report_csv(spark.range(3), str(tmp_path / "r"))
    (part,) = (tmp_path / "r").glob("part-*.csv")
    assert part.read_text() == "id\n0\n1\n2\n"
