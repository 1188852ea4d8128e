"""Readers and writers: text CSV, Parquet, small CSV/JSON reports, input guards."""

from __future__ import annotations

import uuid
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.sources import quoted


def _path(spark: SparkSession, path: str):
    """The path and its file system, so that the same code reaches local and remote storage."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


def require(spark: SparkSession, path: str, what: str) -> str:
    """``path`` if it is there, else an error that names what is missing."""
    if not exists(spark, path):
        raise FileNotFoundError(f"{what} not found at {path}")
    return path


def fingerprint(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the entries of ``folder``: changes when the input changes."""
    fs, target = _path(spark, folder)
    return tuple(sorted(
        (s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(target)
    ))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a folder; none if it does not exist."""
    fs, target = _path(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def pick_source(spark: SparkSession, folder: str, pattern: str) -> str:
    """First file in name order below ``folder`` whose name matches ``pattern``."""
    fs, target = _path(spark, folder)
    found = []
    walk = fs.listFiles(target, True) if fs.exists(target) else None
    while walk is not None and walk.hasNext():
        path = walk.next().getPath()
        if fnmatch(path.getName(), pattern):
            found.append(path.toString())
    if not found:
        raise FileNotFoundError(f"no file like {pattern} below {folder}")
    return min(found)


def is_parquet(spark: SparkSession, path: str) -> bool:
    """A Parquet file, or a folder that holds some."""
    fs, target = _path(spark, path)
    if not fs.getFileStatus(target).isDirectory():
        return path.endswith(".parquet")
    walk = fs.listFiles(target, True)
    while walk.hasNext():
        if walk.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def _open_quotes(spark: SparkSession, path: str) -> bool:
    """Whether any line has an odd number of quotes; escaped quotes are two."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).limit(1).isEmpty()


def _native_csv(spark: SparkSession, path: str, mode: str):
    return (spark.read.option("header", True).option("inferSchema", False).option("mode", mode)
            .option("columnPruning", False).option("quote", '"').option("escape", '"'))


def read_text_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV with a header, every column text; records with a wrong column count are skipped.

    Files are split over tasks. Where a line leaves a quote open, its record goes on in the next
    line; then records are cut by the true state of each split (``sources.quoted``), still by many
    tasks. Finding out takes a pass over the lines, which ``multiline`` saves. Line breaks inside
    quotes come back as one newline.
    """
    if not multiline and not _open_quotes(spark, path):
        # Column pruning stays off, for a pruned parser cannot see that a record is malformed.
        return _native_csv(spark, path, "DROPMALFORMED").csv(path)
    return _by_state(spark, path).where(F.col(quoted.CORRUPT).isNull()).drop(quoted.CORRUPT)


def _by_state(spark: SparkSession, path: str) -> DataFrame:
    names = _native_csv(spark, path, "PERMISSIVE").csv(path).columns
    header = spark.read.text(path).first()
    return quoted.read_records(spark, path, names, header["value"] if header else "")


def malformed_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the texts that ``read_text_csv`` skips."""
    return _by_state(spark, path).where(F.col(quoted.CORRUPT).isNotNull()).select(
        F.col(quoted.CORRUPT).alias("record"))


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str,
                   multiline: bool = False) -> int:
    """Convert once, since Parquet is splittable and pruned; returns the rows written."""
    read_text_csv(spark, csv_path, multiline).write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path).count()


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


VERSIONS_KEPT = 2
_MARKERS = "_current"


def new_version(folder: str) -> str:
    """A folder for the next version of the tables in ``folder``. Nobody reads it until
    ``publish`` names it."""
    return f"{folder}/v-{uuid.uuid4().hex[:12]}"


def _markers(spark: SparkSession, folder: str) -> list[str]:
    fs, target = _path(spark, f"{folder}/{_MARKERS}")
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target)
                  if not s.getPath().getName().startswith("."))


def publish(spark: SparkSession, folder: str, version: str) -> None:
    """Makes ``version`` what readers of ``folder`` get, all its tables at once.

    The pointer is an empty file whose name holds a number and the version; the greatest number
    counts. Creating an empty file is one atomic step on every file system and object store, unlike
    a rename. The version before stays for readers that have opened it; older ones are deleted.
    """
    before = _markers(spark, folder)
    number = int(before[-1].partition(".")[0]) + 1 if before else 1
    fs, marker = _path(spark, f"{folder}/{_MARKERS}/{number:010d}.{version.rsplit('/', 1)[-1]}")
    fs.create(marker, False).close()
    for old in _markers(spark, folder)[:-VERSIONS_KEPT]:
        delete(spark, f"{folder}/{old.partition('.')[2]}")
        delete(spark, f"{folder}/{_MARKERS}/{old}")


def current(spark: SparkSession, folder: str, what: str) -> str:
    """The folder of the version that was published last."""
    found = _markers(spark, folder)
    if not found:
        raise FileNotFoundError(f"{what} not found at {folder}")
    return f"{folder}/{found[-1].partition('.')[2]}"


def published(spark: SparkSession, folder: str) -> bool:
    return bool(_markers(spark, folder))


def write_report_csv(df: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_record_json(df: DataFrame, path: str) -> None:
    """A one-row summary as one JSON file; structs become nested objects."""
    df.coalesce(1).write.mode("overwrite").json(path)


def _literal(name: str, value) -> Column:
    if isinstance(value, dict):
        return F.struct(*(_literal(k, v) for k, v in value.items())).alias(name)
    return (F.lit(value).cast("double") if value is None else F.lit(value)).alias(name)


def record_frame(spark: SparkSession, record: dict) -> DataFrame:
    """A nested record of scalars as one row of structs."""
    return spark.range(1).select(*(_literal(k, v) for k, v in record.items()))


def save_params(spark: SparkSession, params: dict, path: str) -> None:
    write_record_json(record_frame(spark, params), path)


def load_params(spark: SparkSession, path: str) -> dict | None:
    """The saved parameters, or None where none were saved."""
    if not exists(spark, path):
        return None
    return spark.read.json(path).first().asDict()
