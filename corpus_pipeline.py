"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All stages but the last return the columns of documents. A stage
works on what its predecessor kept, all of it. Rows with a null id go through all stages; a null
text is empty. No documents give no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.llm import decontaminate, minhash, packing, substrings, toxicity
from lossledger.llm.frames import ROW, prepared, unique_rows
from lossledger.session import stage


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc, place): each row as a whole, and a number of its own in the order of the ids."""
    rows, _ = unique_rows(docs.select(F.struct("*").alias("doc"), "doc_id",
                                      F.xxhash64("text").alias("tie")), "doc_id", "tie")
    return rows.select("doc", F.col(ROW).alias("place"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It is fitted on the labelled documents of
    the input that are not held out."""
    prepared(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.scored(docs.select(F.struct("*").alias("doc"), "text"), model)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by sets of five words: that with the smallest
    id, and one row of it if its id comes again."""
    prepared(spark)
    rows = _numbered(docs)
    groups = minhash.near_duplicates(rows.select("place", F.col("doc.text").alias("text")),
                                     key="place")
    gone = stage(groups.where(~F.col("kept")).select("place"), "copies")
    return rows.join(gone, "place", "left_anti").select("doc.*")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 20 words or more that occur earlier. A document that
    loses nothing keeps its text as it is; the others keep their words, joined by one space."""
    prepared(spark)
    cut = substrings.cut_repeats(docs)
    lost = F.col("n_removed") > 0
    new = {"text": F.when(lost, F.col("kept_text")).otherwise(F.col("text")),
           "n_chars": F.when(lost, F.length("kept_text")).otherwise(F.col("n_chars"))}
    return cut.select(*(new.get(c, F.col(c)).cast(docs.schema[c].dataType).alias(c)
                        for c in docs.columns))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item. An item of a single word is no passage:
    it says nothing about where a document comes from, and is not looked for."""
    prepared(spark)
    rows = _numbered(docs)
    hits = decontaminate.leaks(rows.select("place", F.col("doc.text").alias("text")),
                               spark.read.parquet(f"{sf_dir}/benchmark.parquet"), key="place",
                               shortest=2)
    gone = stage(hits.select("place").distinct(), "leaks")
    return rows.join(gone, "place", "left_anti").select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in sequences of 4096 ids."""
    prepared(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: SQL has no tokenizer and fits no classifier; tests compare the rows with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the others keep is written in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
