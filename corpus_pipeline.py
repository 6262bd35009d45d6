"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's documents. All but the last return the columns of the documents they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.llm.language import UNKNOWN, predict_language, remainder
from fleetmart.llm.minmax_dedup import MinMaxDedup, near_duplicates
from fleetmart.llm.packing import Packing, pack_documents
from fleetmart.llm.source_mixing import mixed_documents, word_count
from fleetmart.llm.store import Workspace, every
from fleetmart.llm.substring_dedup import remove_repeats

#: A language must be at least this likely among those learned.
LEAST_SCORE = 0.5
PASSAGE_WORDS = 50
BIN_WORDS = 2048


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents written in one of the languages learned; null texts, texts without letters and undecided ones go."""
    judged = predict_language(docs.withColumn("_row", F.struct(*every(docs))), ["_row"], remainder("doc_id", 3) != 1)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("_row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of every group of near duplicates, and rows without an id."""
    judged = near_duplicates(docs, params=MinMaxDedup(shingle_words=5, percent=80))
    dropped = judged.where(~F.col("kept")).select("doc_id").distinct()
    # The row goes through the join whole, so no name in it can clash.
    rows = docs.select(F.col("doc_id"), F.struct(*every(docs)).alias("_row"))
    return rows.join(dropped, "doc_id", "left_anti").select("_row.*")


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words that an earlier document holds; a document left without words goes."""
    others = F.struct(F.col("text").isNull().alias("none"), F.struct(*[c for c, n in zip(every(docs), docs.columns) if n != "text"]).alias("row"))
    judged = remove_repeats(docs, PASSAGE_WORDS, layout=True, carry=others).where("n_removed = 0 or n_words > n_removed")
    rows = judged.select("n_removed", F.when(~F.col("carried.none"), F.col("kept_text")).alias("text"), F.col("carried.row").alias("row"))
    out = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[out.get(n, F.col("row").getField(n)).alias(n) for n in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources take their target weights."""
    return mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in bins of 2048 words; copies of a document never share a bin."""
    sizes = docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("cluster"))
    return pack_documents(sizes, Packing(capacity=BIN_WORDS))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither context trees nor best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = Workspace(spark, "pipeline")
    for name, stage in STAGES:
        docs = work.save(stage(spark, docs, sf_dir), name)
    return docs
