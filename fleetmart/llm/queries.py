"""The numbered queries over the test tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.llm import checking_sql, source_mixing
from fleetmart.llm.block_labeller import extract_main_text
from fleetmart.llm.language import predict_language, remainder
from fleetmart.llm.line_dedup import LineDedup, remove_repeated_lines
from fleetmart.llm.minmax_dedup import MinMaxDedup, near_duplicates
from fleetmart.llm.multi_index import MultiIndex, nearest_vectors
from fleetmart.llm.packing import Packing, pack_documents
from fleetmart.llm.phrase_mining import PhraseMining, mine_phrases
from fleetmart.llm.pitman_yor import score_documents
from fleetmart.llm.polytope_dedup import PolytopeDedup, near_vectors
from fleetmart.llm.substring_dedup import remove_repeats
from fleetmart.llm.url_rules import judge_urls
from fleetmart.llm.whitening import Whitening, whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page by its url. A labelled document speaks for the page of the same number: bad if toxic or of no quality."""
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.when(bad, "block").otherwise("allow").alias("verdict"))
    return judge_urls(table(spark, sf_dir, "pages"), labels)


def op3_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows whose id has remainder 1 are held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder("doc_id", 3) == 1)
    return predict_language(docs, ["doc_id", "held_out"], ~F.col("held_out"))


def op4_conflict_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in bins of 2048 words; equal texts are a duplicate cluster."""
    docs = table(spark, sf_dir, "documents")
    sizes = docs.select("doc_id", "source", source_mixing.word_count("text").alias("size"), F.xxhash64("text").alias("cluster"))
    return pack_documents(sizes, Packing(capacity=2048))


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document; rows whose id has remainder 2 are held out."""
    return score_documents(table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents to the weights 5, 2, 1."""
    return source_mixing.mix_sources(table(spark, sf_dir, "documents"))


def op7_polytope_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label with a cosine of 0.98 or more."""
    return near_vectors(table(spark, sf_dir, "embeddings"), params=PolytopeDedup(cosine=0.98))


def op8_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents on 4-word shingles at 80 percent."""
    return near_duplicates(table(spark, sf_dir, "documents"), params=MinMaxDedup(shingle_words=4))


def op9_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one, among all."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_vectors(vectors, vectors.where("vec_id % 50 = 0"), params=MultiIndex(neighbours=5))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document without the 50-word passages that an earlier document holds."""
    kept = remove_repeats(table(spark, sf_dir, "documents"), 50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document without those that ten documents hold."""
    kept = remove_repeated_lines(table(spark, sf_dir, "documents"), LineDedup(documents=10, least_chars=1))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of two to four words of every language."""
    return mine_phrases(table(spark, sf_dir, "documents"), PhraseMining(words=4, least=30, percent=80, top=2000))


def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on their first four principal components, with unit variance."""
    return whiten(table(spark, sf_dir, "embeddings"), params=Whitening(components=4))


QUERIES = {
    "op1_block_labeller": op1_block_labeller,
    "op2_url_rules": op2_url_rules,
    "op3_language_ppm": op3_language_ppm,
    "op4_conflict_packing": op4_conflict_packing,
    "op5_pitman_yor": op5_pitman_yor,
    "op6_source_mixing": op6_source_mixing,
    "op7_polytope_dedup": op7_polytope_dedup,
    "op8_minmax_dedup": op8_minmax_dedup,
    "op9_multi_index": op9_multi_index,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_line_dedup": op11_line_dedup,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_feast_whitening": op13_feast_whitening,
}
ORACLES: dict[str, str] = {
    "op6_source_mixing": source_mixing.SQL,
    "op7_polytope_dedup": checking_sql.OP7,
    "op8_minmax_dedup": checking_sql.OP8,
    "op10_substring_dedup": checking_sql.OP10,
    "op11_line_dedup": checking_sql.OP11,
    "op12_phrase_mining": checking_sql.OP12,
}
