"""The registered queries of this package: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import alignment, exact, hamming, langid, licenses, mixture, negatives, pieces, secrets, simhash, substrings, tokenfiles, wrappers
from stationflow.llm.support import table


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.licenses(table(spark, sf_dir, "documents"), F.col("text"))
    places = F.col("_found.base_places")
    return found.select(
        "_doc.doc_id", "_found.n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        F.array_join("_found.base_labels", ",").alias("base_labels"), F.array_join("_found.labels", ",").alias("labels"),
        "_found.score", F.size("_found.detections").cast("long").alias("n_detections"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and what they decode to (as SHA-256; it equals the text's own)."""
    docs = table(spark, sf_dir, "documents")
    both = docs.select("doc_id", pieces.round_trip(docs)(F.col("text")).alias("r"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    return both.select(
        "doc_id", F.size("r.ids").cast("long").alias("n_pieces"), F.col("r.ids").alias("ids"),
        F.sha2("r.text", 256).alias("decoded_sha256"), "text_sha256")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, found in the flat files that hold them."""
    return tokenfiles.count_documents(table(spark, sf_dir, "documents"))


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, report = mixture.mix(table(spark, sf_dir, "documents"), F.array("source"))
    return mixture.with_targets(taken, report).select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.col("_taken").alias("taken"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents"))
    return found.select(
        "_doc.doc_id", langid.held_out("_doc.doc_id").alias("held_out"), F.col("_found.lang").alias("lang_pred"),
        F.col("_found.score").alias("score"), F.col("_found.accepted").alias("accepted"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten rows nearest to every row whose id is divisible by 100."""
    return hamming.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))
    return found.select(
        "_doc.doc_id", *(F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in secrets.KINDS),
        F.sha2(secrets.spans("assign", "access", "hex"), 256).alias("base_sha256"), secrets.spans(*secrets.KINDS).alias("spans"))


def op10_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.extract(table(spark, sf_dir, "pages"))
    return found.select("_page.page_id", "_page.url", F.col("_text").alias("text"), F.length("_text").cast("long").alias("n_chars"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = alignment.cross_tokenizer(table(spark, sf_dir, "documents"))
    return found.select("_doc.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("_doc.doc_id", "_found.n_words", "_found.n_removed", F.sha2("_found.kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_licenses, op2_simhash, op3_sentencepiece, op4_token_counts, op5_mixture, op6_language, op7_exact_dedup, op8_top_k, op9_secrets, op10_wrappers, op11_alignment, op12_negatives, op13_substrings)}
