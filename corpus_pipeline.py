"""The corpus pipeline: language ID, exact and near de-duplication, source mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result below the shared folder and gives it to the next. All stages but the
last keep the columns of ``documents``, extra ones included.

Defined results: an empty table passes through all stages as an empty table.
Rows without text or letters go in the first stage. Ids may repeat or be null;
how each operator treats them stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import exact, langid, mixture, pieces, simhash
from stationflow.llm.support import staged, table

BATCH_ROWS = 500


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with enough confidence."""
    return langid.identify(docs).where("_found.accepted").select("_doc.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by their fingerprints, the document with the smallest id."""
    return simhash.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixture.repeat_rows(docs, F.array("source"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, number of pieces, and the piece ids of the whole text."""
    # texts go to Python in batches of rows; with long texts the usual 10,000 rows are tens of megabytes
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ids = pieces.encoded(docs.select("doc_id", "source", "text"))
    return ids.select("doc_id", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixed_sources", mixed_sources),
    ("tokens", tokens),
]

# A trained model, 64-bit SimHash and Viterbi have no SQL; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
