"""The corpus pipeline: documents in, token ids out.

Each stage starts on executors that gave back the heap the stage before it had filled.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import bpe, decontamination, jaccard, langid, pii
from jobtide.llm.common import free_executors, settle, table, workspace


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; those without letters go, too."""
    return langid.known_language(docs)


def join_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies.

    Near copies share 0.8 of their five-word shingles.
    """
    free_executors(spark)
    return jaccard.one_of_each(docs, 5, 80, 100)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no span of the benchmark."""
    free_executors(spark)
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; ``n_chars`` follows the text."""
    free_executors(spark)
    changed = pii.pseudonymized(docs, pii.session_key(spark)).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the text they decode to."""
    free_executors(spark)
    return bpe.encode(docs).select(
        "doc_id",
        "n_tokens",
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", join_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII surrogates", replace_personal_data),
    ("BPE encoding", encode),
]

# No SQL: language prediction and byte-pair encoding cannot be written in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written before the next stage reads it."""
    folder = workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = settle(stage(spark, docs, sf_dir), folder, f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
