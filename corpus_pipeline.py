"""From documents to token ids: quality, near duplicates, secrets, mixture, tokens.

Every stage works on all that the one before kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import jaccard, mixing, pieces, quality, secrets
from siltstone.session import stage_table, table


def keep_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; those that they reject go, texts that are null or empty too. Repeated rows are judged alike."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"), "text")
    return quality.judge(rows, model, key="row").where("kept").select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 0.8 one row with the smallest doc_id stays.

    Rows count by their own text, also where they repeat a doc_id; texts without
    words, and rows without a doc_id, are linked with nothing and stay.
    """
    return jaccard.one_of_each_component(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; found secrets are replaced by a mark and n_chars follows. Null texts stay null."""
    return secrets.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each as often as it is taken (up to 3 times). A null source is one of its own."""
    mix = mixing.Mix(docs, "doc_id", F.array("source"), mixing.n_words(F.col("text")))
    return mix.documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mix; null and empty texts have none."""
    return pieces.encode_documents(docs, "doc_id")


STAGES = [
    ("quality rules", keep_content),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_texts),
]

#: The field, the hashes and the flow cannot be stated in SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
