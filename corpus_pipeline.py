"""The corpus pipeline: documents in, encoded documents out.

Five stages, each on all rows that its predecessor kept: toxic documents go, one document of each group of
near-duplicates stays, secrets are masked, sources are mixed to their target weights, and texts are encoded.

Null and empty texts pass all stages but the mix, which may leave out or repeat any document. Documents with a null id are
never near-duplicates; rows that repeat an id with its text are one document. Other columns pass unread, whatever their
names, up to the last stage, which returns its own. An empty table gives an empty table.
"""

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import bpe, minhash, mixing, secrets, toxicity
from pagemill.llm.common import delete, shared_folder, table

RANKS = "byte_bpe_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the models don't reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group that shares four fifths of its five-word shingles."""
    return minhash.keep_one(docs, words=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and n_chars, if there is one, counted anew."""
    masked = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeat_rows(mixing.mix(docs)).select(*docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and ends (little-endian 32-bit integers), and whether decoding by the offsets in ends
    gives the text back. Null texts have no tokens."""
    if public_tokenizers.PATTERN != bpe.PATTERN:
        raise ValueError("the scanner of pieces is built for another pattern")
    encoded = bpe.encode(docs, public_tokenizers.path(RANKS), keep=("doc_id", "source"), verify=True)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return encoded.select("doc_id", "source", n_tokens, "ids", "ends", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("encoding", encode_texts),
]

#: Scores and signatures are beyond SQL; the tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each one's rows are written to the shared folder and read again by the next; then those
    that it read are deleted. The rows that the last stage reads stay."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            delete(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
