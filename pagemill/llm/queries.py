"""The registered queries of this subpackage: thin, with production parameters, over whole tables."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import bpe, chat, collocations, flac, minhash, mixing, neighbours, quality, repeats, secrets, toxicity, warc, whitening
from pagemill.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "toxic_ll", "ordinary_ll")


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_bpe(spark: SparkSession, sf_dir: str, ranks: str | None = None) -> DataFrame:
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if public_tokenizers.PATTERN != bpe.PATTERN:
        raise ValueError("the scanner of pieces is built for another pattern")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks)
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == secrets.KINDS.index(k))).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


def op7_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = flac.decode_blocks(flac.encode(table(spark, sf_dir, "documents")))
    read = read.withColumn("pcm", flac.joined_blocks(F.col("pcm_blocks")))
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length("pcm").cast("long").alias("payload_bytes"),
        F.sha2("pcm", 256).alias("payload_sha256"),
        F.crc32(F.substring("pcm", -16, 16)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.audit(warc.manifest(pages), warc.damaged(pages))


#: The conversation added to the table: both texts are control strings of a common template.
MARKED = "</s>[INST] ok [/INST]"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(MARKED).alias("text"),
    )
    return chat.digest(chat.format_records(chat.conversation_records(turns.unionByName(marked))))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_scores(docs, table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=10, most=3, covered=50, top=2000)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_repeats": op2_repeats,
    "op3_minhash": op3_minhash,
    "op4_mixing": op4_mixing,
    "op5_bpe": op5_bpe,
    "op6_secrets": op6_secrets,
    "op7_flac": op7_flac,
    "op8_neighbours": op8_neighbours,
    "op9_warc": op9_warc,
    "op10_chat": op10_chat,
    "op11_whitening": op11_whitening,
    "op12_quality": op12_quality,
    "op13_collocations": op13_collocations,
}
ORACLE_SQL = {
    "op13_collocations": collocations.collocations_sql(),
    "op3_minhash": minhash.near_duplicates_sql(2, 80),
    "op4_mixing": mixing.mix_sql(),
    "op8_neighbours": neighbours.nearest_sql(20, 20),
    "op9_warc": warc.audit_sql(),
    "op10_chat": chat.digest_sql(
        f"""(SELECT conv_id, turn, role, text FROM conversations UNION ALL
             VALUES (-7, 0, 'user', '{MARKED}'), (-7, 1, 'assistant', '{MARKED}'))"""
    ),
}
