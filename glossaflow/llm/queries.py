"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossaflow.llm import (
    bpe,
    conversation_repair,
    decontamination,
    exact_dedup,
    html_extraction,
    jaccard_join,
    language_id,
    order_minhash,
    packing,
    quotations,
    token_counts,
    toxicity,
    whitening,
)
from glossaflow.llm.common import held_out, table
from glossaflow.scratch import scratch_folder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4096


def op1_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as packed rows of 2,048 ids."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, RANKS, public_tokenizers.PATTERN)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the bytes they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose 3-word shingles overlap by 90 %."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = jaccard_join.jaccard_classes(docs, words=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and its place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without their quotes, linked to what they answer, formatted for chat training."""
    return quotations.chat_messages(table(spark, sf_dir, "conversations"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a quarter of them (by id) is not learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = language_id.fit(docs, ~held_out("doc_id", 4, 2))
    found = language_id.identify(docs.select("doc_id", "text"), models).drop("text")
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "rejected")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a fifth of the labels (by id) is not learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out("doc_id", 5, 0))
    found = toxicity.score(docs, model, drop_text=True)
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document through a cache that starts empty in this run's scratch folder."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, PIECES, f"{scratch_folder(spark)}/token_counts")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are."""
    return order_minhash.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with equal texts; the one with the largest id stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_duplicates(docs, scan=True)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults by crc32 of ``conv_id:turn``; a dropped row stays as one with no copies."""
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, lot = F.coalesce("text", F.lit(" ")), F.crc32(place) % 20
    return turns.select(
        "conv_id", "turn",
        F.when(lot == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(lot == 1, "").when(lot == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(lot == 0, 0).when(lot == 3, 2).otherwise(1).alias("copies"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, their faults and the cheapest edits that repair them."""
    summary, _ = conversation_repair.repair(damaged(table(spark, sf_dir, "conversations")))
    return summary


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding on the 16 main components, scaled to unit variance."""
    white, model = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )


QUERIES = {
    "op1_pack_tokens": op1_pack_tokens,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_decontaminate": op4_decontaminate,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_language_id": op6_language_id,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_html_extraction": op9_html_extraction,
    "op10_order_minhash": op10_order_minhash,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_whitening": op13_whitening,
}
SQL: dict[str, str] = {
    "op11_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
