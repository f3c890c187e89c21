"""The corpus operators as registered queries over the tables of one folder."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import toxicity
from .bpe import encode_texts
from .common import table
from .decontaminate import contained_items
from .hard_negatives import hard_negatives
from .line_dedup import dedup_lines
from .packing import pack
from .pii import personal_data
from .quality_rules import quality_rules
from .secret_scan import secret_scan
from .simhash import near_duplicates
from .suffix_dedup import remove_repeats
from .url_filter import judge_pages
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

# The URL rules of the query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan(table(spark, folder, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"
    )


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return cleaned.select(
        "doc_id",
        F.col("n_gone").cast("bigint").alias("n_removed_lines"),
        F.length(text).cast("bigint").alias("n_chars_kept"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"),
    )


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"), keep_bytes=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"
    )


def vocabulary() -> tuple[str, str, str]:
    """Vocabulary file, its rank file, and the pattern that splits text before the merges."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), *vocabulary()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_boilerplate_words",
    )


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", "fingerprint", "component_id"
    )


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_pages(table(spark, folder, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contained_items(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    ).select("doc_id", "item_id", "n_shingles", "n_held", F.round("containment", 6).alias("containment"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    return toxicity.toxicity(docs, model).select("doc_id", "held_out", "score", "predicted")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vec_id = F.col("vec_id")
    label = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(
        table(spark, folder, "embeddings").select("vec_id", "embedding", "label"), vec_id % 100 == 0, label
    ).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Deviations beyond BIGINT are null."""
    return whiten(table(spark, folder, "embeddings").select("vec_id", "embedding")).select(
        "vec_id",
        "component",
        "n",
        F.col("deviation").try_cast("bigint").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
    )


def op13_bpe(spark: SparkSession, folder: str) -> DataFrame:
    file, _, pattern = vocabulary()
    return encode_texts(table(spark, folder, "documents"), file, pattern).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_line_dedup,
        op3_suffix_dedup,
        op4_personal_data,
        op5_packing,
        op6_quality_rules,
        op7_simhash,
        op8_url_filter,
        op9_decontamination,
        op10_toxicity,
        op11_hard_negatives,
        op12_whitening,
        op13_bpe,
    )
}
