"""The corpus pipeline: quality rules, line dedup, near copies, benchmark passages, packing."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tallywright.llm.common import KEY, as_before, scratch, table, with_rest
from tallywright.llm.decontaminate import contained_items
from tallywright.llm.line_dedup import dedup_lines
from tallywright.llm.packing import pack
from tallywright.llm.quality_rules import quality_rules, without_lines
from tallywright.llm.queries import vocabulary
from tallywright.llm.simhash import near_duplicates


def _rows(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``; n_chars, where it is a number, as the texts now have it."""
    columns = as_before(packed, docs, ())
    for i, field in enumerate(docs.schema):
        if field.name == "n_chars" and isinstance(field.dataType, NumericType):
            columns[i] = F.char_length(packed["text"]).cast(field.dataType).alias("n_chars")
    return packed.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their boilerplate lines. Null and empty texts go."""
    packed = with_rest(docs)
    judged = quality_rules(packed.select(KEY, "doc_id", "text", "rest.source"))
    lost = judged.where("kept").select(F.col(KEY).alias("kept_key"), "removed_lines")
    joined = packed.join(lost, F.col(KEY) == F.col("kept_key"))
    return _rows(without_lines(joined, "removed_lines"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat earlier ones; a text may become empty."""
    packed = with_rest(docs)
    return _rows(dedup_lines(packed), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near copies; texts without words are one."""
    packed = with_rest(docs)
    firsts = near_duplicates(packed).where("is_first").select(F.col(KEY).alias("kept_key"))
    return packed.join(firsts, F.col(KEY) == F.col("kept_key"), "left_semi").select(
        *as_before(packed, docs, ())
    )


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    packed = with_rest(docs)
    found = contained_items(packed, table(spark, sf_dir, "benchmark"))
    return packed.join(
        found.select(F.col(KEY).alias("gone_key")), F.col(KEY) == F.col("gone_key"), "left_anti"
    ).select(*as_before(packed, docs, ()))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    return pack(docs, *vocabulary()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark", benchmark_passages),
    ("packing", packed),
]

#: Edit distances, fingerprints and token ids are not expressible in SQL; tests hold the stages
#: against plain results.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = scratch(docs, name)
    return docs
