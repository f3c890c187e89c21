"""File sources and sinks (CSV, Parquet) and the SQL catalog of the nine published tables."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import RAW_COLUMNS, raw_schema
from ..session import shared_folder

# The tables that the SQL packs may use.
PUBLISHED = [
    "customer_master",
    "invoice",
    "erp_transactions",
    "payment_gateway",
    "bank_transactions",
    "entity_matches",
    "reconciliation",
    "exception_register",
    "anomaly_detection",
]

_PLACE_BITS = 40
RANKED_AT_ONCE = 100_000  # paths that one task ranks and that are sent to all executors
_SPAN = 1 << 27  # bytes of a file that share a row of a longer list

# Quotes are doubled inside quoted fields; a row of the wrong width is an error.
CSV = {"header": True, "quote": '"', "escape": '"'}
CSV_IN = CSV | {"enforceSchema": False, "mode": "FAILFAST"}
CSV_OUT = CSV | {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths and sizes of the files of a scan: ``_file``, ``_bytes``; contents are not read."""
    meta = F.col("_metadata")
    files = spark.read.format("binaryFile").load(path)
    return files.select(meta["file_path"].alias("_file"), meta["file_size"].alias("_bytes"))


def rank_files(files: DataFrame, at_once: int = RANKED_AT_ONCE) -> tuple[DataFrame, bool]:
    """``files`` with ``_no``, the rank of each path from 0, and whether they are few.

    Up to ``at_once`` paths are ranked by one task. A longer list is dealt by ranges of paths and
    written, so that the ranges stay as they are; each range then starts after the rows of those before.
    """
    spark = files.sparkSession
    if files.limit(at_once + 1).count() <= at_once:
        return files.withColumn("_no", F.row_number().over(Window.orderBy("_file")) - 1), True
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    dealt = files.repartitionByRange(parts, "_file").sortWithinPartitions("_file")
    path = f"{shared_folder(spark)}/tallywright/files/{uuid.uuid4().hex}"
    write_table(dealt.select("*", F.shiftright(place, 33).alias("_range"), place.alias("_at")), path)
    dealt = spark.read.parquet(path)
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_range", "_first", F.coalesce(before, F.lit(0)).alias("_start"))
    ranked = dealt.join(F.broadcast(starts), "_range")
    return ranked.select("_file", "_bytes", (F.col("_start") + F.col("_at") - F.col("_first")).alias("_no")), False


def with_src_row(
    scan: DataFrame, path: str, fmt: str, at_once: int = RANKED_AT_ONCE, span: int = _SPAN
) -> DataFrame:
    """Number the rows of a plain file scan in file order, in one pass over the files.

    The number is the file's rank by path and the row's place in the file: its row index in Parquet,
    in CSV the start of the block that holds it plus its place in the scan task. A row takes a byte
    at least and a task starts with any block that is not its file's last, so places rise through
    a file; a scan that packs its blocks in another way raises.

    Rows are not shuffled: the list of ranks is counted, and sent to them. Only where files are more
    than ``at_once`` are rows joined to it, by path and ``span`` bytes, so that a long file is many keys.
    """
    spark, meta = scan.sparkSession, F.col("_metadata")
    if fmt == "parquet":
        place = meta["row_index"]
    else:
        inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        start, length = meta["file_block_start"], meta["file_block_length"]
        ends = start + length >= meta["file_size"]
        place = F.when(ends | (inside < length), start + inside).otherwise(
            F.raise_error(F.lit("file blocks are packed out of order; rows cannot be numbered"))
        )
    # a place is below the size of its file, or little above it in a task's last block
    last = F.floor(meta["file_size"] / F.lit(span))
    placed = scan.select(
        "*",
        meta["file_path"].alias("_path"),
        place.alias("_place"),
        F.least(F.floor(place / F.lit(span)), last).alias("_of"),
    )
    files, few = rank_files(list_files(spark, path), at_once)
    same = F.col("_path") == F.col("_file")
    if few:
        # ``at_once`` paths at most
        numbered = placed.join(F.broadcast(files), same)
    else:
        spans = F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("_bytes") / F.lit(span)))
        spread = files.withColumn("_span", F.explode(spans))
        numbered = placed.join(spread, same & (F.col("_of") == F.col("_span")))
    fits = (F.col("_no") < 1 << 23) & (F.col("_place") < 1 << _PLACE_BITS)
    number = F.when(fits, F.shiftleft(F.col("_no").cast("bigint"), _PLACE_BITS) + F.col("_place")).otherwise(
        F.raise_error(F.lit("more than 2^23 files, or a file of more than 2^40 bytes"))
    )
    return numbered.withColumn("src_row", number).select(*scan.columns, "src_row")


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False):
    """A CSV table whose columns are found by the names in its header, in any order.

    A missing or unknown column raises, as do rows of the wrong width and files of one table whose
    headers differ. Fields may be quoted and hold commas and doubled quotes. ``multi_line`` allows
    line breaks in quoted fields too; files then cannot be split, so large ones should do without
    (a row that is broken over lines raises).
    """
    options = CSV_IN | {"multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    if sorted(header) != sorted(schema.names):
        missing, unknown = set(schema.names) - set(header), set(header) - set(schema.names)
        raise ValueError(f"{path}: missing columns {sorted(missing)}, unknown {sorted(unknown)}")
    as_found = StructType([schema[name] for name in header])
    return spark.read.schema(as_found).options(**options).csv(path)


def read_raw(
    spark: SparkSession,
    path: str,
    table: str,
    fmt: str = "csv",
    ordered: bool = True,
    multi_line: bool = False,
):
    """One raw source, every column as text. Files without ``src_row`` are numbered on reading."""
    schema = raw_schema(table, with_order=ordered)
    if fmt == "csv":
        df = read_csv(spark, path, schema, multi_line)
    else:
        df = spark.read.schema(schema).parquet(path)
    return (df if ordered else with_src_row(df, path, fmt)).select(*RAW_COLUMNS[table], "src_row")


def load_raw(
    spark: SparkSession,
    folder: str,
    fmt: str = "csv",
    ordered: bool = True,
    multi_line: bool = False,
):
    """The five raw sources, each at ``folder/<table>``."""
    return {t: read_raw(spark, f"{folder}/{t}", t, fmt, ordered, multi_line) for t in RAW_COLUMNS}


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None, laid_out: bool = False
):
    """Write a table, replacing what was there. ``laid_out`` says that ``df`` is read from files that are
    partitioned alike: a task then holds few values, and rows are not shuffled."""
    if partition_by and not laid_out:
        # few files per value, and large values still split
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if fmt == "csv":
        writer.options(**CSV_OUT).csv(path)
    else:
        writer.option("compression", "zstd").parquet(path)
    return path


def write_counted(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None, laid_out: bool = False
) -> int:
    """The same, and the number of rows, counted as they are written."""
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt, partition_by, laid_out)
    return seen.get["rows"]


def publish(tables: dict[str, DataFrame], names: list[str] = PUBLISHED) -> None:
    """Make the tables known to SQL; a missing one is an error."""
    missing = [n for n in names if n not in tables]
    if missing:
        raise FileNotFoundError(f"tables not given: {', '.join(missing)}")
    for name in names:
        tables[name].createOrReplaceTempView(name)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, counts)
