"""Shared by the corpus operators: row keys, scratch tables, batches of texts."""

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..session import shared_folder

KEY = "__row_key"


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, lost executors lose
    nothing. The folder goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/corpus-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def _named(df: DataFrame, column: str) -> Column:
    return df["`" + column.replace("`", "``") + "`"]


def has_key(df: DataFrame) -> bool:
    """Whether ``with_key`` made the column ``__row_key``; a caller's own does not count."""
    return KEY in df.columns and bool(df.schema[KEY].metadata.get(KEY))


def _marked(key: Column) -> Column:
    return key.cast("bigint").alias(KEY, metadata={KEY: True})


def with_key(df: DataFrame, id_col: str = "doc_id", tie: str | None = "text") -> DataFrame:
    """Add ``__row_key``, a unique BIGINT that rises with ``id_col``.

    It is the id itself where ids are unique whole numbers. Otherwise (repeated or null ids, other
    types) rows are numbered in the order of id and then ``tie``, nulls first; rows that are equal
    in both are numbered in any order. Either way no row is merged with another. A table that has
    its keys from here is left as it is; a column of that name from elsewhere is replaced.
    """
    if has_key(df):
        return df
    df = df.drop(KEY)
    if isinstance(df.schema[id_col].dataType, IntegralType):
        odd = (
            df.groupBy(F.col(id_col).alias("i"))
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(
                F.max("n").alias("most"),
                F.max(F.col("i").isNull()).alias("null"),
            )
            .first()
        )
        if odd.most is None or (odd.most == 1 and not odd.null):
            return df.withColumn(KEY, _marked(F.col(id_col)))
    order = [F.col(f"row.{id_col}")] + ([F.xxhash64(f"row.{tie}"), F.col(f"row.{tie}")] if tie else [])
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = df.select(
        F.struct(*[_named(df, c) for c in df.columns]).alias("row"),
        F.monotonically_increasing_id().alias("at"),
    ).repartitionByRange(parts, *order, F.col("at"))
    numbered = sorted_rows.sortWithinPartitions(*order, F.col("at")).select(
        "row.*", _marked(F.monotonically_increasing_id())
    )
    return scratch(numbered, "keyed")


def with_rest(docs: DataFrame) -> DataFrame:
    """(__row_key, doc_id, text, rest) of ``docs``: its other columns, which may be called anything, are
    one struct, so that no name of theirs can meet a name of an operator. ``as_before`` unpacks them."""
    made = {"doc_id", "text"} | ({KEY} if has_key(docs) else set())
    others = [c for c in docs.columns if c not in made]
    rest = F.struct(*[_named(docs, c) for c in others]) if others else F.lit(True)
    return with_key(docs.select(*[c for c in docs.columns if c in made], rest.alias("rest")))


def as_before(packed: DataFrame, docs: DataFrame, without: tuple = (KEY,)) -> list[Column]:
    """The columns of ``docs`` in their order, read from ``packed`` (doc_id, text, rest)."""
    return [
        packed[c] if c in ("doc_id", "text") else packed["rest"].getField(c).alias(c)
        for c in docs.columns
        if c not in without
    ]


def cut_lines(text: Column, numbers: Column) -> Column:
    """``text`` without the lines that ``numbers`` (from 0) names; as it is where that is null."""
    # an array of one, so that the text is split once and not for every line
    cut = F.transform(
        F.array(F.split(text, "\n", -1)),
        lambda lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers),
                lambda i: F.get(lines, i),
            ),
            "\n",
        ),
    )
    return F.when(numbers.isNull() | text.isNull(), text).otherwise(F.get(cut, F.lit(0)))


def texts(
    docs: DataFrame, fn: Callable[[int, str], Iterator[tuple]], schema: str, extra: tuple = ()
) -> DataFrame:
    """Rows that ``fn(key, text, *extra)`` yields for each row of ``docs``, in Arrow batches.

    Null texts come as "". ``fn`` may be a class: it is made once per task, then called per row.
    """
    columns = [KEY, "__text", *extra]
    source = docs.select(
        KEY, F.coalesce(F.col("text"), F.lit("")).alias("__text"), *[F.col(c) for c in extra]
    )
    out = pa_schema(docs.sparkSession, schema)

    def run(batches):
        work = fn() if isinstance(fn, type) else fn
        for batch in slices(batches):
            rows, size = [], 0
            for row in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                made = list(work(*row))
                rows += made
                size += len(made)
                if size >= 50_000:
                    yield _batch(rows, out)
                    rows, size = [], 0
            yield _batch(rows, out)

    return source.mapInArrow(run, schema)


def slices(batches, rows: int = 512):
    """Parts of Arrow batches, so that only few rows are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
