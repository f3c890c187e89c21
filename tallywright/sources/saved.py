"""Saved runs: a folder of tables with a manifest, which is written last and marks the run as whole.

The manifest is a small table itself, one row for each saved table (where it lies, its schema, rows and
format), which repeats the parameters of the run and how many tables it has. Saving over an older run
first puts an empty manifest in place of its, so a run that was broken off cannot be opened, neither as
the new one nor as the old.
"""

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .tables import read_csv, table_counts, write_counted

MANIFEST = "manifest"
_SCHEMA = (
    "table_name string, format string, partition_by string, schema string, row_count bigint,"
    " parameters string, tables int"
)


class BrokenRun(RuntimeError):
    """A folder that holds no run, or one that is not whole."""


def _write_manifest(spark: SparkSession, folder: str, rows: list[tuple]) -> None:
    found = spark.createDataFrame(rows, _SCHEMA).coalesce(1)
    found.write.mode("overwrite").json(f"{folder}/{MANIFEST}")


def save_run(
    spark: SparkSession,
    folder: str,
    tables: dict[str, Callable[[], DataFrame]],
    parameters: dict,
    fmt: str = "parquet",
    partition_by: dict[str, str] | None = None,
    laid_out: bool = False,
) -> dict[str, str]:
    """Write ``tables`` to ``folder/<table>`` and then the manifest; the paths by table.

    ``laid_out`` says that the tables in ``partition_by`` are read from files partitioned alike. Parquet gives back what was saved; CSV gives empty texts back as null.
    """
    partition_by = partition_by or {}
    _write_manifest(spark, folder, [])
    given, paths, rows = json.dumps(parameters, sort_keys=True), {}, []
    for name, build in tables.items():
        df, paths[name] = build(), f"{folder}/{name}"
        by = partition_by.get(name) if fmt == "parquet" else None
        n = write_counted(df, paths[name], fmt, by, laid_out)
        rows.append((name, fmt, by, df.schema.json(), n, given, len(tables)))
    _write_manifest(spark, folder, rows)
    return paths


def _read(spark: SparkSession, path: str, fmt: str, schema: StructType) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema)
    found = spark.read.parquet(path)
    wanted = {f.name: f.dataType.simpleString() for f in schema}
    there = {f.name: f.dataType.simpleString() for f in found.schema}
    changed = {n for n in wanted.keys() | there.keys() if wanted.get(n) != there.get(n)}
    if changed:
        raise BrokenRun(f"{path}: columns {sorted(changed)} are not as the manifest says")
    return spark.read.schema(schema).parquet(path).select(*[f"`{n}`" for n in schema.names])


def open_run(
    spark: SparkSession, folder: str, check_rows: bool = True
) -> tuple[dict[str, DataFrame], dict]:
    """Tables and parameters of a saved run.

    Raises ``BrokenRun`` where there is no manifest, where it is not whole, or where a table lacks
    files, has other columns than were saved, or (``check_rows``, one narrow job) another number of rows.
    """
    try:
        rows = spark.read.schema(_SCHEMA).json(f"{folder}/{MANIFEST}").collect()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        raise BrokenRun(f"{folder} holds no saved run") from error
    if not rows or any(r.tables != len(rows) for r in rows):
        raise BrokenRun(f"{folder} holds a run that was not finished")
    tables = {}
    for r in rows:
        try:
            schema = StructType.fromJson(json.loads(r.schema))
            tables[r.table_name] = _read(spark, f"{folder}/{r.table_name}", r.format, schema)
        except Exception as error:
            if not any(x in str(error) for x in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "missing columns")):
                raise
            raise BrokenRun(f"{folder}/{r.table_name} is gone or empty") from error
    if check_rows:
        saved = {r.table_name: r.row_count for r in rows}
        for r in table_counts(tables).collect():
            if r.row_count != saved[r.table_name]:
                raise BrokenRun(
                    f"{folder}/{r.table_name} has {r.row_count} rows, {saved[r.table_name]} were saved"
                )
    return tables, json.loads(rows[0].parameters)
