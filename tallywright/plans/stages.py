"""Stage tables: each stage is written once and read by all that follow.

The stages are the cleaned sources, the entity matches, the reconciliation, the register, the
anomalies and the two reporting tables. They are Parquet tables in the folder that
``spark.checkpoint.dir`` names, so later queries prune columns and partitions, and a lost executor
costs no recomputation of an earlier stage. Tables whose keys are looked up have the statistics of these
keys beside them. A run can be saved, and opened by another application, which goes on from its tables.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import anomaly, bi, cleaning, matching, reconcile, register
from ..operators.keystats import KeyStats, read_sketches, sketch_keys, write_sketches
from ..schemas import RAW_COLUMNS
from ..session import shared_folder
from ..sources.saved import open_run, save_run
from ..sources.tables import PUBLISHED, load_raw, publish, write_table

CREATED = "2026-09-01"

# Keys that are looked up, by table.
KEYS = {
    "erp_transactions": ["transaction_id"],
    "payment_gateway": ["merchant_reference", "gateway_transaction_id"],
    "exception_register": ["transaction_id"],
}
PARTITIONED = {"reconciliation": "reconciliation_status"}
REPORTS = ("exception_table", "transaction_table")


class Stages:
    def __init__(
        self,
        spark: SparkSession,
        raw: dict[str, DataFrame],
        created: str = CREATED,
        date_formats: tuple[str, ...] = (),
        saved: dict[str, DataFrame] | None = None,
    ):
        self.spark, self.raw, self.created = spark, raw, created
        self.date_formats = date_formats
        app = spark.sparkContext.applicationId
        self._tables: dict[str, DataFrame] = dict(saved or {})
        self._stats: dict[str, KeyStats] = {}
        self.folder = f"{shared_folder(spark)}/tallywright/{app}/{uuid.uuid4().hex}"

    @classmethod
    def open(cls, spark: SparkSession, folder: str, check_rows: bool = True) -> "Stages":
        """The stages of a saved run. What it did not save is built from what it did; the raw sources
        are not needed. A run that is not whole raises."""
        tables, parameters = open_run(spark, folder, check_rows)
        sketches = {n: tables.pop(f"{n}.keys") for n in KEYS if f"{n}.keys" in tables}
        if not parameters["forest"]:
            tables["amount_anomalies"] = tables.pop("anomaly_detection")
            for name in REPORTS:
                tables[f"{name}_amounts"] = tables.pop(name)
        formats = tuple(parameters["date_formats"])
        opened = cls(spark, {}, parameters["created"], formats, saved=tables)
        opened._stats = {n: KeyStats.of(sketches[n], KEYS[n]) for n in sketches}
        return opened

    def _stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._tables:
            df = build()
            path = write_table(df, f"{self.folder}/{name}", partition_by=PARTITIONED.get(name))
            self._tables[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._tables[name]

    def key_stats(self, name: str) -> KeyStats:
        """Statistics of the keys of a stage table; sketched when they are first asked for, and kept
        beside the table."""
        if name not in self._stats:
            df, path = self._tables[name], f"{self.folder}/{name}.keys"
            write_sketches(df, KEYS[name], path)
            self._stats[name] = read_sketches(self.spark, [path], df, KEYS[name])
        return self._stats[name]

    @property
    def stats(self) -> dict[str, KeyStats]:
        """Statistics of the ledger's and the payments' keys."""
        self.ledger  # noqa: B018
        return {name: self.key_stats(name) for name in ("erp_transactions", "payment_gateway")}

    @property
    def cleaned(self) -> dict[str, DataFrame]:
        return {name: self.clean(name) for name in RAW_COLUMNS}

    def clean(self, name: str) -> DataFrame:
        """One cleaned source; the others are not built for it."""
        if name not in self._tables and not self.raw:
            raise FileNotFoundError("the run has neither raw nor cleaned sources")
        return self._stage(name, lambda: self._clean(name))

    def _clean(self, name: str) -> DataFrame:
        return cleaning.clean(name, self.raw[name], self.date_formats)

    @property
    def ledger(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.clean("erp_transactions"), self.clean("payment_gateway"), self.clean("bank_transactions")

    @property
    def pairs(self) -> DataFrame:
        """Ledger rows with payment, bank row and scores; scored once for all that follows, and of no
        more columns than that reads."""

        def build():
            return reconcile.scored_pairs(*self.ledger, self.stats).select(*reconcile.PAIR_COLUMNS)

        return self._stage("ledger_pairs", build)

    @property
    def matches(self) -> DataFrame:
        return self._stage("entity_matches", lambda: matching.match_table(self.pairs))

    @property
    def reconciliation(self) -> DataFrame:
        """Partitioned by status: most reports read the exceptions only."""

        def build():
            erp, payment, _ = self.ledger
            rows = reconcile.reconcile_pairs(self.pairs)
            return reconcile.add_unexpected_payments(rows, payment, erp, self.stats)

        return self._stage("reconciliation", build)

    @property
    def exceptions(self) -> DataFrame:
        return self._stage(
            "exception_register",
            lambda: register.build_exception_register(self.reconciliation, self.created),
        )

    @property
    def anomalies(self) -> DataFrame:
        return self._stage(
            "anomaly_detection", lambda: anomaly.detect_anomalies(self.reconciliation)
        )

    @property
    def amount_anomalies(self) -> DataFrame:
        """Without the isolation forest."""
        return self._stage(
            "amount_anomalies", lambda: anomaly.detect_anomalies(self.reconciliation, forest=False)
        )

    def flags(self, forest: bool = True) -> DataFrame:
        return self.anomalies if forest else self.amount_anomalies

    def report(self, table: str, forest: bool = True) -> DataFrame:
        """A reporting table as a plan that is not written: what reads it makes only the columns that it
        needs. A table that is already staged or saved is read."""
        name = table if forest else f"{table}_amounts"
        if name in self._tables:
            return self._tables[name]
        if table == "transaction_table":
            return bi.transaction_table(self.reconciliation, self.flags(forest))
        return bi.exception_table(
            self.exceptions,
            self.reconciliation,
            self.flags(forest),
            self.key_stats("exception_register"),
        )

    def exception_table(self, forest: bool = True) -> DataFrame:
        name = "exception_table" if forest else "exception_table_amounts"
        return self._stage(name, lambda: self.report("exception_table", forest))

    def transaction_table(self, forest: bool = True) -> DataFrame:
        name = "transaction_table" if forest else "transaction_table_amounts"
        return self._stage(name, lambda: self.report("transaction_table", forest))

    def publish(self, names: list[str] = PUBLISHED, forest: bool = True) -> None:
        """Make stage tables known to SQL under their names."""
        publish(self.pick(names, forest), names)

    def save_all(self, folder: str, fmt: str = "parquet", forest: bool = True) -> dict[str, str]:
        """Write the nine published tables and the two reports to ``folder/<table>``, and a manifest
        that marks the run as whole; the paths by table. Without ``forest`` the anomalies are those of
        the amount rules, under the same names. Parquet runs also keep the statistics of keys. Nothing
        is built from invoices, customers, matches and reports: those not staged yet are written here only."""
        tables = {n: lambda n=n: self.pick([n], forest)[n] for n in PUBLISHED}
        if self.raw:
            for name in ("customer_master", "invoice"):
                tables[name] = lambda n=name: self._tables.get(n) or self._clean(n)
        tables["entity_matches"] = lambda: self._tables.get("entity_matches") or matching.match_table(self.pairs)
        for name in REPORTS:
            tables[name] = lambda n=name: self.report(n, forest)
        if fmt == "parquet":
            for name, keys in KEYS.items():
                tables[f"{name}.keys"] = lambda n=name, k=keys: sketch_keys(self._tables[n], k)
        parameters = {"created": self.created, "date_formats": self.date_formats, "forest": forest}
        paths = save_run(self.spark, folder, tables, parameters, fmt, PARTITIONED, laid_out=True)
        return {name: path for name, path in paths.items() if not name.endswith(".keys")}

    def close(self) -> None:
        """Remove the folder of the stage tables; they cannot be read any more."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    def pick(self, names: list[str], forest: bool = True) -> dict[str, DataFrame]:
        """Some of the published tables; only what is asked for is built."""
        build = {
            "entity_matches": lambda: self.matches,
            "reconciliation": lambda: self.reconciliation,
            "exception_register": lambda: self.exceptions,
            "anomaly_detection": lambda: self.flags(forest),
        }
        return {n: build[n]() if n in build else self.clean(n) for n in names}


def from_files(
    spark: SparkSession,
    folder: str,
    fmt: str = "csv",
    ordered: bool = True,
    date_formats: tuple[str, ...] = (),
    multi_line: bool = False,
) -> Stages:
    """Stages over raw source files; ``multi_line`` allows line breaks in quoted CSV fields."""
    raw = load_raw(spark, folder, fmt, ordered, multi_line)
    return Stages(spark, raw, date_formats=date_formats)
