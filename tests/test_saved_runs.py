"""Runs that are saved and opened again."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tallywright.checks.registry import raw_tables
from tallywright.operators import reconcile
from tallywright.plans.stages import KEYS, Stages
from tallywright.sources import saved
from tallywright.sources.saved import BrokenRun, open_run, save_run
from tallywright.sources.tables import PUBLISHED

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


def same(a, b):
    columns = a.columns
    assert columns == b.columns and a.schema.simpleString() == b.schema.simpleString()
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("runs") / "today")
    stages = Stages(spark, raw_tables(spark, FOLDER), created="2026-08-01", date_formats=("yyyy-MM-dd",))
    paths = stages.save_all(folder, forest=False)
    return stages, folder, paths


@pytest.fixture
def copy(run, tmp_path):
    shutil.copytree(run[1], tmp_path / "copy")
    return str(tmp_path / "copy")


def test_another_session_goes_on_from_a_saved_run(spark, run):
    stages, folder, paths = run
    assert len(paths) == 11
    opened = Stages.open(spark.newSession(), folder)
    assert (opened.created, opened.date_formats) == ("2026-08-01", ("yyyy-MM-dd",))
    before, after = stages.pick(PUBLISHED, False), opened.pick(PUBLISHED, False)
    assert set(after) == set(PUBLISHED)
    for name in PUBLISHED:
        assert same(before[name], after[name]), name
    assert same(stages.exception_table(False), opened.exception_table(False))
    assert opened.key_stats("payment_gateway") == stages.key_stats("payment_gateway")
    # nothing of this was built again, and what was not saved is built from what was
    assert not os.path.exists(opened.folder.removeprefix("file:"))
    assert opened.pairs.count() == stages.pairs.count()
    opened.publish(["reconciliation"], forest=False)
    assert opened.spark.sql("SELECT count(*) AS n FROM reconciliation").first().n == stages.reconciliation.count()
    # the forest's flags were not saved, so they are not taken from the amount rules
    assert "anomaly_detection" not in opened._tables and "amount_anomalies" in opened._tables


def test_saved_exceptions_are_read_by_partition(spark, run):
    df = Stages.open(spark, run[1]).reconciliation.where("reconciliation_status <> 'MATCHED'").select("store_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reconciliation_status" in plan


def test_folders_without_a_whole_run_are_refused(spark, copy, tmp_path):
    with pytest.raises(BrokenRun, match="no saved run"):
        open_run(spark, str(tmp_path / "nowhere"))
    Stages.open(spark, copy)
    shutil.rmtree(f"{copy}/entity_matches")
    with pytest.raises(BrokenRun, match="entity_matches is gone"):
        Stages.open(spark, copy)


def test_changed_tables_are_refused(spark, copy):
    schema = spark.read.parquet(f"{copy}/invoice").schema
    rows = spark.read.parquet(f"{copy}/invoice").take(3)
    invoices = spark.createDataFrame(rows, schema)
    invoices.write.mode("overwrite").parquet(f"{copy}/invoice")
    with pytest.raises(BrokenRun, match="has 3 rows"):
        open_run(spark, copy)
    assert open_run(spark, copy, check_rows=False)[0]["invoice"].count() == 3
    invoices.withColumnRenamed("tax", "vat").write.mode("overwrite").parquet(f"{copy}/invoice")
    with pytest.raises(BrokenRun, match=r"\['tax', 'vat'\]"):
        open_run(spark, copy)


def test_a_run_that_breaks_off_is_refused_and_so_is_the_one_before(spark, copy):
    def fails():
        raise OSError("disk full")

    one = lambda: spark.range(3).toDF("n")
    with pytest.raises(OSError):
        save_run(spark, copy, {"a": one, "b": fails}, {})
    with pytest.raises(BrokenRun, match="not finished"):
        open_run(spark, copy)
    save_run(spark, copy, {"a": one, "b": one}, {"x": 1})
    tables, parameters = open_run(spark, copy)
    assert sorted(tables) == ["a", "b"] and parameters == {"x": 1}


def test_a_manifest_that_lost_rows_is_refused(spark, tmp_path):
    folder = str(tmp_path / "r")
    save_run(spark, folder, {"a": lambda: spark.range(1), "b": lambda: spark.range(2)}, {})
    rows = spark.read.schema(saved._SCHEMA).json(f"{folder}/manifest").collect()
    saved._write_manifest(spark, folder, [tuple(r) for r in rows[:1]])
    with pytest.raises(BrokenRun, match="not finished"):
        open_run(spark, folder)


def test_runs_as_csv(spark, tmp_path):
    folder = str(tmp_path / "csv")
    table = spark.sql("""SELECT * FROM VALUES (1, 'a "b", c', DATE'2026-01-02', 1.50BD, true),
        (2, ' x ', NULL, NULL, NULL), (NULL, NULL, NULL, -0.01BD, false) AS t(k, `a.b`, d, m, f)""")
    save_run(spark, folder, {"t": lambda: table, "none": lambda: table.limit(0)}, {}, "csv")
    tables, _ = open_run(spark, folder)
    assert same(table, tables["t"])  # but empty texts, which CSV does not tell from null
    assert tables["none"].count() == 0


def jobs(spark, build):
    """Jobs that run while ``build`` is called."""
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("counted", "")
    try:
        before = len(tracker.getJobIdsForGroup("counted"))
        build()
        return len(tracker.getJobIdsForGroup("counted")) - before
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_nothing_runs_while_a_reconciliation_is_built(spark, run):
    stages, folder, _ = run
    for s in (stages, Stages.open(spark, folder)):
        ledger, matches = s.ledger, s.matches
        stats = s.stats
        assert jobs(spark, lambda: reconcile.reconcile(*ledger, stats=stats)) == 0
        assert jobs(spark, lambda: reconcile.reconcile(*ledger, matches, stats)) == 0
    assert jobs(spark, lambda: reconcile.reconcile(*ledger)) > 0
    plain, informed = reconcile.reconcile(*ledger), reconcile.reconcile(*ledger, stats=stats)
    assert same(plain, informed)


def test_statistics_cover_all_keys(run):
    stages, _, _ = run
    for name, keys in KEYS.items():
        stats = stages.key_stats(name)
        table = stages.pick([name], False)[name]
        for k in keys:
            assert stats.rows[k] == table.where(F.col(k).isNotNull()).count()
