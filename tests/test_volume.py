"""What the stages shuffle and write: no more than what is read from them."""

import os

import pytest
from pyspark.sql import functions as F

from tallywright.checks import registry
from tallywright.operators import bi, reconcile
from tallywright.operators.cleaning import clean
from tallywright.plans.stages import Stages
from tallywright.schemas import RAW_COLUMNS, raw_schema
from tallywright.sources.tables import write_table


def sources(spark, n=40):
    """Raw sources of ``n`` ledger rows; id 3 has a copy, payment 5 a second use, payment 7 no bank row."""
    blank = {t: dict.fromkeys(c) for t, c in RAW_COLUMNS.items()}

    def frame(table, rows):
        full = [tuple({**blank[table], **r}.values()) + (i,) for i, r in enumerate(rows)]
        return spark.createDataFrame(full, raw_schema(table))

    person = {"customer_name": "Asha Costa", "email": "a@x", "transaction_date": "2026-08-10"}
    ledger = [{**person, "transaction_id": f"T{i}", "amount": f"{i}.00"} for i in [*range(n), 3]]
    paid = [
        {**person, "merchant_reference": f"T{i}", "gateway_transaction_id": f"P{i}", "amount": f"{i}.00", "gateway": "G"}
        for i in [*range(n), 5]
    ]
    paid[-1] |= {"gateway_transaction_id": "P5X", "amount": "1.00"}
    paid += [{**paid[0], "merchant_reference": None}, {**paid[0], "merchant_reference": "none"}]
    settled = [
        {"reference_number": f"P{i}", "credit_amount": f"{i}.00", "value_date": "2026-08-11"}
        for i in range(n)
        if i != 7
    ]
    return {
        "customer_master": frame("customer_master", [{"customer_id": "C1"}]),
        "invoice": frame("invoice", [{"invoice_id": "I1"}]),
        "erp_transactions": frame("erp_transactions", ledger),
        "payment_gateway": frame("payment_gateway", paid),
        "bank_transactions": frame("bank_transactions", settled),
    }


def written(s):
    here = s.folder.removeprefix("file:")
    return set(os.listdir(here)) if os.path.isdir(here) else set()


def test_a_reconciliation_builds_only_the_sources_that_it_reads(spark):
    s = Stages(spark, sources(spark))
    counts = {r.reconciliation_status: r.record_count for r in reconcile.status_counts(s.reconciliation).collect()}
    assert counts == {"MATCHED": 38, "DUPLICATE": 2, "MISSING_BANK_SETTLEMENT": 1, "UNEXPECTED_PAYMENT": 2}
    assert {"invoice", "customer_master"}.isdisjoint(written(s))
    assert s.pairs.columns == reconcile.PAIR_COLUMNS
    assert s.cleaned["invoice"].count() == 1


def test_stage_tables_are_packed_tightly(spark):
    s = Stages(spark, sources(spark))
    s.reconciliation  # noqa: B018
    tables = [(d, fs) for d, _, fs in os.walk(s.folder.removeprefix("file:")) if not d.endswith(".keys")]
    files = [f for _, fs in tables for f in fs if f.endswith(".parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_without_sources_nothing_is_cleaned(spark):
    with pytest.raises(FileNotFoundError):
        Stages(spark, {}).ledger  # noqa: B018


@pytest.fixture
def merged(spark):
    """All joins are shuffled."""
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_payments_are_shuffled_by_gateway_id_and_by_reference_only(spark, merged):
    raw = sources(spark)
    erp, payment, bank = (
        clean(t, raw[t]) for t in ("erp_transactions", "payment_gateway", "bank_transactions")
    )
    pairs = reconcile.scored_pairs(erp, payment, bank)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "merger" not in x]
    # ledger, its copies and those without id, bank, payments twice
    assert len(shuffles) == 6
    got = {r.transaction_id: r for r in pairs.collect()}
    assert len(got) == 40 and pairs.count() == 41
    assert (got["T5"].p_gateway_transaction_id, float(got["T5"].b_amount)) == ("P5", 5.0)
    assert got["T7"].p_found and got["T7"].b_found is None


def test_a_bank_row_belongs_to_the_first_payment_alone(spark):
    """The second use of a reference is settled, the first is not."""
    raw = sources(spark)
    payment = clean("payment_gateway", raw["payment_gateway"]).where("merchant_reference = 'T5'")
    bank = clean("bank_transactions", raw["bank_transactions"]).where("reference_number = 'P6'")
    bank = bank.withColumn("reference_number", F.lit("P5X"))
    found = reconcile.settled_payments(payment, bank).collect()
    assert [(r._key, r.p_gateway_transaction_id, r.b_found) for r in found] == [("T5", "P5", None)]


def test_totals_do_not_write_the_reports(spark, tmp_path):
    s = Stages(spark, sources(spark))
    key = (spark.sparkContext.applicationId, "volume")
    registry._open[key] = s
    try:
        totals = registry.QUERIES["k3_transaction_totals"](spark, "volume").first()
        assert (totals.row_count, totals.unique_transactions) == (42, 41)  # null is an id of its own
        assert registry.QUERIES["k5_kpis"](spark, "volume").first().exceptions == 5
        assert registry.QUERIES["k11_measures_amounts"](spark, "volume").first().total_exceptions == 5
    finally:
        del registry._open[key]
    reports = {"transaction_table_amounts", "exception_table_amounts"}
    assert reports.isdisjoint(written(s))
    s.save_all(str(tmp_path / "run"), forest=False)
    assert (reports | {"invoice", "customer_master", "entity_matches"}).isdisjoint(written(s))
    opened = Stages.open(spark, str(tmp_path / "run"))
    assert bi.transaction_totals(opened.transaction_table(False)).first().row_count == 42
    assert opened.exception_table(False).count() == 5
    # as a stage it is still written
    assert s.transaction_table(False).count() == 42 and "transaction_table_amounts" in written(s)


def test_a_partitioned_stage_is_saved_without_a_shuffle(spark, tmp_path):
    s = Stages(spark, sources(spark))
    rows = s.reconciliation
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup("saved again", "")
    try:
        write_table(rows, str(tmp_path / "r"), "parquet", "reconciliation_status", laid_out=True)
        stages = [i for j in tracker.getJobIdsForGroup("saved again") for i in tracker.getJobInfo(j).stageIds]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(stages) == 1
    again = spark.read.schema(rows.schema).parquet(str(tmp_path / "r"))
    assert rows.exceptAll(again).count() == again.exceptAll(rows).count() == 0
