import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywright.operators import bi, dashboard, register, rootcause
from tallywright.schemas import REGISTER_COLUMNS

RECON = (
    "transaction_id string, invoice_id string, customer_id string, customer_name string, "
    "store_id string, erp_transaction_date timestamp_ntz, erp_amount decimal(18,2), "
    "gateway_transaction_id string, gateway string, payment_transaction_date timestamp_ntz, "
    "payment_amount decimal(18,2), payment_difference decimal(19,2), "
    "bank_transaction_date timestamp_ntz, bank_amount decimal(18,2), "
    "bank_difference decimal(19,2), bank_status string, date_difference_days int, "
    "entity_match_score double, entity_match_confidence string, reconciliation_status string, "
    "src_branch int, src_row long"
)


def recon_table(spark, rows):
    """Reconciliation rows from (id, status, payment difference, bank difference)."""
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "src_row long, transaction_id string, reconciliation_status string, p string, b string",
    )
    given = {
        "transaction_id": F.col("transaction_id"),
        "reconciliation_status": F.col("reconciliation_status"),
        "payment_difference": F.col("p"),
        "bank_difference": F.col("b"),
        "src_row": F.col("src_row"),
        "src_branch": (F.col("reconciliation_status") == "UNEXPECTED_PAYMENT").cast("int"),
        "store_id": F.concat(F.lit("S"), (F.col("src_row") % 3).cast("string")),
        "erp_amount": F.col("src_row"),
    }
    fields = [f.split(" ") for f in RECON.split(", ")]
    return df.select(
        *[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields]
    )


def build(spark, rows, **options):
    return register.build_exception_register(recon_table(spark, rows), "2026-09-01", **options)


@pytest.mark.parametrize(
    "status, impact, severity",
    [
        ("PARTIAL_PAYMENT", "9999.99", "MEDIUM"),
        ("PARTIAL_PAYMENT", "10000", "HIGH"),
        ("PARTIAL_PAYMENT", "-49999.99", "HIGH"),
        ("DUPLICATE", "50000", "CRITICAL"),
        ("MISSING_PAYMENT", None, "HIGH"),
        ("MISSING_BANK_SETTLEMENT", "0", "HIGH"),
        ("UNEXPECTED_PAYMENT", None, "HIGH"),
        ("ENTITY_UNCERTAIN", "1", "HIGH"),
        ("DUPLICATE", None, "MEDIUM"),
        ("SOMETHING_NEW", None, "LOW"),
    ],
)
def test_severity(spark, status, impact, severity):
    row = build(spark, [("t", status, impact, None)]).first()
    assert row.severity == severity
    assert row.sla_days == {"CRITICAL": 1, "HIGH": 3, "MEDIUM": 7, "LOW": 14}[severity]


def test_register_columns_ids_and_defaults(spark):
    rows = [
        ("a", "MATCHED", "0", "0"),
        ("b", "UNEXPECTED_PAYMENT", None, None),
        ("c", "OVERPAYMENT", "-5", "20"),
        ("d", "DUPLICATE", None, None),
    ]
    got = build(spark, rows).orderBy("exception_id").collect()
    # ledger rows come before unexpected payments
    assert [(r.exception_id, r.transaction_id) for r in got] == [
        ("EXC-000001", "c"),
        ("EXC-000002", "d"),
        ("EXC-000003", "b"),
    ]
    assert [float(r.financial_impact) for r in got] == [20, 0, 0]
    first = got[0]
    assert (first.status, first.sla_status, first.exception_age_days) == ("OPEN", "WITHIN_SLA", 0)
    assert first.created_date == dt.date(2026, 9, 1) and first.resolution is None
    assert first.owner == "Payments" and first.root_cause == "Potential overpayment"


def test_age_and_sla_follow_the_given_day(spark):
    got = build(spark, [("c", "OVERPAYMENT", "60000", None)], as_of="2026-09-03").first()
    assert (got.exception_age_days, got.sla_status) == (2, "OUTSIDE_SLA")


def test_no_exceptions_gives_an_empty_register_with_its_columns(spark):
    got = build(spark, [("a", "MATCHED", "0", "0")])
    assert got.columns[:29] == REGISTER_COLUMNS and len(REGISTER_COLUMNS) == 29
    assert got.count() == 0
    assert register.register_totals(got).first().financial_exposure == 0
    assert rootcause.concentration(got).first()[0] == 0.0
    assert rootcause.insights(got).first().top_gateway is None


def test_concentration(spark):
    small = build(spark, [(str(i), "OVERPAYMENT", str(i + 1), None) for i in range(4)])
    assert rootcause.concentration(small).first()[0] == 100.0
    large = build(spark, [(str(i), "OVERPAYMENT", "10", None) for i in range(40)])
    assert rootcause.concentration(large).first()[0] == 25.0


def test_analyses_sum_to_the_total(spark):
    statuses = ["OVERPAYMENT", "DUPLICATE", "PARTIAL_PAYMENT", "UNEXPECTED_PAYMENT", "MATCHED"]
    reg = build(spark, [(str(i), statuses[i % 5], str(i * 3000), None) for i in range(60)]).cache()
    total = register.register_totals(reg).first().financial_exposure
    for name in ("exception_types", "severity", "root_causes", "owners", "stores"):
        got = rootcause.ANALYSES[name](reg).collect()
        assert sum(r.financial_exposure for r in got) == total, name
    order = [r.severity for r in rootcause.severities(reg).collect()]
    assert order == [s for s in rootcause.SEVERITY_ORDER if s in order]
    assert rootcause.gateways(reg).count() == 0  # null gateways are left out


def test_saved_analyses_can_be_read_again(spark, tmp_path):
    reg = build(spark, [("a", "OVERPAYMENT", "5", None), ("b", "DUPLICATE", None, "7")])
    paths = rootcause.save_analyses(reg, str(tmp_path))
    assert len(paths) == 7
    got = spark.read.option("header", True).csv(paths["owners"])
    assert {(r.owner, r.financial_exposure) for r in got.collect()} == {
        ("Payments", "5.00"),
        ("Finance", "7.00"),
    }


# --- reporting tables ----------------------------------------------------------------------------


def with_flags(recon):
    from tallywright.operators.anomaly import detect_anomalies

    return detect_anomalies(recon, forest=False)


@pytest.fixture
def tables(spark, low_bar):
    rows = [("hot", "DUPLICATE", "100", None)] * 60
    rows += [(None, "UNEXPECTED_PAYMENT", None, None)] * 30
    rows += [(f"t{i}", "OVERPAYMENT", str(i), "1") for i in range(20)]
    rows += [(f"m{i}", "MATCHED", "0", "0") for i in range(40)]
    rows += [("two", "MATCHED", "0", "0"), ("two", "MISSING_BANK_SETTLEMENT", "0", None)]
    recon = recon_table(spark, rows).cache()
    reg = register.build_exception_register(recon, "2026-09-01").cache()
    flags = with_flags(recon)
    return (
        recon,
        reg,
        bi.exception_table(reg, recon, flags).cache(),
        bi.transaction_table(recon, flags).cache(),
    )


def test_exception_table_has_one_row_per_exception(tables):
    recon, reg, exceptions, _ = tables
    assert len(exceptions.columns) == 40
    assert exceptions.count() == reg.count() == exceptions.select("exception_id").distinct().count()
    # the first row represents the id: the MATCHED one
    two = exceptions.where("transaction_id = 'two'").first()
    assert two.reconciliation_status == "MATCHED" and two.is_exception
    unknown = exceptions.where("transaction_id IS NULL").first()
    assert unknown.reconciliation_status is None and unknown.potential_anomaly is False


def test_transaction_table_has_one_row_per_id(tables):
    recon, _, _, transactions = tables
    assert len(transactions.columns) == 50
    ids = recon.select("transaction_id").distinct().count()
    assert transactions.count() == ids
    two = transactions.where("transaction_id = 'two'").first()
    assert two.reconciliation_status == "MISSING_BANK_SETTLEMENT"
    assert two.reconciliation_status_anomaly == "MATCHED"


def test_measures(tables):
    _, reg, exceptions, _ = tables
    columns = bi.measure_columns()
    assert len(columns) == 36
    got = bi.measures(exceptions).first()
    assert got.total_exceptions == reg.count() == got.open_exceptions == got.within_sla
    assert got.matched_exceptions == 1 and got.overpayments == 20 and got.duplicate_transactions == 60
    assert got.closed_exceptions == 0 and got.outside_sla == 0
    assert got.total_financial_exposure == Decimal(60 * 100 + sum(max(i, 1) for i in range(20)))
    by_store = bi.measures(exceptions, ["store_id"], ["total_exceptions"])
    assert sum(r.total_exceptions for r in by_store.collect()) == got.total_exceptions


def test_dashboard(tables):
    _, _, exceptions, transactions = tables
    everything = dashboard.select_exceptions(exceptions)
    assert everything.count() == exceptions.count()
    assert dashboard.select_exceptions(exceptions, owners=["Payments"]).count() == 20
    assert dashboard.select_exceptions(exceptions, severities=[]).count() == 0
    kpis = dashboard.kpis(transactions, everything).first()
    assert kpis.transactions == 62  # the null id is no transaction
    assert kpis.exception_rate == round(kpis.exceptions / 62 * 100, 2)
    none = dashboard.kpis(transactions.limit(0), everything).first()
    assert none.exception_rate == 0
    view = dashboard.register_view(exceptions).collect()
    impacts = [r.financial_impact for r in view]
    assert impacts == sorted(impacts, reverse=True) and len(view[0]) == 10
