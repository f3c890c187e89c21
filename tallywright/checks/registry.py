"""Every operator as a registered query over the tables of one folder."""

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, TimestampNTZType

from ..operators import anomaly, bi, cleaning, dashboard, keys, matching, reconcile
from ..operators import register as reg
from ..operators import rootcause as rc
from ..operators.forest import Forest, draw_samples
from ..operators.joins import look_up
from ..plans import packs
from ..plans.stages import Stages
from ..schemas import (
    ANOMALY_COLUMNS,
    ORDER_COLUMNS,
    RAW_COLUMNS,
    RECONCILIATION_COLUMNS,
    REGISTER_COLUMNS,
)
from ..sources.derived import derive_sources
from ..sources.tables import PUBLISHED, read_csv, read_raw, table_counts, write_table

Query = Callable[[SparkSession, str], DataFrame]

# Derived from floating-point means and deviations, whose last bits depend on the summing order.
_ROUNDED = {"amount_z_score", "q1", "q3", "lower_bound", "upper_bound"}


def present(df: DataFrame) -> DataFrame:
    """Plain output types: money as DOUBLE, whole numbers as BIGINT, dates as text."""

    def plain(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, IntegerType):
            c = c.cast("bigint")
        elif isinstance(field.dataType, TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, DateType):
            c = c.cast("string")
        elif field.name in _ROUNDED or field.name.endswith("_scaled"):
            c = F.round(c, 6)
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


_open: dict[tuple[str, str], Stages] = {}
_saved: dict[int, Stages] = {}


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return derive_sources(
        spark.read.parquet(f"{folder}/orders.parquet"),
        spark.read.parquet(f"{folder}/customer.parquet"),
    )


def stages(spark: SparkSession, folder: str) -> Stages:
    """The stage tables of this folder, built at most once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        _open[key] = Stages(spark, raw_tables(spark, folder))
    return _open[key]


def forget_stages() -> None:
    _open.clear()
    _saved.clear()


QUERIES: dict[str, Query] = {}


def query(name: str):
    def add(fn: Callable[[Stages], DataFrame]):
        QUERIES[name] = lambda spark, folder: present(fn(stages(spark, folder)))
        return fn

    return add


def _named(name: str, fn: Callable[[Stages], DataFrame]) -> None:
    query(name)(fn)


# --- sources, sinks, catalog ---------------------------------------------------------------------


def _trial(s: Stages, name: str) -> str:
    return f"{s.folder}/files/{name}"


@query("a1_read_raw_csv")
def _(s: Stages) -> DataFrame:
    path = write_table(s.raw["payment_gateway"], _trial(s, "payment_gateway"), "csv")
    return read_raw(s.spark, path, "payment_gateway")


def _read_reordered(table: str):
    """Written with the columns the other way round, read by name."""

    def read(s: Stages) -> DataFrame:
        raw = s.raw[table]
        path = write_table(raw.select(*raw.columns[::-1]), _trial(s, f"csv_{table}"), "csv")
        return read_raw(s.spark, path, table)

    return read


for _source in RAW_COLUMNS:
    _named(f"a1_read_{_source}", _read_reordered(_source))


@query("a1_number_plain_files")
def _(s: Stages) -> DataFrame:
    """Bank rows from files without row numbers, counted in file order."""
    raw = s.raw["bank_transactions"]
    sorted_rows = raw.repartitionByRange(5, "src_row").sortWithinPartitions("src_row")
    path = write_table(sorted_rows.drop("src_row"), _trial(s, "plain_bank"), "csv")
    numbered = read_raw(s.spark, path, "bank_transactions", ordered=False)
    counted = keys.running_number(
        numbered.withColumn("src_branch", F.lit(0)), "src_branch", "src_row", "row_no"
    )
    return counted.select(*RAW_COLUMNS["bank_transactions"], "row_no")


@query("a2_read_staged_matches")
def _(s: Stages) -> DataFrame:
    return s.matches.drop("src_row")


def _reopened(s: Stages) -> Stages:
    """The stages as another session finds them after they were saved."""
    if id(s) not in _saved:
        s.save_all(_trial(s, "run"), forest=False)
        _saved[id(s)] = Stages.open(s.spark.newSession(), _trial(s, "run"))
    return _saved[id(s)]


@query("a2_reopen_saved")
def _(s: Stages) -> DataFrame:
    return table_counts(_reopened(s).pick(PUBLISHED, forest=False))


@query("a2_reopened_register")
def _(s: Stages) -> DataFrame:
    return _reopened(s).exceptions.select(*REGISTER_COLUMNS)


@query("a2_reopened_exception_table")
def _(s: Stages) -> DataFrame:
    """Built from what was saved, not read."""
    saved = _reopened(s)
    return bi.exception_table(
        saved.exceptions,
        saved.reconciliation,
        saved.flags(forest=False),
        saved.key_stats("exception_register"),
    )


@query("a3_write_and_read_register")
def _(s: Stages) -> DataFrame:
    path = write_table(s.exceptions.select(*REGISTER_COLUMNS), _trial(s, "register"), "csv")
    schema = s.exceptions.select(*REGISTER_COLUMNS).schema
    return read_csv(s.spark, path, schema)


@query("a4_published_invoices")
def _(s: Stages) -> DataFrame:
    s.publish(["invoice", "customer_master"])
    return s.spark.sql("""
        SELECT c.customer_type, count(*) AS invoices, sum(i.net_amount) AS net_amount
        FROM invoice i JOIN customer_master c ON i.customer_id = c.customer_id
        GROUP BY c.customer_type""")


@query("a5_table_counts")
def _(s: Stages) -> DataFrame:
    return table_counts(s.pick(PUBLISHED, forest=False))


@query("a6_reconciliation_pack")
def _(s: Stages) -> DataFrame:
    s.publish(["reconciliation", "exception_register"])
    return packs.run_pack(s.spark, packs.RECONCILIATION_PACK)


@query("a6_investigation_pack")
def _(s: Stages) -> DataFrame:
    s.publish(["reconciliation", "exception_register", "anomaly_detection"], forest=False)
    return packs.run_pack(s.spark, packs.INVESTIGATION_PACK)


# --- cleaning ------------------------------------------------------------------------------------

for _table, _short in {
    "customer_master": "customer",
    "invoice": "invoice",
    "erp_transactions": "erp",
    "payment_gateway": "payment",
    "bank_transactions": "bank",
}.items():
    _named(f"b_clean_{_short}", lambda s, t=_table: cleaning.clean(t, s.raw[t]).drop("src_row"))


@query("b_unparsed")
def _(s: Stages) -> DataFrame:
    """Texts of all sources that are no date or amount."""
    counts = [cleaning.unparsed(table, df) for table, df in s.raw.items()]
    return reduce(DataFrame.union, counts)


@query("b11_clean_counts")
def _(s: Stages) -> DataFrame:
    return table_counts(cleaning.clean_all(s.raw))


# --- keys ----------------------------------------------------------------------------------------


@query("c1_first_payment")
def _(s: Stages) -> DataFrame:
    first = keys.first_per_key(s.clean("payment_gateway"), "merchant_reference", ["src_row"])
    return first.select("merchant_reference", "gateway_transaction_id", "amount", "src_row")


@query("c2_first_bank_row")
def _(s: Stages) -> DataFrame:
    first = keys.first_per_key(s.clean("bank_transactions"), "reference_number", ["src_row"])
    return first.select("reference_number", "bank_transaction_id", "credit_amount", "src_row")


@query("c3_first_match")
def _(s: Stages) -> DataFrame:
    first = keys.first_per_key(s.matches, "transaction_id", ["src_row"])
    return first.select("transaction_id", "entity_match_score", "entity_match_confidence")


@query("c4_repeated_ids")
def _(s: Stages) -> DataFrame:
    erp = s.clean("erp_transactions").select("transaction_id", "src_row")
    return keys.flag_repeated(
        erp, "transaction_id", ["src_row"], stats=s.key_stats("erp_transactions")
    )


@query("c5_first_reconciliation_row")
def _(s: Stages) -> DataFrame:
    return keys.first_per_key(s.reconciliation, "transaction_id", ORDER_COLUMNS).select(
        "transaction_id", "reconciliation_status", "erp_amount", *ORDER_COLUMNS
    )


@query("c6_status_priority")
def _(s: Stages) -> DataFrame:
    return keys.last_by_priority(
        s.reconciliation,
        "transaction_id",
        reg.by_status(bi.STATUS_PRIORITY, bi.OTHER_PRIORITY),
        ORDER_COLUMNS,
    ).select("transaction_id", "reconciliation_status", "erp_amount", *ORDER_COLUMNS)


@query("c7_unique_lookup")
def _(s: Stages) -> DataFrame:
    first = keys.first_per_key(s.reconciliation, "transaction_id", ORDER_COLUMNS)
    return keys.assert_unique(first, ["transaction_id"]).agg(F.count("*").alias("unique_ids"))


@query("c7_checked_first_rows")
def _(s: Stages) -> DataFrame:
    """Checked by the job itself."""
    first = keys.first_per_key(s.reconciliation, "transaction_id", ORDER_COLUMNS)
    return keys.one_per_key(
        first.select("transaction_id", "reconciliation_status", "erp_amount", *ORDER_COLUMNS),
        "transaction_id",
    )


@query("c8_distinct_ids")
def _(s: Stages) -> DataFrame:
    return keys.distinct_count(s.reconciliation, "transaction_id")


# --- joins ---------------------------------------------------------------------------------------


@query("d1_erp_with_payment")
def _(s: Stages) -> DataFrame:
    erp, payment, _ = s.ledger
    return matching.match_transactions(erp, payment, s.key_stats("erp_transactions")).select(
        "transaction_id", "gateway_transaction_id", "erp_amount", "payment_amount", "src_row"
    )


@query("d2_payment_with_bank")
def _(s: Stages) -> DataFrame:
    _, payment, bank = s.ledger
    return reconcile.settled_payments(payment, bank, s.stats).select(
        F.col("_key").alias("merchant_reference"),
        F.col("p_gateway_transaction_id").alias("gateway_transaction_id"),
        F.col("p_amount").alias("payment_amount"),
        F.col("b_amount").alias("bank_amount"),
        F.col("b_date").alias("bank_date"),
        F.coalesce("b_found", F.lit(False)).alias("settled"),
    )


@query("d3_reconciliation_from_matches")
def _(s: Stages) -> DataFrame:
    return reconcile.reconcile(*s.ledger, s.matches, s.stats).select(*RECONCILIATION_COLUMNS)


@query("d4_unexpected_payments")
def _(s: Stages) -> DataFrame:
    erp, payment, _ = s.ledger
    return reconcile.unexpected_payments(payment, erp, s.stats).select(*RECONCILIATION_COLUMNS)


# --- matching ------------------------------------------------------------------------------------


@query("e_similarity")
def _(s: Stages) -> DataFrame:
    erp, payment, _ = s.ledger
    pairs = look_up(
        erp,
        "transaction_id",
        [matching.first_payments(payment)],
        ["src_row"],
        how="inner",
        stats=s.key_stats("erp_transactions"),
    )
    mine, theirs = matching.evidence(), matching.evidence("p_")
    return pairs.select(
        "src_row",
        "transaction_id",
        F.round(matching.name_score(mine["name"], theirs["name"]), 6).alias("name_score"),
        F.round(matching.email_score(mine["email"], theirs["email"]), 6).alias("email_score"),
        matching.amount_score(mine["amount"], theirs["amount"]).alias("amount_score"),
        matching.exact_match(F.col(mine["email"]), F.col(theirs["email"])).alias("email_exact"),
    )


@query("e_match_table")
def _(s: Stages) -> DataFrame:
    erp, payment, _ = s.ledger
    stats = s.key_stats("erp_transactions")
    return matching.match_transactions(erp, payment, stats).drop("src_row")


_named("e_match_bands", lambda s: matching.match_bands(s.matches))
_named("e_mean_score", lambda s: matching.mean_score(s.matches))

# --- reconciliation ------------------------------------------------------------------------------


@query("f_reconciliation")
def _(s: Stages) -> DataFrame:
    return reconcile.reconcile(*s.ledger, stats=s.stats).select(*RECONCILIATION_COLUMNS)


@query("f_ledger_reconciliation")
def _(s: Stages) -> DataFrame:
    return reconcile.reconcile_transactions(*s.ledger, stats=s.stats).select(*RECONCILIATION_COLUMNS)


_named("f_status_counts", lambda s: reconcile.status_counts(s.reconciliation))
_named("f_status_impact", lambda s: reconcile.status_impact(s.reconciliation))

# --- register ------------------------------------------------------------------------------------


@query("g_register")
def _(s: Stages) -> DataFrame:
    return reg.build_exception_register(s.reconciliation, s.created).select(*REGISTER_COLUMNS)


@query("g_register_aged")
def _(s: Stages) -> DataFrame:
    return reg.build_exception_register(s.reconciliation, s.created, as_of="2026-09-05").select(
        "exception_id", "severity", "exception_age_days", "sla_days", "sla_status"
    )


_named("g_totals", lambda s: reg.register_totals(s.exceptions))
_named("g_by_severity", lambda s: reg.counts_by(s.exceptions, "severity"))
_named("g_by_type", lambda s: reg.counts_by(s.exceptions, "reconciliation_status"))
_named("g_by_owner", lambda s: reg.counts_by(s.exceptions, "owner"))
_named("g_exposure_by_type", lambda s: reg.exposure_by(s.exceptions, "reconciliation_status"))

# --- root causes ---------------------------------------------------------------------------------

for _name, _short in {
    "exception_types": "type",
    "gateways": "gateway",
    "stores": "store",
    "customers": "customer",
    "severity": "severity",
    "root_causes": "root_cause",
    "owners": "owner",
}.items():
    _named(f"h_by_{_short}", lambda s, n=_name: rc.ANALYSES[n](s.exceptions))
_named("h_concentration", lambda s: rc.concentration(s.exceptions))
_named("h_insights", lambda s: rc.insights(s.exceptions))


@query("h_saved_analyses")
def _(s: Stages) -> DataFrame:
    paths = rc.save_analyses(s.exceptions, _trial(s, "analyses"))
    return table_counts(
        {n: s.spark.read.option("header", True).csv(p) for n, p in paths.items()}
    )


# --- anomalies -----------------------------------------------------------------------------------


@query("anom_features")
def _(s: Stages) -> DataFrame:
    return anomaly.fill_features(s.reconciliation).select(*ORDER_COLUMNS, *anomaly.FEATURES)


@query("anom_zscore")
def _(s: Stages) -> DataFrame:
    filled = anomaly.fill_features(s.reconciliation)
    return filled.select(
        *ORDER_COLUMNS, anomaly.z_score(filled, "erp_amount").alias("amount_z_score")
    ).withColumn("amount_z_anomaly", F.abs("amount_z_score") >= anomaly.Z_FROM)


@query("anom_iqr_bounds")
def _(s: Stages) -> DataFrame:
    return anomaly.quartile_bounds(anomaly.fill_features(s.reconciliation), "erp_amount")


@query("anom_iqr")
def _(s: Stages) -> DataFrame:
    filled = anomaly.fill_features(s.reconciliation)
    return filled.select(
        *ORDER_COLUMNS, anomaly.iqr_flag(filled, "erp_amount").alias("amount_iqr_anomaly")
    )


@query("anom_scaled_features")
def _(s: Stages) -> DataFrame:
    filled = anomaly.fill_features(s.reconciliation)
    scaled = anomaly.standard_scale(filled, anomaly.FEATURES)
    return scaled.select(*ORDER_COLUMNS, *[f"{c}_scaled" for c in anomaly.FEATURES])


@query("anom_flags_amounts")
def _(s: Stages) -> DataFrame:
    return anomaly.detect_anomalies(s.reconciliation, forest=False).select(
        *ORDER_COLUMNS,
        "transaction_id",
        *[c for c in ANOMALY_COLUMNS if not c.startswith("isolation_forest")],
    )


@query("anom_forest")
def _(s: Stages) -> DataFrame:
    return anomaly.detect_anomalies(s.reconciliation).select(
        *RECONCILIATION_COLUMNS, *ANOMALY_COLUMNS
    )


@query("anom_forest_sample")
def _(s: Stages) -> DataFrame:
    """The rows that each tree is grown from."""
    rows = s.reconciliation.select(*ORDER_COLUMNS)
    return draw_samples(rows, ORDER_COLUMNS, rows.count(), trees=200, seed=42).select(
        "tree", *ORDER_COLUMNS
    )


@query("anom_forest_rules")
def _(s: Stages) -> DataFrame:
    """How many rows keep what must hold for any forest."""
    score, flag = F.col("isolation_forest_score"), F.col("isolation_forest_anomaly")
    flags = ("amount_z_anomaly", "amount_iqr_anomaly", "isolation_forest_anomaly")
    fired = sum(F.col(c).cast("int") for c in flags)
    return s.anomalies.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(score.between(-0.5, 0.5)).alias("scores_in_range"),
        F.count_if(flag == (score < 0)).alias("flags_by_sign"),
        F.count_if(F.col("anomaly_methods_triggered") == fired).alias("methods_add_up"),
        F.count_if(F.col("potential_anomaly") == (fired > 0)).alias("potential_if_any"),
    )


# Two small trees as data: feature, cut, low and high child, depth of a leaf.
_LEAF = (0, float("inf"))
FIXED_TREES = [
    [
        ("erp_amount", 100_000.0, 1, 2, 0.0),
        (*_LEAF, 1, 1, 4.5),
        ("date_difference_days", 0.0, 3, 4, 0.0),
        (*_LEAF, 3, 3, 3.25),
        (*_LEAF, 4, 4, 1.0),
    ],
    [
        ("entity_match_score", 95.0, 1, 2, 0.0),
        ("payment_difference", 0.0, 3, 4, 0.0),
        (*_LEAF, 2, 2, 6.0),
        (*_LEAF, 3, 3, 2.0),
        (*_LEAF, 4, 4, 2.5),
    ],
]


@query("anom_forest_decision")
def _(s: Stages) -> DataFrame:
    """The walk of given trees over the features as they are."""
    place = {c: i for i, c in enumerate(anomaly.FEATURES)}
    trees = [
        (
            np.array([place.get(n[0], 0) for n in nodes]),
            np.array([n[1] for n in nodes]),
            np.array([child for n in nodes for child in n[2:4]]),
            np.array([n[4] for n in nodes]),
        )
        for nodes in FIXED_TREES
    ]
    unscaled = anomaly.Moments(1, dict.fromkeys(anomaly.FEATURES, (0.0, 1.0)))
    model = Forest(unscaled, trees, levels=2, sample=256)
    scored = model.score(anomaly.fill_features(s.reconciliation), "isolation_forest_score")
    return scored.select(
        *ORDER_COLUMNS, F.round("isolation_forest_score", 6).alias("isolation_forest_score")
    )


def _anomaly_totals(s: Stages, forest: bool) -> DataFrame:
    return anomaly.anomaly_totals(s.flags(forest))


def _anomaly_counts(s: Stages, forest: bool) -> DataFrame:
    return anomaly.anomaly_counts(s.flags(forest))


def _both(name: str, fn: Callable[[Stages, bool], DataFrame]) -> None:
    """With all detectors, and (``_amounts``) with the amount rules only, which SQL can check."""
    _named(name, lambda s: fn(s, True))
    _named(f"{name}_amounts", lambda s: fn(s, False))


_both("anom_totals", _anomaly_totals)
_both("anom_status_counts", _anomaly_counts)

# --- SQL packs -----------------------------------------------------------------------------------


def _packed(name: str, forest: bool) -> Callable[[Stages], DataFrame]:
    text = packs.QUERIES[name]
    used = [t for t in ("reconciliation", "exception_register", "anomaly_detection") if t in text]

    def run(s: Stages) -> DataFrame:
        s.publish(used, forest)
        return packs.run_query(s.spark, name)

    return run


for _name, _text in packs.QUERIES.items():
    _named(_name, _packed(_name, True))
    if "anomaly_detection" in _text:
        _named(f"{_name}_amounts", _packed(_name, False))

# --- reporting -----------------------------------------------------------------------------------


def _exception_table(s: Stages, forest: bool) -> DataFrame:
    return bi.exception_table(
        s.exceptions, s.reconciliation, s.flags(forest), s.key_stats("exception_register")
    )


def _transaction_table(s: Stages, forest: bool) -> DataFrame:
    return bi.transaction_table(s.reconciliation, s.flags(forest))


_both("k1_exception_table", _exception_table)
_both("k2_exception_totals", lambda s, f: bi.exception_totals(s.report("exception_table", f)))
_both("k3_transaction_table", _transaction_table)
_named("k3_transaction_totals", lambda s: bi.transaction_totals(s.report("transaction_table", False)))


@query("k4_selected_exceptions")
def _(s: Stages) -> DataFrame:
    return dashboard.select_exceptions(
        s.report("exception_table", False), ["CRITICAL", "HIGH"], ["Payments", "Finance"], ["OPEN"]
    ).select("exception_id", "transaction_id", "severity", "owner", "status", "financial_impact")


@query("k5_kpis")
def _(s: Stages) -> DataFrame:
    chosen = dashboard.select_exceptions(s.report("exception_table", False))
    return dashboard.kpis(s.report("transaction_table", False), chosen)


@query("k6_status_counts")
def _(s: Stages) -> DataFrame:
    return dashboard.value_counts(
        s.report("transaction_table", False), "reconciliation_status", "transactions"
    )


@query("k6_severity_counts")
def _(s: Stages) -> DataFrame:
    return dashboard.value_counts(s.report("exception_table", False), "severity", "exceptions")


_named("k7_by_root_cause", lambda s: dashboard.exposure_per(s.report("exception_table", False), "root_cause"))
_named("k7_by_gateway", lambda s: dashboard.exposure_per(s.report("exception_table", False), "gateway"))
_both(
    "k8_anomaly_counts",
    lambda s, f: dashboard.value_counts(
        s.report("transaction_table", f), "potential_anomaly", "transactions"
    ),
)
_named("k9_register_view", lambda s: dashboard.register_view(s.report("exception_table", False)))
_named("k10_workbook_summary", lambda s: dashboard.workbook_summary(s.exceptions))
_named("k10_workbook_types", lambda s: dashboard.workbook_types(s.exceptions))
_both("k11_measures", lambda s, f: bi.measures(s.report("exception_table", f)))
_both("k11_measures_by_gateway", lambda s, f: bi.measures(s.report("exception_table", f), ["gateway"]))


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES["r1_status_summary"](spark, folder)
