"""Where the exceptions come from: counts and exposure per type, gateway, store, customer, …"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import write_table

# Severities from worst to least.
SEVERITY_ORDER = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]


def severity_rank(c: str = "severity") -> Column:
    """1 for the worst; unknown severities rank last."""
    chain = F
    for rank, name in enumerate(SEVERITY_ORDER, 1):
        chain = chain.when(F.col(c) == name, F.lit(rank))
    return chain.otherwise(F.lit(len(SEVERITY_ORDER) + 1))


def _analyse(
    register: DataFrame,
    keys: list[str],
    count_name: str = "exception_count",
    mean: bool = False,
    required: str | None = None,
) -> DataFrame:
    kept = register if required is None else register.where(F.col(required).isNotNull())
    exposure = F.sum("financial_impact")
    measures = [F.count("exception_id").alias(count_name), exposure.alias("financial_exposure")]
    if mean:
        known = F.count("financial_impact")
        measures.append(
            F.when(known > 0, exposure.cast("double") / known).alias("average_impact")
        )
    return kept.groupBy(*keys).agg(*measures)


def _largest_first(df: DataFrame, *ties: str) -> DataFrame:
    return df.orderBy(F.desc("financial_exposure"), *ties)


def exception_types(register: DataFrame) -> DataFrame:
    key = "reconciliation_status"
    return _largest_first(_analyse(register, [key], mean=True), key)


def gateways(register: DataFrame) -> DataFrame:
    return _largest_first(
        _analyse(register, ["gateway"], "exceptions", True, "gateway"), "gateway"
    )


def stores(register: DataFrame) -> DataFrame:
    return _largest_first(
        _analyse(register, ["store_id"], "exceptions", True, "store_id"), "store_id"
    )


def customers(register: DataFrame) -> DataFrame:
    keys = ["customer_id", "customer_name"]
    return _analyse(register, keys, required="customer_id").orderBy(
        F.desc("exception_count"), F.desc("financial_exposure"), *keys
    )


def severities(register: DataFrame) -> DataFrame:
    return _analyse(register, ["severity"], required="severity").orderBy(
        severity_rank(), "severity"
    )


def root_causes(register: DataFrame) -> DataFrame:
    return _largest_first(
        _analyse(register, ["root_cause"], required="root_cause"), "root_cause"
    )


def owners(register: DataFrame) -> DataFrame:
    return _largest_first(_analyse(register, ["owner"], required="owner"), "owner")


# The seven analyses and the names they are saved under.
ANALYSES = {
    "exception_types": exception_types,
    "gateways": gateways,
    "stores": stores,
    "customers": customers,
    "severity": severities,
    "root_causes": root_causes,
    "owners": owners,
}


def _total() -> Column:
    return F.coalesce(F.sum("financial_impact").cast("double"), F.lit(0.0))


def _percent(register: DataFrame, whole: Column, top: int) -> Column:
    """Share of the ``top`` largest impacts in ``whole``, in percent; 0 without any."""
    largest = register.orderBy(F.desc_nulls_last("financial_impact")).limit(top)
    part = largest.agg(_total().alias("top_exposure")).scalar()
    return F.when(whole != 0, F.round(part / whole * 100, 2)).otherwise(F.lit(0.0))


def concentration(register: DataFrame, top: int = 10) -> DataFrame:
    """Share of the ``top`` largest impacts in the total exposure, in percent; 0 without any."""
    whole = register.agg(_total().alias("whole"))
    return whole.select(
        _percent(register, F.col("whole"), top).alias("concentration_percent")
    )


def insights(register: DataFrame) -> DataFrame:
    """One row: total exposure, share of the top ten, and the largest type, gateway and store.

    All sums come from one pass over grouping sets; the name breaks ties, as in the analyses.
    """
    keys = ["reconciliation_status", "gateway", "store_id"]
    sets = [[F.col(k)] for k in keys]
    sums = register.groupingSets([*sets, []], *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("left_out"), F.sum("financial_impact").alias("exposure")
    )
    everything = 2 ** len(keys) - 1
    best = []
    for i, key in enumerate(keys):
        here = F.col("left_out") == everything - 2 ** (len(keys) - 1 - i)
        if key != "reconciliation_status":
            here &= F.col(key).isNotNull()
        place = F.struct(F.col("exposure").isNull(), -F.col("exposure"), F.col(key))
        row = F.struct(F.col(key).alias("name"), F.col("exposure"))
        best.append(F.min_by(F.when(here, row), F.when(here, place)).alias(key))
    total = F.max(F.when(F.col("left_out") == everything, F.col("exposure")))
    found = sums.agg(F.coalesce(total, F.lit(0)).alias("total_exposure"), *best)
    return found.select(
        "total_exposure",
        _percent(register, F.col("total_exposure").cast("double"), 10).alias(
            "concentration_percent"
        ),
        *[
            c
            for key in keys
            for c in (
                F.col(key)["name"].alias(f"top_{key}"),
                F.col(key)["exposure"].alias(f"top_{key}_exposure"),
            )
        ],
    )


def save_analyses(register: DataFrame, folder: str, fmt: str = "csv") -> dict[str, str]:
    """Write the seven analyses; returns the path of each."""
    return {
        name: write_table(analyse(register), f"{folder}/root_cause_{name}", fmt)
        for name, analyse in ANALYSES.items()
    }
