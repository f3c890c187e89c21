"""The queries that fan out, against the same joins written out in full."""

import random

import pandas as pd
import pytest

from tallywright.plans import packs
from tallywright.sources.tables import publish

def last(v):
    """Sort key that puts missing values last."""
    return (v is None, v or 0)


def first(v):
    return (v is not None, v or "")


def fan_out(left, *sides):
    """Combinations of rows with the same id; a side is (rows, whether it may be missing)."""
    out = [(x,) for x in left]
    for rows, optional in sides:
        grown = []
        for combined in out:
            id = combined[0]["transaction_id"]
            met = [y for y in rows if id is not None and y["transaction_id"] == id]
            grown += [(*combined, y) for y in met or ([{}] if optional else [])]
        out = grown
    return out


def priority_queue(r, a, e):
    urgent = [x for x in a if x["investigation_priority"] in ("HIGH", "MEDIUM")]
    rows = fan_out(urgent, (r, True), (e, True))
    rows.sort(
        key=lambda t: (
            t[0]["investigation_priority"] != "HIGH",
            -(t[2].get("financial_impact") or 0),
            last(t[0]["isolation_forest_score"]),
            first(t[0]["transaction_id"]),
            (t[0]["src_branch"], t[0]["src_row"]),
            first(t[2].get("exception_id")),
            (t[1].get("src_branch", 0), t[1].get("src_row", 0)),
        )
    )
    return rows[:100]


def matched_anomalies(r, a, e):
    flagged = [x for x in a if x["potential_anomaly"]]
    matched = [x for x in r if x["reconciliation_status"] == "MATCHED"]
    rows = fan_out(flagged, (matched, False))
    rows.sort(
        key=lambda t: (
            last(t[0]["isolation_forest_score"]),
            t[0]["transaction_id"],
            (t[0]["src_branch"], t[0]["src_row"]),
            (t[1]["src_branch"], t[1]["src_row"]),
        )
    )
    return rows[:100]


def anomalies_by(key, most):
    def count(r, a, e):
        groups = {}
        for _, x, y in fan_out([x for x in a if x["potential_anomaly"]], (r, False), (e, True)):
            groups.setdefault(x[key], []).append(y.get("financial_impact") or 0)
        rows = [(k, len(v), float(sum(v))) for k, v in groups.items()]
        return sorted(rows, key=lambda t: (-t[1], last(t[0])))[:most]

    return count


PLAIN = {
    "v1_priority_queue": priority_queue,
    "v2_matched_anomalies": matched_anomalies,
    "v3_anomalies_by_gateway": anomalies_by("gateway", None),
    "v4_anomalies_by_store": anomalies_by("store_id", 20),
}


def made_up(seed, rows=150):
    """Three tables in which one id holds a third of the rows, and some ids are missing."""
    rnd = random.Random(seed)

    def id():
        return rnd.choice(["hot", "hot", "hot", None, *[f"t{rnd.randrange(40)}"] * 5])

    r = pd.DataFrame(
        [
            {
                "transaction_id": id(),
                "reconciliation_status": rnd.choice(["MATCHED", "DUPLICATE", "OVERPAYMENT"]),
                "customer_id": f"c{i}",
                "customer_name": f"n{i}",
                "store_id": rnd.choice([None, *"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]),
                "gateway": rnd.choice([None, "G1", "G2"]),
                "erp_amount": float(rnd.randrange(9)),
                "payment_amount": float(i),
                "bank_amount": 1.0,
                "src_branch": rnd.randrange(2),
                "src_row": i,
            }
            for i in range(rows)
        ]
    )
    a = pd.DataFrame(
        [
            {
                "transaction_id": id(),
                "reconciliation_status": rnd.choice(["MATCHED", "DUPLICATE"]),
                "investigation_priority": rnd.choice(["HIGH", "MEDIUM", "NORMAL"]),
                "isolation_forest_score": rnd.choice([None, -0.1, -0.2, 0.3]),
                "entity_match_score": float(rnd.randrange(100)),
                "amount_z_score": 0.5,
                "amount_iqr_anomaly": rnd.random() < 0.5,
                "potential_anomaly": rnd.random() < 0.6,
                "src_branch": 0,
                "src_row": i,
            }
            for i in range(rows)
        ]
    )
    e = pd.DataFrame(
        [
            {
                "exception_id": f"EXC-{i:06d}",
                "transaction_id": id(),
                "severity": "HIGH",
                "financial_impact": rnd.choice([None, 0.0, 10.0, 20.0, float(i)]),
                "owner": "Finance",
                "status": "OPEN",
                "root_cause": "x",
            }
            for i in range(rows)
        ]
    )
    return r, a, e


def plain(rows):
    missing = lambda v: v is None or v != v
    return [tuple(None if missing(v) else v for v in row) for row in rows]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("name", PLAIN)
def test_fan_out(spark, name, seed):
    tables, rows = {}, []
    names = ("reconciliation", "anomaly_detection", "exception_register")
    for table, pdf in zip(names, made_up(seed)):
        clean = pdf.astype(object).where(pdf.notna(), None)
        kinds = {"object": "string", "float64": "double", "int64": "bigint", "bool": "boolean"}
        schema = ", ".join(f"{c} {kinds.get(str(t), 'string')}" for c, t in pdf.dtypes.items())
        tables[table] = spark.createDataFrame(clean.values.tolist(), schema)
        rows.append(clean.to_dict("records"))
    publish(tables, list(names))
    got = packs.run_query(spark, name)
    want = PLAIN[name](*rows)
    if name in ("v1_priority_queue", "v2_matched_anomalies"):
        # a column comes from the first side that has it
        value = lambda t, c: next((x[c] for x in t if c in x), None)
        want = [tuple(value(t, c) for c in got.columns) for t in want]
    assert plain(got.collect()) == plain(want)


def test_a_pack_runs_its_queries_to_the_end(spark):
    text = "SELECT CAST(concat('a', id) AS INT) AS n FROM range(3)"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        packs.run_pack(spark, {"fails_late": text})


def test_every_query_of_both_packs_is_there():
    assert len(packs.RECONCILIATION_PACK) == len(packs.INVESTIGATION_PACK) == 10


def test_a_failing_query_stops_the_pack(spark):
    with pytest.raises(Exception, match="no_such_table"):
        packs.run_pack(spark, {"bad": "SELECT * FROM no_such_table", "never": "SELECT 1"})


def test_publishing_needs_every_table(spark):
    with pytest.raises(FileNotFoundError, match="invoice"):
        publish({"reconciliation": spark.range(1)}, ["reconciliation", "invoice"])
