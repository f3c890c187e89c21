"""The two investigation packs as named SQL over the published tables.

Every ORDER BY is a total order, so a LIMIT always keeps the same rows. Joins that fan out on a
repeated transaction id keep their bag semantics, but never build the pairs of a group: counts and
sums are multiplied per id (``PER_ID``), and top-k lists take at most k rows per id and side.
"""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_FIRST = "abs(coalesce(payment_difference, bank_difference, 0))"
_BREAKS = "FROM reconciliation WHERE reconciliation_status <> 'MATCHED'"
_RANK = "CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END"

RECONCILIATION_PACK = {
    "r1_status_summary": """
        SELECT reconciliation_status, record_count,
               round(100.0D * record_count / sum(record_count) OVER (), 2) AS percentage_of_records
        FROM (SELECT reconciliation_status, count(*) AS record_count
              FROM reconciliation GROUP BY reconciliation_status)
        ORDER BY record_count DESC, reconciliation_status""",
    "r2_exposure_by_status": f"""
        SELECT reconciliation_status, count(*) AS exception_count,
               sum(greatest(abs(coalesce(payment_difference, 0)),
                            abs(coalesce(bank_difference, 0)))) AS financial_exposure
        {_BREAKS}
        GROUP BY reconciliation_status
        ORDER BY financial_exposure DESC, reconciliation_status""",
    "r3_high_impact": f"""
        SELECT transaction_id, reconciliation_status, customer_id, customer_name, store_id, gateway,
               erp_amount, payment_amount, bank_amount, payment_difference, bank_difference,
               entity_match_confidence
        {_BREAKS}
        ORDER BY {_FIRST} DESC, transaction_id NULLS LAST, src_branch, src_row
        LIMIT 100""",
    "r4_by_gateway": f"""
        SELECT gateway, reconciliation_status, count(*) AS exception_count,
               sum({_FIRST}) AS financial_exposure
        {_BREAKS}
        GROUP BY gateway, reconciliation_status
        ORDER BY financial_exposure DESC, gateway NULLS LAST, reconciliation_status""",
    "r5_by_store": f"""
        SELECT store_id, count(*) AS exception_count, sum({_FIRST}) AS financial_exposure
        {_BREAKS}
        GROUP BY store_id
        ORDER BY financial_exposure DESC, store_id NULLS LAST
        LIMIT 20""",
    "r6_by_customer": f"""
        SELECT customer_id, customer_name, count(*) AS exception_count,
               sum({_FIRST}) AS financial_exposure
        {_BREAKS}
        GROUP BY customer_id, customer_name
        ORDER BY financial_exposure DESC, customer_id NULLS LAST, customer_name NULLS LAST
        LIMIT 20""",
    "r7_date_mismatches": """
        SELECT transaction_id, customer_id, customer_name, gateway, date_difference_days,
               erp_amount, payment_amount, reconciliation_status
        FROM reconciliation
        WHERE reconciliation_status = 'DATE_MISMATCH'
        ORDER BY abs(date_difference_days) DESC, transaction_id, src_branch, src_row""",
    "r8_entity_uncertain": """
        SELECT transaction_id, customer_id, customer_name, entity_match_score,
               entity_match_confidence, gateway, erp_amount, payment_amount
        FROM reconciliation
        WHERE reconciliation_status = 'ENTITY_UNCERTAIN'
        ORDER BY entity_match_score, transaction_id, src_branch, src_row""",
    "r9_duplicates": """
        SELECT transaction_id, count(*) AS occurrence_count, min(customer_id) AS customer_id,
               min(customer_name) AS customer_name, min(store_id) AS store_id,
               min(erp_amount) AS transaction_amount
        FROM reconciliation
        WHERE reconciliation_status = 'DUPLICATE'
        GROUP BY transaction_id
        ORDER BY occurrence_count DESC, transaction_amount DESC NULLS LAST, transaction_id""",
    "r10_open_workload": f"""
        SELECT owner, severity, status, count(*) AS exception_count,
               sum(financial_impact) AS financial_exposure
        FROM exception_register
        GROUP BY owner, severity, status
        ORDER BY {_RANK}, financial_exposure DESC, owner, severity, status""",
}

# Anomalous rows, reconciliation rows and exceptions per transaction id. A transaction with a, r and
# e of them stands for a * r * greatest(e, 1) joined rows.
PER_ID = """
        flagged AS (
            SELECT transaction_id, CAST(count(*) AS DECIMAL(20,0)) AS a
            FROM anomaly_detection WHERE potential_anomaly GROUP BY transaction_id),
        booked AS (
            SELECT transaction_id, {key}, CAST(count(*) AS DECIMAL(20,0)) AS r
            FROM reconciliation GROUP BY transaction_id, {key}),
        raised AS (
            SELECT transaction_id, CAST(count(*) AS DECIMAL(20,0)) AS e,
                   sum(coalesce(financial_impact, 0)) AS impact
            FROM exception_register GROUP BY transaction_id)"""


def _anomalies_by(key: str, tail: str = "") -> str:
    return f"""
        WITH {PER_ID.format(key=key)}
        SELECT {key}, CAST(sum(a * r * coalesce(e, 1)) AS BIGINT) AS potential_anomalies,
               sum(a * r * coalesce(impact, 0)) AS related_financial_exposure
        FROM flagged
        JOIN booked USING (transaction_id)
        LEFT JOIN raised USING (transaction_id)
        GROUP BY {key}
        ORDER BY potential_anomalies DESC, {key} NULLS LAST {tail}"""


INVESTIGATION_PACK = {
    # One joined row has at least as many rows before it as there are combinations of smaller
    # places, so rows whose places multiply to more than 100 cannot be among the first 100. The r
    # side only breaks ties, so the first 100 (a, e) pairs hold all that can be shown.
    "v1_priority_queue": """
        WITH a AS (
            SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY transaction_id
                          ORDER BY urgency, isolation_forest_score NULLS LAST, src_branch, src_row)
                          AS place
                FROM (SELECT transaction_id, reconciliation_status, investigation_priority,
                             isolation_forest_score, entity_match_score, src_branch, src_row,
                             if(investigation_priority = 'HIGH', 1, 2) AS urgency
                      FROM anomaly_detection
                      WHERE investigation_priority IN ('HIGH', 'MEDIUM')))
            WHERE place <= 100),
        e AS (
            SELECT * FROM (
                SELECT transaction_id AS e_id, exception_id, severity, financial_impact, owner,
                       status, root_cause,
                       row_number() OVER (PARTITION BY transaction_id
                           ORDER BY coalesce(financial_impact, 0) DESC, exception_id) AS e_place
                FROM exception_register)
            WHERE e_place <= 100),
        pairs AS (
            SELECT * FROM a LEFT JOIN e ON transaction_id = e_id AND place * e_place <= 100
            ORDER BY urgency, coalesce(financial_impact, 0) DESC,
                     isolation_forest_score NULLS LAST, transaction_id, src_branch, src_row,
                     exception_id
            LIMIT 100),
        r AS (
            SELECT * FROM (
                SELECT /*+ BROADCAST(ids) */ b.transaction_id AS r_id, customer_id, customer_name,
                       store_id, gateway, erp_amount, payment_amount, bank_amount,
                       src_branch AS r_branch, src_row AS r_row,
                       row_number() OVER (PARTITION BY b.transaction_id
                                          ORDER BY src_branch, src_row) AS r_place
                FROM reconciliation b
                JOIN (SELECT DISTINCT transaction_id FROM pairs) ids
                  ON b.transaction_id = ids.transaction_id)
            WHERE r_place <= 100)
        SELECT transaction_id, reconciliation_status, investigation_priority,
               isolation_forest_score, entity_match_score, customer_id, customer_name, store_id,
               gateway, erp_amount, payment_amount, bank_amount, exception_id, severity,
               financial_impact, owner, status, root_cause
        FROM pairs LEFT JOIN r ON transaction_id = r_id
        ORDER BY urgency, coalesce(financial_impact, 0) DESC, isolation_forest_score NULLS LAST,
                 transaction_id, src_branch, src_row, exception_id, r_branch, r_row
        LIMIT 100""",
    "v2_matched_anomalies": """
        WITH a AS (
            SELECT * FROM (
                SELECT transaction_id, amount_z_score, amount_iqr_anomaly, isolation_forest_score,
                       investigation_priority, src_branch, src_row,
                       row_number() OVER (PARTITION BY transaction_id
                           ORDER BY isolation_forest_score NULLS LAST, src_branch, src_row)
                           AS place
                FROM anomaly_detection
                WHERE potential_anomaly AND transaction_id IS NOT NULL)
            WHERE place <= 100),
        r AS (
            SELECT * FROM (
                SELECT transaction_id AS r_id, customer_id, customer_name, store_id, gateway,
                       erp_amount, src_branch AS r_branch, src_row AS r_row,
                       row_number() OVER (PARTITION BY transaction_id
                                          ORDER BY src_branch, src_row) AS r_place
                FROM reconciliation
                WHERE reconciliation_status = 'MATCHED' AND transaction_id IS NOT NULL)
            WHERE r_place <= 100)
        SELECT transaction_id, customer_id, customer_name, store_id, gateway, erp_amount,
               amount_z_score, amount_iqr_anomaly, isolation_forest_score, investigation_priority
        FROM a JOIN r ON transaction_id = r_id AND place * r_place <= 100
        ORDER BY isolation_forest_score NULLS LAST, transaction_id, src_branch, src_row,
                 r_branch, r_row
        LIMIT 100""",
    "v3_anomalies_by_gateway": _anomalies_by("gateway"),
    "v4_anomalies_by_store": _anomalies_by("store_id", "LIMIT 20"),
    "v5_exposure_by_owner": """
        SELECT owner, count(*) AS exception_count,
               count_if(severity = 'CRITICAL') AS critical_count,
               count_if(severity = 'HIGH') AS high_count,
               sum(financial_impact) AS financial_exposure
        FROM exception_register
        GROUP BY owner
        ORDER BY financial_exposure DESC, owner""",
    "v6_severity_sla": f"""
        SELECT severity, sla_status, count(*) AS exception_count,
               sum(financial_impact) AS financial_exposure
        FROM exception_register
        GROUP BY severity, sla_status
        ORDER BY {_RANK}, severity, sla_status""",
    "v7_root_causes": """
        SELECT root_cause, count(*) AS exception_count, sum(financial_impact) AS financial_exposure
        FROM exception_register
        GROUP BY root_cause
        ORDER BY financial_exposure DESC, root_cause""",
    "v8_largest_exceptions": """
        SELECT exception_id, transaction_id, reconciliation_status, severity, financial_impact,
               owner, root_cause, recommended_action
        FROM exception_register
        WHERE financial_impact > 0
        ORDER BY financial_impact DESC, src_branch, src_row
        LIMIT 100""",
    "v9_status_workload": """
        SELECT status, count(*) AS exception_count, sum(financial_impact) AS financial_exposure
        FROM exception_register
        GROUP BY status
        ORDER BY exception_count DESC, status NULLS LAST""",
    "v10_executive": """
        SELECT (SELECT count_if(reconciliation_status <> 'MATCHED') FROM reconciliation)
                   AS total_exceptions,
               (SELECT sum(financial_impact) FROM exception_register) AS total_financial_exposure,
               (SELECT count_if(severity = 'CRITICAL') FROM exception_register)
                   AS critical_exceptions,
               (SELECT count_if(severity = 'HIGH') FROM exception_register) AS high_exceptions,
               (SELECT count_if(potential_anomaly) FROM anomaly_detection) AS potential_anomalies,
               (SELECT count_if(potential_anomaly AND reconciliation_status = 'MATCHED')
                FROM anomaly_detection) AS anomalous_matched_transactions""",
}

PACKS = {"reconciliation": RECONCILIATION_PACK, "investigation": INVESTIGATION_PACK}
QUERIES = RECONCILIATION_PACK | INVESTIGATION_PACK


def run_query(spark: SparkSession, name: str) -> DataFrame:
    """One named query over the published tables."""
    return spark.sql(QUERIES[name])


def run_pack(spark: SparkSession, pack: dict[str, str]) -> DataFrame:
    """Run all queries of a pack in order and report the rows of each; the first failure raises."""
    rows = []
    for name, text in pack.items():
        # the whole result is made; a mere count would leave sorts and output expressions out
        seen = Observation()
        df = spark.sql(text).observe(seen, F.count(F.lit(1)).alias("n"))
        df.write.format("noop").mode("overwrite").save()
        rows.append((name, seen.get["n"]))
    return spark.createDataFrame(rows, "query_name string, row_count bigint")
