"""What each registered query should give, as one DuckDB statement over the same files.

Written apart from the operators: row-at-a-time table for the similarity, plain windows for first
rows, duplicates and numbers, joins with all their fan-out, built-in quantiles.
"""

from ..plans.stages import CREATED
from ..schemas import RAW_COLUMNS, RECONCILIATION_COLUMNS, REGISTER_COLUMNS
from ..sources.derived import source_sql

_WS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def _name(c: str) -> str:
    return (
        rf"regexp_replace(regexp_replace(upper({c}), '^{_WS}+|{_WS}+$', '', 'g'), "
        rf"'{_WS}+', ' ', 'g')"
    )


def _email(c: str) -> str:
    return rf"regexp_replace(lower({c}), '^{_WS}+|{_WS}+$', '', 'g')"


def _phone(c: str) -> str:
    return rf"right(regexp_replace({c}, '[^\p{{Nd}}]', '', 'g'), 10)"


def _date(c: str) -> str:
    return f"TRY_CAST({c} AS TIMESTAMP)"


def _money(c: str) -> str:
    return f"TRY_CAST({c} AS DECIMAL(18,2))"


_CLEAN = {
    "customer_master": (["customer_name", "email", "phone"], ["created_date"], []),
    "invoice": ([], ["invoice_date"], ["invoice_amount", "tax", "discount", "net_amount"]),
    "erp_transactions": (["customer_name", "email", "phone"], ["transaction_date"], ["amount"]),
    "payment_gateway": (["customer_name", "email"], ["transaction_date"], ["amount"]),
    "bank_transactions": (
        [],
        ["transaction_date", "value_date"],
        ["credit_amount", "debit_amount"],
    ),
}
_TWINS = {"customer_name": _name, "email": _email, "phone": _phone}


def _clean_cte(table: str) -> str:
    twins, dates, amounts = _CLEAN[table]
    typed = [f"{_date(c)} AS {c}" for c in dates] + [f"{_money(c)} AS {c}" for c in amounts]
    extra = [f"{_TWINS[c](c)} AS {c}_clean" for c in twins]
    columns = ", ".join([f"* REPLACE ({', '.join(typed)})", *extra])
    return f"SELECT {columns} FROM raw_{table}"


# Longest common subsequence by the textbook table: one row of the table per character of a.
_LCS = """list_extract(list_reduce(
        list_transform(string_split({a}, ''), lambda x: [CAST(unicode(x) AS BIGINT)]),
        lambda above, x: list_reduce(
            list_transform(range(1, length({b}) + 1), lambda j: [CAST(j AS BIGINT)]),
            lambda done, j: list_append(done,
                CASE WHEN unicode(substr({b}, CAST(j[1] AS INT), 1)) = x[1] THEN above[j[1]] + 1
                     ELSE greatest(above[j[1] + 1], done[j[1]]) END),
            [CAST(0 AS BIGINT)]),
        list_transform(range(0, length({b}) + 1), lambda z: CAST(0 AS BIGINT))),
    length({b}) + 1)"""


def _ratio(a: str, b: str) -> str:
    return f"""CASE WHEN {a} IS NULL OR {b} IS NULL OR {a} = '' OR {b} = '' THEN 0.0::DOUBLE
        WHEN {a} = {b} THEN 100.0::DOUBLE
        ELSE 200.0::DOUBLE * {_LCS.format(a=a, b=b)} / (length({a}) + length({b})) END"""


_SCORE = f"""round(0.50::DOUBLE * ({_ratio('e.email_clean', 'p.email_clean')})
        + 0.30::DOUBLE * ({_ratio('e.customer_name_clean', 'p.customer_name_clean')})
        + 0.20::DOUBLE * (CASE WHEN e.amount = p.amount THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END),
        2)"""


# The wording per status.
_CAUSE = """CASE reconciliation_status
    WHEN 'PARTIAL_PAYMENT' THEN 'Potential partial payment'
    WHEN 'OVERPAYMENT' THEN 'Potential overpayment'
    WHEN 'AMOUNT_MISMATCH' THEN 'Payment amount differs from ERP amount'
    WHEN 'MISSING_PAYMENT' THEN 'ERP transaction has no payment gateway record'
    WHEN 'UNEXPECTED_PAYMENT' THEN 'Payment exists without corresponding ERP transaction'
    WHEN 'MISSING_BANK_SETTLEMENT' THEN 'Payment received but bank settlement is missing'
    WHEN 'DUPLICATE' THEN 'Duplicate ERP transaction detected'
    WHEN 'DATE_MISMATCH' THEN 'Transaction dates differ across systems'
    WHEN 'ENTITY_UNCERTAIN' THEN 'Customer/entity relationship requires review'
    ELSE 'No exception'
    END"""
_ACTION = """CASE reconciliation_status
    WHEN 'PARTIAL_PAYMENT' THEN 'Review outstanding payment balance'
    WHEN 'OVERPAYMENT' THEN 'Review excess payment and refund requirements'
    WHEN 'AMOUNT_MISMATCH' THEN 'Compare ERP, gateway and settlement records'
    WHEN 'MISSING_PAYMENT' THEN 'Verify payment gateway processing and payment status'
    WHEN 'UNEXPECTED_PAYMENT' THEN 'Investigate payment origin and identify related transaction'
    WHEN 'MISSING_BANK_SETTLEMENT' THEN 'Review bank settlement file and settlement cycle'
    WHEN 'DUPLICATE' THEN 'Verify duplicate posting and reverse erroneous entry if confirmed'
    WHEN 'DATE_MISMATCH' THEN 'Review transaction and settlement dates'
    WHEN 'ENTITY_UNCERTAIN' THEN 'Perform manual entity verification'
    ELSE 'No action required'
    END"""
_OWNER = """CASE reconciliation_status
    WHEN 'AMOUNT_MISMATCH' THEN 'Payments'
    WHEN 'PARTIAL_PAYMENT' THEN 'Payments'
    WHEN 'OVERPAYMENT' THEN 'Payments'
    WHEN 'ENTITY_UNCERTAIN' THEN 'Data Quality'
    WHEN 'DATE_MISMATCH' THEN 'Operations'
    ELSE 'Finance'
    END"""
_PRIORITY = """CASE reconciliation_status WHEN 'MATCHED' THEN 0 WHEN 'DATE_MISMATCH' THEN 1
        WHEN 'PARTIAL_PAYMENT' THEN 2 WHEN 'OVERPAYMENT' THEN 3 WHEN 'MISSING_PAYMENT' THEN 4
        WHEN 'UNEXPECTED_PAYMENT' THEN 5 WHEN 'DUPLICATE' THEN 6 WHEN 'ENTITY_UNCERTAIN' THEN 7
        WHEN 'AMOUNT_MISMATCH' THEN 8 ELSE 9 END"""

_FEATURES = (
    "erp_amount payment_amount bank_amount payment_difference bank_difference "
    "date_difference_days entity_match_score"
).split()

_CTES: dict[str, str] = {}
for _t in RAW_COLUMNS:
    _CTES[f"raw_{_t}"] = source_sql(_t, "duckdb")
    _CTES[_t] = _clean_cte(_t)

_CTES["first_payment"] = """
    SELECT * FROM payment_gateway WHERE merchant_reference IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY merchant_reference ORDER BY src_row) = 1"""
_CTES["first_bank"] = """
    SELECT * FROM bank_transactions WHERE reference_number IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY reference_number ORDER BY src_row) = 1"""
_CTES["pairs"] = f"""
    SELECT e.src_row, e.transaction_id, {_SCORE} AS score,
        {_ratio('e.customer_name_clean', 'p.customer_name_clean')} AS name_score,
        {_ratio('e.email_clean', 'p.email_clean')} AS email_score,
        CASE WHEN e.amount = p.amount THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS amount_score,
        coalesce(e.email_clean = p.email_clean, FALSE) AS email_exact
    FROM erp_transactions e JOIN first_payment p ON e.transaction_id = p.merchant_reference"""
_CTES["entity_matches"] = """
    SELECT e.transaction_id, p.gateway_transaction_id, e.customer_id AS erp_customer_id,
        e.customer_name AS erp_customer_name, p.customer_name AS payment_customer_name,
        coalesce(s.score, 0.0) AS entity_match_score,
        CASE WHEN s.score IS NULL THEN 'NO_MATCH' WHEN s.score >= 95 THEN 'HIGH_CONFIDENCE'
             WHEN s.score >= 80 THEN 'MEDIUM_CONFIDENCE' ELSE 'MANUAL_REVIEW' END
            AS entity_match_confidence,
        e.amount AS erp_amount, p.amount AS payment_amount, e.src_row
    FROM erp_transactions e
    LEFT JOIN first_payment p ON e.transaction_id = p.merchant_reference
    LEFT JOIN pairs s ON e.src_row = s.src_row"""
_CTES["first_match"] = """
    SELECT * FROM entity_matches WHERE transaction_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY src_row) = 1"""
_CTES["ledger"] = """
    SELECT e.transaction_id, e.invoice_id, e.customer_id, e.customer_name, e.store_id,
        e.transaction_date AS erp_transaction_date, e.amount AS erp_amount,
        p.gateway_transaction_id, p.gateway, p.transaction_date AS payment_transaction_date,
        p.amount AS payment_amount, e.amount - p.amount AS payment_difference,
        b.value_date AS bank_transaction_date, b.credit_amount AS bank_amount,
        p.amount - b.credit_amount AS bank_difference,
        CASE WHEN b.reference_number IS NULL THEN 'MISSING_SETTLEMENT' ELSE 'SETTLED' END
            AS bank_status,
        CAST(floor((epoch_us(p.transaction_date) - epoch_us(e.transaction_date))
             / 86400000000.0) AS BIGINT) AS date_difference_days,
        coalesce(m.entity_match_score, 0.0) AS entity_match_score,
        coalesce(m.entity_match_confidence, 'NO_MATCH') AS entity_match_confidence,
        CASE WHEN count(*) OVER (PARTITION BY e.transaction_id) > 1 THEN 'DUPLICATE'
             WHEN p.merchant_reference IS NULL THEN 'MISSING_PAYMENT'
             WHEN m.entity_match_confidence = 'MANUAL_REVIEW' THEN 'ENTITY_UNCERTAIN'
             WHEN p.amount < e.amount THEN 'PARTIAL_PAYMENT'
             WHEN p.amount > e.amount THEN 'OVERPAYMENT'
             WHEN abs(floor((epoch_us(p.transaction_date) - epoch_us(e.transaction_date))
                      / 86400000000.0)) > 1 THEN 'DATE_MISMATCH'
             WHEN p.amount = e.amount AND b.reference_number IS NULL
                  THEN 'MISSING_BANK_SETTLEMENT'
             WHEN p.amount = e.amount THEN 'MATCHED' ELSE 'AMOUNT_MISMATCH' END
            AS reconciliation_status,
        0 AS src_branch, e.src_row
    FROM erp_transactions e
    LEFT JOIN first_payment p ON e.transaction_id = p.merchant_reference
    LEFT JOIN first_bank b ON p.gateway_transaction_id = b.reference_number
    LEFT JOIN first_match m ON e.transaction_id = m.transaction_id"""
_CTES["unexpected"] = """
    SELECT p.merchant_reference AS transaction_id, NULL::VARCHAR AS invoice_id,
        NULL::VARCHAR AS customer_id, p.customer_name, NULL::VARCHAR AS store_id,
        NULL::TIMESTAMP AS erp_transaction_date, NULL::DECIMAL(18,2) AS erp_amount,
        p.gateway_transaction_id, p.gateway, p.transaction_date AS payment_transaction_date,
        p.amount AS payment_amount, NULL::DECIMAL(19,2) AS payment_difference,
        NULL::TIMESTAMP AS bank_transaction_date, NULL::DECIMAL(18,2) AS bank_amount,
        NULL::DECIMAL(19,2) AS bank_difference, 'UNKNOWN' AS bank_status,
        NULL::BIGINT AS date_difference_days, 0.0 AS entity_match_score,
        'NO_MATCH' AS entity_match_confidence, 'UNEXPECTED_PAYMENT' AS reconciliation_status,
        1 AS src_branch, p.src_row
    FROM payment_gateway p
    WHERE NOT EXISTS (SELECT 1 FROM erp_transactions e
                      WHERE e.transaction_id = p.merchant_reference)"""
_CTES["reconciliation"] = "SELECT * FROM ledger UNION ALL SELECT * FROM unexpected"
_CTES["assessed"] = """
    SELECT *, CAST(greatest(coalesce(abs(payment_difference), 0), coalesce(abs(bank_difference), 0))
                   AS DECIMAL(18,2)) AS financial_impact,
        row_number() OVER (ORDER BY src_branch, src_row) AS place
    FROM reconciliation WHERE reconciliation_status <> 'MATCHED'"""
_CTES["exception_register"] = f"""
    SELECT *, CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 7
                            ELSE 14 END::BIGINT AS sla_days
    FROM (SELECT *, printf('EXC-%06d', place) AS exception_id,
            CASE WHEN financial_impact >= 50000 THEN 'CRITICAL'
                 WHEN financial_impact >= 10000 THEN 'HIGH'
                 WHEN reconciliation_status IN ('ENTITY_UNCERTAIN', 'MISSING_PAYMENT',
                      'MISSING_BANK_SETTLEMENT', 'UNEXPECTED_PAYMENT') THEN 'HIGH'
                 WHEN reconciliation_status IN ('AMOUNT_MISMATCH', 'PARTIAL_PAYMENT',
                      'OVERPAYMENT', 'DATE_MISMATCH', 'DUPLICATE') THEN 'MEDIUM'
                 ELSE 'LOW' END AS severity,
            {_CAUSE} AS root_cause, {_ACTION} AS recommended_action, {_OWNER} AS owner,
            'OPEN' AS status, DATE '{CREATED}' AS created_date, 0::BIGINT AS exception_age_days,
            'WITHIN_SLA' AS sla_status, NULL::VARCHAR AS resolution, NULL::DATE AS resolution_date
          FROM assessed)"""
_CTES["filled"] = f"""
    SELECT * REPLACE ({', '.join(f'coalesce({c}, 0) AS {c}' for c in _FEATURES)})
    FROM reconciliation"""
_CTES["spread"] = """
    SELECT avg(CAST(erp_amount AS DOUBLE)) AS mean, stddev_samp(CAST(erp_amount AS DOUBLE)) AS std,
        quantile_cont(CAST(erp_amount AS DOUBLE), 0.25) AS q1,
        quantile_cont(CAST(erp_amount AS DOUBLE), 0.75) AS q3
    FROM filled"""
_CTES["flagged"] = """
    SELECT f.*,
        CASE WHEN std > 0 THEN (CAST(erp_amount AS DOUBLE) - mean) / std ELSE 0.0 END
            AS amount_z_score,
        CAST(erp_amount AS DOUBLE) < q1 - 1.5 * (q3 - q1)
            OR CAST(erp_amount AS DOUBLE) > q3 + 1.5 * (q3 - q1) AS amount_iqr_anomaly
    FROM filled f, spread"""
_CTES["anomaly_detection"] = """
    SELECT *, CASE WHEN anomaly_methods_triggered >= 1 THEN 'POTENTIAL_ANOMALY'
                   ELSE 'NORMAL_RANGE' END AS anomaly_status,
        anomaly_methods_triggered >= 1 AS potential_anomaly,
        reconciliation_status <> 'MATCHED' AS known_exception,
        CASE WHEN anomaly_methods_triggered >= 1 AND reconciliation_status <> 'MATCHED' THEN 'HIGH'
             WHEN anomaly_methods_triggered >= 1 THEN 'MEDIUM'
             WHEN reconciliation_status <> 'MATCHED' THEN 'EXCEPTION_REVIEW'
             ELSE 'NORMAL' END AS investigation_priority
    FROM (SELECT *, abs(amount_z_score) >= 3 AS amount_z_anomaly,
            NULL::BOOLEAN AS isolation_forest_anomaly, NULL::DOUBLE AS isolation_forest_score,
            CAST(abs(amount_z_score) >= 3 AS BIGINT) + CAST(amount_iqr_anomaly AS BIGINT)
                AS anomaly_methods_triggered
          FROM flagged)"""
_CTES["first_row"] = """
    SELECT * FROM reconciliation WHERE transaction_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY src_branch, src_row) = 1"""
_CTES["first_anomaly"] = """
    SELECT * FROM anomaly_detection WHERE transaction_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY src_branch, src_row) = 1"""
_CTES["chosen_row"] = f"""
    SELECT * FROM reconciliation
    QUALIFY row_number() OVER (PARTITION BY transaction_id
        ORDER BY {_PRIORITY} DESC, src_branch DESC, src_row DESC) = 1"""

_FLAGS = (
    "amount_z_score amount_z_anomaly amount_iqr_anomaly isolation_forest_anomaly "
    "isolation_forest_score anomaly_methods_triggered potential_anomaly anomaly_status "
    "known_exception investigation_priority"
).split()
_REGISTER_PART = (
    "exception_id transaction_id severity financial_impact owner status root_cause "
    "recommended_action created_date exception_age_days sla_days sla_status resolution "
    "resolution_date"
).split()
_ROW_PART = (
    "invoice_id customer_id customer_name store_id erp_amount payment_amount payment_difference "
    "bank_amount bank_difference bank_status date_difference_days reconciliation_status "
    "entity_match_score entity_match_confidence gateway"
).split()

_CTES["exception_table"] = f"""
    SELECT {', '.join(f'e.{c}' for c in _REGISTER_PART)}, {', '.join(f'r.{c}' for c in _ROW_PART)},
        {', '.join(f'a.{c}' for c in _FLAGS if c not in ('potential_anomaly', 'known_exception'))},
        coalesce(a.potential_anomaly, FALSE) AS potential_anomaly, TRUE AS known_exception,
        TRUE AS is_exception
    FROM exception_register e
    LEFT JOIN first_row r ON e.transaction_id = r.transaction_id
    LEFT JOIN first_anomaly a ON e.transaction_id = a.transaction_id"""
_CTES["transaction_table"] = f"""
    SELECT {', '.join(f'r.{c}' for c in RECONCILIATION_COLUMNS)},
        {', '.join(f'a.{c} AS {c}_anomaly' for c in RECONCILIATION_COLUMNS[1:])},
        {', '.join(f'a.{c}' for c in _FLAGS)},
        r.reconciliation_status <> 'MATCHED' AS is_exception
    FROM chosen_row r LEFT JOIN first_anomaly a ON r.transaction_id = a.transaction_id"""

_KEPT = {"pairs", "reconciliation", "exception_register", "anomaly_detection"}

_MONEY = set(
    "amount invoice_amount tax discount net_amount credit_amount debit_amount erp_amount "
    "payment_amount payment_difference bank_amount bank_difference financial_impact "
    "financial_exposure transaction_amount payment_impact total_exposure".split()
)
_TIMES = set(
    "created_date invoice_date transaction_date value_date erp_transaction_date "
    "payment_transaction_date bank_transaction_date".split()
)


def _shown(columns: list[str], day_only: tuple[str, ...] = ()) -> str:
    """Output types: money as DOUBLE, dates as text, z-scores to six places."""

    def one(c: str) -> str:
        bare = c.removesuffix("_anomaly") if c.endswith("_anomaly") else c
        if c in day_only or c == "resolution_date":
            return f"strftime({c}, '%Y-%m-%d') AS {c}"
        if c in _MONEY or bare in _MONEY:
            return f"CAST({c} AS DOUBLE) AS {c}"
        if c in _TIMES or bare in _TIMES:
            return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"
        if c == "amount_z_score":
            return f"round({c}, 6) AS {c}"
        if bare in ("date_difference_days", "anomaly_methods_triggered"):
            return f"CAST({c} AS BIGINT) AS {c}"
        if bare == "entity_match_score":
            return f"CAST({c} AS DOUBLE) AS {c}"
        return c

    return ", ".join(one(c) for c in columns)


def _needed(text: str) -> list[str]:
    """The named subqueries a statement uses, directly or through others, in order."""
    import re

    found: set[str] = set()
    queue = [text]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in words & _CTES.keys() - found:
            found.add(name)
            queue.append(_CTES[name])
    return [n for n in _CTES if n in found]


def _statement(body: str) -> str:
    parts = [
        f"{n} AS {'MATERIALIZED ' if n in _KEPT else ''}({_CTES[n]})" for n in _needed(body)
    ]
    return f"WITH {', '.join(parts)}\n{body}"


def _count(table: str) -> str:
    return f"SELECT '{table}' AS table_name, count(*) AS row_count FROM {table}"


def _sum(c: str = "financial_impact") -> str:
    return f"CAST(sum({c}) AS DOUBLE)"


def _grouped(table: str, key: str, columns: str, where: str = "TRUE") -> str:
    return f"SELECT {key}, {columns} FROM {table} WHERE {where} GROUP BY {key}"


def _clean_columns(table: str) -> list[str]:
    return RAW_COLUMNS[table] + [f"{c}_clean" for c in _CLEAN[table][0]]


_FIRST = "abs(coalesce(payment_difference, bank_difference, 0))"
_N = "count(*) AS exception_count"
_EXPOSURE = f"{_sum()} AS financial_exposure"
_MEAN = "CAST(sum(financial_impact) AS DOUBLE) / count(*) AS average_impact"


def _all() -> dict[str, str]:
    q: dict[str, str] = {}
    raw_payment = ", ".join(RAW_COLUMNS["payment_gateway"])
    match_columns = (
        "transaction_id gateway_transaction_id erp_customer_id erp_customer_name "
        "payment_customer_name entity_match_score entity_match_confidence erp_amount "
        "payment_amount"
    ).split()
    register = _shown(REGISTER_COLUMNS, ("created_date",))
    recon = _shown(RECONCILIATION_COLUMNS)

    q["a1_read_raw_csv"] = f"SELECT {raw_payment}, src_row FROM raw_payment_gateway"
    for table, columns in RAW_COLUMNS.items():
        q[f"a1_read_{table}"] = f"SELECT {', '.join(columns)}, src_row FROM raw_{table}"
    bank = ", ".join(RAW_COLUMNS["bank_transactions"])
    q["a1_number_plain_files"] = f"""SELECT {bank}, row_number() OVER (ORDER BY src_row) AS row_no
        FROM raw_bank_transactions"""
    q["b_unparsed"] = " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{c}' AS column_name,
            count(*) FILTER (coalesce(trim({c}), '') <> '' AND {kind(c)} IS NULL) AS lost
            FROM raw_{table}"""
        for table, (_, dates, amounts) in _CLEAN.items()
        for columns, kind in ((dates, _date), (amounts, _money))
        for c in columns
    )
    q["a2_read_staged_matches"] = f"SELECT {_shown(match_columns)} FROM entity_matches"
    q["a3_write_and_read_register"] = f"SELECT {register} FROM exception_register"
    q["a4_published_invoices"] = f"""SELECT customer_type, count(*) AS invoices,
        {_sum('net_amount')} AS net_amount
        FROM invoice i JOIN customer_master c ON i.customer_id = c.customer_id
        GROUP BY customer_type"""
    published = [*RAW_COLUMNS, "entity_matches", "reconciliation", "exception_register"]
    q["a5_table_counts"] = " UNION ALL ".join(map(_count, [*published, "anomaly_detection"]))
    q["a2_reopen_saved"] = q["a5_table_counts"]
    q["a2_reopened_register"] = q["a3_write_and_read_register"]
    q["b11_clean_counts"] = " UNION ALL ".join(map(_count, RAW_COLUMNS))
    for table, short in zip(RAW_COLUMNS, ["customer", "invoice", "erp", "payment", "bank"]):
        q[f"b_clean_{short}"] = f"SELECT {_shown(_clean_columns(table))} FROM {table}"

    q["c1_first_payment"] = f"""SELECT merchant_reference, gateway_transaction_id,
        {_shown(['amount'])}, src_row FROM first_payment"""
    q["c2_first_bank_row"] = f"""SELECT reference_number, bank_transaction_id,
        {_shown(['credit_amount'])}, src_row FROM first_bank"""
    q["c3_first_match"] = f"""SELECT transaction_id, {_shown(['entity_match_score'])},
        entity_match_confidence FROM first_match"""
    q["c4_repeated_ids"] = """SELECT transaction_id, src_row,
        count(*) OVER (PARTITION BY transaction_id) > 1 AS is_repeated FROM erp_transactions"""
    place = "CAST(src_branch AS BIGINT) AS src_branch, src_row"
    few = f"transaction_id, reconciliation_status, {_shown(['erp_amount'])}, {place}"
    q["c5_first_reconciliation_row"] = f"SELECT {few} FROM first_row"
    q["c7_checked_first_rows"] = q["c5_first_reconciliation_row"]
    q["c6_status_priority"] = f"SELECT {few} FROM chosen_row"
    q["c7_unique_lookup"] = "SELECT count(*) AS unique_ids FROM first_row"
    q["c8_distinct_ids"] = (
        "SELECT count(DISTINCT transaction_id) AS distinct_count FROM reconciliation"
    )

    q["d1_erp_with_payment"] = f"""SELECT transaction_id, gateway_transaction_id,
        {_shown(['erp_amount', 'payment_amount'])}, src_row FROM entity_matches"""
    q["d2_payment_with_bank"] = """SELECT p.merchant_reference, p.gateway_transaction_id,
        CAST(p.amount AS DOUBLE) AS payment_amount,
        CAST(b.credit_amount AS DOUBLE) AS bank_amount,
        strftime(b.value_date, '%Y-%m-%d %H:%M:%S') AS bank_date,
        b.reference_number IS NOT NULL AS settled
        FROM first_payment p LEFT JOIN first_bank b
          ON p.gateway_transaction_id = b.reference_number"""
    q["d3_reconciliation_from_matches"] = f"SELECT {recon} FROM reconciliation"
    q["d4_unexpected_payments"] = f"SELECT {recon} FROM unexpected"

    q["e_similarity"] = """SELECT src_row, transaction_id, round(name_score, 6) AS name_score,
        round(email_score, 6) AS email_score, amount_score, email_exact FROM pairs"""
    q["e_match_table"] = q["a2_read_staged_matches"]
    mean = "CAST(sum(CAST(entity_match_score AS DECIMAL(18,2))) AS DOUBLE) / count(*)"
    q["e_match_bands"] = _grouped(
        "entity_matches",
        "entity_match_confidence",
        f"count(*) AS match_count, {mean} AS average_score",
    )
    q["e_mean_score"] = (
        f"SELECT count(*) AS match_count, {mean} AS average_score FROM entity_matches"
    )

    q["f_reconciliation"] = f"SELECT {recon} FROM reconciliation"
    q["f_ledger_reconciliation"] = f"SELECT {recon} FROM ledger"
    status = "reconciliation_status"
    q["f_status_counts"] = _grouped("reconciliation", status, "count(*) AS record_count")
    q["f_status_impact"] = _grouped(
        "reconciliation",
        status,
        "coalesce(CAST(sum(abs(payment_difference)) AS DOUBLE), 0.0) AS payment_impact",
    )

    q["g_register"] = f"SELECT {register} FROM exception_register"
    q["g_register_aged"] = """SELECT exception_id, severity, 4::BIGINT AS exception_age_days,
        sla_days, CASE WHEN sla_days < 4 THEN 'OUTSIDE_SLA' ELSE 'WITHIN_SLA' END AS sla_status
        FROM exception_register"""
    q["g_totals"] = f"""SELECT count(*) AS total_exceptions, {_EXPOSURE}
        FROM exception_register"""
    for short, key in (("severity", "severity"), ("type", status), ("owner", "owner")):
        q[f"g_by_{short}"] = _grouped("exception_register", key, _N)
    q["g_exposure_by_type"] = _grouped("exception_register", status, _EXPOSURE)

    q["h_by_type"] = _grouped("exception_register", status, f"{_N}, {_EXPOSURE}, {_MEAN}")
    for short, key in (("gateway", "gateway"), ("store", "store_id")):
        q[f"h_by_{short}"] = _grouped(
            "exception_register",
            key,
            f"count(*) AS exceptions, {_EXPOSURE}, {_MEAN}",
            f"{key} IS NOT NULL",
        )
    q["h_by_customer"] = _grouped(
        "exception_register",
        "customer_id, customer_name",
        f"{_N}, {_EXPOSURE}",
        "customer_id IS NOT NULL",
    )
    for key in ("severity", "root_cause", "owner"):
        q[f"h_by_{key}"] = _grouped("exception_register", key, f"{_N}, {_EXPOSURE}")
    share = """round(CAST((SELECT sum(financial_impact) FROM (
            SELECT financial_impact FROM exception_register
            ORDER BY financial_impact DESC LIMIT 10)) AS DOUBLE)
        / CAST((SELECT sum(financial_impact) FROM exception_register) AS DOUBLE) * 100, 2)"""
    q["h_concentration"] = f"SELECT {share} AS concentration_percent"

    def best(key: str, what: str) -> str:
        return f"""(SELECT {what} FROM (SELECT {key}, sum(financial_impact) AS s
            FROM exception_register WHERE {key} IS NOT NULL GROUP BY {key}
            ORDER BY s DESC, {key} LIMIT 1))"""

    tops = ", ".join(
        f"{best(k, k)} AS top_{k}, {best(k, 'CAST(s AS DOUBLE)')} AS top_{k}_exposure"
        for k in (status, "gateway", "store_id")
    )
    q["h_insights"] = f"""SELECT {_sum()} AS total_exposure, {share} AS concentration_percent,
        {tops} FROM exception_register"""
    analysed = {
        "exception_types": (status, "TRUE"),
        "gateways": ("gateway", "gateway IS NOT NULL"),
        "stores": ("store_id", "store_id IS NOT NULL"),
        "customers": ("(customer_id, customer_name)", "customer_id IS NOT NULL"),
        "severity": ("severity", "TRUE"),
        "root_causes": ("root_cause", "TRUE"),
        "owners": ("owner", "TRUE"),
    }
    q["h_saved_analyses"] = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(DISTINCT {k}) AS row_count "
        f"FROM exception_register WHERE {w}"
        for n, (k, w) in analysed.items()
    )

    q["anom_features"] = f"SELECT {place}, {_shown(_FEATURES)} FROM filled"
    q["anom_zscore"] = f"""SELECT {place}, round(amount_z_score, 6) AS amount_z_score,
        abs(amount_z_score) >= 3 AS amount_z_anomaly FROM flagged"""
    q["anom_iqr_bounds"] = """SELECT round(q1, 6) AS q1, round(q3, 6) AS q3,
        round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound,
        round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound FROM spread"""
    q["anom_iqr"] = f"SELECT {place}, amount_iqr_anomaly FROM flagged"
    scaled = ", ".join(
        f"""round((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ())
            / (CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) OVER () > 0
                    THEN stddev_pop(CAST({c} AS DOUBLE)) OVER () ELSE 1 END), 6) AS {c}_scaled"""
        for c in _FEATURES
    )
    q["anom_scaled_features"] = f"SELECT {place}, {scaled} FROM filled"
    amount_flags = [c for c in _FLAGS if not c.startswith("isolation_forest")]
    q["anom_flags_amounts"] = (
        f"SELECT {place}, transaction_id, {_shown(amount_flags)} FROM anomaly_detection"
    )
    digits = "CAST('0x' || substr(m, {}, 8) AS BIGINT) % 2147483647"
    q["anom_forest_sample"] = f"""SELECT tree, {place} FROM (
        SELECT *, row_number() OVER (PARTITION BY tree
                                     ORDER BY (a + tree * b) % 2147483647, src_branch, src_row) AS nth
        FROM (SELECT src_branch, src_row, {digits.format(1)} AS a, {digits.format(9)} AS b,
                  {digits.format(17)} AS c, n, unnest(range(0, 200)) AS tree
              FROM (SELECT src_branch, src_row, count(*) OVER () AS n,
                        md5('42|' || src_branch || '|' || src_row) AS m FROM reconciliation))
        WHERE c < ceil(least(1.0::DOUBLE, 65536.0::DOUBLE / n) * 2147483647))
        WHERE nth <= 256"""
    q["anom_forest_rules"] = """SELECT count(*) AS row_count, count(*) AS scores_in_range,
        count(*) AS flags_by_sign, count(*) AS methods_add_up, count(*) AS potential_if_any FROM filled"""
    # the two fixed trees as nested cases; 0.57… is Euler's constant, 256 the sample
    q["anom_forest_decision"] = f"""SELECT {place}, round(0.5::DOUBLE - pow(2.0::DOUBLE, -(
            (CASE WHEN erp_amount <= 100000 THEN 4.5::DOUBLE
                WHEN date_difference_days <= 0 THEN 3.25::DOUBLE ELSE 1.0::DOUBLE END)
            + (CASE WHEN entity_match_score > 95 THEN 6.0::DOUBLE
                WHEN payment_difference <= 0 THEN 2.0::DOUBLE ELSE 2.5::DOUBLE END))
            / (2 * (2 * (ln(255.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 510.0::DOUBLE / 256))), 6)
        AS isolation_forest_score FROM filled"""
    q["anom_totals_amounts"] = """SELECT count(*) FILTER (amount_z_anomaly) AS z_score_anomalies,
        count(*) FILTER (amount_iqr_anomaly) AS iqr_anomalies, 0::BIGINT AS isolation_forest_anomalies,
        count(*) FILTER (potential_anomaly) AS potential_anomalies FROM anomaly_detection"""
    q["anom_status_counts_amounts"] = _grouped(
        "anomaly_detection",
        "anomaly_status, investigation_priority",
        "count(*) AS record_count",
    )

    breaks = "reconciliation_status <> 'MATCHED'"
    first_sum = f"CAST(sum({_FIRST}) AS DOUBLE) AS financial_exposure"
    q["r1_status_summary"] = f"""SELECT {status}, count(*) AS record_count,
        round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM reconciliation), 2)
            AS percentage_of_records
        FROM reconciliation GROUP BY {status}"""
    q["r2_exposure_by_status"] = _grouped(
        "reconciliation",
        status,
        f"""{_N}, CAST(sum(CASE
            WHEN abs(payment_difference) > abs(coalesce(bank_difference, 0))
            THEN abs(payment_difference) WHEN bank_difference IS NOT NULL
            THEN abs(bank_difference) ELSE 0 END) AS DOUBLE) AS financial_exposure""",
        breaks,
    )
    q["r3_high_impact"] = f"""SELECT transaction_id, {status}, customer_id, customer_name,
        store_id, gateway,
        {_shown('erp_amount payment_amount bank_amount payment_difference bank_difference'.split())},
        entity_match_confidence FROM reconciliation WHERE {breaks}
        ORDER BY {_FIRST} DESC, transaction_id NULLS LAST, src_branch, src_row LIMIT 100"""
    q["r4_by_gateway"] = _grouped(
        "reconciliation", f"gateway, {status}", f"{_N}, {first_sum}", breaks
    )
    q["r5_by_store"] = (
        _grouped("reconciliation", "store_id", f"{_N}, {first_sum}", breaks)
        + f" ORDER BY sum({_FIRST}) DESC, store_id NULLS LAST LIMIT 20"
    )
    q["r6_by_customer"] = (
        _grouped("reconciliation", "customer_id, customer_name", f"{_N}, {first_sum}", breaks)
        + f" ORDER BY sum({_FIRST}) DESC, customer_id NULLS LAST, customer_name NULLS LAST LIMIT 20"
    )
    q["r7_date_mismatches"] = f"""SELECT transaction_id, customer_id, customer_name, gateway,
        {_shown(['date_difference_days', 'erp_amount', 'payment_amount'])}, {status}
        FROM reconciliation WHERE {status} = 'DATE_MISMATCH'"""
    q["r8_entity_uncertain"] = f"""SELECT transaction_id, customer_id, customer_name,
        {_shown(['entity_match_score'])}, entity_match_confidence, gateway,
        {_shown(['erp_amount', 'payment_amount'])}
        FROM reconciliation WHERE {status} = 'ENTITY_UNCERTAIN'"""
    q["r9_duplicates"] = _grouped(
        "reconciliation",
        "transaction_id",
        """count(*) AS occurrence_count, min(customer_id) AS customer_id,
        min(customer_name) AS customer_name, min(store_id) AS store_id,
        CAST(min(erp_amount) AS DOUBLE) AS transaction_amount""",
        f"{status} = 'DUPLICATE'",
    )
    q["r10_open_workload"] = _grouped(
        "exception_register", "owner, severity, status", f"{_N}, {_EXPOSURE}"
    )

    impact = "coalesce(e.financial_impact, 0)"
    q["v1_priority_queue_amounts"] = f"""SELECT a.transaction_id, a.reconciliation_status,
        a.investigation_priority, a.isolation_forest_score,
        CAST(a.entity_match_score AS DOUBLE) AS entity_match_score,
        r.customer_id, r.customer_name, r.store_id, r.gateway,
        CAST(r.erp_amount AS DOUBLE) AS erp_amount,
        CAST(r.payment_amount AS DOUBLE) AS payment_amount,
        CAST(r.bank_amount AS DOUBLE) AS bank_amount, e.exception_id, e.severity,
        CAST(e.financial_impact AS DOUBLE) AS financial_impact, e.owner, e.status, e.root_cause
        FROM anomaly_detection a
        LEFT JOIN reconciliation r ON a.transaction_id = r.transaction_id
        LEFT JOIN exception_register e ON a.transaction_id = e.transaction_id
        WHERE a.investigation_priority IN ('HIGH', 'MEDIUM')
        ORDER BY CASE a.investigation_priority WHEN 'HIGH' THEN 1 ELSE 2 END, {impact} DESC,
            a.transaction_id NULLS FIRST, a.src_branch, a.src_row, e.exception_id NULLS FIRST,
            r.src_branch, r.src_row LIMIT 100"""
    q["v2_matched_anomalies_amounts"] = """SELECT a.transaction_id, r.customer_id,
        r.customer_name, r.store_id, r.gateway, CAST(r.erp_amount AS DOUBLE) AS erp_amount,
        round(a.amount_z_score, 6) AS amount_z_score, a.amount_iqr_anomaly,
        a.isolation_forest_score, a.investigation_priority
        FROM anomaly_detection a JOIN reconciliation r ON a.transaction_id = r.transaction_id
        WHERE r.reconciliation_status = 'MATCHED' AND a.potential_anomaly
        ORDER BY a.transaction_id, a.src_branch, a.src_row, r.src_branch, r.src_row LIMIT 100"""
    for name, key, tail in (
        ("v3_anomalies_by_gateway", "gateway", ""),
        (
            "v4_anomalies_by_store",
            "store_id",
            "ORDER BY count(*) DESC, r.store_id NULLS LAST LIMIT 20",
        ),
    ):
        q[f"{name}_amounts"] = f"""SELECT r.{key}, count(*) AS potential_anomalies,
            CAST(sum({impact}) AS DOUBLE) AS related_financial_exposure
            FROM anomaly_detection a JOIN reconciliation r ON a.transaction_id = r.transaction_id
            LEFT JOIN exception_register e ON a.transaction_id = e.transaction_id
            WHERE a.potential_anomaly GROUP BY r.{key} {tail}"""
    q["v5_exposure_by_owner"] = _grouped(
        "exception_register",
        "owner",
        f"""{_N}, CAST(sum(CASE WHEN severity = 'CRITICAL' THEN 1 ELSE 0 END) AS BIGINT)
            AS critical_count, CAST(sum(CASE WHEN severity = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT)
            AS high_count, {_EXPOSURE}""",
    )
    q["v6_severity_sla"] = _grouped(
        "exception_register", "severity, sla_status", f"{_N}, {_EXPOSURE}"
    )
    q["v7_root_causes"] = _grouped("exception_register", "root_cause", f"{_N}, {_EXPOSURE}")
    q["v8_largest_exceptions"] = f"""SELECT exception_id, transaction_id, {status}, severity,
        {_shown(['financial_impact'])}, owner, root_cause, recommended_action
        FROM exception_register WHERE financial_impact > 0
        ORDER BY financial_impact DESC, place LIMIT 100"""
    q["v9_status_workload"] = _grouped("exception_register", "status", f"{_N}, {_EXPOSURE}")
    q["v10_executive_amounts"] = f"""SELECT
        (SELECT count(*) FROM reconciliation WHERE {breaks}) AS total_exceptions,
        (SELECT {_sum()} FROM exception_register) AS total_financial_exposure,
        (SELECT count(*) FROM exception_register WHERE severity = 'CRITICAL')
            AS critical_exceptions,
        (SELECT count(*) FROM exception_register WHERE severity = 'HIGH') AS high_exceptions,
        (SELECT count(*) FROM anomaly_detection WHERE potential_anomaly) AS potential_anomalies,
        (SELECT count(*) FROM anomaly_detection WHERE potential_anomaly
            AND reconciliation_status = 'MATCHED') AS anomalous_matched_transactions"""
    names = (*[n for n in q if n.startswith("r") and n[1].isdigit()],)
    q["a6_reconciliation_pack"] = " UNION ALL ".join(
        f"SELECT '{n}' AS query_name, count(*) AS row_count FROM ({q[n]})" for n in names
    )
    investigation = [n for n in q if n.startswith("v") and n[1].isdigit()]
    q["a6_investigation_pack"] = " UNION ALL ".join(
        f"SELECT '{n.removesuffix('_amounts')}' AS query_name, count(*) AS row_count FROM ({q[n]})"
        for n in investigation
    )

    table_columns = [*_REGISTER_PART, *_ROW_PART, *_FLAGS, "is_exception"]
    q["k1_exception_table_amounts"] = (
        f"SELECT {_shown(table_columns, ('created_date',))} FROM exception_table"
    )
    q["a2_reopened_exception_table"] = q["k1_exception_table_amounts"]
    q["k2_exception_totals_amounts"] = f"""SELECT count(*) AS row_count,
        40::BIGINT AS column_count, count(DISTINCT exception_id) AS unique_exceptions,
        count(DISTINCT transaction_id) AS unique_transactions,
        count(*) FILTER (potential_anomaly) AS potential_anomalies, {_EXPOSURE} FROM exception_table"""
    clashing = [f"{c}_anomaly" for c in RECONCILIATION_COLUMNS[1:]]
    q["k3_transaction_table_amounts"] = f"""SELECT
        {_shown([*RECONCILIATION_COLUMNS, *clashing, *_FLAGS, 'is_exception'])}
        FROM transaction_table"""
    q["k3_transaction_totals"] = """SELECT count(*) AS row_count,
        count(DISTINCT transaction_id) AS unique_transactions FROM transaction_table"""
    q["k4_selected_exceptions"] = f"""SELECT exception_id, transaction_id, severity, owner, status,
        {_shown(['financial_impact'])} FROM exception_table
        WHERE severity IN ('CRITICAL', 'HIGH') AND owner IN ('Payments', 'Finance')
          AND status = 'OPEN'"""
    q["k5_kpis"] = f"""SELECT
        (SELECT count(DISTINCT transaction_id) FROM transaction_table) AS transactions,
        count(DISTINCT exception_id) AS exceptions, {_EXPOSURE},
        round(count(DISTINCT exception_id)
              / (SELECT count(DISTINCT transaction_id) FROM transaction_table) * 100.0::DOUBLE, 2)
            AS exception_rate FROM exception_table"""
    q["k6_status_counts"] = _grouped("transaction_table", status, "count(*) AS transactions")
    q["k6_severity_counts"] = _grouped("exception_table", "severity", "count(*) AS exceptions")
    q["k7_by_root_cause"] = _grouped(
        "exception_table", "root_cause", f"{_sum()} AS financial_impact"
    )
    q["k7_by_gateway"] = _grouped(
        "exception_table", "gateway", f"{_sum()} AS financial_impact", "gateway IS NOT NULL"
    )
    q["k8_anomaly_counts_amounts"] = _grouped(
        "transaction_table",
        "potential_anomaly",
        "count(*) AS transactions",
        "potential_anomaly IS NOT NULL",
    )
    q["k9_register_view"] = f"""SELECT exception_id, transaction_id, severity,
        {_shown(['financial_impact'])}, owner, status, root_cause, recommended_action,
        exception_age_days, sla_status FROM exception_table"""
    q["k10_workbook_summary"] = f"""SELECT count(*) AS total_exceptions, {_EXPOSURE},
        count(*) FILTER (severity = 'CRITICAL') AS critical_exceptions,
        count(*) FILTER (severity = 'HIGH') AS high_exceptions,
        count(*) FILTER (severity = 'MEDIUM') AS medium_exceptions FROM exception_register"""
    q["k10_workbook_types"] = _grouped("exception_register", status, f"{_N}, {_EXPOSURE}")

    def many(column: str, names: str) -> list[str]:
        pairs = [n.split("=") for n in names.split()]
        return [f"count(*) FILTER ({column} = '{v.replace('+', ' ')}') AS {n}" for n, v in pairs]

    def spent(where: str = "TRUE") -> str:
        return f"coalesce(CAST(sum(financial_impact) FILTER ({where}) AS DOUBLE), 0.0)"

    measured = [
        "count(*) AS total_exceptions",
        f"{spent()} AS total_financial_exposure",
        f"{spent()} AS gateway_exposure",
        "CAST(sum(financial_impact) AS DOUBLE) / count(*) AS average_exception_impact",
        *many(
            "severity",
            "critical_exceptions=CRITICAL high_exceptions=HIGH medium_exceptions=MEDIUM",
        ),
        *[
            f"{spent(f'''severity = '{s}' ''')} AS {s.lower()}_exposure"
            for s in ("CRITICAL", "HIGH", "MEDIUM")
        ],
        *many(
            status,
            "matched_exceptions=MATCHED partial_payments=PARTIAL_PAYMENT overpayments=OVERPAYMENT "
            "duplicate_transactions=DUPLICATE missing_payments=MISSING_PAYMENT "
            "unexpected_payments=UNEXPECTED_PAYMENT date_mismatches=DATE_MISMATCH "
            "entity_uncertain=ENTITY_UNCERTAIN",
        ),
        *many(
            "status",
            "open_exceptions=OPEN assigned_exceptions=ASSIGNED "
            "investigating_exceptions=INVESTIGATING escalated_exceptions=ESCALATED "
            "resolved_exceptions=RESOLVED closed_exceptions=CLOSED "
            "false_positives=FALSE+POSITIVE",
        ),
        *many("sla_status", "within_sla=WITHIN_SLA"),
        *many("investigation_priority", "high_priority_investigations=HIGH"),
        "count(*) FILTER (sla_status IS DISTINCT FROM 'WITHIN_SLA') AS outside_sla",
        "count(*) FILTER (potential_anomaly) AS potential_anomalies",
        "count(*) FILTER (isolation_forest_anomaly) AS isolation_forest_anomalies",
        "count(*) FILTER (amount_z_anomaly) AS z_score_anomalies",
        "count(*) FILTER (amount_iqr_anomaly) AS iqr_anomalies",
        f"""count(*) FILTER (potential_anomaly AND {status} = 'MATCHED')
            AS matched_statistical_anomalies""",
        """CAST(sum(CAST(entity_match_score AS DECIMAL(18,2))) AS DOUBLE)
            / count(entity_match_score) AS average_entity_match_score""",
        "avg(date_difference_days) AS average_date_difference",
        "avg(exception_age_days) AS average_exception_age",
    ]
    q["k11_measures_amounts"] = f"SELECT {', '.join(measured)} FROM exception_table"
    q["k11_measures_by_gateway_amounts"] = _grouped(
        "exception_table", "gateway", ", ".join(measured)
    )
    return {name: _statement(body) for name, body in q.items()}


ORACLES = _all()
