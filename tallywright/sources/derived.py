"""The five raw sources, derived from an orders and a customer table.

Faults are placed by the order key, so every rule of matching and reconciling has rows. One SQL
text serves Spark and DuckDB; only the words in ``DIALECTS`` differ.
"""

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RAW_COLUMNS

# First and second words of the names.
FIRST = "Asha Bruno Chen Dalia Emeka Farid Greta Hiro Ines Jonas Kofi Lena Mateo Nadia Omar"
SECOND = (
    "Abara Bianchi Costa Dvorak Evans Fujita Garcia Haddad Ivanov Jansen Keller Lopez Moreau Novak"
)

# Extra copies sort behind all first copies, whatever the size of the order key.
COPY = 10_000_000_000_000

DIALECTS = {
    "spark": {
        "text": "STRING",
        "copies": "explode(filter(array({0}), x -> x IS NOT NULL))",
        "pick": "element_at(array({0}), CAST({1} AS INT))",
    },
    "duckdb": {
        "text": "VARCHAR",
        "copies": "unnest(list_filter([{0}], lambda x: x IS NOT NULL))",
        "pick": "list_extract([{0}], {1})",
    },
}


def _pad(value: str, width: int, text: str) -> str:
    digits = f"CAST({value} AS {text})"
    return f"lpad({digits}, CAST(greatest({width}, length({digits})) AS INT), '0')"


def source_sql(table: str, dialect: str, orders: str = "orders", customer: str = "customer") -> str:
    """SELECT statement of one raw source (text columns and ``src_row``)."""
    text = DIALECTS[dialect]["text"]
    copies = DIALECTS[dialect]["copies"].format
    money = "CAST({} AS DECIMAL(18,2))".format

    def word(words: str, place: str) -> str:
        listed = ", ".join(f"'{w}'" for w in words.split())
        return DIALECTS[dialect]["pick"].format(listed, place)

    def person(key: str) -> str:
        name = f"concat({word(FIRST, f'{key} % 15 + 1')}, ' ', {word(SECOND, f'{key} % 14 + 1')})"
        return f"""concat('CUST', {_pad(key, 6, text)}) AS customer_id,
            {name} AS customer_name,
            concat(replace(lower({name}), ' ', '.'), CAST({key} % 997 AS {text}), '@example.com')
                AS email,
            concat('+91 (9', {_pad(key, 9, text)}, ') -') AS phone"""

    base = f"""
        SELECT o_orderkey AS k,
            {person("o_custkey")},
            concat('TX', {_pad("o_orderkey", 7, text)}) AS tx,
            concat('PG', {_pad("o_orderkey", 8, text)}) AS pg,
            concat('INV', {_pad("o_orderkey", 7, text)}) AS inv,
            o_orderdate AS d,
            {money(f'''{money("o_totalprice")} *
                CASE WHEN o_orderkey % 1000 = 777 THEN 10 ELSE 1 END''')} AS amt
        FROM {orders}"""

    if table == "customer_master":
        return f"""
        SELECT {person("c_custkey")},
            concat(CAST(c_custkey % 300 + 1 AS {text}), ' Market Road') AS address,
            concat('City ', CAST(c_nationkey AS {text})) AS city,
            concat('State ', CAST(c_nationkey % 5 AS {text})) AS state,
            CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Individual' ELSE 'Business' END
                AS customer_type,
            CASE WHEN c_custkey % 250 = 249 THEN 'not-a-date'
                 ELSE concat('2026-0', CAST(c_custkey % 8 + 1 AS {text}), '-',
                             {_pad("c_custkey % 28 + 1", 2, text)}) END AS created_date,
            c_custkey AS src_row
        FROM {customer}"""

    if table == "invoice":
        tax, discount = money("amt * 0.18"), money("amt * 0.05")
        return f"""
        SELECT inv AS invoice_id, customer_id, CAST(d AS {text}) AS invoice_date,
            CAST(amt - {tax} + {discount} AS {text}) AS invoice_amount,
            CAST({tax} AS {text}) AS tax,
            CASE WHEN k % 700 = 699 THEN 'n/a' ELSE CAST({discount} AS {text}) END AS discount,
            CAST(amt AS {text}) AS net_amount,
            k AS src_row
        FROM ({base}) b"""

    if table == "erp_transactions":
        twice = "CASE WHEN k % 100 = 7 OR k % 1000 IN (13, 21) THEN 1 END"
        return f"""
        SELECT tx AS transaction_id, inv AS invoice_id, customer_id, customer_name, email, phone,
            CAST(d AS {text}) AS transaction_date, CAST(amt AS {text}) AS amount,
            'INR' AS currency,
            CASE WHEN k % 20 = 19 THEN 'PENDING' ELSE 'PAID' END AS payment_status,
            concat('STORE', {_pad("k % 250 + 1", 3, text)}) AS store_id,
            k + copy_no * {COPY} AS src_row
        FROM (SELECT *, {copies(f"0, {twice}")} AS copy_no FROM ({base}) b) c"""

    if table == "payment_gateway":
        # copy 0: the payment; 1: unexpected; 2: second use of the reference; 3: no reference
        kinds = """CASE WHEN k % 100 <> 13 THEN 0 END, CASE WHEN k % 200 = 0 THEN 1 END,
                   CASE WHEN k % 400 = 11 THEN 2 END, CASE WHEN k % 1500 = 1 THEN 3 END"""
        return f"""
        SELECT CASE copy_no WHEN 0 THEN pg WHEN 1 THEN concat('PG_UNEXPECTED_', pg)
                    WHEN 2 THEN concat(pg, 'X') ELSE concat('PG_NOREF_', pg) END
                AS gateway_transaction_id,
            CASE WHEN copy_no IN (0, 2) THEN tx
                 WHEN copy_no = 1 THEN concat('UNKNOWN_TX_', CAST(k AS {text})) END
                AS merchant_reference,
            CASE WHEN copy_no = 1 THEN 'Unknown Payer'
                 WHEN copy_no > 0 THEN customer_name
                 WHEN k % 40 = 13 THEN concat(split_part(customer_name, ' ', 2), ' ',
                                              split_part(customer_name, ' ', 1))
                 WHEN k % 40 = 10 THEN upper(customer_name)
                 WHEN k % 40 = 11 THEN replace(customer_name, ' ', '  ')
                 ELSE customer_name END AS customer_name,
            CASE WHEN copy_no = 1 THEN 'unknown@example.com'
                 WHEN copy_no > 0 THEN email
                 WHEN k % 60 = 14 THEN upper(email)
                 WHEN k % 60 = 15 THEN concat('  ', email, ' ')
                 WHEN k % 60 = 16 THEN replace(email, '@example.com', '@mail.example.com')
                 ELSE email END AS email,
            CASE WHEN copy_no > 0 THEN CAST(d AS {text})
                 WHEN k % 500 = 98 THEN 'not-a-date'
                 WHEN k % 100 = 5 THEN CAST(d + INTERVAL '2' DAY AS {text})
                 WHEN k % 100 = 6 THEN CAST(d - INTERVAL '1' DAY AS {text})
                 WHEN k % 100 = 8 THEN CAST(d - INTERVAL '2' DAY AS {text})
                 ELSE CAST(d AS {text}) END AS transaction_date,
            CASE WHEN copy_no = 2 THEN '1.00'
                 WHEN copy_no = 3 THEN '2.00'
                 WHEN copy_no = 1 THEN CAST(amt AS {text})
                 WHEN k % 500 = 99 THEN 'N/A'
                 WHEN k % 50 = 3 THEN CAST({money("amt * 0.60")} AS {text})
                 WHEN k % 100 = 21 THEN CAST({money("amt * 1.20")} AS {text})
                 ELSE CAST(amt AS {text}) END AS amount,
            CASE WHEN k % 50 = 49 THEN 'FAILED' ELSE 'SUCCESS' END AS payment_status,
            concat('Gateway_', substr('ABC', CAST(k % 3 + 1 AS INT), 1)) AS gateway,
            k + copy_no * {COPY} AS src_row
        FROM (SELECT *, {copies(kinds)} AS copy_no FROM ({base}) b) c"""

    # bank_transactions
    rows = "CASE WHEN k % 100 <> 31 THEN 0 END, CASE WHEN k % 300 = 17 THEN 1 END"
    paid = f"""CASE WHEN k % 50 = 3 THEN {money("amt * 0.60")}
                    WHEN k % 100 = 21 THEN {money("amt * 1.20")} ELSE amt END"""
    return f"""
        SELECT concat('BNK', substr(pg, 3), CASE WHEN copy_no = 1 THEN 'R' ELSE '' END)
                AS bank_transaction_id,
            CAST(d AS {text}) AS transaction_date,
            CAST(d + INTERVAL '1' DAY AS {text}) AS value_date,
            concat(customer_name, ' ', pg) AS narration,
            CASE WHEN copy_no = 1 THEN '1.00'
                 WHEN k % 100 = 41 OR k % 500 = 5 THEN CAST({money(f"({paid}) * 0.90")} AS {text})
                 ELSE CAST({money(paid)} AS {text}) END AS credit_amount,
            '0.0' AS debit_amount,
            pg AS reference_number,
            k + copy_no * {COPY} AS src_row
        FROM (SELECT *, {copies(rows)} AS copy_no FROM ({base}) b) c"""


def spread_small(df: DataFrame) -> DataFrame:
    """Deal a scan of no more splits than cores over all cores; larger scans stay as they are.

    A small file is often a single row group, which one task would read whatever the splits are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() > cores else df.repartition(cores)


def derive_sources(orders: DataFrame, customer: DataFrame) -> dict[str, DataFrame]:
    """The five raw sources as DataFrames."""
    spark: SparkSession = orders.sparkSession
    orders = spread_small(
        orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    )
    return {
        table: spark.sql(
            source_sql(table, "spark", "{orders}", "{customer}"), orders=orders, customer=customer
        )
        for table in RAW_COLUMNS
    }
