"""Staging tables derived from the shared test tables.

Each is a SQL text over ``{table}`` placeholders in the dialect subset that Spark
and DuckDB share, so the checks start both engines from the same staged rows.
All business columns are strings, as a delimited file would deliver them.

Dimensions are staged in two waves, a month apart. The first lacks one group of
keys, the second lacks another and changes, blanks or fills some attributes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from starloom.spec import LoadStamp

SOURCE = "TPCH"
STAMPS = {1: LoadStamp(dt.datetime(2024, 1, 15, 6, 0, 0)), 2: LoadStamp(dt.datetime(2024, 2, 15, 6, 0, 0))}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(spark: SparkSession, sf_dir: str, name: str, wave: int = 1) -> DataFrame:
    text = STAGING[name](wave)
    used = {t: read(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def duckdb_text(name: str, wave: int = 1) -> str:
    return STAGING[name](wave).format(**{t: t for t in TABLES})


def money(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(18,4)) AS STRING)"


def day(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS STRING)"


def _present(wave: int) -> str:
    return "r_name <> 'ASIA'" if wave == 1 else "r_name <> 'EUROPE'"


def _region(wave: int) -> str:
    return "r_name" if wave == 1 else "CASE WHEN r_name = 'AMERICA' THEN 'AMERICAS' ELSE r_name END"


def _phone(wave: int, key: str, balance: str) -> str:
    blank = f"{balance} < 0" if wave == 1 else f"{balance} > 9000"
    return f"CASE WHEN {blank} THEN CAST(NULL AS STRING) ELSE '555-' || CAST({key} AS STRING) END"


def _segment(wave: int) -> str:
    if wave == 1:
        return "c_mktsegment"
    return "CASE WHEN c_acctbal BETWEEN 5000 AND 6000 THEN 'PRIORITY' ELSE c_mktsegment END"


_CUSTOMERS = "{customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"
_LINES = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey"


def _source_system(wave: int) -> str:
    description = "'feed of ' || event_type" if wave == 1 else (
        "CASE WHEN event_type = 'click' THEN 'clicks, renamed' WHEN event_type = 'view' THEN CAST(NULL AS STRING) "
        "ELSE 'feed of ' || event_type END"
    )
    gone = "signup" if wave == 1 else "error"
    return f"""
        SELECT upper(event_type) AS source_system_code, event_type AS source_system_name,
               {description} AS description
        FROM {{events}} WHERE event_type <> '{gone}'"""


def _currency(wave: int) -> str:
    symbol = "CASE WHEN r_name = 'EUROPE' THEN CAST(NULL AS STRING) ELSE substr(r_name, 1, 1) END"
    name = "CASE WHEN r_name = 'AMERICA' THEN 'AMERICAN UNIT' ELSE r_name END"
    return f"""
        SELECT '{SOURCE}' AS source_system, substr(r_name, 1, 3) AS currency_code,
               {"r_name" if wave == 1 else name} AS currency_name,
               {symbol if wave == 1 else "substr(r_name, 1, 1)"} AS symbol
        FROM {_CUSTOMERS} WHERE r_name <> '{"AFRICA" if wave == 1 else "ASIA"}'"""


def _location(wave: int) -> str:
    latitude = "'10.25'" if wave == 1 else "CASE WHEN r_name = 'AFRICA' THEN '12.5' ELSE '10.25' END"
    return f"""
        SELECT '{SOURCE}' AS source_system, CAST(n_nationkey AS STRING) AS location_id,
               CAST(NULL AS STRING) AS address_line1, CAST(NULL AS STRING) AS address_line2,
               n_name AS city, {_region(wave)} AS region, CAST(NULL AS STRING) AS postal_code, n_name AS country,
               {latitude} AS latitude, CASE WHEN r_name = 'ASIA' THEN 'east' ELSE '20.125' END AS longitude
        FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey WHERE {_present(wave)}"""


def _customer(wave: int) -> str:
    return f"""
        SELECT '{SOURCE}' AS source_system, CAST(c_custkey AS STRING) AS customer_id,
               CAST(c_nationkey AS STRING) AS location_id, c_name AS first_name, substr(c_name, 10) AS last_name,
               lower(c_name) || '@example.com' AS email, {_phone(wave, "c_custkey", "c_acctbal")} AS phone,
               {_segment(wave)} AS customer_segment
        FROM {_CUSTOMERS} WHERE {_present(wave)}"""


def _product_columns(wave: int) -> str:
    raised = "CASE WHEN p_size > 40 THEN p_retailprice + 10 ELSE p_retailprice END"
    price = money("p_retailprice" if wave == 1 else raised)
    no_cost = "p_size <= 5" if wave == 1 else "p_size > 45"
    return f"""p_name AS product_name, p_type AS category, 'size ' || CAST(p_size AS STRING) AS subcategory,
               p_brand AS brand, {price} AS unit_price,
               CASE WHEN {no_cost} THEN 'unknown' ELSE {money("p_retailprice")} END AS unit_cost"""


def _sold(wave: int) -> str:
    return "p_type <> 'PROMO'" if wave == 1 else "p_type <> 'ECONOMY'"


def _product(wave: int) -> str:
    return f"""
        SELECT '{SOURCE}' AS source_system, CAST(p_partkey AS STRING) AS product_id, {_product_columns(wave)},
               CASE WHEN p_brand = 'Brand#1' THEN 'EUR' WHEN p_brand = 'Brand#2' THEN 'XXX' ELSE 'AME' END
                   AS currency_code
        FROM {{part}} WHERE {_sold(wave)}"""


def _employee(wave: int) -> str:
    title = "'Buyer'" if wave == 1 else "CASE WHEN s_acctbal > 5000 THEN 'Senior Buyer' ELSE 'Buyer' END"
    left = "CAST(NULL AS STRING)" if wave == 1 else (
        "CASE WHEN s_acctbal < 0 THEN '2024-02-01' ELSE CAST(NULL AS STRING) END"
    )
    return f"""
        SELECT '{SOURCE}' AS source_system, CAST(s_suppkey AS STRING) AS employee_id,
               CAST(s_nationkey AS STRING) AS location_id, s_name AS first_name, substr(s_name, 10) AS last_name,
               lower(s_name) || '@example.com' AS email, {title} AS job_title, r_name AS department,
               CAST(NULL AS STRING) AS manager_employee_id,
               '{"2020-01-01" if wave == 1 else "2020-06-01"}' AS hire_date, {left} AS termination_date
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
        WHERE {_present(wave)}"""


def _person(wave: int, source: str, entity: str, prefix: str) -> str:
    return f"""'{source}' AS source_system, '{prefix}' || CAST(c_custkey AS STRING) AS {entity}_id,
               c_name AS first_name, substr(c_name, 10) AS last_name, lower(c_name) || '@example.com' AS email,
               {_phone(wave, "c_custkey", "c_acctbal")} AS phone, c_name || ' street' AS address_line1,
               n_name AS city, {_region(wave)} AS region, CAST(c_nationkey AS STRING) AS postal_code,
               n_name AS country"""


def _address_customer(source: str):
    def text(wave: int) -> str:
        return f"""
        SELECT {_person(wave, source, "customer", "CUST")}, {_segment(wave)} AS customer_segment
        FROM {_CUSTOMERS} WHERE {_present(wave)}"""

    return text


def _account(wave: int) -> str:
    status = "'Active'" if wave == 1 else "CASE WHEN c_acctbal < 0 THEN 'Closed' ELSE 'Active' END"
    return f"""
        SELECT 'BANKING_CORE' AS source_system, 'ACCT' || CAST(c_custkey AS STRING) AS account_id,
               'CUST' || CAST(c_custkey AS STRING) AS customer_id, c_mktsegment AS account_type,
               {status} AS account_status, '{"2020-01-01" if wave == 1 else "2020-06-01"}' AS open_date,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'EUR' WHEN c_mktsegment = 'FURNITURE' THEN 'XXX'
                    ELSE 'AME' END AS currency_code, {money("c_acctbal")} AS balance
        FROM {{customer}}"""


def _loan(wave: int) -> str:
    status = "o_orderstatus" if wave == 1 else "CASE WHEN o_orderstatus = 'O' THEN 'P' ELSE o_orderstatus END"
    return f"""
        SELECT 'BANKING_CORE' AS source_system, 'LOAN' || CAST(o_orderkey AS STRING) AS loan_id,
               'CUST' || CAST(o_custkey AS STRING) AS customer_id, o_orderpriority AS loan_type,
               {money("o_totalprice")} AS principal_amount, '{"4.25" if wave == 1 else "4.75"}' AS interest_rate,
               CASE WHEN o_orderstatus = 'F' THEN 'open end' ELSE '360' END AS term_months,
               {day("o_orderdate")} AS origination_date, {status} AS status
        FROM {{orders}}"""


def _patient(wave: int) -> str:
    born = "'1970-01-01'" if wave == 1 else "'1971-01-01'"
    return f"""
        SELECT {_person(wave, "HEALTHCARE_CORE", "patient", "PAT")}, 'F' AS gender, {born} AS date_of_birth,
               '{"A+" if wave == 1 else "B+"}' AS blood_type, {_segment(wave)} AS insurance_plan
        FROM {_CUSTOMERS} WHERE {_present(wave)}"""


def _provider(wave: int) -> str:
    specialty = "r_name" if wave == 1 else "CASE WHEN s_acctbal > 5000 THEN 'SURGERY' ELSE r_name END"
    return f"""
        SELECT 'HEALTHCARE_CORE' AS source_system, 'PROV' || CAST(s_suppkey AS STRING) AS provider_id,
               s_name AS first_name, '{"Miller" if wave == 1 else "Smith"}' AS last_name, {specialty} AS specialty,
               CAST(s_suppkey AS STRING) AS npi_number, n_name || ' clinic' AS facility_name, n_name AS city,
               {_region(wave)} AS region, {_phone(wave, "s_suppkey", "s_acctbal")} AS phone
        FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
        WHERE {_present(wave)}"""


def _retail_product(wave: int) -> str:
    return f"""
        SELECT 'RETAIL_CORE' AS source_system, 'PROD' || CAST(p_partkey AS STRING) AS product_id,
               {_product_columns(wave)}
        FROM {{part}} WHERE {_sold(wave)}"""


def _line_measures(net: str = money("l_extendedprice * (1 - l_discount)")) -> str:
    return f"""
               CAST(o_custkey AS STRING) AS customer_id, CAST(l_partkey AS STRING) AS product_id,
               CAST(l_suppkey AS STRING) AS employee_id, CAST(l_linenumber AS STRING) AS location_id,
               CASE WHEN l_returnflag = 'A' THEN 'EUR' WHEN l_returnflag = 'R' THEN 'XXX' END AS currency_code,
               CASE WHEN l_quantity = 50 AND l_returnflag = 'R' THEN 'n/a' ELSE {money("l_quantity")} END AS quantity,
               {money("l_extendedprice")} AS unit_price,
               CASE WHEN l_discount > 0 THEN {money("l_extendedprice * l_discount")} END AS discount_amount,
               CASE WHEN l_tax > 0 THEN {money("l_extendedprice * l_tax")} END AS tax_amount,
               {net} AS net_amount"""


_ORDER_DAY = f"CASE WHEN o_orderstatus = 'P' AND l_linenumber = 7 THEN 'pending' ELSE {day('o_orderdate')} END"


def _sales(wave: int) -> str:
    return f"""
        SELECT '{SOURCE}' AS source_system,
               CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS sale_id,
               {_ORDER_DAY} AS sale_date, {_line_measures()}
        FROM {_LINES}
        UNION ALL
        SELECT '{SOURCE}' AS source_system,
               CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS sale_id,
               'pending' AS sale_date, {_line_measures()}
        FROM {_LINES} WHERE o_orderstatus = 'P' AND l_linenumber = 1"""


def _order_lines(
    where: str = "true", source: str = f"'{SOURCE}'", order_id: str = "CAST(l_orderkey AS STRING)",
    line: str = "CAST(l_linenumber AS STRING)", date: str = _ORDER_DAY, **measures: str,
) -> str:
    return f"""
        SELECT {source} AS source_system, {order_id} AS order_id, {line} AS order_line_number, {date} AS order_date,
               o_orderstatus AS order_status, {_line_measures(**measures)}
        FROM {_LINES} WHERE {where}"""


def _orders(wave: int) -> str:
    return _order_lines()


def _damaged_orders(wave: int) -> str:
    """All order lines, and some of them again without a date, without or with unreadable keys, and with too large an amount."""
    return " UNION ALL ".join(
        [
            _order_lines(),
            _order_lines("o_orderstatus = 'P' AND l_linenumber = 1", date="'pending'"),
            _order_lines("l_linenumber = 2 AND l_returnflag = 'R'", line="'x' || CAST(l_linenumber AS STRING)"),
            _order_lines("l_linenumber = 3 AND l_returnflag = 'A'", order_id="CAST(NULL AS STRING)"),
            _order_lines("l_linenumber = 4 AND l_returnflag = 'N'", source="CAST(NULL AS STRING)"),
            _order_lines("l_linenumber = 5 AND l_returnflag = 'R'", order_id="CAST(l_orderkey AS STRING) || 'B'", net="'99999999999999999999'"),
        ]
    )


_TOO_LARGE = "l_linenumber = 6 AND o_orderstatus = 'P' AND l_discount > 0"


def _retail_orders(wave: int) -> str:
    return f"""
        SELECT 'RETAIL_CORE' AS source_system,
               'ORD' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS order_id,
               {_ORDER_DAY} AS order_date, o_orderstatus AS order_status,
               'CUST' || CAST(o_custkey AS STRING) AS customer_id, 'PROD' || CAST(l_partkey AS STRING) AS product_id,
               CASE WHEN {_TOO_LARGE} THEN '99999999999999' ELSE {money("l_quantity")} END AS quantity,
               CASE WHEN {_TOO_LARGE} THEN '99999999999999' ELSE {money("l_extendedprice")} END AS unit_price,
               CASE WHEN l_discount > 0 THEN CAST(CAST(l_discount * 100 AS DECIMAL(9,4)) AS STRING) END AS discount_pct,
               o_orderpriority AS channel
        FROM {_LINES}"""


def _inventory(wave: int) -> str:
    return f"""
        SELECT 'RETAIL_CORE' AS source_system,
               'INV' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) AS inventory_id,
               'PROD' || CAST(l_partkey AS STRING) AS product_id, 'W' || CAST(l_suppkey AS STRING) AS warehouse,
               CAST(CAST(sum(l_quantity) AS INT) AS STRING) AS quantity_on_hand,
               CAST(max(l_linenumber) AS STRING) AS reorder_level, {day("max(l_shipdate)")} AS last_restock_date
        FROM {{lineitem}} GROUP BY l_partkey, l_suppkey"""


def _transactions(wave: int) -> str:
    return f"""
        SELECT '{SOURCE}' AS source_system, CAST(event_id AS STRING) AS transaction_id,
               {day("ts")} AS transaction_date, CAST(user_id AS STRING) AS account_id,
               CAST(user_id AS STRING) AS customer_id, CAST(NULL AS STRING) AS employee_id,
               CAST(user_id AS STRING) AS location_id,
               CASE WHEN event_type = 'view' THEN 'EUR' END AS currency_code, event_type AS transaction_type,
               CASE WHEN event_type = 'error' AND value > 99 THEN 'n/a' ELSE {money("value")} END
                   AS transaction_amount, CAST(NULL AS STRING) AS running_balance
        FROM {{events}}"""


def _bank_transactions(wave: int) -> str:
    return f"""
        SELECT 'BANKING_CORE' AS source_system, 'TXN' || CAST(event_id AS STRING) AS transaction_id,
               'ACCT' || CAST(user_id AS STRING) AS account_id, {day("ts")} AS transaction_date,
               event_type AS transaction_type, {money("value")} AS amount,
               CASE WHEN event_type = 'view' THEN 'EUR' END AS currency_code,
               {money("value")} AS running_balance, 'web' AS channel
        FROM {{events}}"""


def _claims(wave: int) -> str:
    return f"""
        SELECT 'HEALTHCARE_CORE' AS source_system,
               'CLM' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS claim_id,
               'PAT' || CAST(o_custkey AS STRING) AS patient_id, 'PROV' || CAST(l_suppkey AS STRING) AS provider_id,
               {day("l_shipdate")} AS claim_date, l_returnflag AS diagnosis_code, l_linestatus AS procedure_code,
               {money("l_extendedprice")} AS claim_amount, o_orderstatus AS claim_status, o_orderpriority AS payer
        FROM {_LINES}"""


def _pharmacy(wave: int) -> str:
    return f"""
        SELECT 'HEALTHCARE_CORE' AS source_system,
               'RX' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS prescription_id,
               'PAT' || CAST(o_custkey AS STRING) AS patient_id, 'PROV' || CAST(l_suppkey AS STRING) AS provider_id,
               l_returnflag || ' drug' AS drug_name, CAST(l_partkey AS STRING) AS ndc_code,
               {money("l_quantity")} AS quantity,
               CASE WHEN l_linestatus = 'O' THEN 'as needed' ELSE '30' END AS days_supply,
               {day("l_shipdate")} AS fill_date, 'central' AS pharmacy_name, {money("l_extendedprice")} AS cost
        FROM {_LINES}"""


STAGING = {
    "source_system": _source_system,
    "currency": _currency,
    "location": _location,
    "customer": _customer,
    "product": _product,
    "employee": _employee,
    "bank_customer": _address_customer("BANKING_CORE"),
    "retail_customer": _address_customer("RETAIL_CORE"),
    "account": _account,
    "loan": _loan,
    "patient": _patient,
    "provider": _provider,
    "retail_product": _retail_product,
    "sales": _sales,
    "orders": _orders,
    "damaged_orders": _damaged_orders,
    "retail_orders": _retail_orders,
    "inventory": _inventory,
    "transactions": _transactions,
    "bank_transactions": _bank_transactions,
    "claims": _claims,
    "pharmacy": _pharmacy,
}
