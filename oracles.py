"""DuckDB SQL for the checks, written from the warehouse rules and not from the specs.

Every text starts from the staged rows (``shared_tables``) or the shared tables
and works out its result with plain joins and windows. Dates and timestamps are
given as text and decimals as doubles, as the registered queries do.
"""

from __future__ import annotations

from starloom.plans.shared_tables import duckdb_text

D1, D2, BEFORE_D2 = "DATE '2024-01-15'", "DATE '2024-02-15'", "DATE '2024-02-14'"
T1, T2 = "TIMESTAMP '2024-01-15 06:00:00'", "TIMESTAMP '2024-02-15 06:00:00'"
HIGH = "DATE '9999-12-31'"
MONEY = "DECIMAL(18,4)"


def cols(text: str) -> list[str]:
    return text.split()


def text_of(*names: str) -> str:
    return ", ".join(f"CAST({n} AS VARCHAR) AS {n}" for n in names)


def number_of(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def query(ctes: list[str], final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


def staged(name: str, wave: int = 1, alias: str | None = None) -> str:
    return f"{alias or f'stg_{name}_{wave}'} AS ({duckdb_text(name, wave)})"


# --- dimensions ----------------------------------------------------------------


def scd1(name: str, key: str, natural: list[str], attrs: list[str], compare: list[str], src: str) -> list[str]:
    """``name_1`` and ``name_2``: the dimension after each wave; ``src`` has a {w} for the wave."""
    ids, on = ", ".join(natural), " AND ".join(f"s.{c} = t.{c}" for c in natural)
    listed = ", ".join(attrs)
    differs = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in compare)
    merged = ", ".join(f"CASE WHEN {differs} THEN s.{c} ELSE t.{c} END AS {c}" for c in attrs)
    return [
        f"{name}_src_1 AS ({src.format(w=1)})",
        f"{name}_src_2 AS ({src.format(w=2)})",
        f"""{name}_1 AS (SELECT row_number() OVER (ORDER BY {ids}) AS {key}, {ids}, {listed},
            {T1} AS created_date, CAST(NULL AS TIMESTAMP) AS updated_date FROM {name}_src_1)""",
        f"""{name}_2 AS (
            SELECT t.{key}, {", ".join("t." + c for c in natural)}, {merged}, t.created_date,
                   CASE WHEN {differs} THEN {T2} ELSE t.updated_date END AS updated_date
            FROM {name}_1 t JOIN {name}_src_2 s ON {on}
            UNION ALL
            SELECT {key}, {ids}, {listed}, created_date, updated_date FROM {name}_1 t
            WHERE NOT EXISTS (SELECT 1 FROM {name}_src_2 s WHERE {on})
            UNION ALL
            SELECT (SELECT max({key}) FROM {name}_1) + row_number() OVER (ORDER BY {ids}), {ids}, {listed},
                   {T2}, NULL
            FROM {name}_src_2 s WHERE NOT EXISTS (SELECT 1 FROM {name}_1 t WHERE {on}))""",
    ]


def scd2(name: str, key: str, natural: list[str], attrs: list[str], compare: list[str], src: str,
         src_2: str | None = None) -> list[str]:
    ids, on = ", ".join(natural), " AND ".join(f"s.{c} = t.{c}" for c in natural)
    listed = ", ".join(attrs)
    differs = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in compare)
    return [
        f"{name}_src_1 AS ({src.format(w=1)})",
        f"""{name}_1 AS (SELECT row_number() OVER (ORDER BY {ids}) AS {key}, {ids}, {listed}, true AS is_current,
            {D1} AS effective_date, {HIGH} AS expiry_date, {T1} AS created_date,
            CAST(NULL AS TIMESTAMP) AS updated_date FROM {name}_src_1)""",
        f"{name}_src_2 AS ({(src_2 or src).format(w=2)})",
        f"""{name}_fresh AS (SELECT s.* FROM {name}_src_2 s LEFT JOIN {name}_1 t ON {on}
            WHERE t.{key} IS NULL OR {differs})""",
        f"""{name}_2 AS (
            SELECT t.{key}, {", ".join("t." + c for c in natural + attrs)}, s.{natural[0]} IS NULL AS is_current,
                   t.effective_date,
                   CASE WHEN s.{natural[0]} IS NULL THEN t.expiry_date ELSE {BEFORE_D2} END AS expiry_date,
                   t.created_date, CASE WHEN s.{natural[0]} IS NULL THEN t.updated_date ELSE {T2} END AS updated_date
            FROM {name}_1 t LEFT JOIN {name}_fresh s ON {on}
            UNION ALL
            SELECT (SELECT max({key}) FROM {name}_1) + row_number() OVER (ORDER BY {ids}), {ids}, {listed}, true,
                   {D2}, {HIGH}, {T2}, NULL
            FROM {name}_fresh)""",
    ]


LOCATION_ATTRS = cols("address_line1 address_line2 city region postal_code country latitude longitude")
LOCATION_COMPARE = cols("address_line1 city region postal_code country")
CUSTOMER_ATTRS = cols("location_key first_name last_name email phone customer_segment")
PRODUCT_ATTRS = cols("product_name category subcategory brand unit_price unit_cost currency_key")
EMPLOYEE_ATTRS = cols(
    "location_key first_name last_name email job_title department manager_employee_id hire_date termination_date"
)
ACCOUNT_ATTRS = cols("customer_key account_type account_status open_date currency_key")
LOAN_ATTRS = cols("customer_key loan_type principal_amount interest_rate term_months origination_date status")
PATIENT_ATTRS = cols(
    "location_key first_name last_name gender date_of_birth blood_type email phone insurance_plan"
)
PROVIDER_ATTRS = cols("first_name last_name specialty npi_number facility_name city region phone")


def both(*names: str) -> list[str]:
    return [staged(n, w) for n in names for w in (1, 2)]


def location_ctes() -> list[str]:
    src = """SELECT source_system, location_id, address_line1, address_line2, city, region, postal_code, country,
                    TRY_CAST(latitude AS DECIMAL(9,6)) AS latitude, TRY_CAST(longitude AS DECIMAL(9,6)) AS longitude
             FROM stg_location_{w}"""
    return both("location") + scd1(
        "dim_location", "location_key", ["location_id", "source_system"], LOCATION_ATTRS, LOCATION_COMPARE, src
    )


def own_location_ctes(staging: str, entity: str) -> list[str]:
    src = f"""SELECT source_system, {entity} AS location_id, address_line1, CAST(NULL AS VARCHAR) AS address_line2,
                     city, region, postal_code, country, CAST(NULL AS DECIMAL(9,6)) AS latitude,
                     CAST(NULL AS DECIMAL(9,6)) AS longitude
              FROM stg_{staging}_{{w}}"""
    return both(staging) + scd1(
        "dim_location", "location_key", ["location_id", "source_system"], LOCATION_ATTRS, LOCATION_COMPARE, src
    )


def currency_ctes() -> list[str]:
    src = "SELECT DISTINCT currency_code, currency_name, symbol FROM stg_currency_{w}"
    return both("currency") + scd1(
        "dim_currency", "currency_key", ["currency_code"], ["currency_name", "symbol"], ["currency_name", "symbol"], src
    )


def source_system_ctes() -> list[str]:
    names = ["source_system_name", "description"]
    src = "SELECT DISTINCT source_system_code, source_system_name, description FROM stg_source_system_{w}"
    return both("source_system") + scd1(
        "dim_source_system", "source_system_key", ["source_system_code"], names, names, src
    )


def customer_ctes() -> list[str]:
    src = """SELECT s.source_system, s.customer_id, l.location_key, s.first_name, s.last_name, s.email, s.phone,
                    s.customer_segment
             FROM stg_customer_{w} s LEFT JOIN dim_location_{w} l
               ON l.location_id = s.location_id AND l.source_system = s.source_system"""
    return location_ctes() + both("customer") + scd2(
        "dim_customer", "customer_key", ["customer_id", "source_system"], CUSTOMER_ATTRS, CUSTOMER_ATTRS, src
    )


def product_ctes() -> list[str]:
    src = f"""SELECT s.source_system, s.product_id, s.product_name, s.category, s.subcategory, s.brand,
                     TRY_CAST(s.unit_price AS {MONEY}) AS unit_price, TRY_CAST(s.unit_cost AS {MONEY}) AS unit_cost,
                     c.currency_key
              FROM stg_product_{{w}} s LEFT JOIN dim_currency_{{w}} c ON c.currency_code = s.currency_code"""
    return currency_ctes() + both("product") + scd2(
        "dim_product", "product_key", ["product_id", "source_system"], PRODUCT_ATTRS, PRODUCT_ATTRS, src
    )


def employee_ctes() -> list[str]:
    src = """SELECT s.source_system, s.employee_id, l.location_key, s.first_name, s.last_name, s.email, s.job_title,
                    s.department, s.manager_employee_id, TRY_CAST(s.hire_date AS DATE) AS hire_date,
                    TRY_CAST(s.termination_date AS DATE) AS termination_date
             FROM stg_employee_{w} s LEFT JOIN dim_location_{w} l
               ON l.location_id = s.location_id AND l.source_system = s.source_system"""
    compare = [c for c in EMPLOYEE_ATTRS if c != "hire_date"]
    return both("employee") + scd2(
        "dim_employee", "employee_key", ["employee_id", "source_system"], EMPLOYEE_ATTRS, compare, src
    )


def address_customer_ctes(staging: str) -> list[str]:
    src = f"""SELECT s.source_system, s.customer_id, l.location_key, s.first_name, s.last_name, s.email, s.phone,
                     s.customer_segment
              FROM stg_{staging}_{{w}} s JOIN dim_location_{{w}} l
                ON l.location_id = s.customer_id AND l.source_system = s.source_system"""
    return own_location_ctes(staging, "customer_id") + scd2(
        "dim_customer", "customer_key", ["customer_id", "source_system"], CUSTOMER_ATTRS, CUSTOMER_ATTRS, src
    )


def account_ctes() -> list[str]:
    src = """SELECT s.source_system, s.account_id, c.customer_key, s.account_type, s.account_status,
                    TRY_CAST(s.open_date AS DATE) AS open_date, u.currency_key
             FROM stg_account_{w} s JOIN dim_customer_{w} c
               ON c.customer_id = s.customer_id AND c.source_system = s.source_system AND c.is_current
             LEFT JOIN dim_currency_{w} u ON u.currency_code = s.currency_code"""
    compare = [c for c in ACCOUNT_ATTRS if c != "open_date"]
    return address_customer_ctes("bank_customer") + currency_ctes() + both("account") + scd2(
        "dim_account", "account_key", ["account_id", "source_system"], ACCOUNT_ATTRS, compare, src
    )


def loan_ctes() -> list[str]:
    src = f"""SELECT s.source_system, s.loan_id, c.customer_key, s.loan_type,
                     TRY_CAST(s.principal_amount AS {MONEY}) AS principal_amount,
                     TRY_CAST(s.interest_rate AS DECIMAL(9,4)) AS interest_rate,
                     TRY_CAST(s.term_months AS INTEGER) AS term_months,
                     TRY_CAST(s.origination_date AS DATE) AS origination_date, s.status
              FROM stg_loan_{{w}} s JOIN dim_customer_{{w}} c
                ON c.customer_id = s.customer_id AND c.source_system = s.source_system AND c.is_current"""
    return address_customer_ctes("bank_customer") + both("loan") + scd2(
        "dim_loan", "loan_key", ["loan_id", "source_system"], LOAN_ATTRS, ["status"], src
    )


def patient_ctes() -> list[str]:
    src = """SELECT s.source_system, s.patient_id, l.location_key, s.first_name, s.last_name, s.gender,
                    TRY_CAST(s.date_of_birth AS DATE) AS date_of_birth, s.blood_type, s.email, s.phone,
                    s.insurance_plan
             FROM stg_patient_{w} s JOIN dim_location_{w} l
               ON l.location_id = s.patient_id AND l.source_system = s.source_system"""
    compare = cols("location_key first_name last_name email phone insurance_plan")
    return own_location_ctes("patient", "patient_id") + scd2(
        "dim_patient", "patient_key", ["patient_id", "source_system"], PATIENT_ATTRS, compare, src
    )


def provider_ctes() -> list[str]:
    src = "SELECT source_system, provider_id, " + ", ".join(PROVIDER_ATTRS) + " FROM stg_provider_{w}"
    compare = cols("specialty facility_name city region phone")
    return both("provider") + scd2(
        "dim_provider", "provider_key", ["provider_id", "source_system"], PROVIDER_ATTRS, compare, src
    )


def retail_product_ctes() -> list[str]:
    src = f"""SELECT source_system, product_id, product_name, category, subcategory, brand,
                     TRY_CAST(unit_price AS {MONEY}) AS unit_price, TRY_CAST(unit_cost AS {MONEY}) AS unit_cost,
                     CAST(NULL AS BIGINT) AS currency_key
              FROM stg_retail_product_{{w}}"""
    return both("retail_product") + scd2(
        "dim_product", "product_key", ["product_id", "source_system"], PRODUCT_ATTRS, PRODUCT_ATTRS[:-1], src
    )


_DIM_CASTS = {
    **dict.fromkeys(cols("unit_price unit_cost principal_amount interest_rate latitude longitude"), "DOUBLE"),
    **dict.fromkeys(cols("hire_date termination_date open_date origination_date date_of_birth"), "VARCHAR"),
}


def dim_select(name: str, key: str, natural: list[str], attrs: list[str], scd: int = 2, wave: int = 2) -> str:
    shown = ", ".join(f"CAST({c} AS {_DIM_CASTS[c]}) AS {c}" if c in _DIM_CASTS else c for c in attrs)
    version = f"is_current, {text_of('effective_date', 'expiry_date')}, " if scd == 2 else ""
    return (
        f"SELECT {key}, {', '.join(natural)}, {shown}, {version}{text_of('created_date', 'updated_date')} "
        f"FROM {name}_{wave}"
    )


# --- facts -----------------------------------------------------------------------

CUSTOMER_ON = "c.customer_id = f.customer_id AND c.source_system = f.source_system AND c.is_current"
PRODUCT_ON = "p.product_id = f.product_id AND p.source_system = f.source_system AND p.is_current"
EMPLOYEE_ON = "e.employee_id = f.employee_id AND e.source_system = f.source_system AND e.is_current"
LOCATION_ON = "l.location_id = f.location_id AND l.source_system = f.source_system"
CURRENCY_ON = "u.currency_code = f.currency_code"


def latest(name: str, select: str, source: str, keys: str, order: str, day: str = "", needs: str = "") -> list[str]:
    """``name``: typed rows of ``source``, the latest per key, ties settled by the other columns.

    With ``day`` rows whose day and ``needs`` can be read come first, then the later day.
    """
    by = ", ".join(f"{c} DESC NULLS LAST" for c in order.split())
    if day:
        readable = [f"TRY_CAST({day} AS DATE) IS NOT NULL", *[f"{c} IS NOT NULL" for c in needs.split()]]
        by = f"CASE WHEN {' AND '.join(readable)} THEN 0 ELSE 1 END, TRY_CAST({day} AS DATE) DESC NULLS LAST, {by}"
    return [
        f"{name}_typed AS (SELECT {select} FROM {source})",
        f"""{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {by}) AS rn
            FROM {name}_typed) WHERE rn = 1)""",
    ]


def key_of(date: str) -> str:
    return f"CAST(strftime(TRY_CAST({date} AS DATE), '%Y%m%d') AS INTEGER)"


def amounts(zero: bool = True) -> str:
    parts = []
    for c in cols("quantity unit_price discount_amount tax_amount net_amount"):
        cast = f"TRY_CAST({c} AS {MONEY})"
        parts.append(f"coalesce({cast}, 0) AS {c}" if zero and c in ("discount_amount", "tax_amount") else f"{cast} AS {c}")
    return ", ".join(parts)


AMOUNTS = number_of(*cols("quantity unit_price discount_amount tax_amount net_amount"))
LINE_JOINS = f"""JOIN dim_customer_2 c ON {CUSTOMER_ON} JOIN dim_product_2 p ON {PRODUCT_ON}
    LEFT JOIN dim_employee_2 e ON {EMPLOYEE_ON} LEFT JOIN dim_location_2 l ON {LOCATION_ON}
    LEFT JOIN dim_currency_2 u ON {CURRENCY_ON}"""
LINE_PARENTS = "customer_id product_id employee_id location_id currency_code"
LINE_KEYS = "c.customer_key, p.product_key, e.employee_key, l.location_key, u.currency_key"
LINE_NEEDS = "quantity unit_price net_amount"
LINE_FILTER = "quantity IS NOT NULL AND f.unit_price IS NOT NULL AND net_amount IS NOT NULL"


def line_dims() -> list[str]:
    return customer_ctes() + product_ctes() + employee_ctes()


def sales_ctes() -> list[str]:
    select = f"source_system, sale_id, {amounts()}, {LINE_PARENTS.replace(' ', ', ')}, sale_date"
    order = f"quantity unit_price discount_amount tax_amount net_amount {LINE_PARENTS}"
    return (
        line_dims()
        + [staged("sales")]
        + latest("sales", select, "stg_sales_1", "source_system, sale_id", order, "sale_date", LINE_NEEDS)
        + [
            f"""fact_sales AS (SELECT {key_of("sale_date")} AS date_key, {LINE_KEYS}, f.source_system, f.sale_id,
                f.quantity, f.unit_price, f.discount_amount, f.tax_amount, f.net_amount
                FROM sales f {LINE_JOINS} WHERE TRY_CAST(sale_date AS DATE) IS NOT NULL AND {LINE_FILTER})"""
        ]
    )


def typed_orders(source: str = "stg_orders_1", name: str = "order_lines") -> list[str]:
    select = (
        f"source_system, order_id, CAST(order_line_number AS INTEGER) AS order_line_number, order_status, "
        f"{amounts()}, {LINE_PARENTS.replace(' ', ', ')}, order_date"
    )
    order = f"order_status quantity unit_price discount_amount tax_amount net_amount {LINE_PARENTS}"
    return latest(name, select, source, "source_system, order_id, order_line_number", order, "order_date", LINE_NEEDS)


def orders_ctes() -> list[str]:
    return (
        line_dims()
        + [staged("orders")]
        + typed_orders()
        + [
            f"""fact_orders AS (SELECT {key_of("order_date")} AS date_key, {LINE_KEYS}, f.source_system, f.order_id,
                f.order_line_number, f.order_status, f.quantity, f.unit_price, f.discount_amount, f.tax_amount,
                f.net_amount
                FROM order_lines f {LINE_JOINS} WHERE TRY_CAST(order_date AS DATE) IS NOT NULL AND {LINE_FILTER})"""
        ]
    )


def damaged_ctes() -> list[str]:
    """The outcome of every staged row of damaged_orders."""
    return line_dims() + [
        staged("damaged_orders"),
        f"""seen AS (SELECT *, TRY_CAST(order_line_number AS INTEGER) AS line, TRY_CAST(order_date AS DATE) AS day,
            TRY_CAST(quantity AS {MONEY}) AS q, TRY_CAST(unit_price AS {MONEY}) AS u, TRY_CAST(net_amount AS {MONEY}) AS n
            FROM stg_damaged_orders_1)""",
        f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY source_system, order_id, line ORDER BY
            CASE WHEN day IS NULL OR q IS NULL OR u IS NULL OR n IS NULL THEN 1 ELSE 0 END, day DESC NULLS LAST,
            order_status DESC, q DESC NULLS LAST, u DESC NULLS LAST, TRY_CAST(coalesce(discount_amount, '0') AS {MONEY}) DESC,
            TRY_CAST(coalesce(tax_amount, '0') AS {MONEY}) DESC, n DESC NULLS LAST,
            {", ".join(c + " DESC NULLS LAST" for c in LINE_PARENTS.split())}) AS place FROM seen)""",
        f"""damaged AS (SELECT CASE
                WHEN f.source_system IS NULL OR f.order_id IS NULL OR f.order_line_number IS NULL THEN 'missing_key'
                WHEN f.line IS NULL THEN 'bad_order_line_number' WHEN f.place > 1 THEN 'set_aside'
                WHEN f.day IS NULL THEN 'bad_date' WHEN f.q IS NULL THEN 'bad_quantity'
                WHEN f.u IS NULL THEN 'bad_unit_price' WHEN f.n IS NULL THEN 'bad_net_amount'
                WHEN c.customer_key IS NULL THEN 'unknown_dim_customer'
                WHEN p.product_key IS NULL THEN 'unknown_dim_product' ELSE 'accepted' END AS outcome
            FROM ranked f LEFT JOIN dim_customer_2 c ON {CUSTOMER_ON} LEFT JOIN dim_product_2 p ON {PRODUCT_ON})""",
    ]


def transactions_ctes() -> list[str]:
    """Event ids are unique, so no row is superseded."""
    return (
        customer_ctes()
        + currency_ctes()
        + [staged("transactions")]
        + [
            f"""fact_transactions AS (SELECT {key_of("transaction_date")} AS date_key, c.customer_key,
                CAST(NULL AS BIGINT) AS employee_key, l.location_key, u.currency_key, f.source_system,
                f.transaction_id, f.account_id, f.transaction_type,
                TRY_CAST(f.transaction_amount AS {MONEY}) AS transaction_amount,
                TRY_CAST(f.running_balance AS {MONEY}) AS running_balance
                FROM stg_transactions_1 f JOIN dim_customer_2 c ON {CUSTOMER_ON}
                LEFT JOIN dim_location_2 l ON {LOCATION_ON} LEFT JOIN dim_currency_2 u ON {CURRENCY_ON}
                WHERE TRY_CAST(f.transaction_amount AS {MONEY}) IS NOT NULL)"""
        ]
    )


def bank_transactions_ctes() -> list[str]:
    return (
        account_ctes()
        + [staged("bank_transactions")]
        + [
            f"""fact_transactions AS (SELECT {key_of("transaction_date")} AS date_key, a.customer_key, u.currency_key,
                CAST(NULL AS BIGINT) AS employee_key, CAST(NULL AS BIGINT) AS location_key, f.source_system,
                f.transaction_id, f.account_id, f.transaction_type, TRY_CAST(f.amount AS {MONEY}) AS transaction_amount,
                TRY_CAST(f.running_balance AS {MONEY}) AS running_balance
                FROM stg_bank_transactions_1 f JOIN dim_account_2 a
                  ON a.account_id = f.account_id AND a.source_system = f.source_system AND a.is_current
                LEFT JOIN dim_currency_2 u ON {CURRENCY_ON})"""
        ]
    )


def care_ctes(name: str, select: str, key: str, order: str, date: str, shown: str, needs: str) -> list[str]:
    return (
        patient_ctes()
        + provider_ctes()
        + [staged(name)]
        + latest(f"{name}_rows", select, f"stg_{name}_1", f"source_system, {key}", order, date, needs)
        + [
            f"""fact_{name} AS (SELECT {key_of(date)} AS date_key, p.patient_key, d.provider_key, f.source_system, {shown}
                FROM {name}_rows f
                JOIN dim_patient_1 p ON p.patient_id = f.patient_id AND p.source_system = f.source_system
                JOIN dim_provider_1 d ON d.provider_id = f.provider_id AND d.source_system = f.source_system)"""
        ]
    )


def claims_ctes() -> list[str]:
    plain = "diagnosis_code, procedure_code"
    return care_ctes(
        "claims",
        f"""source_system, claim_id, {plain}, TRY_CAST(claim_amount AS {MONEY}) AS claim_amount, claim_status, payer,
            patient_id, provider_id, claim_date""",
        "claim_id",
        "diagnosis_code procedure_code claim_amount claim_status payer patient_id provider_id",
        "claim_date",
        "f.claim_id, f.diagnosis_code, f.procedure_code, f.claim_amount, f.claim_status, f.payer",
        "claim_amount",
    )


def pharmacy_ctes() -> list[str]:
    return care_ctes(
        "pharmacy",
        f"""source_system, prescription_id, drug_name, ndc_code, TRY_CAST(quantity AS {MONEY}) AS quantity,
            TRY_CAST(days_supply AS INTEGER) AS days_supply, pharmacy_name, TRY_CAST(cost AS {MONEY}) AS cost,
            patient_id, provider_id, fill_date""",
        "prescription_id",
        "drug_name ndc_code quantity days_supply pharmacy_name cost patient_id provider_id",
        "fill_date",
        "f.prescription_id, f.drug_name, f.ndc_code, f.quantity, f.days_supply, f.pharmacy_name, f.cost",
        "cost",
    )


def netted_ctes() -> list[str]:
    return [
            staged("retail_orders"),
            f"""priced AS (SELECT source_system, order_id, order_status, order_date, customer_id, product_id,
                TRY_CAST(quantity AS {MONEY}) AS quantity, TRY_CAST(unit_price AS {MONEY}) AS unit_price,
                TRY_CAST(discount_pct AS DECIMAL(9,4)) AS discount_pct FROM stg_retail_orders_1)""",
            # Whole quantities and percentages and two-decimal prices: four decimals hold the discount exactly.
            # A quantity beyond an integer makes both amounts too large for their columns.
            f"""discounted AS (SELECT *, CAST(TRY_CAST(quantity AS INTEGER)
                * CAST(coalesce(discount_pct, 0) AS INTEGER) * TRY_CAST(unit_price AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2)) AS {MONEY}) AS discount_amount
                FROM priced)""",
            f"""netted AS (SELECT *, CAST(TRY_CAST(quantity AS INTEGER) * TRY_CAST(unit_price AS DECIMAL(14,4)) - discount_amount AS {MONEY})
                AS net_amount FROM discounted)""",
    ]


def retail_orders_ctes() -> list[str]:
    return (
        address_customer_ctes("retail_customer")
        + retail_product_ctes()
        + netted_ctes()
        + latest(
            "retail_lines",
            "*",
            "netted",
            "source_system, order_id",
            "order_status quantity unit_price discount_amount net_amount customer_id product_id",
            "order_date",
            LINE_NEEDS,
        )
        + [
            f"""fact_orders AS (SELECT {key_of("order_date")} AS date_key, c.customer_key, p.product_key,
                CAST(NULL AS BIGINT) AS employee_key, CAST(NULL AS BIGINT) AS location_key,
                CAST(NULL AS BIGINT) AS currency_key, f.source_system, f.order_id,
                CAST(1 AS INTEGER) AS order_line_number, f.order_status, f.quantity, f.unit_price,
                f.discount_amount, CAST(0 AS {MONEY}) AS tax_amount, f.net_amount
                FROM retail_lines f JOIN dim_customer_1 c ON {CUSTOMER_ON} JOIN dim_product_1 p ON {PRODUCT_ON}
                WHERE TRY_CAST(order_date AS DATE) IS NOT NULL AND f.net_amount IS NOT NULL)"""
        ]
    )


def inventory_ctes() -> list[str]:
    return (
        retail_product_ctes()
        + [staged("inventory")]
        + [
            f"""fact_inventory AS (SELECT 20240115 AS snapshot_date_key, p.product_key, f.source_system,
                f.inventory_id, f.warehouse, CAST(f.quantity_on_hand AS INTEGER) AS quantity_on_hand,
                CAST(f.reorder_level AS INTEGER) AS reorder_level, f.last_restock_date
                FROM stg_inventory_1 f JOIN dim_product_1 p ON {PRODUCT_ON})"""
        ]
    )


def calendar_cte(first: str, last: str) -> str:
    return f"""dim_date AS (SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
        CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
        CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
        CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_number,
        monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter_number,
        CAST(year(d) AS INTEGER) AS year_number, dayofweek(d) IN (0, 6) AS is_weekend, false AS is_holiday,
        CAST(NULL AS INTEGER) AS fiscal_year, CAST(NULL AS INTEGER) AS fiscal_quarter,
        CAST(NULL AS INTEGER) AS fiscal_period
        FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS d))"""


ORDER_CALENDAR = calendar_cte(
    "(SELECT CAST(min(o_orderdate) AS DATE) FROM orders)", "(SELECT CAST(max(o_orderdate) AS DATE) FROM orders)"
)


# --- the checks --------------------------------------------------------------------


def dim_checks() -> dict[str, str]:
    customer = ("dim_customer", "customer_key", ["customer_id", "source_system"], CUSTOMER_ATTRS)
    location = ("dim_location", "location_key", ["location_id", "source_system"], LOCATION_ATTRS)
    product = ("dim_product", "product_key", ["product_id", "source_system"], PRODUCT_ATTRS)
    named = ["source_system_name", "description"]
    return {
        "scd1_source_system": query(
            source_system_ctes(),
            dim_select("dim_source_system", "source_system_key", ["source_system_code"], named, scd=1),
        ),
        "scd1_currency": query(
            currency_ctes(), dim_select("dim_currency", "currency_key", ["currency_code"], ["currency_name", "symbol"], 1)
        ),
        "scd1_location": query(location_ctes(), dim_select(*location, scd=1)),
        "location_from_entity": query(
            own_location_ctes("bank_customer", "customer_id"), dim_select(*location, scd=1)
        ),
        "scd2_customer": query(customer_ctes(), dim_select(*customer)),
        "scd2_product": query(product_ctes(), dim_select(*product)),
        "scd2_employee": query(
            location_ctes() + employee_ctes(),
            dim_select("dim_employee", "employee_key", ["employee_id", "source_system"], EMPLOYEE_ATTRS),
        ),
        "scd2_customer_banking": query(address_customer_ctes("bank_customer"), dim_select(*customer)),
        "scd2_account": query(
            account_ctes(), dim_select("dim_account", "account_key", ["account_id", "source_system"], ACCOUNT_ATTRS)
        ),
        "scd2_loan": query(loan_ctes(), dim_select("dim_loan", "loan_key", ["loan_id", "source_system"], LOAN_ATTRS)),
        "scd2_patient": query(
            patient_ctes(), dim_select("dim_patient", "patient_key", ["patient_id", "source_system"], PATIENT_ATTRS)
        ),
        "scd2_provider": query(
            provider_ctes(),
            dim_select("dim_provider", "provider_key", ["provider_id", "source_system"], PROVIDER_ATTRS),
        ),
        "scd2_customer_retail": query(address_customer_ctes("retail_customer"), dim_select(*customer)),
        "scd2_product_retail": query(retail_product_ctes(), dim_select(*product)),
        "merge_counts": query(
            customer_ctes(),
            f"""SELECT count(*) FILTER (WHERE effective_date = {D2}) AS rows_inserted,
                       count(*) FILTER (WHERE NOT is_current) AS rows_updated FROM dim_customer_2""",
        ),
        "update_join": query(
            customer_ctes(),
            f"""SELECT customer_id, is_current, {text_of("effective_date", "expiry_date", "updated_date")}
                FROM dim_customer_2 WHERE NOT is_current""",
        ),
        "change_join": query(
            change_join_ctes(), "SELECT customer_id, location_key, phone, customer_segment FROM fresh"
        ),
        "anti_left_null": query(
            both("customer"),
            """SELECT s.customer_id, s.source_system FROM stg_customer_2 s
               LEFT JOIN stg_customer_1 t ON t.customer_id = s.customer_id AND t.source_system = s.source_system
               WHERE t.customer_id IS NULL""",
        ),
        "change_predicate": query(
            both("customer"),
            """SELECT customer_id,
                      a.phone IS DISTINCT FROM coalesce(b.phone, '')
                        OR a.customer_segment IS DISTINCT FROM b.customer_segment AS changed,
                      coalesce(a.phone, '') <> coalesce(b.phone, '')
                        OR coalesce(a.customer_segment, '') <> coalesce(b.customer_segment, '')
                        AS changed_null_as_empty
               FROM stg_customer_1 a JOIN stg_customer_2 b USING (customer_id)""",
        ),
        "scd2_notebooks": query(
            both("account")
            + scd2(
                "dim_account",
                "account_key",
                ["account_id", "source_system"],
                LAKE_ACCOUNT_ATTRS,
                LAKE_ACCOUNT_ATTRS[:-1],
                """SELECT source_system, account_id, customer_id, account_type, account_status, currency_code,
                          TRY_CAST(open_date AS DATE) AS open_date FROM stg_account_{w}""",
            ),
            dim_select("dim_account", "account_key", ["account_id", "source_system"], LAKE_ACCOUNT_ATTRS),
        ),
    }


LAKE_ACCOUNT_ATTRS = cols("customer_id account_type account_status currency_code open_date")


def change_join_ctes() -> list[str]:
    """The second wave against the first wave's customers and locations."""
    looked_up = """SELECT s.source_system, s.customer_id, l.location_key, s.first_name, s.last_name, s.email, s.phone,
                          s.customer_segment
                   FROM stg_customer_{w} s LEFT JOIN dim_location_1 l
                     ON l.location_id = s.location_id AND l.source_system = s.source_system"""
    chain = location_ctes() + both("customer") + scd2(
        "dim_customer", "customer_key", ["customer_id", "source_system"], CUSTOMER_ATTRS, CUSTOMER_ATTRS, looked_up
    )
    return chain + ["fresh AS (SELECT * FROM dim_customer_fresh)"]


PADDED = """SELECT CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN ' ' || CAST(o_orderkey AS VARCHAR) END AS order_id,
    '  ' || o_orderstatus || ' ' AS order_status, o_orderpriority, o_totalprice FROM orders"""


def clean_checks() -> dict[str, str]:
    line = cols("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
                "l_returnflag l_linestatus")  # fmt: skip
    rest = [c for c in line if c not in ("l_orderkey", "l_linenumber")]
    return {
        "conform_trim": f"""SELECT trim(order_id) AS order_id, trim(order_status) AS order_status,
            trim(o_orderpriority) AS o_orderpriority, o_totalprice FROM ({PADDED})""",
        "drop_null_key": f"SELECT * FROM ({PADDED}) WHERE order_id IS NOT NULL",
        "dedup_latest": f"""SELECT {", ".join(line)}, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC NULLS LAST, {", ".join(c + " DESC NULLS LAST" for c in rest)}) AS rn
            FROM lineitem) WHERE rn = 1""",
        "conform": """SELECT CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
            o_orderkey, o_orderstatus FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey
                ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderstatus DESC) AS rn
            FROM orders) WHERE rn = 1""",
        "distinct_source": query(
            [staged("source_system", 2)], "SELECT DISTINCT source_system_code, description FROM stg_source_system_2"
        ),
        "typed_project": query(
            [staged("sales")],
            f"""SELECT sale_id, CAST(TRY_CAST(sale_date AS DATE) AS VARCHAR) AS sale_day,
                CAST(TRY_CAST(quantity AS {MONEY}) AS DOUBLE) AS quantity,
                CAST(TRY_CAST(unit_price AS {MONEY}) AS DOUBLE) AS unit_price,
                TRY_CAST(location_id AS INTEGER) AS line,
                CAST(TRY_CAST(discount_amount AS {MONEY}) AS DOUBLE) AS discount_amount FROM stg_sales_1""",
        ),
        "default_zero": query(
            [staged("sales")],
            "SELECT sale_id, "
            + ", ".join(
                f"coalesce(CAST(TRY_CAST({c} AS {MONEY}) AS DOUBLE), 0) AS {c}"
                for c in ("quantity", "discount_amount", "tax_amount")
            )
            + " FROM stg_sales_1",
        ),
        "rejects_split": query(
            outcome_ctes(),
            """SELECT source_system, order_id, order_line_number, reason AS reject_reason FROM outcome
               WHERE reason <> 'accepted'""",
        ),
        "reject_partition": query(damaged_ctes(), "SELECT outcome, count(*) AS n FROM damaged GROUP BY outcome"),
        "rejects_count": query(
            outcome_ctes(), "SELECT reason AS outcome, count(*) AS n FROM outcome GROUP BY reason"
        ),
    }


def outcome_ctes() -> list[str]:
    return (
        customer_ctes()
        + product_ctes()
        + [staged("orders")]
        + typed_orders()
        + [
            f"""outcome AS (SELECT f.source_system, f.order_id, f.order_line_number,
                CASE WHEN TRY_CAST(order_date AS DATE) IS NULL THEN 'bad_date'
                     WHEN quantity IS NULL THEN 'bad_quantity'
                     WHEN f.unit_price IS NULL THEN 'bad_unit_price'
                     WHEN net_amount IS NULL THEN 'bad_net_amount'
                     WHEN c.customer_key IS NULL THEN 'unknown_dim_customer'
                     WHEN p.product_key IS NULL THEN 'unknown_dim_product' ELSE 'accepted' END AS reason
                FROM order_lines f LEFT JOIN dim_customer_2 c ON {CUSTOMER_ON} LEFT JOIN dim_product_2 p ON {PRODUCT_ON})"""
        ]
    )


def key_checks() -> dict[str, str]:
    days = """date_key, CAST(full_date AS VARCHAR) AS full_date, day_of_week, day_name, day_of_month, day_of_year,
        week_of_year, month_number, month_name, quarter_number, year_number, is_weekend, is_holiday, fiscal_year,
        fiscal_quarter, fiscal_period"""
    return {
        "date_key": query(
            [staged("orders")],
            f"SELECT order_id, order_line_number, order_date, {key_of('order_date')} AS date_key FROM stg_orders_1",
        ),
        "snapshot_key": query(
            [staged("inventory")],
            "SELECT inventory_id, CAST(20240115 AS INTEGER) AS snapshot_date_key FROM stg_inventory_1",
        ),
        "surrogate_keys": """SELECT 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_sk,
            CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderkey, o_custkey FROM orders""",
        "dim_date": query([ORDER_CALENDAR], f"SELECT {days} FROM dim_date"),
        "dim_date_missing": query(
            [ORDER_CALENDAR],
            f"""SELECT {days} FROM dim_date
                WHERE full_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
        ),
        "is_weekend": query(
            [ORDER_CALENDAR],
            """SELECT is_weekend, day_name, count(*) AS n FROM orders JOIN dim_date
               ON full_date = CAST(o_orderdate AS DATE) GROUP BY is_weekend, day_name""",
        ),
    }


def lookup_checks() -> dict[str, str]:
    line = "f.source_system, f.order_id, f.order_line_number"
    by_code = f"""SELECT f.order_id, f.order_line_number, f.currency_code, u.currency_key
        FROM stg_orders_1 f LEFT JOIN dim_currency_2 u ON {CURRENCY_ON}"""
    first_delivery = "SELECT DISTINCT * FROM lines WHERE order_status = 'F'"
    deliveries = [
        staged("orders"),
        """lines AS (SELECT source_system, order_id, order_line_number, order_status, quantity, net_amount
           FROM stg_orders_1)""",
    ]
    return {
        "lookup_inner": query(
            customer_ctes() + [staged("orders")],
            f"SELECT {line}, f.customer_id, c.customer_key FROM stg_orders_1 f JOIN dim_customer_2 c ON {CUSTOMER_ON}",
        ),
        "lookup_left": query(
            location_ctes() + employee_ctes() + [staged("orders")],
            f"""SELECT {line}, f.employee_id, e.employee_key FROM stg_orders_1 f
                LEFT JOIN dim_employee_2 e ON {EMPLOYEE_ON}""",
        ),
        "lookup_code": query(currency_ctes() + [staged("orders")], by_code),
        "salted_lookup": query(currency_ctes() + [staged("orders")], by_code),
        "lookup_location": query(
            location_ctes() + [staged("customer")],
            f"""SELECT f.source_system, f.customer_id, f.location_id, l.location_key FROM stg_customer_1 f
                LEFT JOIN dim_location_2 l ON {LOCATION_ON}""",
        ),
        "two_hop_lookup": query(
            address_customer_ctes("bank_customer") + [staged("account", 2), staged("bank_transactions")],
            """SELECT f.source_system, f.transaction_id, f.account_id, a.customer_id, c.customer_key
               FROM stg_bank_transactions_1 f
               JOIN stg_account_2 a ON a.account_id = f.account_id AND a.source_system = f.source_system
               JOIN dim_customer_2 c ON c.customer_id = a.customer_id AND c.source_system = a.source_system
                AND c.is_current""",
        ),
        "pick_keys": query(
            product_ctes(), "SELECT product_id, source_system, product_key FROM dim_product_2 WHERE is_current"
        ),
        "rename_prefix": query(
            [staged("customer")],
            "SELECT "
            + ", ".join(
                f"{c} AS cur_{c}"
                for c in cols("source_system customer_id location_id first_name last_name email phone customer_segment")
            )
            + " FROM stg_customer_1",
        ),
        "current_filter": query(
            location_ctes() + employee_ctes(),
            "SELECT employee_key, employee_id, job_title FROM dim_employee_2 WHERE is_current",
        ),
        "anti_not_exists": query(
            deliveries
            + [f"first_one AS ({first_delivery})"]
            + latest(
                "everything", "*", "lines", "source_system, order_id, order_line_number",
                "order_status quantity net_amount",
            ),
            """SELECT * FROM everything e WHERE NOT EXISTS (SELECT 1 FROM first_one f
               WHERE f.source_system = e.source_system AND f.order_id = e.order_id
                 AND f.order_line_number = e.order_line_number)""",
        ),
        "fact_append": query(
            [staged("orders")]
            + latest(
                "everything",
                "source_system, order_id, order_line_number, order_status, net_amount",
                "stg_orders_1",
                "source_system, order_id, order_line_number",
                "order_status net_amount",
            ),
            """SELECT *, CAST(CASE WHEN order_status = 'F' THEN 1 ELSE 2 END AS INTEGER) AS delivery
               FROM everything""",
        ),
    }


LINE_SHOWN = "date_key, customer_key, product_key, employee_key, location_key, currency_key, source_system"
MOVE_SHOWN = f"""date_key, customer_key, employee_key, location_key, currency_key, source_system, transaction_id,
    account_id, transaction_type, {number_of("transaction_amount", "running_balance")}"""


def fact_checks() -> dict[str, str]:
    orders = f"SELECT {LINE_SHOWN}, order_id, order_line_number, order_status, {AMOUNTS} FROM fact_orders"
    return {
        "fact_sales": query(sales_ctes(), f"SELECT {LINE_SHOWN}, sale_id, {AMOUNTS} FROM fact_sales"),
        "fact_orders": query(orders_ctes(), orders),
        "fact_transactions": query(transactions_ctes(), f"SELECT {MOVE_SHOWN} FROM fact_transactions"),
        "fact_transactions_banking": query(bank_transactions_ctes(), f"SELECT {MOVE_SHOWN} FROM fact_transactions"),
        "fact_claims": query(
            claims_ctes(),
            f"""SELECT date_key, patient_key, provider_key, source_system, claim_id, diagnosis_code, procedure_code,
                {number_of("claim_amount")}, claim_status, payer FROM fact_claims""",
        ),
        "fact_pharmacy": query(
            pharmacy_ctes(),
            f"""SELECT date_key, patient_key, provider_key, source_system, prescription_id, drug_name, ndc_code,
                {number_of("quantity", "cost")}, days_supply, pharmacy_name FROM fact_pharmacy""",
        ),
        "fact_orders_retail": query(retail_orders_ctes(), orders),
        "fact_inventory": query(
            inventory_ctes(),
            """SELECT CAST(snapshot_date_key AS INTEGER) AS snapshot_date_key, product_key, source_system, inventory_id,
                warehouse, quantity_on_hand, reorder_level, last_restock_date FROM fact_inventory""",
        ),
        "order_amounts": query(
            netted_ctes(),
            f"""SELECT order_id, customer_id, product_id,
                {number_of("quantity", "unit_price", "discount_pct", "discount_amount", "net_amount")},
                CAST(0 AS DOUBLE) AS tax_amount, CAST(1 AS INTEGER) AS order_line_number FROM netted""",
        ),
        "null_key_cols": query(
            retail_orders_ctes(),
            """SELECT employee_key, location_key, currency_key, count(*) AS n FROM fact_orders
               GROUP BY employee_key, location_key, currency_key""",
        ),
    }


def report_checks() -> dict[str, str]:
    def monthly(ctes: list[str], fact: str) -> str:
        return query(
            ctes + [ORDER_CALENDAR],
            f"""SELECT d.year_number, d.month_number, d.month_name, p.category, p.product_name, c.customer_segment,
                    CAST(sum(f.quantity) AS DOUBLE) AS total_quantity,
                    CAST(sum(f.net_amount) AS DOUBLE) AS total_net_amount
                FROM {fact} f JOIN dim_date d ON d.date_key = f.date_key
                JOIN dim_product_2 p ON p.product_key = f.product_key
                JOIN dim_customer_2 c ON c.customer_key = f.customer_key
                GROUP BY ALL""",
        )

    shown = f"SELECT {LINE_SHOWN}, sale_id, {AMOUNTS} FROM fact_sales"
    published = published_ctes()
    return {
        "vw_sales_summary": monthly(sales_ctes(), "fact_sales"),
        "vw_orders_summary": monthly(orders_ctes(), "fact_orders"),
        "sales_by_segment": query(
            published,
            """SELECT c.customer_segment, CAST(sum(f.net_amount) AS DOUBLE) AS total_net_amount,
                      count(*) AS transaction_count
               FROM fact_sales f JOIN dim_customer_2 c ON c.customer_key = f.customer_key AND c.is_current
               GROUP BY c.customer_segment""",
        ),
        "ext_view_dim": query(
            published,
            dim_select("dim_customer", "customer_key", ["customer_id", "source_system"], CUSTOMER_ATTRS)
            + " WHERE is_current",
        ),
        "ext_view_fact": query(published, shown),
        "expire_versions": query(
            published, dim_select("dim_customer", "customer_key", ["customer_id", "source_system"], CUSTOMER_ATTRS)
        ),
        "compact_cluster": query(deliveries_ctes(), shown),
        "compact_curve": query(deliveries_ctes(), shown + " WHERE date_key BETWEEN 19920101 AND 19961231"),
        "generic_delivery": query(published, shown),
        "analyze_table": query(published, " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count,
                       CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest FROM fact_sales"""
            for c in ("date_key", "customer_key", "employee_key", "quantity"))),
        "run_log": query(
            published,
            f"""SELECT 'load_dim_currency' AS procedure_name, 'SUCCESS' AS status,
                       (SELECT count(*) FROM dim_currency_1) AS rows_inserted, 0 AS rows_updated,
                       CAST(NULL AS VARCHAR) AS error_message
                UNION ALL SELECT 'load_dim_location', 'SUCCESS', (SELECT count(*) FROM dim_location_1), 0, NULL
                UNION ALL SELECT 'load_dim_customer', 'SUCCESS', (SELECT count(*) FROM dim_customer_1), 0, NULL
                UNION ALL SELECT 'load_dim_product', 'SUCCESS', (SELECT count(*) FROM dim_product_1), 0, NULL
                UNION ALL SELECT 'load_dim_employee', 'SUCCESS', (SELECT count(*) FROM dim_employee_1), 0, NULL
                UNION ALL SELECT 'load_fact_sales', 'SUCCESS', (SELECT count(*) FROM fact_sales), 0, NULL
                UNION ALL SELECT 'load_dim_customer', 'SUCCESS',
                    (SELECT count(*) FROM dim_customer_2 WHERE effective_date = {D2}),
                    (SELECT count(*) FROM dim_customer_2 WHERE NOT is_current), NULL""",
        ),
    }


def published_ctes() -> list[str]:
    """Sales against the dimensions of the first wave; customers loaded again with the first wave's locations."""
    looked_up = """SELECT s.source_system, s.customer_id, l.location_key, s.first_name, s.last_name, s.email, s.phone,
                          s.customer_segment
                   FROM stg_customer_{w} s LEFT JOIN dim_location_1 l
                     ON l.location_id = s.location_id AND l.source_system = s.source_system"""
    customers = both("customer") + scd2(
        "dim_customer", "customer_key", ["customer_id", "source_system"], CUSTOMER_ATTRS, CUSTOMER_ATTRS, looked_up
    )
    first_wave = LINE_JOINS
    for dim in cols("dim_customer dim_product dim_employee dim_location dim_currency"):
        first_wave = first_wave.replace(f"{dim}_2", f"{dim}_1")
    sales = sales_ctes()
    fact = sales[-1].replace(LINE_JOINS, first_wave)
    typed = sales[-4:-1]
    return location_ctes() + customers + product_ctes() + employee_ctes() + typed + [fact]


def deliveries_ctes() -> list[str]:
    """Sales delivered in two parts by currency. The second adds the sales the first did not load."""
    ctes = published_ctes()
    dims, typed, fact = ctes[:-3], ctes[-3:-1], ctes[-1]
    parts = []
    for number, part in ((1, "currency_code = 'EUR'"), (2, "currency_code IS DISTINCT FROM 'EUR'")):
        rows = [c.replace("sales AS (", f"sales_{number} AS (", 1) for c in typed[1:]]
        rows = [c.replace("FROM sales_typed)", f"FROM sales_typed WHERE {part})") for c in rows]
        loaded = fact.replace("fact_sales AS", f"delivery_{number} AS").replace("FROM sales f", f"FROM sales_{number} f")
        parts += rows + [loaded]
    both_parts = """fact_sales AS (SELECT * FROM delivery_1 UNION ALL SELECT * FROM delivery_2 d WHERE NOT EXISTS
        (SELECT 1 FROM delivery_1 e WHERE e.source_system = d.source_system AND e.sale_id = d.sale_id))"""
    return dims + typed[:1] + parts + [both_parts]


EVENT_MARKS = """marks AS (SELECT CAST(user_id AS VARCHAR) AS source_system, event_type AS object_name, max(ts) AS mark
    FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY ALL)"""


EARLY = "TIMESTAMP '2024-01-08'"


def metadata(until: str | None = None) -> str:
    return f"""SELECT CAST(user_id AS VARCHAR) AS source_system, event_type AS object_name,
        CAST(count(*) AS INTEGER) AS load_priority,
        CASE WHEN count(*) > 12 THEN 'INCREMENTAL' ELSE 'FULL' END AS load_type,
        'stg_' || event_type AS sink_table, max(value) > 90 AS is_active
        FROM events {"" if until is None else f"WHERE ts < {until}"} GROUP BY user_id, event_type"""


def control_checks() -> dict[str, str]:
    windows = """SELECT unnest([0, 5, 10]) AS back, ts, event_type, value FROM events"""
    window_start = "time_bucket(INTERVAL 5 MINUTE, ts) - back * INTERVAL 1 MINUTE"

    def alerts(measure: str, where: str, over: int) -> str:
        return f"""SELECT CAST(s AS VARCHAR) AS window_start, CAST(s + INTERVAL 15 MINUTE AS VARCHAR) AS window_end,
            {measure} AS measure FROM (SELECT {window_start} AS s, event_type, value FROM ({windows}) {where})
            GROUP BY s HAVING {measure} > {over}"""

    return {
        "load_plan": f"""SELECT source_system, object_name, load_priority, load_type, sink_table
            FROM ({metadata()}) WHERE is_active ORDER BY load_priority, object_name, source_system""",
        "active_filter": f"SELECT source_system, object_name FROM ({metadata()}) WHERE is_active",
        "seed_upsert": query(
            [
                f"early AS ({metadata(EARLY)})",
                f"whole AS ({metadata()})",
                "numbered AS (SELECT row_number() OVER (ORDER BY source_system, object_name) AS metadata_key, * FROM early)",
                f"""merged AS (
                    SELECT n.metadata_key, source_system, object_name, w.load_priority, w.load_type, w.sink_table,
                           n.is_active, {T1} AS created_date, {T2} AS updated_date
                    FROM numbered n JOIN whole w USING (source_system, object_name)
                    UNION ALL
                    SELECT (SELECT max(metadata_key) FROM numbered)
                             + row_number() OVER (ORDER BY w.source_system, w.object_name),
                           w.source_system, w.object_name, w.load_priority, w.load_type, w.sink_table, w.is_active,
                           {T2}, NULL
                    FROM whole w ANTI JOIN numbered n USING (source_system, object_name))""",
            ],
            f"""SELECT metadata_key, source_system, object_name, load_priority, load_type, sink_table, is_active,
                {text_of("created_date", "updated_date")} FROM merged""",
        ),
        "get_watermark": query(
            [EVENT_MARKS],
            """SELECT CAST(c_custkey AS VARCHAR) AS source_system, 'purchase' AS object_name,
                CAST(coalesce(mark, TIMESTAMP '1900-01-01') AS VARCHAR) AS last_watermark_value
                FROM customer LEFT JOIN marks ON source_system = CAST(c_custkey AS VARCHAR)
                 AND object_name = 'purchase'""",
        ),
        "set_watermark": query(
            [
                EVENT_MARKS,
                """later AS (SELECT CAST(user_id AS VARCHAR) AS source_system, event_type AS object_name, max(ts) AS mark
                   FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY ALL)""",
            ],
            """SELECT source_system, object_name, CAST(coalesce(l.mark, m.mark) AS VARCHAR) AS last_watermark_value,
                CASE WHEN l.mark IS NULL THEN '2024-01-15 06:00:00' ELSE '2024-02-15 06:00:00' END AS updated_date
                FROM marks m FULL JOIN later l USING (source_system, object_name)""",
        ),
        "watermark_column_filter": query(
            [EVENT_MARKS],
            """SELECT event_id, CAST(user_id AS VARCHAR) AS source_system, event_type AS object_name,
                CAST(ts AS VARCHAR) AS ts
                FROM events LEFT JOIN marks ON source_system = CAST(user_id AS VARCHAR) AND object_name = event_type
                WHERE mark IS NULL OR ts > mark""",
        ),
        "purge_logs": """SELECT event_id AS run_key, event_type AS procedure_name, CAST(ts AS VARCHAR) AS start_time,
            CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status, value
            FROM events WHERE ts >= TIMESTAMP '2024-04-15 12:00:00' - INTERVAL 90 DAY""",
        "stream_alerts": alerts("count(*)", "WHERE event_type = 'error'", 0),
        "stream_metric": alerts("CAST(sum(CAST(value AS DECIMAL(18,2))) / count(*) AS DOUBLE)", "", 80),
        "load_routing": f"""SELECT source_system, object_name,
            CASE WHEN load_type = 'INCREMENTAL' THEN 'incremental' ELSE 'full' END AS route
            FROM ({metadata()}) WHERE is_active""",
        "alert_windows": alerts("count(*)", "WHERE event_type = 'error'", 0),
        "alert_metric": alerts("CAST(sum(CAST(value AS DECIMAL(18,2))) / count(*) AS DOUBLE)", "", 80),
    }


def outcome_of(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'PASS' ELSE 'FAIL' END"


def check(name: str, target: str, result: str, expected: str, actual: str) -> str:
    return f"""SELECT '{name}' AS check_name, '{target}' AS object_name, {outcome_of(result)} AS check_result,
        CAST({expected} AS VARCHAR) AS expected_value, CAST({actual} AS VARCHAR) AS actual_value"""


def none_check(name: str, target: str, count: str) -> str:
    return check(name, target, f"({count}) = 0", "0", f"({count})")


def quality_checks() -> dict[str, str]:
    fact = orders_first_wave()
    moves = transactions_first_wave()
    natural = "source_system, order_id, order_line_number"
    staged_count = "(SELECT count(*) FROM stg_orders_1 WHERE order_id IS NOT NULL)"
    moved_count = "(SELECT count(*) FROM stg_transactions_1 WHERE transaction_id IS NOT NULL)"

    def row_count(target: str, expected: str) -> str:
        actual = f"(SELECT count(*) FROM {target})"
        return check("staging_vs_fact_row_count", target, f"{actual} >= {expected}", expected, actual)

    def required(target: str, keys: str, shown: str | None = None) -> str:
        missing = " OR ".join(f"{k} IS NULL" for k in keys.split())
        return none_check(
            "required_dimension_keys_not_null", shown or target, f"SELECT count(*) FROM {target} WHERE {missing}"
        )

    def repeated(table: str, where: str, keys: str) -> str:
        return f"SELECT count(*) FROM (SELECT 1 FROM {table} {where} GROUP BY {keys} HAVING count(*) > 1)"

    order_keys = "date_key customer_key product_key"
    return {
        "dq_row_count": query(fact, row_count("fact_orders", staged_count)),
        "dq_required_keys": query(
            fact,
            required("fact_orders", order_keys)
            + " UNION ALL "
            + required("fact_orders", "employee_key currency_key", "fact_orders.optional"),
        ),
        "dq_other_facts": query(
            fact + moves,
            " UNION ALL ".join(
                [
                    row_count("fact_orders", staged_count),
                    required("fact_orders", order_keys),
                    row_count("fact_transactions", moved_count),
                    required("fact_transactions", "date_key customer_key"),
                ]
            ),
        ),
        "dq_unique_natural": query(
            fact,
            none_check("natural_key_unique", "stg_orders", repeated("stg_orders_1", "", natural))
            + " UNION ALL "
            + none_check("natural_key_unique", "fact_orders", repeated("fact_orders", "", natural)),
        ),
        "dq_current_unique": query(
            customer_ctes(),
            none_check(
                "one_current_row_per_key",
                "dim_customer",
                repeated("dim_customer_2", "WHERE is_current", "customer_id, source_system"),
            ),
        ),
        "dq_orphans": query(
            fact,
            none_check(
                "orphaned_customer_key",
                "fact_orders",
                "SELECT count(*) FROM fact_orders WHERE customer_key NOT IN (SELECT customer_key FROM dim_customer_1)",
            )
            + " UNION ALL "
            + none_check(
                "orphaned_customer_id",
                "stg_orders",
                "SELECT count(*) FROM stg_orders_1 WHERE customer_id NOT IN (SELECT customer_id FROM stg_customer_1)",
            ),
        ),
        "dq_not_null": query(
            [staged("sales")],
            " UNION ALL ".join(
                none_check(f"not_null_{c}", "stg_sales", f"SELECT count(*) FROM stg_sales_1 WHERE {c} IS NULL")
                for c in cols("sale_id currency_code discount_amount tax_amount")
            ),
        ),
        "dq_count_reconcile": query(
            inventory_ctes(),
            " UNION ALL ".join(
                check("staged_equals_loaded", target, f"{a} = {b}", b, a)
                for target, b, a in (
                    ("fact_inventory", "(SELECT count(*) FROM stg_inventory_1)", "(SELECT count(*) FROM fact_inventory)"),
                    ("events", "(SELECT count(*) FROM events)", "(SELECT count(DISTINCT event_id) FROM events)"),
                )
            ),
        ),
    }


def on_first_wave(cte: str) -> str:
    for dim in cols("dim_customer dim_product dim_employee dim_location dim_currency"):
        cte = cte.replace(f"{dim}_2", f"{dim}_1")
    return cte


def orders_first_wave() -> list[str]:
    ctes = orders_ctes()
    return ctes[:-1] + [on_first_wave(ctes[-1])]


def transactions_first_wave() -> list[str]:
    """To follow ``orders_first_wave``, which brings the dimensions."""
    ctes = transactions_ctes()
    return [ctes[-2], on_first_wave(ctes[-1])]


def file_checks() -> dict[str, str]:
    line = "order_id, order_line_number, order_status, quantity, net_amount"
    stamp = "'2024-01-15 06:00:00'"
    customer = "source_system, customer_id, location_id, first_name, last_name, email, phone, customer_segment"
    return {
        "src_csv": query(
            [staged("orders")],
            f"""SELECT {line}, CAST(7 AS BIGINT) AS staging_batch_id, {stamp} AS staging_loaded_date,
                'TPCH' AS source_system FROM stg_orders_1""",
        ),
        "src_csv_infer": query(
            [staged("orders")],
            """SELECT CAST(order_id AS INTEGER) AS order_id, CAST(order_line_number AS INTEGER) AS order_line_number,
                order_status, quantity, 'int' AS order_id_type, 'int' AS order_line_number_type,
                'string' AS order_status_type, 'string' AS quantity_type, 'double' AS net_amount_type
                FROM stg_orders_1""",
        ),
        "lineage_cols": f"""SELECT 'orders.parquet' AS file_name, {stamp} AS _ingest_timestamp, count(*) AS n
            FROM orders""",
        "schema_evolve": query(
            [staged("orders")],
            f"SELECT {line}, CASE WHEN order_status <> 'F' THEN order_date END AS order_date FROM stg_orders_1",
        ),
        "incremental_gate": query(
            [staged("orders")],
            f"SELECT {line}, CAST(CASE WHEN order_status = 'F' THEN 1 ELSE 2 END AS INTEGER) AS run FROM stg_orders_1",
        ),
        "incremental_delivery": query(
            retail_product_ctes(),
            f"""SELECT 'load_dim_product' AS procedure_name, 'SUCCESS' AS status,
                    (SELECT count(*) FROM dim_product_1) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated
                UNION ALL SELECT 'load_dim_product', 'SUCCESS', count(*) FILTER (WHERE effective_date = {D2}),
                    count(*) FILTER (WHERE NOT is_current) FROM dim_product_2""",
        ),
        "sink_full": query([staged("customer", 2)], f"SELECT {customer} FROM stg_customer_2"),
        "sink_append": query(
            [staged("customer", 2)],
            f"""SELECT {customer}, CAST(2 AS BIGINT) AS staging_batch_id,
                '2024-02-15 06:00:00' AS staging_loaded_date FROM stg_customer_2""",
        ),
        **dict.fromkeys(("stream_bronze", "src_file_stream_cont"), f"""SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id,
            event_type, value, props, 'events.parquet' AS _ingest_file, {stamp} AS _ingest_timestamp FROM events"""),
        "sink_overwrite": """SELECT user_id, event_id, event_type, CAST(ts AS VARCHAR) AS ts FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
            FROM events WHERE event_type = 'purchase') WHERE rn = 1""",
        "stream_upsert_files": """SELECT user_id, event_type, event_id, CAST(ts AS VARCHAR) AS ts, value, files_a_batch
            FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                ORDER BY hour(ts) // 8, ts DESC, event_id DESC, value DESC) AS rn FROM events),
                 (VALUES (CAST(1 AS INTEGER)), (500)) AS v(files_a_batch) WHERE rn = 1""",
        "stream_upsert": """SELECT user_id, event_type, event_id, CAST(ts AS VARCHAR) AS ts, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                ORDER BY ts DESC, event_id DESC, value DESC) AS rn FROM events) WHERE rn = 1""",
    }


def oracle_sql() -> dict[str, str]:
    checks = (
        dim_checks, clean_checks, key_checks, lookup_checks, fact_checks, report_checks, control_checks,
        quality_checks, file_checks,
    )
    return {name: text for group in checks for name, text in group().items()}
