"""Specs of the generic warehouse: six dimensions and three facts."""

from __future__ import annotations

from starloom.functions import MONEY
from starloom.spec import DimSpec, FactSpec, Lookup

COORDINATE = "decimal(9,6)"


def by_id(dim: str, entity: str, required: bool = False, versioned: bool = True, source: str | None = None, salts: int = 1) -> Lookup:
    """Lookup of a dimension by its id and source system."""
    return Lookup(
        dim=dim,
        source=(source or f"{entity}_id", "source_system"),
        target=(f"{entity}_id", "source_system"),
        key=f"{entity}_key",
        required=required,
        current_only=versioned,
        salts=salts,
    )


TO_CUSTOMER = by_id("dim_customer", "customer", required=True, salts=16)
TO_PRODUCT = by_id("dim_product", "product", required=True, salts=16)
TO_EMPLOYEE = by_id("dim_employee", "employee")
TO_LOCATION = by_id("dim_location", "location", versioned=False)
TO_CURRENCY = Lookup("dim_currency", ("currency_code",), ("currency_code",), "currency_key", current_only=False)

SOURCE_SYSTEM = DimSpec(
    name="dim_source_system",
    key="source_system_key",
    natural_key=("source_system_code",),
    columns={"source_system_name": "string", "description": "string"},
    compare=("source_system_name", "description"),
    scd=1,
)

CURRENCY = DimSpec(
    name="dim_currency",
    key="currency_key",
    natural_key=("currency_code",),
    columns={"currency_name": "string", "symbol": "string"},
    compare=("currency_name", "symbol"),
    scd=1,
)

# A corrected address line 2 or coordinate alone is no change; it is written along with one.
LOCATION = DimSpec(
    name="dim_location",
    key="location_key",
    natural_key=("location_id", "source_system"),
    columns={
        "address_line1": "string",
        "address_line2": "string",
        "city": "string",
        "region": "string",
        "postal_code": "string",
        "country": "string",
        "latitude": COORDINATE,
        "longitude": COORDINATE,
    },
    compare=("address_line1", "city", "region", "postal_code", "country"),
    scd=1,
)

CUSTOMER_COLUMNS = {
    "location_key": "bigint",
    "first_name": "string",
    "last_name": "string",
    "email": "string",
    "phone": "string",
    "customer_segment": "string",
}

CUSTOMER = DimSpec(
    name="dim_customer",
    key="customer_key",
    natural_key=("customer_id", "source_system"),
    columns=CUSTOMER_COLUMNS,
    compare=tuple(CUSTOMER_COLUMNS),
    lookups=(TO_LOCATION,),
)

PRODUCT_COLUMNS = {
    "product_name": "string",
    "category": "string",
    "subcategory": "string",
    "brand": "string",
    "unit_price": MONEY,
    "unit_cost": MONEY,
    "currency_key": "bigint",
}

PRODUCT = DimSpec(
    name="dim_product",
    key="product_key",
    natural_key=("product_id", "source_system"),
    columns=PRODUCT_COLUMNS,
    compare=tuple(PRODUCT_COLUMNS),
    lookups=(TO_CURRENCY,),
)

EMPLOYEE = DimSpec(
    name="dim_employee",
    key="employee_key",
    natural_key=("employee_id", "source_system"),
    columns={
        "location_key": "bigint",
        "first_name": "string",
        "last_name": "string",
        "email": "string",
        "job_title": "string",
        "department": "string",
        "manager_employee_id": "string",
        "hire_date": "date",
        "termination_date": "date",
    },
    compare=(
        "location_key",
        "first_name",
        "last_name",
        "email",
        "job_title",
        "department",
        "manager_employee_id",
        "termination_date",
    ),
    lookups=(TO_LOCATION,),
)

_AMOUNTS = {
    "quantity": MONEY,
    "unit_price": MONEY,
    "discount_amount": MONEY,
    "tax_amount": MONEY,
    "net_amount": MONEY,
}
_LINE_LOOKUPS = (TO_CUSTOMER, TO_PRODUCT, TO_EMPLOYEE, TO_LOCATION, TO_CURRENCY)

SALES = FactSpec(
    name="fact_sales",
    key="sale_key",
    natural_key=("source_system", "sale_id"),
    columns={"source_system": "string", "sale_id": "string", **_AMOUNTS},
    lookups=_LINE_LOOKUPS,
    date_source="sale_date",
    zero=("discount_amount", "tax_amount"),
    required=("quantity", "unit_price", "net_amount"),
    latest_by=("sale_date",),
)

ORDER_COLUMNS = {
    "source_system": "string",
    "order_id": "string",
    "order_line_number": "int",
    "order_status": "string",
    **_AMOUNTS,
}

ORDERS = FactSpec(
    name="fact_orders",
    key="order_line_key",
    natural_key=("source_system", "order_id", "order_line_number"),
    columns=ORDER_COLUMNS,
    lookups=_LINE_LOOKUPS,
    date_source="order_date",
    zero=("discount_amount", "tax_amount"),
    required=("quantity", "unit_price", "net_amount"),
    latest_by=("order_date",),
)

TRANSACTION_COLUMNS = {
    "source_system": "string",
    "transaction_id": "string",
    "account_id": "string",
    "transaction_type": "string",
    "transaction_amount": MONEY,
    "running_balance": MONEY,
}

TRANSACTIONS = FactSpec(
    name="fact_transactions",
    key="transaction_key",
    natural_key=("source_system", "transaction_id"),
    columns=TRANSACTION_COLUMNS,
    lookups=(TO_CUSTOMER, TO_EMPLOYEE, TO_LOCATION, TO_CURRENCY),
    date_source="transaction_date",
    required=("account_id", "transaction_type", "transaction_amount"),
    latest_by=("transaction_date",),
)

# The source system, and object, place in the order and file of each load. Currencies come before all that look them up.
SOURCE = "CORE"
LOAD_PLAN = (
    ("source_system", 1, "source_system.csv"),
    ("currency", 1, "currency.csv"),
    ("location", 5, "location.csv"),
    ("customer", 10, "customer.csv"),
    ("product", 10, "product.csv"),
    ("employee", 10, "employee.csv"),
    ("sales", 30, "sales.csv"),
    ("orders", 30, "orders.csv"),
    ("transactions", 30, "transactions.csv"),
)
