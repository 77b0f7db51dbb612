"""Specs of the retail model."""

from __future__ import annotations

from dataclasses import replace

from starloom.plans.banking import BANK_CUSTOMER
from starloom.plans.generic import ORDER_COLUMNS, PRODUCT, TO_CUSTOMER, TO_PRODUCT
from starloom.spec import FactSpec

SOURCE = "RETAIL_CORE"

# Same table and address rule as the bank's customers; the source system tells them apart.
RETAIL_CUSTOMER = BANK_CUSTOMER

# Retail products have no currency; the key column stays NULL.
RETAIL_PRODUCT = replace(
    PRODUCT,
    lookups=(),
    absent=("currency_key",),
    compare=tuple(c for c in PRODUCT.compare if c != "currency_key"),
)

RETAIL_ORDERS = FactSpec(
    name="fact_orders",
    key="order_line_key",
    natural_key=("source_system", "order_id", "order_line_number"),
    columns=ORDER_COLUMNS,
    lookups=(TO_CUSTOMER, TO_PRODUCT),
    null_keys=("employee_key", "location_key", "currency_key"),
    date_source="order_date",
    required=("quantity", "unit_price", "net_amount"),
    latest_by=("order_date",),
)

# The natural key has no date, so a later snapshot of the same item adds nothing.
INVENTORY = FactSpec(
    name="fact_inventory",
    key="inventory_key",
    natural_key=("source_system", "inventory_id"),
    columns={
        "source_system": "string",
        "inventory_id": "string",
        "warehouse": "string",
        "quantity_on_hand": "int",
        "reorder_level": "int",
        "last_restock_date": "date",
    },
    lookups=(TO_PRODUCT,),
    date_key="snapshot_date_key",
    required=("quantity_on_hand",),
    latest_by=("last_restock_date",),
)

DIMS = (RETAIL_CUSTOMER, RETAIL_PRODUCT)
FACTS = (RETAIL_ORDERS, INVENTORY)

# Fixed values: (object, load priority, file) of the load plan.
LOAD_PLAN = (
    ("retail_customer", 10, "customers.csv"),
    ("retail_product", 10, "products.csv"),
    ("retail_order", 20, "orders.csv"),
    ("retail_inventory", 20, "inventory.csv"),
)
