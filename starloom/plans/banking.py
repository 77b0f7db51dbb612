"""Specs of the banking model."""

from __future__ import annotations

from dataclasses import replace

from starloom.functions import MONEY, RATE
from starloom.plans.generic import CUSTOMER, TO_CURRENCY, TO_CUSTOMER, TRANSACTION_COLUMNS
from starloom.spec import DimSpec, FactSpec, Lookup

SOURCE = "BANKING_CORE"

# The customer's own address is its location, so the lookup always matches.
TO_OWN_LOCATION = Lookup(
    "dim_location",
    ("customer_id", "source_system"),
    ("location_id", "source_system"),
    "location_key",
    required=True,
    current_only=False,
)
BANK_CUSTOMER = replace(CUSTOMER, lookups=(TO_OWN_LOCATION,))

# A new version of the customer has a new key, which makes a new version of its accounts.
ACCOUNT = DimSpec(
    name="dim_account",
    key="account_key",
    natural_key=("account_id", "source_system"),
    columns={
        "customer_key": "bigint",
        "account_type": "string",
        "account_status": "string",
        "open_date": "date",
        "currency_key": "bigint",
    },
    compare=("customer_key", "account_type", "account_status", "currency_key"),
    lookups=(TO_CUSTOMER, TO_CURRENCY),
)

# Only the status makes a new version; a loan keeps the customer key it was first given.
LOAN = DimSpec(
    name="dim_loan",
    key="loan_key",
    natural_key=("loan_id", "source_system"),
    columns={
        "customer_key": "bigint",
        "loan_type": "string",
        "principal_amount": MONEY,
        "interest_rate": RATE,
        "term_months": "int",
        "origination_date": "date",
        "status": "string",
    },
    compare=("status",),
    lookups=(TO_CUSTOMER,),
)

# The account already carries the customer key of its current version.
TO_ACCOUNT_OWNER = Lookup(
    "dim_account",
    ("account_id", "source_system"),
    ("account_id", "source_system"),
    "customer_key",
    required=True,
)

BANK_TRANSACTIONS = FactSpec(
    name="fact_transactions",
    key="transaction_key",
    natural_key=("source_system", "transaction_id"),
    columns=TRANSACTION_COLUMNS,
    sources={"transaction_amount": "amount"},
    lookups=(TO_ACCOUNT_OWNER, TO_CURRENCY),
    null_keys=("employee_key", "location_key"),
    date_source="transaction_date",
    required=("account_id", "transaction_type", "transaction_amount"),
    latest_by=("transaction_date",),
)

# The lakehouse form of the same dimensions keeps the parent's id in place of its key.
LAKE_ACCOUNT = DimSpec(
    name="dim_account",
    key="account_key",
    natural_key=("account_id", "source_system"),
    columns={
        "customer_id": "string",
        "account_type": "string",
        "account_status": "string",
        "currency_code": "string",
        "open_date": "date",
    },
    compare=("customer_id", "account_type", "account_status", "currency_code"),
)
LAKE_LOAN = DimSpec(
    name="dim_loan",
    key="loan_key",
    natural_key=("loan_id", "source_system"),
    columns={"customer_id": "string", **{c: t for c, t in LOAN.columns.items() if c != "customer_key"}},
    compare=("customer_id", "loan_type", "status"),
)

DIMS = (BANK_CUSTOMER, ACCOUNT, LOAN)
FACTS = (BANK_TRANSACTIONS,)

# Fixed values: (object, load priority, file) of the load plan; parents come before children.
LOAD_PLAN = (
    ("banking_customer", 10, "customers.csv"),
    ("banking_account", 20, "accounts.csv"),
    ("banking_loan", 20, "loans.csv"),
    ("banking_transaction", 30, "transactions.csv"),
)
