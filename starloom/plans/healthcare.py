"""Specs of the healthcare model."""

from __future__ import annotations

from starloom.functions import MONEY
from starloom.plans.generic import by_id
from starloom.spec import DimSpec, FactSpec, Lookup

SOURCE = "HEALTHCARE_CORE"

PATIENT = DimSpec(
    name="dim_patient",
    key="patient_key",
    natural_key=("patient_id", "source_system"),
    columns={
        "location_key": "bigint",
        "first_name": "string",
        "last_name": "string",
        "gender": "string",
        "date_of_birth": "date",
        "blood_type": "string",
        "email": "string",
        "phone": "string",
        "insurance_plan": "string",
    },
    compare=("location_key", "first_name", "last_name", "email", "phone", "insurance_plan"),
    lookups=(
        Lookup(
            "dim_location",
            ("patient_id", "source_system"),
            ("location_id", "source_system"),
            "location_key",
            required=True,
            current_only=False,
        ),
    ),
)

PROVIDER = DimSpec(
    name="dim_provider",
    key="provider_key",
    natural_key=("provider_id", "source_system"),
    columns={
        "first_name": "string",
        "last_name": "string",
        "specialty": "string",
        "npi_number": "string",
        "facility_name": "string",
        "city": "string",
        "region": "string",
        "phone": "string",
    },
    compare=("specialty", "facility_name", "city", "region", "phone"),
)

_LOOKUPS = (by_id("dim_patient", "patient", required=True), by_id("dim_provider", "provider", required=True))

CLAIMS = FactSpec(
    name="fact_claims",
    key="claim_key",
    natural_key=("source_system", "claim_id"),
    columns={
        "source_system": "string",
        "claim_id": "string",
        "diagnosis_code": "string",
        "procedure_code": "string",
        "claim_amount": MONEY,
        "claim_status": "string",
        "payer": "string",
    },
    lookups=_LOOKUPS,
    date_source="claim_date",
    required=("claim_amount",),
    latest_by=("claim_date",),
)

PHARMACY = FactSpec(
    name="fact_pharmacy",
    key="pharmacy_key",
    natural_key=("source_system", "prescription_id"),
    columns={
        "source_system": "string",
        "prescription_id": "string",
        "drug_name": "string",
        "ndc_code": "string",
        "quantity": MONEY,
        "days_supply": "int",
        "pharmacy_name": "string",
        "cost": MONEY,
    },
    lookups=_LOOKUPS,
    date_source="fill_date",
    required=("cost",),
    latest_by=("fill_date",),
)

DIMS = (PATIENT, PROVIDER)
FACTS = (CLAIMS, PHARMACY)

# Fixed values: (object, load priority, file) of the load plan.
LOAD_PLAN = (
    ("healthcare_patient", 10, "patients.csv"),
    ("healthcare_provider", 10, "providers.csv"),
    ("healthcare_claim", 20, "claims.csv"),
    ("healthcare_pharmacy", 20, "pharmacy.csv"),
)
