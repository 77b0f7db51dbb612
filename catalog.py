"""The registered queries: each operator run over the shared tables.

A query takes the session and a folder of parquet tables. It shows dates and
timestamps as text and decimals as doubles, so that results of two engines can
be compared value by value; the operators themselves keep the proper types.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import functions as fn
from starloom.operators import clean, control, facts, keys, lookups, marts, quality, scd
from starloom.operators.calendar import dim_date
from starloom.plans import banking, deliveries, generic, healthcare, retail
from starloom.plans.loads import Warehouse
from starloom.plans.shared_tables import SOURCE, STAMPS, read, stage
from starloom.session import materialize, scratch_dir
from starloom.sources import files, maintenance
from starloom.sources.tables import Layout
from starloom.spec import DimSpec, FactSpec, Lookup
from starloom.streaming import (
    read_alerts,
    stream_bronze,
    stream_failed_runs,
    stream_files,
    stream_metric,
    stream_upsert,
    write_windows,
)
from starloom.streaming.bronze import read_raw
from starloom.streaming.upsert import CleansedTable

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a query under a name; it runs in UTC and shows plain values."""

    def register(run: Query) -> Query:
        def registered(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return present(run(spark, sf_dir))

        _QUERIES[name] = registered
        return run

    return register


def present(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField):
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(field.name).cast("string").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- dimensions built from the staged waves ------------------------------------

GENERIC = {
    "dim_source_system": (generic.SOURCE_SYSTEM, "source_system"),
    "dim_currency": (generic.CURRENCY, "currency"),
    "dim_location": (generic.LOCATION, "location"),
    "dim_customer": (generic.CUSTOMER, "customer"),
    "dim_product": (generic.PRODUCT, "product"),
    "dim_employee": (generic.EMPLOYEE, "employee"),
}
BANKING = {
    "dim_location": (generic.LOCATION, ("bank_customer", "customer_id")),
    "dim_customer": (banking.BANK_CUSTOMER, "bank_customer"),
    "dim_currency": (generic.CURRENCY, "currency"),
    "dim_account": (banking.ACCOUNT, "account"),
    "dim_loan": (banking.LOAN, "loan"),
}
HEALTHCARE = {
    "dim_location": (generic.LOCATION, ("patient", "patient_id")),
    "dim_patient": (healthcare.PATIENT, "patient"),
    "dim_provider": (healthcare.PROVIDER, "provider"),
}
RETAIL = {
    "dim_location": (generic.LOCATION, ("retail_customer", "customer_id")),
    "dim_customer": (retail.RETAIL_CUSTOMER, "retail_customer"),
    "dim_product": (retail.RETAIL_PRODUCT, "retail_product"),
}


def staged_dim(spark: SparkSession, sf_dir: str, staging: str | tuple[str, str], wave: int) -> DataFrame:
    if isinstance(staging, str):
        return stage(spark, sf_dir, staging, wave)
    name, entity_id = staging
    return scd.location_from_entity(stage(spark, sf_dir, name, wave), entity_id)


_built: dict[tuple, DataFrame] = {}


def build_dims(spark: SparkSession, sf_dir: str, model: dict, names: list[str], waves: int = 2) -> dict[str, DataFrame]:
    """The named dimensions of a model and their parents, after the given number of waves.

    They are written once per session, like the published tables they stand for.
    """
    return {name: built_dim(spark, sf_dir, model, name, waves) for name in with_parents(model, names)}


def built_dim(spark: SparkSession, sf_dir: str, model: dict, name: str, wave: int) -> DataFrame:
    known = (spark.sparkContext.applicationId, sf_dir, id(model), name, wave)
    if known not in _built:
        _built[known] = materialize(merge_wave(spark, sf_dir, model, name, wave), name)
    return _built[known]


def merge_wave(spark: SparkSession, sf_dir: str, model: dict, name: str, wave: int) -> DataFrame:
    """A dimension after one more wave: its state before, and its parents as of this wave."""
    spec, staging = model[name]
    parents = {lk.dim: built_dim(spark, sf_dir, model, lk.dim, wave) for lk in spec.lookups}
    before = built_dim(spark, sf_dir, model, name, wave - 1) if wave > 1 else None
    source = scd.dim_source(staged_dim(spark, sf_dir, staging, wave), spec, parents)
    return scd.merge_dim(before, source, spec, STAMPS[wave])


def with_parents(model: dict, names: list[str]) -> list[str]:
    wanted = set(names)
    for name in reversed(list(model)):
        if name in wanted:
            wanted |= {lk.dim for lk in model[name][0].lookups}
    return [name for name in model if name in wanted]


def shown(dim: DataFrame) -> DataFrame:
    return dim.drop("created_by", "updated_by")


def register_dim(query_name: str, model: dict, dim: str) -> None:
    @query(query_name)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(merge_wave(spark, sf_dir, model, dim, 2))


for _name, _model, _dim in (
    ("scd1_source_system", GENERIC, "dim_source_system"),
    ("scd1_currency", GENERIC, "dim_currency"),
    ("scd1_location", GENERIC, "dim_location"),
    ("location_from_entity", BANKING, "dim_location"),
    ("scd2_customer", GENERIC, "dim_customer"),
    ("scd2_product", GENERIC, "dim_product"),
    ("scd2_employee", GENERIC, "dim_employee"),
    ("scd2_customer_banking", BANKING, "dim_customer"),
    ("scd2_account", BANKING, "dim_account"),
    ("scd2_loan", BANKING, "dim_loan"),
    ("scd2_patient", HEALTHCARE, "dim_patient"),
    ("scd2_provider", HEALTHCARE, "dim_provider"),
    ("scd2_customer_retail", RETAIL, "dim_customer"),
    ("scd2_product_retail", RETAIL, "dim_product"),
):
    register_dim(_name, _model, _dim)


def merge_customer_waves(spark: SparkSession, sf_dir: str, spec: DimSpec) -> tuple[DataFrame, DataFrame]:
    """Customers after the first wave, and the second wave as dimension rows."""
    first = build_dims(spark, sf_dir, GENERIC, ["dim_customer"], waves=1)
    source = scd.dim_source(stage(spark, sf_dir, "customer", 2), spec, first)
    return first["dim_customer"], source


@query("merge_counts")
def merge_counts(spark, sf_dir):
    target, source = merge_customer_waves(spark, sf_dir, generic.CUSTOMER)
    return scd.merge_counts(scd.scd2_changes(target, source, generic.CUSTOMER, STAMPS[2]))


@query("update_join")
def update_join(spark, sf_dir):
    target, source = merge_customer_waves(spark, sf_dir, generic.CUSTOMER)
    changes = scd.scd2_changes(target, source, generic.CUSTOMER, STAMPS[2])
    return changes.where(F.col(scd.ACTION) == scd.EXPIRE).select(
        "customer_id", "is_current", "effective_date", "expiry_date", "updated_date"
    )


@query("change_join")
def change_join(spark, sf_dir):
    target, source = merge_customer_waves(spark, sf_dir, generic.CUSTOMER)
    fresh = scd.new_or_changed(target, source, generic.CUSTOMER)
    return fresh.select("customer_id", "location_key", "phone", "customer_segment")


@query("anti_left_null")
def anti_left_null(spark, sf_dir):
    """Customers of the second wave without a current version in the first."""
    target, source = merge_customer_waves(spark, sf_dir, generic.CUSTOMER)
    natural = list(generic.CUSTOMER.natural_key)
    return source.join(lookups.current_filter(target).select(*natural), natural, "left_anti").select(*natural)


@query("change_predicate")
def change_predicate(spark, sf_dir):
    """Which customers count as changed when NULL differs from empty, and when it does not."""
    blank = F.coalesce("phone", F.lit(""))
    old = stage(spark, sf_dir, "customer", 1).select("customer_id", F.struct("phone", "customer_segment").alias("old"))
    new = stage(spark, sf_dir, "customer", 2).withColumn("phone", blank)
    new = new.select("customer_id", F.struct("phone", "customer_segment").alias("new"))
    columns = {"phone": "string", "customer_segment": "string"}
    return old.join(new, "customer_id").select(
        "customer_id",
        F.expr(fn.changed("old", "new", columns, columns)).alias("changed"),
        F.expr(fn.changed("old", "new", columns, columns, null_as_default=True)).alias("changed_null_as_empty"),
    )


@query("scd2_notebooks")
def scd2_notebooks(spark, sf_dir):
    """A dimension described on the spot: the lakehouse form of the accounts, with the customer's id."""
    spec, dim = banking.LAKE_ACCOUNT, None
    for wave in (1, 2):
        source = scd.dim_source(stage(spark, sf_dir, "account", wave), spec)
        dim = materialize(scd.scd2_merge(dim, source, spec, STAMPS[wave]), spec.name)
    return shown(dim)


# --- cleansing -----------------------------------------------------------------


def padded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw text: padded, and without a key where the priority is not specified."""
    pad = F.concat(F.lit("  "), F.col("o_orderstatus"), F.lit(" "))
    key = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.concat(F.lit(" "), F.col("o_orderkey").cast("string")))
    return read(spark, sf_dir, "orders").select(
        key.alias("order_id"), pad.alias("order_status"), "o_orderpriority", "o_totalprice"
    )


@query("conform_trim")
def conform_trim(spark, sf_dir):
    return clean.conform_trim(padded_orders(spark, sf_dir))


@query("drop_null_key")
def drop_null_key(spark, sf_dir):
    return clean.drop_null_key(padded_orders(spark, sf_dir), ["order_id"])


@query("dedup_latest")
def dedup_latest(spark, sf_dir):
    return clean.dedup_latest(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("conform")
def conform(spark, sf_dir):
    """The cleansed orders per customer: trimmed, keyed, the latest order of each."""
    rows = read(spark, sf_dir, "orders").select(
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("customer_id"),
        "o_orderdate",
        "o_orderkey",
        "o_orderstatus",
    )
    return clean.conform(rows, ["customer_id"], ["o_orderdate"])


@query("distinct_source")
def distinct_source(spark, sf_dir):
    return clean.distinct_source(stage(spark, sf_dir, "source_system", 2), ["source_system_code", "description"])


@query("typed_project")
def typed_project(spark, sf_dir):
    types = {
        "sale_id": "string",
        "sale_day": "date",
        "quantity": fn.MONEY,
        "unit_price": fn.MONEY,
        "line": "int",
        "discount_amount": fn.MONEY,
    }
    return clean.typed_project(
        stage(spark, sf_dir, "sales"), types, sources={"sale_day": "sale_date", "line": "location_id"}
    )


@query("default_zero")
def default_zero(spark, sf_dir):
    rows = stage(spark, sf_dir, "sales")
    return rows.select("sale_id", *[fn.default_zero(c).alias(c) for c in ("quantity", "discount_amount", "tax_amount")])


@query("rejects_split")
def rejects_split(spark, sf_dir):
    """Order lines that cannot be loaded, with the reason."""
    rejected = facts.rejected(resolve(spark, sf_dir, generic.ORDERS, "orders", GENERIC))
    return rejected.select("source_system", "order_id", "order_line_number", clean.REJECT)


@query("rejects_count")
def rejects_count(spark, sf_dir):
    """How many of the new order lines are accepted, and how many are rejected for each reason."""
    resolved = resolve(spark, sf_dir, generic.ORDERS, "orders", GENERIC)
    return resolved.groupBy(F.coalesce(clean.REJECT, F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n"))


@query("reject_partition")
def reject_partition(spark, sf_dir):
    """What became of order lines that come again damaged: every staged row is accepted, rejected or set aside."""
    resolved = resolve(spark, sf_dir, generic.ORDERS, "damaged_orders", GENERIC)
    return facts.batch_outcomes(stage(spark, sf_dir, "damaged_orders"), resolved)


# --- keys and calendar -----------------------------------------------------------


@query("date_key")
def date_key(spark, sf_dir):
    rows = stage(spark, sf_dir, "orders")
    return rows.select("order_id", "order_line_number", "order_date", fn.date_key("order_date").alias("date_key"))


@query("snapshot_key")
def snapshot_key(spark, sf_dir):
    key = fn.snapshot_key(STAMPS[1].load_date).alias("snapshot_date_key")
    return stage(spark, sf_dir, "inventory").select("inventory_id", key)


@query("surrogate_keys")
def surrogate_keys(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_custkey")
    return keys.surrogate_keys(orders, "order_sk", ["o_orderdate", "o_orderkey"], start=1000)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over the span of the orders."""
    span = read(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date"))
    first, last = span.first()
    return dim_date(spark, first, last)


@query("dim_date")
def dim_date_query(spark, sf_dir):
    return calendar(spark, sf_dir)


@query("dim_date_missing")
def dim_date_missing(spark, sf_dir):
    """Only the days of the span on which nothing was ordered."""
    days = calendar(spark, sf_dir)
    ordered = read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("full_date")).distinct()
    first, last = days.agg(F.min("full_date"), F.max("full_date")).first()
    return dim_date(spark, first, last, existing=ordered)


# --- lookups ---------------------------------------------------------------------


@query("lookup_inner")
def lookup_inner(spark, sf_dir):
    dims = build_dims(spark, sf_dir, GENERIC, ["dim_customer"])
    rows = stage(spark, sf_dir, "orders").select("source_system", "order_id", "order_line_number", "customer_id")
    return lookups.lookup_key(rows, dims["dim_customer"], generic.TO_CUSTOMER)


@query("lookup_left")
def lookup_left(spark, sf_dir):
    dims = build_dims(spark, sf_dir, GENERIC, ["dim_employee"])
    rows = stage(spark, sf_dir, "orders").select("source_system", "order_id", "order_line_number", "employee_id")
    return lookups.lookup_key(rows, dims["dim_employee"], generic.TO_EMPLOYEE)


@query("lookup_code")
def lookup_code(spark, sf_dir):
    dims = build_dims(spark, sf_dir, GENERIC, ["dim_currency"])
    rows = stage(spark, sf_dir, "orders").select("order_id", "order_line_number", "currency_code")
    return lookups.lookup_key(rows, dims["dim_currency"], generic.TO_CURRENCY)


@query("lookup_location")
def lookup_location(spark, sf_dir):
    dims = build_dims(spark, sf_dir, GENERIC, ["dim_location"])
    rows = stage(spark, sf_dir, "customer").select("source_system", "customer_id", "location_id")
    return lookups.lookup_key(rows, dims["dim_location"], generic.TO_LOCATION)


@query("salted_lookup")
def salted_lookup(spark, sf_dir):
    """Order lines to currencies: a handful of codes hold all rows, and a third has none."""
    dims = build_dims(spark, sf_dir, GENERIC, ["dim_currency"])
    rows = stage(spark, sf_dir, "orders").select("order_id", "order_line_number", "currency_code")
    return lookups.salted_lookup(rows, dims["dim_currency"], generic.TO_CURRENCY, ["order_id", "order_line_number"])


@query("two_hop_lookup")
def two_hop_lookup(spark, sf_dir):
    """Transaction to account, then the account's customer id to the customer."""
    dims = build_dims(spark, sf_dir, BANKING, ["dim_customer"])
    accounts = stage(spark, sf_dir, "account", 2).select("account_id", "source_system", "customer_id")
    owner = Lookup("account", ("account_id", "source_system"), ("account_id", "source_system"), "customer_id",
                   required=True, current_only=False)
    rows = stage(spark, sf_dir, "bank_transactions").select("source_system", "transaction_id", "account_id")
    rows = lookups.lookup_key(rows, accounts, owner)
    return lookups.lookup_key(rows, dims["dim_customer"], generic.TO_CUSTOMER)


@query("pick_keys")
def pick_keys(spark, sf_dir):
    dims = build_dims(spark, sf_dir, GENERIC, ["dim_product"])
    picked = lookups.pick_keys(dims["dim_product"], generic.TO_PRODUCT)
    return picked.withColumnsRenamed({"_on_product_id": "product_id", "_on_source_system": "source_system"})


@query("rename_prefix")
def rename_prefix(spark, sf_dir):
    return lookups.rename_prefix(stage(spark, sf_dir, "customer"), "cur_")


@query("current_filter")
def current_filter(spark, sf_dir):
    dims = build_dims(spark, sf_dir, GENERIC, ["dim_employee"])
    return lookups.current_filter(dims["dim_employee"]).select("employee_key", "employee_id", "job_title")


@query("anti_not_exists")
def anti_not_exists(spark, sf_dir):
    """Order lines of a second delivery that the first, of the finished orders, did not bring."""
    lines = stage(spark, sf_dir, "orders").select(
        "source_system", "order_id", "order_line_number", "order_status", "quantity", "net_amount"
    )
    natural = ["source_system", "order_id", "order_line_number"]
    loaded = facts.fact_append(None, lines.where("order_status = 'F'"), natural)
    return facts.fact_append(loaded, lines, natural)


# --- facts -----------------------------------------------------------------------


def resolve(
    spark: SparkSession, sf_dir: str, spec: FactSpec, staging: str, model: dict, waves: int = 2, prepare=None
) -> DataFrame:
    dims = build_dims(spark, sf_dir, model, [lk.dim for lk in spec.lookups], waves)
    staged = stage(spark, sf_dir, staging)
    staged = staged if prepare is None else prepare(staged)
    return facts.resolve_facts(staged, spec, dims, STAMPS[waves])


def register_fact(
    query_name: str, spec: FactSpec, staging: str, model: dict, waves: int = 2, prepare=None
) -> None:
    @query(query_name)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return facts.accepted(resolve(spark, sf_dir, spec, staging, model, waves, prepare), spec)


register_fact("fact_sales", generic.SALES, "sales", GENERIC)
register_fact("fact_orders", generic.ORDERS, "orders", GENERIC)
register_fact("fact_transactions", generic.TRANSACTIONS, "transactions", GENERIC)
register_fact("fact_transactions_banking", banking.BANK_TRANSACTIONS, "bank_transactions", BANKING)
register_fact("fact_claims", healthcare.CLAIMS, "claims", HEALTHCARE, waves=1)
register_fact("fact_pharmacy", healthcare.PHARMACY, "pharmacy", HEALTHCARE, waves=1)
register_fact("fact_orders_retail", retail.RETAIL_ORDERS, "retail_orders", RETAIL, waves=1, prepare=facts.order_amounts)
register_fact("fact_inventory", retail.INVENTORY, "inventory", RETAIL, waves=1)


@query("fact_append")
def fact_append(spark, sf_dir):
    """Cleansed order lines appended in two deliveries, the second of which repeats the first."""
    lines = stage(spark, sf_dir, "orders").select(
        "source_system", "order_id", "order_line_number", "order_status", "net_amount"
    )
    natural = ["source_system", "order_id", "order_line_number"]
    first = materialize(facts.fact_append(None, lines.where("order_status = 'F'"), natural), "first_delivery")
    second = facts.fact_append(first, lines, natural)
    return first.withColumn("delivery", F.lit(1)).unionByName(second.withColumn("delivery", F.lit(2)))


@query("order_amounts")
def order_amounts(spark, sf_dir):
    priced = facts.order_amounts(stage(spark, sf_dir, "retail_orders"))
    return priced.select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "discount_pct", "discount_amount",
        "tax_amount", "net_amount", "order_line_number",
    )


@query("null_key_cols")
def null_key_cols(spark, sf_dir):
    """The keys of retail order lines: those this source lacks are NULL."""
    resolved = resolve(
        spark, sf_dir, retail.RETAIL_ORDERS, "retail_orders", RETAIL, waves=1, prepare=facts.order_amounts
    )
    lines = facts.accepted(resolved, retail.RETAIL_ORDERS)
    return lines.groupBy("employee_key", "location_key", "currency_key").agg(F.count("*").alias("n"))


# --- reporting -------------------------------------------------------------------


def summary(spark: SparkSession, sf_dir: str, spec: FactSpec, staging: str) -> DataFrame:
    dims = build_dims(spark, sf_dir, GENERIC, [lk.dim for lk in spec.lookups])
    needed = ["date_key", "product_key", "customer_key", "quantity", "net_amount"]
    fact = facts.load_facts(stage(spark, sf_dir, staging), spec, dims, STAMPS[2], columns=needed)
    return marts.monthly_summary(fact, calendar(spark, sf_dir), dims["dim_product"], dims["dim_customer"])


@query("vw_sales_summary")
def vw_sales_summary(spark, sf_dir):
    return summary(spark, sf_dir, generic.SALES, "sales")


@query("vw_orders_summary")
def vw_orders_summary(spark, sf_dir):
    return summary(spark, sf_dir, generic.ORDERS, "orders")


_published: dict[tuple, Warehouse] = {}


def published_sales(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Sales and their dimensions published after the first wave, customers once more after the second."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _published:
        house = Warehouse(spark, fresh_folder(spark, "warehouse"))
        dims: dict[str, DataFrame] = {}
        for name in ("dim_currency", "dim_location", "dim_customer", "dim_product", "dim_employee"):
            spec, staging = GENERIC[name]
            house.load_dim(stage(spark, sf_dir, staging, 1), spec, STAMPS[1], dims)
            dims[name] = house.dim(spec).current()
        house.load_fact(stage(spark, sf_dir, "sales"), generic.SALES, STAMPS[1], dims)
        house.load_dim(stage(spark, sf_dir, "customer", 2), generic.CUSTOMER, STAMPS[2], dims)
        _published[known] = house
    return _published[known]


@query("sales_by_segment")
def sales_by_segment(spark, sf_dir):
    """Facts loaded with a version that has expired since drop out."""
    house = published_sales(spark, sf_dir)
    return marts.sales_by_segment(house.fact(generic.SALES).read(), house.dim(generic.CUSTOMER).read())


@query("ext_view_dim")
def ext_view_dim(spark, sf_dir):
    """Current customers read in place from the published files."""
    house = published_sales(spark, sf_dir)
    return shown(lookups.current_filter(house.dim(generic.CUSTOMER).read()))


@query("ext_view_fact")
def ext_view_fact(spark, sf_dir):
    """Published sales read in place."""
    house = published_sales(spark, sf_dir)
    return house.fact(generic.SALES).read().drop("sale_key", "created_date")


def compacted_sales(spark: SparkSession, sf_dir: str, column: str | list[str] | None = None) -> Warehouse:
    """Sales of two deliveries, compacted."""
    dims = build_dims(spark, sf_dir, GENERIC, [lk.dim for lk in generic.SALES.lookups], waves=1)
    house = Warehouse(spark, fresh_folder(spark, "compact"))
    sales = stage(spark, sf_dir, "sales")
    house.load_fact(sales.where("currency_code = 'EUR'"), generic.SALES, STAMPS[1], dims)
    house.load_fact(sales.where("currency_code IS DISTINCT FROM 'EUR'"), generic.SALES, STAMPS[2], dims)
    maintenance.compact_cluster(house.fact(generic.SALES), ["sale_id"], STAMPS[2].load_ts, column=column)
    return house


@query("compact_cluster")
def compact_cluster(spark, sf_dir):
    """Sales of two deliveries after compaction: the same rows in one load, clustered by date."""
    return compacted_sales(spark, sf_dir).fact(generic.SALES).read().drop("sale_key", "created_date")


@query("compact_curve")
def compact_curve(spark, sf_dir):
    """Sales of two deliveries compacted along a curve through date and customer, read by the statistics of their files."""
    house = compacted_sales(spark, sf_dir, ["date_key", "customer_key"])
    table = house.fact(generic.SALES)
    maintenance.analyze_files(table, ["date_key", "customer_key"])
    return table.current(where={"date_key": (19920101, 19961231), "customer_key": (1, 2**62)}).drop("sale_key", "created_date")


@query("analyze_table")
def analyze_table(spark, sf_dir):
    """Statistics of the files of the published sales, put together for the table."""
    table = published_sales(spark, sf_dir).fact(generic.SALES)
    columns = ["date_key", "customer_key", "employee_key", "quantity"]
    maintenance.analyze_files(table, columns)
    return maintenance.table_statistics(table, columns)


@query("generic_delivery")
def generic_delivery(spark, sf_dir):
    """Sales delivered with their dimensions as files, currencies first, by the seeded load plan."""
    house, root = Warehouse(spark, fresh_folder(spark, "core")), fresh_folder(spark, "core-files")
    for name, _, file in generic.LOAD_PLAN:
        rows = stage(spark, sf_dir, name, 1)
        rows.select(*deliveries.GENERIC.objects[name].columns).write.options(**files.CSV, compression="gzip").csv(f"{root}/{deliveries.GENERIC.folder}/{file}")
    deliveries.load_delivery(house, deliveries.GENERIC, root, STAMPS[1], 1)
    return house.fact(generic.SALES).read().drop("sale_key", "created_date")


# --- control ---------------------------------------------------------------------


def metadata_rows(spark: SparkSession, sf_dir: str, until: dt.datetime | None = None) -> DataFrame:
    """A load-plan row per user and event type, standing for source system and object."""
    events = read(spark, sf_dir, "events")
    events = events if until is None else events.where(F.col("ts") < F.lit(until))
    text = F.lit(None).cast("string")
    return events.groupBy(
        F.col("user_id").cast("string").alias("source_system"), F.col("event_type").alias("object_name")
    ).agg(
        F.count("*").cast("int").alias("load_priority"),
        F.when(F.count("*") > 12, F.lit("INCREMENTAL")).otherwise(F.lit("FULL")).alias("load_type"),
        F.lit("raw").alias("source_container"),
        F.first("event_type").alias("source_folder_path"),
        F.concat(F.first("event_type"), F.lit(".csv")).alias("source_file_name"),
        F.lit("ts").alias("watermark_column"),
        F.lit("staging").alias("sink_schema"),
        F.concat(F.lit("stg_"), F.first("event_type")).alias("sink_table"),
        text.alias("load_procedure_name"),
        (F.max("value") > 90).alias("is_active"),
    )


@query("load_plan")
def load_plan(spark, sf_dir):
    plan = control.load_plan(metadata_rows(spark, sf_dir))
    return plan.select("source_system", "object_name", "load_priority", "load_type", "sink_table")


@query("active_filter")
def active_filter(spark, sf_dir):
    return control.active_filter(metadata_rows(spark, sf_dir)).select("source_system", "object_name")


@query("seed_upsert")
def seed_upsert(spark, sf_dir):
    """Metadata seeded from half a month, then from the whole: known rows overwritten, new ones added."""
    spec = control.PIPELINE_METADATA
    first = scd.scd1_merge(None, metadata_rows(spark, sf_dir, dt.datetime(2024, 1, 8)), spec, STAMPS[1])
    return scd.scd1_merge(materialize(first, spec.name), metadata_rows(spark, sf_dir), spec, STAMPS[2]).select(
        "metadata_key", "source_system", "object_name", "load_priority", "load_type", "sink_table", "is_active",
        "created_date", "updated_date",
    )


MIDDLE = dt.datetime(2024, 1, 16)


def marks_until(spark: SparkSession, sf_dir: str, until: dt.datetime) -> DataFrame:
    """High-water marks per user and event type, as of a time."""
    events = read(spark, sf_dir, "events").where(F.col("ts") < F.lit(until))
    mark = F.max("ts").cast("timestamp").alias("last_watermark_value")
    return events.groupBy(
        F.col("user_id").cast("string").alias("source_system"), F.col("event_type").alias("object_name")
    ).agg(mark, F.lit(STAMPS[1].load_ts.isoformat(sep=" ")).cast("timestamp").alias("updated_date"))


@query("get_watermark")
def get_watermark(spark, sf_dir):
    """The purchase mark of every customer; those without purchases get the default."""
    requests = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("source_system"), F.lit("purchase").alias("object_name")
    )
    return control.get_watermarks(requests, marks_until(spark, sf_dir, MIDDLE))


@query("set_watermark")
def set_watermark(spark, sf_dir):
    """Marks of the first half of the month, then set from the second; users without a later event of a type keep their mark."""
    later = read(spark, sf_dir, "events").where(F.col("ts") >= F.lit(MIDDLE))
    updates = later.select(
        F.col("user_id").cast("string").alias("source_system"),
        F.col("event_type").alias("object_name"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    return control.set_watermarks(
        marks_until(spark, sf_dir, MIDDLE), control.next_watermarks(updates, "ts"), STAMPS[2]
    )


@query("watermark_column_filter")
def watermark_column_filter(spark, sf_dir):
    """Events past the mark of their user and type."""
    rows = read(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("source_system"),
        F.col("event_type").alias("object_name"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    return control.above_watermarks(rows, "ts", marks_until(spark, sf_dir, MIDDLE))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a run log: an error is a failed run."""
    status = F.when(F.col("event_type") == "error", F.lit("FAILED")).otherwise(F.lit("SUCCESS"))
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_key"),
        F.col("event_type").alias("procedure_name"),
        F.col("ts").cast("timestamp").alias("start_time"),
        status.alias("status"),
        "value",
    )


@query("purge_logs")
def purge_logs(spark, sf_dir):
    return control.purge_logs(runs(spark, sf_dir), "start_time", dt.datetime(2024, 4, 15, 12), 90)


@query("alert_windows")
def alert_windows(spark, sf_dir):
    return control.failed_run_alerts(runs(spark, sf_dir), "start_time")


@query("alert_metric")
def alert_metric(spark, sf_dir):
    exact = runs(spark, sf_dir).withColumn("value", F.col("value").cast("decimal(18,2)"))
    return control.metric_alerts(exact, "start_time", "value")


# --- quality ---------------------------------------------------------------------


def checked_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Staged order lines, the fact built from them, and its dimensions."""
    dims = build_dims(spark, sf_dir, GENERIC, [lk.dim for lk in generic.ORDERS.lookups], waves=1)
    staged = stage(spark, sf_dir, "orders")
    return staged, facts.load_facts(staged, generic.ORDERS, dims, STAMPS[1]), dims


@query("dq_row_count")
def dq_row_count(spark, sf_dir):
    staged, fact, _ = checked_orders(spark, sf_dir)
    return quality.dq_row_count(staged, fact, "order_id", "fact_orders")


@query("dq_required_keys")
def dq_required_keys(spark, sf_dir):
    _, fact, _ = checked_orders(spark, sf_dir)
    return quality.dq_required_keys(fact, ["date_key", "customer_key", "product_key"], "fact_orders").unionByName(
        quality.dq_required_keys(fact, ["employee_key", "currency_key"], "fact_orders.optional")
    )


@query("dq_other_facts")
def dq_other_facts(spark, sf_dir):
    """The two standard checks on orders and on transactions."""
    staged, fact, dims = checked_orders(spark, sf_dir)
    moves = stage(spark, sf_dir, "transactions")
    moved = facts.load_facts(moves, generic.TRANSACTIONS, dims, STAMPS[1])
    return quality.validate_facts(
        {
            "fact_orders": (staged, fact, "order_id", ["date_key", "customer_key", "product_key"]),
            "fact_transactions": (moves, moved, "transaction_id", ["date_key", "customer_key"]),
        }
    )


@query("dq_unique_natural")
def dq_unique_natural(spark, sf_dir):
    """The staged lines repeat keys, the fact does not."""
    staged, fact, _ = checked_orders(spark, sf_dir)
    natural = list(generic.ORDERS.natural_key)
    return quality.dq_unique_natural(staged, natural, "stg_orders").unionByName(
        quality.dq_unique_natural(fact, natural, "fact_orders")
    )


@query("dq_current_unique")
def dq_current_unique(spark, sf_dir):
    dim = build_dims(spark, sf_dir, GENERIC, ["dim_customer"])["dim_customer"]
    return quality.dq_current_unique(dim, list(generic.CUSTOMER.natural_key), "dim_customer")


@query("dq_orphans")
def dq_orphans(spark, sf_dir):
    """Keys of the fact against the customers, and lines staged for customers not staged."""
    staged, fact, dims = checked_orders(spark, sf_dir)
    known = quality.dq_orphans(fact, dims["dim_customer"], "customer_key", "fact_orders")
    ids = stage(spark, sf_dir, "customer", 1)
    return known.unionByName(quality.dq_orphans(staged, ids, "customer_id", "stg_orders"))


@query("dq_not_null")
def dq_not_null(spark, sf_dir):
    return quality.dq_not_null(
        stage(spark, sf_dir, "sales"), ["sale_id", "currency_code", "discount_amount", "tax_amount"], "stg_sales"
    )


@query("dq_count_reconcile")
def dq_count_reconcile(spark, sf_dir):
    """Exact counts: inventory loads whole but for unknown products, the bank's transactions load whole."""
    dims = build_dims(spark, sf_dir, RETAIL, ["dim_product"], waves=1)
    items = stage(spark, sf_dir, "inventory")
    loaded = facts.load_facts(items, retail.INVENTORY, dims, STAMPS[1])
    once = clean.dedup_latest(read(spark, sf_dir, "events"), ["event_id"])
    return quality.dq_count_reconcile(items, loaded, "fact_inventory").unionByName(
        quality.dq_count_reconcile(read(spark, sf_dir, "events"), once, "events")
    )


# --- files and streams -------------------------------------------------------------

ORDER_COLUMNS = ("order_id", "order_line_number", "order_status", "quantity", "net_amount")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def landed_csv(spark: SparkSession, sf_dir: str, status: str | None, folder: str, *extra: str) -> str:
    """Staged order lines written as delimited files, as a source system would."""
    lines = stage(spark, sf_dir, "orders")
    lines = lines if status is None else lines.where(F.col("order_status") == status)
    lines.select(*extra, *ORDER_COLUMNS).write.mode("append").options(**files.CSV).csv(folder)
    return folder


@query("src_csv")
def src_csv(spark, sf_dir):
    """Order lines written as delimited files, scanned back and stamped."""
    folder = landed_csv(spark, sf_dir, None, fresh_folder(spark, "csv"))
    rows = files.stage_stamp(files.read_csv(spark, folder, ORDER_COLUMNS), SOURCE, 7, STAMPS[1])
    return rows


@query("src_csv_infer")
def src_csv_infer(spark, sf_dir):
    """The types a scan would guess: numbers with an unreadable value among them stay text."""
    folder = landed_csv(spark, sf_dir, None, fresh_folder(spark, "infer"))
    rows = files.read_inferred(spark, folder)
    kinds = [F.lit(f.dataType.simpleString()).alias(f"{f.name}_type") for f in rows.schema.fields]
    return rows.select("order_id", "order_line_number", "order_status", "quantity", *kinds)


@query("lineage_cols")
def lineage_cols(spark, sf_dir):
    """Rows per ingested file."""
    rows = files.with_lineage(spark.read.parquet(f"{sf_dir}/orders.parquet"), STAMPS[1])
    name = F.element_at(F.split(files.LINEAGE_FILE, "/"), -1).alias("file_name")
    return rows.groupBy(name, files.LINEAGE_TIME).agg(F.count("*").alias("n"))


@query("schema_evolve")
def schema_evolve(spark, sf_dir):
    """Three deliveries, the later ones with a new column in front: matched by name, NULL where absent."""
    folder = fresh_folder(spark, "evolve")
    landed_csv(spark, sf_dir, "F", f"{folder}/a")
    landed_csv(spark, sf_dir, "O", f"{folder}/b", "order_date")
    landed_csv(spark, sf_dir, "P", f"{folder}/c", "order_date")
    listed = files.list_files(spark, f"{folder}/*/*.csv")
    rows = files.read_evolving(spark, sorted(r.path for r in listed.select("path").toLocalIterator()))
    return rows.drop(files.LINEAGE_FILE, files.LINEAGE_TIME)


@query("incremental_gate")
def incremental_gate(spark, sf_dir):
    """The first run takes what is there, the second only what has come since, the third nothing."""
    folder = fresh_folder(spark, "gate")
    landed_csv(spark, sf_dir, "F", folder)
    rows, mark = files.incremental_gate(spark, folder, ORDER_COLUMNS, control.NEVER)
    first = materialize(rows.withColumn("run", F.lit(1)), "gate_1")
    landed_csv(spark, sf_dir, "O", folder)
    landed_csv(spark, sf_dir, "P", folder)
    rows, mark = files.incremental_gate(spark, folder, ORDER_COLUMNS, mark)
    second = materialize(rows.withColumn("run", F.lit(2)), "gate_2")
    if files.incremental_gate(spark, folder, ORDER_COLUMNS, mark) is not None:
        raise RuntimeError("the gate let old files through")
    return first.unionByName(second)


@query("incremental_delivery")
def incremental_delivery(spark, sf_dir):
    """Products delivered, looked at again unchanged, and delivered anew: the loads that were run."""
    house, root = Warehouse(spark, fresh_folder(spark, "incremental")), fresh_folder(spark, "delivered")
    shop = deliveries.RETAIL
    plan = deliveries.metadata_rows(spark, shop).where("object_name = 'retail_product'")
    plan = plan.withColumn("load_type", F.lit("INCREMENTAL"))
    columns = shop.objects["retail_product"].columns
    for batch, wave in enumerate((1, None, 2), 1):
        if wave:
            rows = stage(spark, sf_dir, "retail_product", wave).withColumn("created_date", F.lit("2024-01-01"))
            rows.select(*columns).write.mode("append").options(**files.CSV).csv(f"{root}/{shop.folder}/products.csv")
        deliveries.load_delivery(house, shop, root, STAMPS[wave or 1], batch, plan)
    return house.runs().select("procedure_name", "status", "rows_inserted", "rows_updated")


@query("sink_full")
def sink_full(spark, sf_dir):
    """A staging table loaded twice in full holds the second snapshot."""
    path = fresh_folder(spark, "full")
    for wave in (1, 2):
        files.sink_full(stage(spark, sf_dir, "customer", wave), path)
    return spark.read.parquet(path)


@query("sink_append")
def sink_append(spark, sf_dir):
    """A staging table that accumulates two batches, and the rows of the second one."""
    path = fresh_folder(spark, "append")
    for wave in (1, 2):
        rows = files.stage_stamp(stage(spark, sf_dir, "customer", wave), SOURCE, wave, STAMPS[wave])
        files.sink_append(rows, path)
    return files.current_batch(spark.read.parquet(path), 2)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    return stream_files(spark, sf_dir, schema, "parquet", STAMPS[1], pattern="events.parquet")


@query("stream_bronze")
def stream_bronze_query(spark, sf_dir):
    """Events drained into a raw table; a second run of the same stream adds nothing."""
    path, checkpoint = fresh_folder(spark, "bronze"), fresh_folder(spark, "bronze-checkpoint")
    for _ in range(2):
        stream_bronze(event_stream(spark, sf_dir), path, checkpoint).awaitTermination()
    raw = read_raw(spark, path).drop(files.ARRIVAL)
    return raw.withColumn(files.LINEAGE_FILE, F.element_at(F.split(files.LINEAGE_FILE, "/"), -1))


@query("src_file_stream_cont")
def src_file_stream_cont(spark, sf_dir):
    """Events taken by a stream that runs on, a micro-batch every second, until all files that are there have been taken."""
    path, checkpoint = fresh_folder(spark, "continuous"), fresh_folder(spark, "continuous-checkpoint")
    running = stream_bronze(event_stream(spark, sf_dir), path, checkpoint, seconds=1)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    raw = read_raw(spark, path).drop(files.ARRIVAL)
    return raw.withColumn(files.LINEAGE_FILE, F.element_at(F.split(files.LINEAGE_FILE, "/"), -1))


@query("stream_upsert")
def stream_upsert_query(spark, sf_dir):
    """Latest event per user and type, inserted by a stream that is then replayed from the start."""
    root = fresh_folder(spark, "silver")
    schema = read(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value").schema
    target = CleansedTable(spark, Layout(root), "events", schema)
    for attempt in ("first", "second", "replay"):
        checkpoint = f"{root}/_checkpoints/{'replay' if attempt == 'replay' else 'stream'}"
        stream_upsert(
            event_stream(spark, sf_dir), target, ["user_id", "event_type"], checkpoint, ["ts"]
        ).awaitTermination()
    return target.read()


@query("stream_upsert_files")
def stream_upsert_files(spark, sf_dir):
    """Events that arrive in files by the hour of day, upserted with one file a micro-batch and with all in one."""
    folder = fresh_folder(spark, "arrivals")
    events = read(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    for eight_hours in range(3):  # one after the other, as they would arrive
        some = events.where(F.floor(F.hour("ts") / 8) == eight_hours)
        some.coalesce(1).write.mode("append").parquet(folder)
    results = []
    for most in (1, 500):
        root = fresh_folder(spark, f"silver-{most}")
        target = CleansedTable(spark, Layout(root), "events", events.schema)
        arriving = stream_files(spark, folder, events.schema, "parquet", STAMPS[1], "*.parquet", max_files=most)
        stream_upsert(arriving, target, ["user_id", "event_type"], f"{root}/_checkpoints/stream", ["ts"]).awaitTermination()
        results.append(target.read().withColumn("files_a_batch", F.lit(most)))
    return results[0].unionByName(results[1])


@query("sink_overwrite")
def sink_overwrite(spark, sf_dir):
    """Conformed events published twice in full: the last purchase of every user replaces the last event."""
    events = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    target = CleansedTable(spark, Layout(fresh_folder(spark, "overwrite")), "events", events.schema)
    target.replace_with(events, ["user_id"], ["ts"], STAMPS[1].load_ts)
    target.replace_with(events.where("event_type = 'purchase'"), ["user_id"], ["ts"], STAMPS[2].load_ts)
    return target.read()


def alert_stream(spark: SparkSession, sf_dir: str, windows_of, over: float) -> DataFrame:
    path, checkpoint = fresh_folder(spark, "alerts"), fresh_folder(spark, "alerts-checkpoint")
    status = F.when(F.col("event_type") == "error", F.lit("FAILED")).otherwise(F.lit("SUCCESS"))
    exact = F.col("value").cast("decimal(18,2)").alias("value")
    events = event_stream(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("end_time"), status.alias("status"), exact)
    windows = windows_of(events)
    write_windows(windows, path, checkpoint).awaitTermination()
    return read_alerts(spark, path, windows.schema, over)


@query("stream_alerts")
def stream_alerts(spark, sf_dir):
    """The failed-run alerts of a stream: every window with a failure, the last ones too."""
    return alert_stream(spark, sf_dir, lambda e: stream_failed_runs(e, "end_time"), control.FAILED_RUNS_OVER)


@query("stream_metric")
def stream_metric_query(spark, sf_dir):
    """The metric alerts of a stream."""
    return alert_stream(spark, sf_dir, lambda e: stream_metric(e, "end_time", "value"), control.METRIC_OVER)


@query("expire_versions")
def expire_versions(spark, sf_dir):
    """Customers of two published loads, after the files of the first have been expired."""
    house = Warehouse(spark, fresh_folder(spark, "expire"))
    places = build_dims(spark, sf_dir, GENERIC, ["dim_location"], waves=1)
    for wave in (1, 2):
        house.load_dim(stage(spark, sf_dir, "customer", wave), generic.CUSTOMER, STAMPS[wave], places)
    table = house.dim(generic.CUSTOMER)
    if not maintenance.expire_versions(table, dt.datetime(2024, 6, 1)):
        raise RuntimeError("nothing was expired")
    return shown(table.read())


@query("load_routing")
def load_routing(spark, sf_dir):
    """The branch each active object of the plan takes, by its load type."""
    plan = control.load_plan(metadata_rows(spark, sf_dir))
    route = control.route_of("load_type")
    return plan.select("source_system", "object_name", route.alias("route"))


@query("run_log")
def run_log(spark, sf_dir):
    """The log of the published sales loads."""
    house = published_sales(spark, sf_dir)
    return house.runs().select("procedure_name", "status", "rows_inserted", "rows_updated", "error_message")


@query("is_weekend")
def is_weekend(spark, sf_dir):
    """Orders by kind of day."""
    days = calendar(spark, sf_dir).select("full_date", "is_weekend", "day_name")
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("full_date"))
    return orders.join(days, "full_date").groupBy("is_weekend", "day_name").agg(F.count("*").alias("n"))


# The query run as the flagship: two waves of dimensions, the order fact, the monthly report.
flagship = partial(_QUERIES["vw_orders_summary"])
