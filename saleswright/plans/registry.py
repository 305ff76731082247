"""The registered queries: each takes (spark, folder of the given tables).

All of them run over whole tables. Decimals are shown as doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright import schemas
from saleswright.functions import dates, money, text
from saleswright.operators import (
    cleaning,
    constraints,
    dedup,
    ingest,
    keys,
    merging,
    metrics,
    modelling,
    profiling,
    quality,
)
from saleswright.operators.joins import join_on_text
from saleswright.plans import jobs, staging
from saleswright.session import enable_skew_handling, size_shuffles
from saleswright.sources import files, key_filters, sinks
from saleswright.storage import materialize, scratch_path, scratch_run

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = "2002-01-01 00:00:00"
EARLIER_TS = "2001-01-01 00:00:00"
AS_OF = "2001-07-01"
SUMMARY_DAY = "1998-06-15"

_QUERIES: dict[str, Query] = {}


def _run_time() -> Column:
    return dates.time_value(RUN_TS)


def _earlier() -> Column:
    return dates.time_value(EARLIER_TS)


def _as_of() -> Column:
    return dates.date_value(AS_OF)


def query(build: Query) -> Query:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        size_shuffles(enable_skew_handling(spark), staging.given_bytes(spark, sf_dir))
        return money.decimals_as_double(build(spark, sf_dir))

    _QUERIES[build.__name__] = run
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- tables the queries start from


def _clean_sales(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_sales(staging.raw_sales(spark, d))


def _clean_customers(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_customers(staging.raw_customers(spark, d))


def _clean_products(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_products(staging.raw_products(spark, d))


def _customer_dim(spark: SparkSession, d: str) -> DataFrame:
    return modelling.customer_dimension(_clean_customers(spark, d), _run_time())


def _product_dim(spark: SparkSession, d: str) -> DataFrame:
    return modelling.product_dimension(_clean_products(spark, d), _run_time())


def _fact(
    spark: SparkSession,
    d: str,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    customers = _customer_dim(spark, d) if customers is None else customers
    products = _product_dim(spark, d) if products is None else products
    return modelling.sales_fact(_clean_sales(spark, d), customers, products, _run_time())


def _dims_once(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Both dimensions as written tables, for queries that read them repeatedly."""
    return (
        materialize(_customer_dim(spark, d), "dim-customers"),
        materialize(_product_dim(spark, d), "dim-products"),
    )


def _stored(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The warehouse fact and product dimension with their ids."""
    customers, products = _dims_once(spark, d)
    customer_ids = keys.surrogate_keys(customers, "customer_code", "customer_id")
    product_ids = keys.surrogate_keys(products, "product_code", "product_id")
    fact = _fact(spark, d, customers, products)
    return modelling.warehouse_fact(fact, customer_ids, product_ids), product_ids


def _unfiltered_sales(spark: SparkSession, d: str) -> DataFrame:
    """Raw sales with date and amounts computed but nothing rejected."""
    unit_price, quantity, discount = F.col("unit_price"), F.col("quantity"), F.col("discount")
    return staging.raw_sales(spark, d).withColumns(
        {
            "sale_date": dates.parse_date(F.col("sale_date")),
            "discount_amount": money.or_zero(discount),
            "tax_amount": money.tax(unit_price, quantity),
            "total_amount": money.total(unit_price, quantity, discount),
        }
    )


def _quality_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    # Clean sales before the fact's inner joins, so that sales of rejected
    # customers and products show as orphans.
    # Written once, since several checks read each table.
    customers, products = _dims_once(spark, d)
    return {
        "dim_customers": customers,
        "dim_products": products,
        "fact_sales": materialize(
            _clean_sales(spark, d).select(
                "transaction_id",
                "customer_code",
                "product_code",
                "sale_date",
                "quantity",
                "unit_price",
                "total_amount",
            ),
            "clean-sales",
        ),
    }


_CODES = ("customer_code", "product_code")


def _checks(spark: SparkSession, d: str) -> DataFrame:
    return quality.run_all_checks(spark, _quality_tables(spark, d), _as_of(), _CODES)


# --- flagship and metrics


@query
def daily_category_metrics(spark, d):
    return metrics.daily_category_metrics(_fact(spark, d))


@query
def daily_metrics_refresh(spark, d):
    customers = materialize(_customer_dim(spark, d), "dim-customers")
    ids = keys.surrogate_keys(customers.select("customer_code"), "customer_code", "customer_id")
    # What the states are made of; the table would keep the other columns as well.
    fact = join_on_text(_fact(spark, d, customers), ids, "customer_code").select(
        "transaction_id", "sale_date", "product_category", "customer_id", "quantity", "total_amount"
    )
    fact = materialize(fact, "fact-with-ids")
    path = scratch_path(spark, "daily-states")
    # The second delivery brings late sales for most days, and arrives twice.
    first = F.substring("transaction_id", 22, 1) < "7"
    jobs.fold_delivery(spark, fact.where(first), "first", path)
    for _ in range(2):
        jobs.fold_delivery(spark, fact.where(~first), "second", path)
    return jobs.daily_metrics(spark, path)


@query
def customer_metrics(spark, d):
    return metrics.customer_metrics(_fact(spark, d), _as_of())


@query
def customer_recency_window(spark, d):
    sales = _clean_sales(spark, d).select("transaction_id", "customer_code", "sale_date")
    return metrics.customer_recency(materialize(sales, "sale-dates"), _as_of())


@query
def global_metrics(spark, d):
    return metrics.global_metrics(_clean_sales(spark, d))


@query
def top_categories(spark, d):
    lines = modelling.with_gross_total(dedup.complete_distinct(staging.raw_sales(spark, d)))
    return metrics.top_categories(
        modelling.enrich_with_products(lines, _clean_products(spark, d), _run_time())
    )


@query
def daily_sales_summary(spark, d):
    fact, products = _stored(spark, d)
    lines = fact.select("sale_date", "customer_id", "product_id", "total_amount")
    return metrics.daily_sales_summary(
        materialize(lines, "stored-fact"), products, dates.date_value(SUMMARY_DAY), _run_time()
    )


@query
def daily_sales_summary_all(spark, d):
    return metrics.daily_sales_summary_all(_fact(spark, d), _run_time())


@query
def order_size_distribution(spark, d):
    return metrics.order_size_distribution(_clean_sales(spark, d).withColumn(
        "order_size_category", money.order_size(F.col("total_amount"))
    ))


# --- cleaning


@query
def dedup_by_key(spark, d):
    return dedup.one_per_key(staging.raw_sales(spark, d), ["transaction_id"])


@query
def clean_sales(spark, d):
    return _clean_sales(spark, d)


@query
def clean_sales_recovered_dates(spark, d):
    formats = (dates.ISO_DATE, *dates.OTHER_DATES)
    return cleaning.clean_sales(staging.raw_sales(spark, d), formats).select(
        "transaction_id", "sale_date", "total_amount"
    )


@query
def clean_sales_rejects(spark, d):
    return cleaning.count_rejects(
        staging.raw_sales(spark, d), "transaction_id", cleaning.sales_rules()
    )


@query
def clean_customers(spark, d):
    return _clean_customers(spark, d)


@query
def email_rejects(spark, d):
    return cleaning.count_rejected_emails(staging.raw_customers(spark, d))


@query
def clean_products(spark, d):
    return _clean_products(spark, d)


@query
def drop_nulls_distinct(spark, d):
    return dedup.complete_distinct(staging.raw_sales(spark, d))


@query
def scalar_string_std(spark, d):
    return staging.raw_customers(spark, d).select(
        "customer_code",
        F.trim("country").alias("trimmed"),
        text.title_text(F.col("first_name")).alias("titled"),
        text.code_text(F.col("customer_segment")).alias("coded"),
        F.lower("first_name").alias("lowered"),
        F.col("email").rlike(text.EMAIL_PATTERN).alias("email_ok"),
        text.valid_email(F.col("email")).alias("email"),
        text.phone_digits(F.col("phone")).alias("phone"),
    )


@query
def scalar_dates(spark, d):
    given_text = F.col("sale_date")
    strict = dates.parse_date(given_text)
    lenient = dates.parse_date(given_text, (dates.ISO_DATE, *dates.OTHER_DATES))
    return (
        staging.raw_sales(spark, d)
        .groupBy("sale_date")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "sale_date",
            "n",
            strict.alias("strict_date"),
            lenient.alias("lenient_date"),
            dates.midnight(strict).alias("midnight"),
            dates.days_since(strict, _as_of()).alias("days_before"),
            F.year(strict).alias("year"),
        )
    )


@query
def scalar_conditionals(spark, d):
    unit_price, quantity, discount = F.col("unit_price"), F.col("quantity"), F.col("discount")
    amount = money.total(unit_price, quantity, discount)
    return staging.raw_sales(spark, d).select(
        "product_code",
        "unit_price",
        "quantity",
        money.or_zero(discount).alias("discount_amount"),
        money.tax(unit_price, quantity).alias("tax_amount"),
        amount.alias("total_amount"),
        money.order_size(amount).alias("order_size_category"),
        F.try_divide(amount.cast("double"), quantity.cast("double")).alias("per_unit"),
        F.round(amount, 1).alias("rounded"),
        (F.col("customer_code").isNotNull() & (unit_price > 0)).alias("usable"),
    )


@query
def sale_year(spark, d):
    sales = modelling.with_sale_year(staging.raw_sales(spark, d))
    return sales.groupBy("sale_year").agg(F.count(F.lit(1)).alias("n"))


# --- ingestion and scans


@query
def flatten_customers(spark, d):
    return staging.raw_customers(spark, d)


@query
def ingest_metadata(spark, d):
    return ingest.add_ingestion_metadata(
        staging.raw_suppliers(spark, d), _run_time(), "suppliers.csv"
    )


def _as_csv(df: DataFrame, label: str, compression: str = "none") -> str:
    path = scratch_path(df.sparkSession, label)
    sinks.write_csv(df, path, compression)
    return path


@query
def scan_csv_sales(spark, d):
    return files.read_sales_csv(spark, _as_csv(staging.raw_sales_wide(spark, d), "sales-csv"))


@query
def scan_csv_products(spark, d):
    return files.read_products_csv(spark, _as_csv(staging.raw_products(spark, d), "products-csv"))


@query
def scan_csv_suppliers(spark, d):
    return files.read_suppliers_csv(
        spark, _as_csv(staging.raw_suppliers(spark, d), "suppliers-csv")
    )


@query
def scan_csv_infer(spark, d):
    return files.read_csv_inferred(spark, _as_csv(staging.raw_products(spark, d), "products-csv"))


@query
def scan_json_customers(spark, d):
    # All documents are one array in one file, read by its byte ranges.
    path = scratch_path(spark, "customers-json")
    staging.write_document_arrays(staging.customer_documents(spark, d), path, per_file=None)
    return ingest.flatten_customers(files.read_customers_json(spark, path))


@query
def scan_parquet(spark, d):
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    return files.read_table(spark, f"{d}/customer.parquet", columns)


# --- model


@query
def dim_customers(spark, d):
    return _customer_dim(spark, d)


@query
def dim_products(spark, d):
    return _product_dim(spark, d)


@query
def fact_sales(spark, d):
    return _fact(spark, d)


@query
def fact_join_loss(spark, d):
    return modelling.fact_join_loss(
        _clean_sales(spark, d), _clean_customers(spark, d), _clean_products(spark, d)
    )


@query
def enrich_left(spark, d):
    return modelling.enrich_with_products(
        _clean_sales(spark, d).select("transaction_id", "product_code", "total_amount"),
        _clean_products(spark, d),
        _run_time(),
    )


@query
def total_gross(spark, d):
    sales = staging.raw_sales(spark, d).select("product_code", "quantity", "unit_price")
    return modelling.with_gross_total(sales)


@query
def total_fractional_discount(spark, d):
    lines = staging.given(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("discount"),
    )
    return modelling.with_rate_total(lines)


# --- quality


@query
def dq_completeness(spark, d):
    customers = quality.check_completeness(_customer_dim(spark, d), "dim_customers")
    return customers.unionByName(
        quality.check_completeness(_product_dim(spark, d), "dim_products", least=10**12)
    )


@query
def dq_uniqueness(spark, d):
    # Both are looked at twice, so they are computed once and written.
    dimension = materialize(_customer_dim(spark, d).select("customer_code"), "dim-customers")
    customers = quality.check_uniqueness(dimension, "dim_customers", ["customer_code"])
    raw = staging.raw_sales(spark, d).select("transaction_id", "customer_code", "product_code")
    raw = materialize(raw, "raw-keys")
    sales = quality.check_uniqueness(raw, "raw_sales", ["transaction_id"])
    pairs = quality.check_uniqueness(raw, "raw_sales", ["customer_code", "product_code"])
    numbered = keys.surrogate_keys(dimension, "customer_code", "customer_id")
    ids = quality.check_uniqueness(numbered, "dim_customers", ["customer_id"])
    days = metrics.daily_sales_summary_all(_fact(spark, d), _run_time())
    day = quality.check_uniqueness(days, "daily_sales_summary", ["summary_date"])
    return customers.unionByName(sales).unionByName(pairs).unionByName(ids).unionByName(day)


@query
def dq_referential(spark, d):
    tables = _quality_tables(spark, d)
    return quality.check_references(
        tables["fact_sales"], tables["dim_customers"], tables["dim_products"], keys=_CODES
    )


@query
def dq_referential_ids(spark, d):
    customers, products = _dims_once(spark, d)
    customer_ids = keys.surrogate_keys(customers, "customer_code", "customer_id")
    product_ids = keys.surrogate_keys(products, "product_code", "product_id")
    sales = _clean_sales(spark, d).select("customer_code", "product_code")
    buyers = customer_ids.select("customer_code", "customer_id")
    fact = join_on_text(sales, buyers, "customer_code", "left")
    items = product_ids.select("product_code", "product_id")
    fact = join_on_text(fact, items, "product_code", "left")
    # Sales of the newest customers, and of rejected ones and products, are orphans.
    return quality.check_references(fact, _registered(customer_ids, before="1998-11-01"), product_ids)


@query
def dq_business_rules(spark, d):
    return quality.check_business_rules(_unfiltered_sales(spark, d), _as_of())


@query
def dq_run_all(spark, d):
    return _checks(spark, d)


@query
def dq_summary(spark, d):
    return quality.summarize_checks(quality.log_rows(_checks(spark, d), "run-1", _run_time()))


@query
def dq_alert_level(spark, d):
    log = quality.log_rows(_checks(spark, d), "run-1", _run_time())
    return quality.add_alert_level(quality.summarize_checks(log)).select(
        "pipeline_run_id", "alert_level"
    )


@query
def dq_log(spark, d):
    path = scratch_path(spark, "quality-log")
    tables = _quality_tables(spark, d)
    references = quality.check_references(
        tables["fact_sales"], tables["dim_customers"], tables["dim_products"], keys=_CODES
    )
    # Three rows, computed once for the two runs that log them.
    rules = quality.check_business_rules(_unfiltered_sales(spark, d), _as_of())
    rules = materialize(rules, "rules")
    # The first run is written twice, and the second time replaces the first.
    jobs.write_quality_log(spark, rules, "run-1", _run_time(), path)
    jobs.write_quality_log(spark, references, "run-1", _earlier(), path)
    jobs.write_quality_log(spark, rules, "run-2", _run_time(), path)
    return jobs.quality_log(spark, path)


def _raw_as_warehouse(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Raw rows under the warehouse's column names."""
    return {
        "dim_customers": staging.raw_customers(spark, d),
        "dim_products": staging.raw_products(spark, d),
        "fact_sales": _unfiltered_sales(spark, d),
    }


def _each_table(check: Callable[..., DataFrame], spark: SparkSession, d: str) -> DataFrame:
    results = [
        check(df, name, schemas.WAREHOUSE[name]) for name, df in _raw_as_warehouse(spark, d).items()
    ]
    return results[0].unionByName(results[1]).unionByName(results[2])


@query
def constraint_not_null(spark, d):
    return _each_table(constraints.missing_values, spark, d)


@query
def constraint_lengths(spark, d):
    return _each_table(constraints.overlong_texts, spark, d)


@query
def constraint_decimals(spark, d):
    return _each_table(constraints.overflowing_decimals, spark, d)


# --- profiles


@query
def profile_nulls(spark, d):
    return profiling.null_counts(staging.raw_sales(spark, d), "sales").unionByName(
        profiling.null_counts(staging.raw_customers(spark, d), "customers")
    )


@query
def profile_duplicates(spark, d):
    names = staging.raw_customers(spark, d).select("first_name", "country", "customer_segment")
    return profiling.duplicate_count(staging.raw_sales(spark, d), "sales").unionByName(
        profiling.duplicate_count(names, "customer_names")
    )


@query
def profile_sources(spark, d):
    sales = _as_csv(staging.raw_sales_wide(spark, d), "sales-csv")
    products = _as_csv(staging.raw_products(spark, d), "products-csv")
    documents = scratch_path(spark, "customers-json")
    staging.write_document_arrays(staging.customer_documents(spark, d), documents)
    return profiling.profile_sources(
        spark,
        {
            "sales": lambda: files.read_sales_csv(spark, sales),
            "products": lambda: files.read_products_csv(spark, products),
            "customers": lambda: ingest.flatten_customers(
                files.read_customers_json(spark, documents)
            ),
            "returns": lambda: files.read_sales_csv(spark, f"{sales}-returns"),
        },
    )


@query
def defects_sales(spark, d):
    return profiling.sales_defects(staging.raw_sales(spark, d))


@query
def defects_customers(spark, d):
    return profiling.customer_defects(staging.raw_customers(spark, d))


@query
def defects_products(spark, d):
    return profiling.product_defects(staging.raw_products(spark, d))


@query
def stage_counts(spark, d):
    sales = materialize(_clean_sales(spark, d), "clean-sales")
    customers, products = _dims_once(spark, d)
    return profiling.stage_counts(
        {
            "ingest": {
                "sales": staging.raw_sales(spark, d),
                "customers": staging.raw_customers(spark, d),
                "products": staging.raw_products(spark, d),
            },
            "clean": {"sales": sales, "customers": customers, "products": products},
            "model": {"fact_sales": modelling.sales_fact(sales, customers, products, _run_time())},
        }
    )


# --- warehouse


def _registered(df: DataFrame, *, before: str | None = None, since: str | None = None) -> DataFrame:
    """Customers the warehouse knew by a date, or that arrived since one (or undated)."""
    day = F.col("registration_date")
    return df.where(day < before) if before else df.where((day >= since) | day.isNull())


@query
def surrogate_keys(spark, d):
    dimension = materialize(_customer_dim(spark, d), "dim-customers")
    customers = dimension.select("customer_code", "customer_segment")
    known = _registered(dimension, before="1998-01-01").select("customer_code")
    current = keys.surrogate_keys(known, "customer_code", "customer_id")
    return keys.surrogate_keys(customers, "customer_code", "customer_id", existing=current)


@query
def surrogate_keys_sales(spark, d):
    sales = _clean_sales(spark, d).select("transaction_id", "sale_date")
    return keys.surrogate_keys(sales, "transaction_id", "sale_id")


@query
def column_defaults(spark, d):
    sales = _clean_sales(spark, d).select(
        "transaction_id", "sale_date", "quantity", "discount", "payment_method"
    )
    return modelling.with_table_defaults(sales, schemas.FACT_SALES, _run_time())


@query
def warehouse_fact(spark, d):
    return _stored(spark, d)[0]


@query
def load_quarantine(spark, d):
    customers, products = _dims_once(spark, d)
    # The warehouse does not know the newest customers yet.
    known = _registered(customers, before="1998-11-01").select("customer_code")
    judged = jobs.part_delivery(
        spark,
        _clean_sales(spark, d).drop("discount"),
        keys.surrogate_keys(known, "customer_code", "customer_id"),
        keys.surrogate_keys(products.select("product_code"), "product_code", "product_id"),
        scratch_path(spark, "parted"),
    )
    return judged.select("transaction_id", "outcome", "total_amount")


@query
def dim_scd1_merge(spark, d):
    dimension = materialize(_customer_dim(spark, d), "dim-customers")
    known = _registered(dimension, before="1998-01-01").withColumns(
        {
            "customer_segment": F.lit("UNKNOWN"),
            "email": F.lit(None).cast("string"),
            "created_at": _earlier(),
            "updated_at": _earlier(),
        }
    )
    current = keys.surrogate_keys(known, "customer_code", "customer_id")
    incoming = _registered(dimension, since="1996-01-01")
    return merging.merge_dimension(current, incoming, "customer_code", "customer_id")


@query
def fact_append_idempotent(spark, d):
    columns = ["transaction_id", "sale_date", "total_amount", "created_at"]
    fact = materialize(_fact(spark, d).select(*columns), "fact-sales")
    path = scratch_path(spark, "appended")
    target = fact.where(F.col("sale_date") < "1999-01-01").withColumn("created_at", _earlier())
    # The target has grown by date, as it does from delivery to delivery.
    sinks.write_table(target.repartitionByRange(48, "sale_date"), path)
    batch = fact.where(F.col("sale_date") >= "1998-01-01")
    for _ in range(2):
        if key_filters.few(batch):
            key_filters.add_filters(spark, path, "transaction_id")
        sinks.append_table(key_filters.rows_to_append(spark, path, batch, "transaction_id"), path)
    return files.read_table(spark, path)


@query
def summary_upsert(spark, d):
    path = scratch_path(spark, "daily-summary")
    days = metrics.daily_sales_summary_all(_fact(spark, d), _run_time())
    days = materialize(days, "days")
    stale = days.where(F.col("summary_date") < "1999-01-01").withColumns(
        {
            "total_transactions": F.lit(0).cast("long"),
            "top_product_category": F.lit(None).cast("string"),
            "created_at": _earlier(),
        }
    )
    jobs.upsert_summary(spark, stale, path)
    fresh = days.where(F.col("summary_date") >= "1998-11-10")
    jobs.upsert_summary(spark, fresh, path)
    return files.read_table(spark, path).drop("summary_month")


@query
def insert_if_absent(spark, d):
    arrivals = staging.raw_customers(spark, d).select(
        "customer_code", "first_name", "last_name", "email", "customer_segment"
    )
    # Every customer arrives twice, once without an address.
    twice = arrivals.unionByName(arrivals.withColumn("email", F.lit(None).cast("string")))
    dimension = materialize(_customer_dim(spark, d), "dim-customers")
    return merging.insert_if_absent(dimension, twice, "customer_code")


# --- sinks


@query
def sink_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "clean-sales")
    sinks.write_table(_clean_sales(spark, d), path)
    return files.read_table(spark, path)


@query
def sink_partitioned_roundtrip(spark, d):
    path = scratch_path(spark, "fact-sales")
    columns = ["transaction_id", "sale_date", "product_category", "total_amount"]
    sinks.write_partitioned(_fact(spark, d).select(*columns), path, "sale_date")
    return files.read_table(spark, path)


@query
def sink_csv_roundtrip(spark, d):
    lines = jobs.quick_enriched(
        staging.raw_sales(spark, d), staging.raw_products(spark, d), _run_time()
    )
    path = scratch_path(spark, "enriched-csv")
    sinks.write_csv(lines, path)
    return files.read_csv(spark, path, lines.schema)


@query
def sink_json_roundtrip(spark, d):
    report = money.decimals_as_double(metrics.daily_category_metrics(_fact(spark, d)))
    path = scratch_path(spark, "metrics-json")
    sinks.write_json(report, path)
    return spark.read.schema(report.schema).json(path)


# --- batch runs


def _delivered(
    spark: SparkSession, d: str, sales: DataFrame, lake: str, run: str, ts: str
) -> jobs.JobConfig:
    """A run's sources as files: sales and products as CSV, customers as JSON arrays.

    Each task that makes sales writes one compressed file, so as many tasks read them.
    """
    documents = scratch_path(spark, "customers-json")
    staging.write_document_arrays(staging.customer_documents(spark, d), documents)
    return jobs.JobConfig(
        sales_csv=_as_csv(sales, "sales-csv", "gzip"),
        products_csv=_as_csv(staging.raw_products(spark, d), "products-csv", "gzip"),
        customers_json=documents,
        lake=lake,
        run_id=run,
        run_ts=ts,
        as_of=AS_OF,
    )


@query
def batch_run(spark, d):
    lake = scratch_path(spark, "lake")
    with scratch_run(spark):
        cfg = _delivered(spark, d, staging.raw_sales_wide(spark, d), lake, "run-1", RUN_TS)
        counts, tallies = jobs.run_to_quality(spark, cfg)
        closed = int(tallies.first().critical_failures > 0)
    rows = [(stage, name, n) for stage, tables in counts.items() for name, n in tables.items()]
    rows.append(("quality", "gate_closed", closed))
    return spark.createDataFrame(rows, "stage string, table_name string, records long")


@query
def batch_rerun(spark, d):
    lake = scratch_path(spark, "lake")
    sales = staging.raw_sales_wide(spark, d)
    for run, part, ts in (
        # The first delivery has some of the orders, the second has all.
        ("run-1", sales.where(F.substring("transaction_id", 22, 1) < "5"), EARLIER_TS),
        ("run-2", sales, RUN_TS),
    ):
        # Only the first stage reads what was delivered.
        with scratch_run(spark):
            cfg = _delivered(spark, d, part, lake, run, ts)
            jobs.run_ingest(spark, cfg)
        with scratch_run(spark):
            jobs.run_cleaning(spark, cfg)
            jobs.run_modelling(spark, cfg)
            jobs.run_load(spark, cfg)
    return jobs.warehouse_table(spark, cfg, "fact_sales").drop("sale_id")


@query
def batch_resume(spark, d):
    lake = scratch_path(spark, "lake")

    def broken() -> dict[str, int]:
        raise ConnectionError("lost")

    with scratch_run(spark):
        cfg = _delivered(spark, d, staging.raw_sales_wide(spark, d), lake, "run-1", RUN_TS)
        # The first run breaks off while it models; the second does only the rest.
        journal = jobs.run_journal(spark, cfg)
        journal.once("ingest", lambda _: [], lambda: jobs.run_ingest(spark, cfg))
        journal.once("clean", lambda _: [], lambda: jobs.run_cleaning(spark, cfg))
        try:
            journal.once("model", lambda _: [], broken)
        except ConnectionError:
            journal = jobs.run_journal(spark, cfg)
        counts, tallies = jobs.run_to_quality(spark, cfg, journal)
        closed = int(tallies.first().critical_failures > 0)
    rows = [(stage, name, n) for stage, tables in counts.items() for name, n in tables.items()]
    rows += [(stage, "passed_over", 1) for stage in journal.skipped]
    rows.append(("quality", "gate_closed", closed))
    return spark.createDataFrame(rows, "stage string, table_name string, records long")


# --- composite


@query
def quick_report(spark, d):
    return jobs.quick_report(
        staging.raw_sales(spark, d), staging.raw_products(spark, d), _run_time()
    )
