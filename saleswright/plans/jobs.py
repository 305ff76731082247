"""The batch jobs: ingest, clean, model, load, check, summarise.

Each stage reads the tables of the one before from Parquet, and ``run_all``
keeps a journal of the stages it has finished, so a run that is repeated goes on
with the stage it failed in. Counts are taken while writing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from saleswright import schemas
from saleswright.functions import dates
from saleswright.operators import (
    cleaning,
    constraints,
    dedup,
    distinct_states,
    ingest,
    merging,
    metrics,
    modelling,
    quality,
    quarantine,
)
from saleswright.operators.keys import growing_ids, surrogate_keys
from saleswright.plans.journal import RunJournal
from saleswright.schemas import ColumnSpec
from saleswright.sources import files, key_filters, sinks
from saleswright.sources.jdbc import JdbcWarehouse, KeyRange
from saleswright.storage import exists, materialize, recover, scratch_run


#: Columns the warehouse declares as primary or unique keys besides the codes.
PRIMARY_KEYS = {
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "fact_sales": "sale_id",
    "daily_sales_summary": "summary_date",
    "data_quality_logs": "log_id",
}


@dataclass(frozen=True)
class JobConfig:
    """Inputs, the folder of the lake's tables and the run's parameters."""

    sales_csv: str
    products_csv: str
    customers_json: str
    lake: str
    run_id: str
    run_ts: datetime | str
    as_of: date | str
    date_formats: tuple[str, ...] = (dates.ISO_DATE,)
    customers_per_line: bool = False
    #: Take the currency from wide sales files instead of the fixed one.
    keep_currency: bool = False

    def table(self, name: str) -> str:
        return f"{self.lake.rstrip('/')}/{name}"

    @property
    def run_time(self) -> Column:
        return dates.time_value(self.run_ts)

    @property
    def today(self) -> Column:
        return dates.date_value(self.as_of)


def open_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where there is none yet or nothing in it."""
    recover(spark, path)
    if not exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


# --- lake


def run_ingest(spark: SparkSession, cfg: JobConfig) -> dict[str, int]:
    """Sources to the raw tables."""
    sales = files.read_sales_csv(spark, cfg.sales_csv, wide=cfg.keep_currency)
    raw = {
        "raw_sales": sales.drop("sales_channel", "region"),
        "raw_customers": files.read_customers_json(
            spark,
            cfg.customers_json,
            document_per_line=cfg.customers_per_line,
            file_column="source_file",
        ),
        "raw_products": files.read_products_csv(spark, cfg.products_csv),
    }
    # The file's name is read off the scan, hence before flattening.
    stamped = {name: ingest.add_ingestion_metadata(df, cfg.run_time) for name, df in raw.items()}
    stamped["raw_customers"] = ingest.flatten_customers(
        stamped["raw_customers"], "ingestion_timestamp", "source_file"
    )
    return {name: sinks.write_table(df, cfg.table(name)) for name, df in stamped.items()}


def run_cleaning(spark: SparkSession, cfg: JobConfig) -> dict[str, int]:
    """Raw to clean tables; returns the rows kept and removed."""

    def raw(name: str) -> DataFrame:
        return files.read_table(spark, cfg.table(name))

    currency = F.col("currency") if cfg.keep_currency else None
    sales = cleaning.clean_sales(raw("raw_sales"), cfg.date_formats, currency)
    clean = {
        "clean_sales": sales.drop("currency"),
        "clean_customers": cleaning.clean_customers(raw("raw_customers")),
        "clean_products": cleaning.clean_products(raw("raw_products")),
    }
    counts = {}
    for name, df in clean.items():
        kept = sinks.write_table(df, cfg.table(name))
        removed = raw(name.replace("clean", "raw")).count() - kept
        counts |= {name: kept, f"{name}_removed": removed}
    return counts


def run_modelling(spark: SparkSession, cfg: JobConfig) -> dict[str, int]:
    """Clean tables to dimensions, fact and metrics."""

    def table(name: str) -> DataFrame:
        return files.read_table(spark, cfg.table(name))

    counts = {
        "dim_customers": sinks.write_table(
            modelling.customer_dimension(table("clean_customers"), cfg.run_time),
            cfg.table("dim_customers"),
        ),
        "dim_products": sinks.write_table(
            modelling.product_dimension(table("clean_products"), cfg.run_time),
            cfg.table("dim_products"),
        ),
    }
    fact = modelling.sales_fact(
        table("clean_sales"), table("dim_customers"), table("dim_products"), cfg.run_time
    )
    parts = sinks.parts_for(table("clean_sales").count())
    counts["fact_sales"] = sinks.write_partitioned(
        fact, cfg.table("fact_sales"), "sale_date", parts
    )

    fact = files.read_table(spark, cfg.table("fact_sales"), schema=fact.schema)
    counts["daily_category_metrics"] = sinks.write_partitioned(
        metrics.daily_category_metrics(fact), cfg.table("daily_category_metrics"), "sale_date"
    )
    counts["customer_metrics"] = sinks.write_table(
        metrics.customer_metrics(fact, cfg.today), cfg.table("customer_metrics")
    )
    return counts


# --- warehouse tables in the lake


def load_dimension(
    spark: SparkSession,
    incoming: DataFrame,
    path: str,
    key: str,
    id_column: str,
    specs: Sequence[ColumnSpec],
) -> int:
    """Merge a dimension into its warehouse table; ids and creation times stay."""
    incoming = modelling.to_table_types(incoming, specs)
    current = open_if_present(spark, path)
    if current is None:
        return sinks.write_table(surrogate_keys(incoming, key, id_column), path)
    return sinks.replace_table(merging.merge_dimension(current, incoming, key, id_column), path)


def load_fact(
    spark: SparkSession,
    sales: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    path: str,
) -> int:
    """Append the lake's sales that the warehouse fact lacks; a repeated load adds none.

    Known transactions are dropped before the joins that look up the ids, and
    only files of the fact that may hold one that arrives are opened for that. A
    large load opens them all and writes no filters; the next small one does.
    Ids of sales are given in the tasks that write: unique and growing, but not
    without gaps. A load that is larger still is appended in parts of some days
    each; if it breaks off, the load that repeats it appends those that lack.
    """
    top = 0
    parts = sinks.parts_for(sales.count())
    if open_if_present(spark, path) is not None:
        # Also for files of a load that broke off before their filters were written.
        if key_filters.few(sales):
            key_filters.add_filters(spark, path, "transaction_id", "sale_id")
        top = key_filters.largest_id(spark, path, "sale_id")
        sales = key_filters.rows_to_append(spark, path, sales, "transaction_id")
        if parts > 1:
            # Written once, as what the fact lacks is not to be found for each part.
            sales = materialize(sales, "lacking")
    n = 0
    for part in sinks.in_parts(sales, "sale_date", parts):
        seen = Observation()

        def numbered(rows: DataFrame, top=top, seen=seen) -> DataFrame:
            return growing_ids(rows, "sale_id", top).observe(seen, F.max("sale_id").alias("top"))

        fresh = modelling.warehouse_fact(part, customers, products)
        added = sinks.append_partitioned(fresh, path, "sale_date", numbered)
        if added:
            n, top = n + added, seen.get["top"]
    if 0 < n <= key_filters.FEW_ROWS:
        key_filters.add_filters(spark, path, "transaction_id", "sale_id")
    return n


def warehouse_table(spark: SparkSession, cfg: JobConfig, name: str) -> DataFrame:
    return files.read_table(
        spark, cfg.table(f"warehouse/{name}"), schema=schemas.table_schema(name)
    )


def run_load(spark: SparkSession, cfg: JobConfig) -> dict[str, int]:
    """Dimensions, then the fact, into the warehouse tables."""
    counts = {}
    for name, key, id_column in (
        ("dim_customers", "customer_code", "customer_id"),
        ("dim_products", "product_code", "product_id"),
    ):
        counts[name] = load_dimension(
            spark,
            files.read_table(spark, cfg.table(name)),
            cfg.table(f"warehouse/{name}"),
            key,
            id_column,
            schemas.WAREHOUSE[name],
        )
    lake_fact = open_if_present(spark, cfg.table("fact_sales"))
    if lake_fact is None:
        counts["fact_sales"] = 0
        return counts
    counts["fact_sales"] = load_fact(
        spark,
        lake_fact,
        warehouse_table(spark, cfg, "dim_customers"),
        warehouse_table(spark, cfg, "dim_products"),
        cfg.table("warehouse/fact_sales"),
    )
    return counts


def load_to_database(
    spark: SparkSession, cfg: JobConfig, target: JdbcWarehouse, split: KeyRange, writers: int
) -> None:
    """The same load into a database that holds the keys and constraints.

    Dimensions replace the tables' rows, the fact's new rows are appended.
    ``split`` deals the reading of the fact's keys over tasks. The dimension
    tables must not be referenced by the fact's, as databases refuse to empty
    such tables.
    """
    for name in ("dim_customers", "dim_products"):
        target.replace(warehouse_table(spark, cfg, name), name, writers)
    fact = warehouse_table(spark, cfg, "fact_sales")
    present = target.read(spark, "fact_sales", ["transaction_id"], split)
    target.append(merging.rows_to_append(present, fact, "transaction_id"), "fact_sales", writers)


# --- quarantine


def part_delivery(
    spark: SparkSession, sales: DataFrame, customers: DataFrame, products: DataFrame, path: str
) -> DataFrame:
    """Part the lake's sales by whether the warehouse fact's constraints take them.

    One write puts every row below ``path``, in a folder for each outcome: those
    in ``stored`` break no constraint and have their ids, the others stay as they
    came, each under the first constraint that it breaks. Returns the table.
    """
    judged = quarantine.judge(
        sales,
        [s for s in schemas.FACT_SALES if s.name != "sale_id"],
        {
            "unknown_customer": (customers, "customer_code", "customer_id"),
            "unknown_product": (products, "product_code", "product_id"),
        },
    )
    judged.write.mode("overwrite").partitionBy("outcome").parquet(path)
    return spark.read.schema(judged.schema).parquet(path)


# --- daily metrics by delivery


def fold_delivery(spark: SparkSession, sales: DataFrame, delivery: str, path: str) -> int:
    """Fold a delivery's new sales into the states of the daily metrics at ``path``.

    ``sales`` has the columns of the enriched fact and ``customer_id``, and only
    rows that no other delivery brought. States are kept per delivery, in a
    folder per month: only months with sales in the delivery are opened and
    written anew, late sales among them, and a delivery that is folded in again
    replaces its own states.
    """
    states = distinct_states.partial_states(sales).select(
        "*",
        F.lit(delivery).alias("delivery"),
        F.date_format("sale_date", "yyyy-MM").alias("sale_month"),
    )
    if open_if_present(spark, path) is None:
        return sinks.replace_partitions(states, path, "sale_month")
    # Written first, so that the delivery is not computed for its months as well.
    states = materialize(states, "states")
    months = [r.sale_month for r in states.select("sale_month").distinct().toLocalIterator()]
    current = spark.read.schema(states.schema).parquet(path)
    kept = current.where(F.col("sale_month").isin(months) & (F.col("delivery") != delivery))
    return sinks.replace_partitions(kept.unionByName(states), path, "sale_month")


def daily_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics per day and category of all deliveries folded in."""
    return distinct_states.metrics_of(spark.read.parquet(path))


# --- quality and summary


def _table_or_empty(spark: SparkSession, cfg: JobConfig, name: str) -> DataFrame:
    if open_if_present(spark, cfg.table(f"warehouse/{name}")) is None:
        return spark.createDataFrame([], schemas.table_schema(name))
    return warehouse_table(spark, cfg, name)


def _constraint_checks(spark: SparkSession, cfg: JobConfig, stored: Mapping) -> DataFrame:
    """The declared constraints of the tables that there are.

    Required columns and primary keys are looked at in the warehouse, in one
    pass. Lengths and decimals are looked at in the lake, in another, as values
    that do not fit are NULL after the load.
    """
    parts = []
    for name, table in stored.items():
        specs = schemas.WAREHOUSE[name]
        lake = open_if_present(spark, cfg.table(name))
        kinds = [constraints.NOT_NULL]
        fitting = [constraints.TEXT_LENGTH, constraints.DECIMAL_RANGE]
        if lake is None:
            kinds += fitting
        else:
            parts.append(constraints.count_violations(lake, name, specs, fitting))
        parts.append(constraints.count_violations(table, name, specs, kinds, PRIMARY_KEYS[name]))
    return constraints.as_checks(reduce(DataFrame.unionByName, parts))


def quality_log(spark: SparkSession, path: str) -> DataFrame:
    """The quality log, kept in one folder per run."""
    return files.read_table(spark, path, schema=schemas.table_schema("data_quality_logs"))


def write_quality_log(
    spark: SparkSession, checks: DataFrame, run_id: str, run_ts: Column, path: str
) -> DataFrame:
    """Make ``checks`` the log of the run and return its rows.

    A stage that is repeated replaces the rows of its run, so that a repaired
    run is judged anew; those of other runs stay, and numbers go on from them.
    """
    after = 0
    if open_if_present(spark, path) is not None:
        others = quality_log(spark, path).where(F.col("pipeline_run_id") != run_id)
        after = others.agg(F.max("log_id")).first()[0] or 0
    sinks.replace_partitions(
        quality.log_rows(checks, run_id, run_ts, after), path, "pipeline_run_id"
    )
    return quality_log(spark, path).where(F.col("pipeline_run_id") == run_id)


def run_quality(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """Check the warehouse tables, write the run's log, return the tallies.

    The eleven checks of the suite and those of the declared constraints.
    """
    tables = {name: _table_or_empty(spark, cfg, name) for name in quality.SUITE}
    declared = dict(tables)
    log = cfg.table("warehouse/data_quality_logs")
    summary = open_if_present(spark, cfg.table("warehouse/daily_sales_summary"))
    if summary is not None:
        declared["daily_sales_summary"] = summary
    if open_if_present(spark, log) is not None:
        declared["data_quality_logs"] = quality_log(spark, log)
    # Written before the log is replaced, as some checks read it.
    checks = materialize(
        quality.run_all_checks(spark, tables, cfg.today).unionByName(
            _constraint_checks(spark, cfg, declared)
        ),
        "checks",
    )
    written = write_quality_log(spark, checks, cfg.run_id, cfg.run_time, log)
    return quality.add_alert_level(quality.summarize_checks(written))


def upsert_summary(
    spark: SparkSession, incoming: DataFrame, path: str, month_of: Column | None = None
) -> int:
    """Merge days into the summary table, rewriting only the months they fall in.

    ``month_of`` is the one day that ``incoming`` is about, if there is only one:
    then the month is known without looking at the rows.
    """
    month = F.date_format("summary_date", "yyyy-MM")
    current = open_if_present(spark, path)
    if current is None:
        merged = incoming
    else:
        # Months as the folders name them, so that the others are not read.
        current = current.withColumn("summary_month", F.col("summary_month").cast("string"))
        if month_of is None:
            months = incoming.select(month.alias("summary_month")).distinct()
            touched = current.join(months, "summary_month", "left_semi")
        else:
            touched = current.where(F.col("summary_month") == F.date_format(month_of, "yyyy-MM"))
        touched = touched.drop("summary_month")
        merged = merging.merge_summary(touched, incoming)
    return sinks.replace_partitions(
        merged.withColumn("summary_month", month), path, "summary_month"
    )


def run_summary(spark: SparkSession, cfg: JobConfig) -> int:
    """The summary of the day ``as_of``."""
    day = metrics.daily_sales_summary(
        warehouse_table(spark, cfg, "fact_sales"),
        warehouse_table(spark, cfg, "dim_products"),
        cfg.today,
        cfg.run_time,
    )
    return upsert_summary(spark, day, cfg.table("warehouse/daily_sales_summary"), cfg.today)


@dataclass(frozen=True)
class RunReport:
    """Rows written per stage and table, the quality tallies, stages done before."""

    counts: Mapping[str, Mapping[str, int]]
    quality: Mapping[str, object]
    skipped: tuple[str, ...] = ()


def run_all(spark: SparkSession, cfg: JobConfig) -> RunReport:
    """All stages in order; raises at the first failure and at a failed gate.

    A run that is repeated with the same id, settings and input files goes on
    with the first stage that is not proven done. The checks run each time, as
    tables may have been repaired in between. Scratch tables are deleted at the
    end, whether the run fails or not.
    """
    with scratch_run(spark):
        journal = run_journal(spark, cfg)
        counts, tallies = run_to_quality(spark, cfg, journal)
        quality.enforce_gate(tallies)
        counts["summary"] = journal.once(
            "summary",
            lambda counts: [cfg.table(f"warehouse/{name}") for name in counts],
            lambda: {"daily_sales_summary": run_summary(spark, cfg)},
        )
        return RunReport(counts, tallies.first().asDict(), tuple(journal.skipped))


#: Stages that the journal knows, in order.
JOURNALED = ("ingest", "clean", "model", "load", "summary")


def run_journal(spark: SparkSession, cfg: JobConfig) -> RunJournal:
    inputs = [cfg.sales_csv, cfg.products_csv, cfg.customers_json]
    return RunJournal(spark, cfg.lake, cfg.run_id, cfg, inputs, JOURNALED)


def run_to_quality(
    spark: SparkSession, cfg: JobConfig, journal: RunJournal | None = None
) -> tuple[dict[str, dict[str, int]], DataFrame]:
    """The stages up to the gate: rows per stage and table, and the quality tallies."""
    journal = run_journal(spark, cfg) if journal is None else journal

    def written(folder: str):
        return lambda counts: [
            cfg.table(folder + name) for name in counts if not name.endswith("_removed")
        ]

    counts = {
        "ingest": journal.once("ingest", written(""), lambda: run_ingest(spark, cfg)),
        "clean": journal.once("clean", written(""), lambda: run_cleaning(spark, cfg)),
        "model": journal.once("model", written(""), lambda: run_modelling(spark, cfg)),
        "load": journal.once("load", written("warehouse/"), lambda: run_load(spark, cfg)),
    }
    return counts, run_quality(spark, cfg)


# --- quick report


def _labelled(lines: DataFrame, products: DataFrame, run_ts: Column) -> DataFrame:
    return modelling.enrich_with_products(modelling.with_rate_total(lines), products, run_ts)


def quick_enriched(sales: DataFrame, products: DataFrame, run_ts: Column) -> DataFrame:
    """Complete, distinct sales with total and product labels."""
    return _labelled(
        dedup.complete_distinct(sales), dedup.complete_distinct(products), run_ts
    )


def quick_report(sales: DataFrame, products: DataFrame, run_ts: Column) -> DataFrame:
    """Counts before and after cleaning and the overall figures, in one row."""
    # Both are counted and joined, so they are computed once and written.
    lines = materialize(dedup.complete_distinct(sales), "complete-sales")
    items = materialize(dedup.complete_distinct(products), "complete-products")
    return _report_row(sales, products, lines, items, _labelled(lines, items, run_ts))


def _report_row(
    sales: DataFrame, products: DataFrame, lines: DataFrame, items: DataFrame, labelled: DataFrame
) -> DataFrame:
    def count(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    figures = metrics.global_metrics(labelled)
    return figures.select(
        count(sales).alias("original_sales"),
        count(products).alias("original_products"),
        count(lines).alias("cleaned_sales"),
        count(items).alias("cleaned_products"),
        F.col("total_transactions").alias("final_records"),
        *figures.columns,
    )


def run_quick_report(
    spark: SparkSession, sales_csv: str, products_csv: str, out: str, run_ts: datetime | str
) -> DataFrame:
    """The short way from two CSV files, types inferred, to labelled lines and figures.

    Writes the lines as CSV and the report and top categories as JSON below
    ``out``; returns the report.
    """
    sales = files.read_csv_inferred(spark, sales_csv)
    products = files.read_csv_inferred(spark, products_csv)
    lines = materialize(dedup.complete_distinct(sales), "complete-sales")
    items = materialize(dedup.complete_distinct(products), "complete-products")
    labelled = _labelled(lines, items, dates.time_value(run_ts))
    folder = out.rstrip("/")
    sinks.write_csv(labelled, f"{folder}/sales_processed")
    report = materialize(
        _report_row(sales, products, lines, items, labelled), "quick-report"
    )
    sinks.write_json(report, f"{folder}/business_metrics")
    sinks.write_json(metrics.top_categories(labelled), f"{folder}/top_categories")
    return report
