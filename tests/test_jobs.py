import csv
import json
import pathlib
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest
from fixtures import CUSTOMERS, PRODUCTS, SALES
from pyspark.sql import functions as F

from saleswright import storage
from saleswright.functions import dates
from saleswright.operators import cleaning, merging, modelling, quality
from saleswright.plans import jobs, staging
from saleswright.schemas import SALES_CSV
from saleswright.sources import files, key_filters, sinks
from saleswright.sources.jdbc import JdbcWarehouse, KeyRange

SALES_HEADER = (
    "transaction_id customer_code product_code sale_date quantity unit_price discount "
    "payment_method currency sales_channel region"
).split()
PRODUCT_HEADER = (
    "product_code product_name category subcategory brand unit_price cost_price weight_kg"
).split()


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows([["" if v is None else v for v in row] for row in rows])
    return str(path)


def document(row):
    code, first, last, email, phone, country, city, registered, segment = row
    return {
        "customer_id": code,
        "personal_info": {"first_name": first, "last_name": last},
        "contact": {"email": email, "phone": phone},
        "address": {"country": country, "city": city},
        "registration_date": registered,
        "segment": segment,
    }


@pytest.fixture()
def sources(tmp_path):
    wide = [(*row, "PEN", "web", "north") for row in SALES]
    documents = tmp_path / "customers.json"
    documents.write_text(json.dumps([document(c) for c in CUSTOMERS], indent=2), encoding="utf-8")
    return {
        "sales_csv": write_csv(tmp_path / "sales.csv", SALES_HEADER, wide),
        "products_csv": write_csv(tmp_path / "products.csv", PRODUCT_HEADER, PRODUCTS),
        "customers_json": str(documents),
        "lake": str(tmp_path / "lake"),
    }


def config(sources, run, ts, as_of="2024-03-04"):
    return jobs.JobConfig(**sources, run_id=run, run_ts=ts, as_of=as_of)


def test_whole_run_and_rerun(spark, sources):
    first = config(sources, "run-1", "2024-08-01 06:00:00")
    report = jobs.run_all(spark, first)
    assert report.counts["ingest"] == {"raw_sales": 12, "raw_customers": 4, "raw_products": 6}
    assert report.counts["clean"] == {
        "clean_sales": 5,
        "clean_sales_removed": 7,
        "clean_customers": 3,
        "clean_customers_removed": 1,
        "clean_products": 2,
        "clean_products_removed": 4,
    }
    assert report.counts["model"]["fact_sales"] == 4
    assert report.counts["load"] == {"dim_customers": 3, "dim_products": 2, "fact_sales": 4}
    assert report.counts["summary"] == {"daily_sales_summary": 1}
    # The negative total fails the price rule, which is not critical.
    # Eleven checks, and keys, NOT NULL, lengths and decimals of three tables (the
    # customers have no decimals).
    assert (report.quality["total_checks"], report.quality["failed_checks"]) == (22, 1)
    assert report.quality["alert_level"] == "NONE"

    raw = files.read_table(spark, first.table("raw_sales")).first()
    assert raw.source_file == "sales.csv"
    assert raw.ingestion_timestamp == datetime(2024, 8, 1, 6)

    summary = files.read_table(spark, first.table("warehouse/daily_sales_summary")).first()
    assert (summary.summary_date, summary.total_transactions) == (date(2024, 3, 4), 2)

    second = config(sources, "run-2", "2024-08-02 06:00:00")
    again = jobs.run_all(spark, second)
    assert again.counts["load"]["fact_sales"] == 0
    customers = files.read_table(spark, second.table("warehouse/dim_customers"))
    assert {r.customer_code: r.customer_id for r in customers.collect()} == {
        "C1": 1,
        "C2": 2,
        "C3": 3,
    }
    assert {r.created_at.day for r in customers.collect()} == {1}
    assert {r.updated_at.day for r in customers.collect()} == {2}
    assert files.read_table(spark, second.table("warehouse/fact_sales")).count() == 4
    log = jobs.quality_log(spark, second.table("warehouse/data_quality_logs"))
    # The second run also checks the summary (three constraints more and its
    # key) and the log (two and its key).
    runs = {r.pipeline_run_id: r["count"] for r in log.groupBy("pipeline_run_id").count().collect()}
    assert runs == {"run-1": 22, "run-2": 29}
    assert sorted(r.log_id for r in log.collect()) == list(range(1, 52))
    days = files.read_table(spark, second.table("warehouse/daily_sales_summary"))
    assert [r.created_at.day for r in days.collect()] == [1]


def test_a_price_too_wide_for_the_warehouse_closes_the_gate(spark, sources, tmp_path):
    wide = ("S1", "C1", "P1", "2024-03-01", 1, 5e9, 0.0, "CASH", "PEN", "web", "north")
    sources["sales_csv"] = write_csv(tmp_path / "wide.csv", SALES_HEADER, [wide])
    cfg = config(sources, "run-1", "2024-08-01 06:00:00")
    with pytest.raises(quality.QualityGateError):
        jobs.run_all(spark, cfg)
    log = files.read_table(spark, cfg.table("warehouse/data_quality_logs"))
    failed = {(r.table_name, r.check_name): r.records_failed for r in log.where("records_failed > 0").collect()}
    # Price and tax exceed their columns; the price is also required.
    assert failed == {("fact_sales", "decimal_range"): 2, ("fact_sales", "not_null"): 1}


def test_a_repaired_run_opens_the_gate(spark, sources, tmp_path):
    """The quality stage may be repeated under its run id; the last outcome counts."""
    cfg = config(sources, "run-1", "2024-08-01 06:00:00")
    counts, tallies = jobs.run_to_quality(spark, cfg)
    quality.enforce_gate(tallies)
    checks = tallies.first().total_checks
    path = cfg.table("warehouse/fact_sales")
    fact = jobs.warehouse_table(spark, cfg, "fact_sales")
    good = tmp_path / "good"
    fact.write.parquet(str(good))
    orphan = spark.read.parquet(str(good)).withColumn("customer_id", F.lit(99).cast("long"))
    sinks.write_partitioned(orphan, path, "sale_date")
    with pytest.raises(quality.QualityGateError):
        quality.enforce_gate(jobs.run_quality(spark, cfg))
    sinks.write_partitioned(spark.read.parquet(str(good)), path, "sale_date")
    again = jobs.run_quality(spark, cfg)
    quality.enforce_gate(again)
    # The log itself is checked as well, now that there is one.
    assert again.first().total_checks == checks + 3


def test_nothing_is_left_behind(spark, sources, tmp_path):
    before = set((p.name for p in _shared(spark).iterdir()))
    jobs.run_all(spark, config(sources, "run-1", "2024-08-01 06:00:00"))
    assert {p.name for p in _shared(spark).iterdir()} == before


def _shared(spark):
    return pathlib.Path(storage.shared_dir(spark))


def test_the_source_currency_may_be_kept(spark, sources):
    cfg = replace(config(sources, "run-1", "2024-08-01 06:00:00"), keep_currency=True)
    jobs.run_ingest(spark, cfg)
    jobs.run_cleaning(spark, cfg)
    clean = spark.read.parquet(cfg.table("clean_sales"))
    assert {r.currency_code for r in clean.collect()} == {"PEN"}
    assert "currency" not in clean.columns


def test_failed_gate_stops_the_run(spark, sources, tmp_path):
    sources["sales_csv"] = write_csv(tmp_path / "none.csv", SALES_HEADER, [])
    with pytest.raises(quality.QualityGateError):
        jobs.run_all(spark, config(sources, "run-1", "2024-08-01 06:00:00"))


def test_missing_source_raises(spark, sources):
    sources["products_csv"] = sources["products_csv"] + ".gone"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.run_all(spark, config(sources, "run-1", "2024-08-01 06:00:00"))


def test_quick_report_from_files(spark, sources, tmp_path):
    out = tmp_path / "quick"
    report = jobs.run_quick_report(
        spark, sources["sales_csv"], sources["products_csv"], str(out), "2024-08-01 06:00:00"
    ).first()
    # Complete rows only: without S2's second copy, S7 and the sale without id.
    assert (report.original_sales, report.cleaned_sales, report.final_records) == (12, 9, 9)
    assert (report.original_products, report.cleaned_products) == (6, 5)
    complete = [r for r in SALES if None not in r]
    amounts = [Decimal(str(r[5])) * r[4] * (1 - Decimal(str(r[6]))) for r in complete]
    assert report.total_sales == sum(amounts)
    assert report.max_sale == max(amounts)
    written = spark.read.option("header", True).csv(str(out / "sales_processed"))
    assert written.count() == 9 and "category" in written.columns
    saved = spark.read.json(str(out / "business_metrics")).first()
    assert saved.total_transactions == 9
    names = [r.category for r in spark.read.json(str(out / "top_categories")).collect()]
    assert set(names) == {"Non-Fiction", "home"}


def test_wide_files_load_by_position(spark, sources):
    sales = files.read_sales_csv(spark, sources["sales_csv"])
    assert sales.columns == SALES_HEADER[:8]
    assert sales.count() == len(SALES)


def test_bad_number_is_null(spark, tmp_path):
    path = write_csv(tmp_path / "s.csv", SALES_HEADER[:8], [["T1", "C", "P", "d", "two", "x", "", ""]])
    row = files.read_sales_csv(spark, path).first()
    assert (row.transaction_id, row.quantity, row.unit_price) == ("T1", None, None)


def test_customer_documents_per_line(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text("\n".join(json.dumps(document(c)) for c in CUSTOMERS), encoding="utf-8")
    assert files.read_customers_json(spark, str(path), document_per_line=True).count() == 4
    inferred = files.read_customers_json(spark, str(path), schema=None, document_per_line=True)
    assert inferred.select("contact.email").count() == 4


def test_array_files_hold_every_document(spark, tmp_path):
    documents = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "C0").otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.struct(F.lit("a\n,]b").alias("first_name")).alias("personal_info"),
    )
    path = str(tmp_path / "arrays")
    staging.write_document_arrays(documents, path, per_file=150)
    assert len(list((tmp_path / "arrays").glob("file=*/*.txt"))) == 7
    back = files.read_customers_json(spark, path).select("customer_id", "personal_info.first_name")
    wanted = documents.select("customer_id", "personal_info.first_name")
    assert back.exceptAll(wanted).count() == 0 and back.count() == 1000


def test_single_document_counts_once(spark, tmp_path):
    path = tmp_path / "one.json"
    path.write_text(json.dumps(document(CUSTOMERS[0])), encoding="utf-8")
    assert files.read_customers_json(spark, str(path)).count() == 1


DIM = "customer_id long, customer_code string, city string, created_at string, updated_at string"


def test_merge_dimension(spark):
    current = spark.createDataFrame(
        [(1, "C1", "Lima", "t0", "t0"), (2, "C2", "Cusco", "t0", "t0")], DIM
    )
    incoming = spark.createDataFrame(
        [("C0", "Ica", "t1", "t1"), ("C2", None, "t1", "t1")],
        "customer_code string, city string, created_at string, updated_at string",
    )
    merged = merging.merge_dimension(current, incoming, "customer_code", "customer_id")
    rows = {r.customer_code: tuple(r) for r in merged.collect()}
    assert rows == {
        "C1": (1, "C1", "Lima", "t0", "t0"),
        "C2": (2, "C2", None, "t0", "t1"),
        "C0": (3, "C0", "Ica", "t1", "t1"),
    }
    twice = merging.merge_dimension(merged, incoming, "customer_code", "customer_id")
    assert merged.exceptAll(twice).count() == 0 and twice.count() == 3


def test_append_once_is_idempotent(spark):
    target = spark.createDataFrame([("T1", 1)], "transaction_id string, n int")
    batch = spark.createDataFrame([("T1", 9), ("T2", 2), ("T2", 2)], target.schema)
    once = merging.append_once(target, batch, "transaction_id")
    assert sorted(map(tuple, once.collect())) == [("T1", 1), ("T2", 2)]
    twice = merging.append_once(once, batch, "transaction_id")
    assert twice.exceptAll(once).count() == 0 and twice.count() == 2


def test_insert_if_absent(spark):
    current = spark.createDataFrame([("C1", "Ana", "Lima")], "code string, name string, city string")
    incoming = spark.createDataFrame([("C1", "Eva"), ("C2", "Bo")], "code string, name string")
    rows = merging.insert_if_absent(current, incoming, "code").collect()
    assert sorted(map(tuple, rows), key=str) == [("C1", "Ana", "Lima"), ("C2", "Bo", None)]


def test_summary_upsert_touches_only_its_months(spark, tmp_path):
    schema = "summary_date date, total_transactions long, created_at string"
    path = str(tmp_path / "summary")
    days = [(date(2024, 1, 5), 1, "t0"), (date(2024, 2, 5), 2, "t0"), (date(2024, 2, 6), 3, "t0")]
    jobs.upsert_summary(spark, spark.createDataFrame(days, schema), path)
    untouched = set(p.name for p in (tmp_path / "summary" / "summary_month=2024-01").iterdir())
    fresh = [(date(2024, 2, 6), 30, "t1"), (date(2024, 2, 7), 4, "t1")]
    jobs.upsert_summary(spark, spark.createDataFrame(fresh, schema), path)
    rows = {r.summary_date: tuple(r)[1:3] for r in spark.read.parquet(path).collect()}
    assert rows == {
        date(2024, 1, 5): (1, "t0"),
        date(2024, 2, 5): (2, "t0"),
        date(2024, 2, 6): (30, "t0"),
        date(2024, 2, 7): (4, "t1"),
    }
    assert untouched == set(
        p.name for p in (tmp_path / "summary" / "summary_month=2024-01").iterdir()
    )


def test_sinks_count_and_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(" a ", Decimal("1.50"), date(2024, 1, 1)), (None, None, date(2024, 1, 2))],
        "t string, d decimal(10,2), day date",
    )
    for write, read in [
        (sinks.write_table, lambda p: spark.read.parquet(p)),
        (sinks.write_csv, lambda p: files.read_csv(spark, p, df.schema)),
        (sinks.write_json, lambda p: spark.read.schema(df.schema).json(p)),
        (lambda x, p: sinks.write_partitioned(x, p, "day"), lambda p: spark.read.parquet(p)),
    ]:
        path = str(tmp_path / f"out-{len(list(tmp_path.iterdir()))}")
        assert write(df, path) == 2
        back = read(path).select(*df.columns)
        assert back.exceptAll(df).count() == 0 and back.count() == 2


def test_empty_write_counts_zero(spark, tmp_path):
    df = spark.range(5).where("id < 0")
    assert sinks.write_table(df, str(tmp_path / "empty")) == 0


def test_table_can_be_replaced_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(10), path)
    assert sinks.replace_table(spark.read.parquet(path).where("id < 4"), path) == 4
    assert spark.read.parquet(path).count() == 4


def test_a_failed_replacement_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(10), path)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_table(broken, path)
    assert spark.read.parquet(path).count() == 10
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    # A switch that broke off in the middle is put right.
    (tmp_path / "t").rename(tmp_path / "t.before")
    assert jobs.open_if_present(spark, path).count() == 10


def test_large_partition_is_cut_into_files(spark, tmp_path):
    day = F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02"))
    rows = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        path = tmp_path / "big"
        sinks.write_partitioned(rows.withColumn("day", day), str(path), "day")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((path / "day=2024-01-02").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(path)).count() == 200_000


def test_amounts_that_cannot_be_stored_are_named(spark):
    """NaN, infinite and too wide prices and discounts are defects, not zeros."""
    row = ("C1", "P1", "2024-03-01", 2)
    given = [
        (100.0, float("nan")), (100.0, float("inf")), (100.0, 1e300), (float("nan"), 1.0),
        (float("inf"), 1.0), (1e300, None), (0.004, 1.0), (2e10, 2e10), (100.0, None),
    ]
    sales = spark.createDataFrame(
        [(f"T{k}", *row, p, d, "CASH") for k, (p, d) in enumerate(given)], SALES_CSV
    )
    counts = {
        r.outcome: r.records
        for r in cleaning.count_rejects(sales, "transaction_id", cleaning.sales_rules()).collect()
    }
    assert {k: v for k, v in counts.items() if v} == {
        "kept": 2, "unstorable_discount": 3, "unstorable_unit_price": 3, "bad_unit_price": 1,
    }
    kept = {r.transaction_id: r for r in cleaning.clean_sales(sales).collect()}
    assert kept["T7"].total_amount == Decimal("24000000000.000")
    assert kept["T7"].discount_amount == Decimal("20000000000.00")
    assert kept["T8"].discount_amount == 0 and kept["T8"].total_amount == 220


def test_each_dimension_is_joined_once_for_a_load(spark, sources):
    cfg = config(sources, "run-1", "2024-08-01 06:00:00")
    jobs.run_all(spark, cfg)
    current = jobs.warehouse_table(spark, cfg, "fact_sales")
    lake = spark.read.parquet(cfg.table("fact_sales"))
    dims = [jobs.warehouse_table(spark, cfg, n) for n in ("dim_customers", "dim_products")]
    rows = merging.rows_to_append(current, lake, "transaction_id")
    plan = modelling.warehouse_fact(rows, *dims)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2


def test_jdbc_options():
    target = JdbcWarehouse("jdbc:postgresql://db/warehouse", {"user": "u", "driver": "d"})
    assert target.read_options("dim_customers", KeyRange("customer_id", 1, 100, 4)) == {
        "url": "jdbc:postgresql://db/warehouse",
        "dbtable": "dim_customers",
        "user": "u",
        "driver": "d",
        "partitionColumn": "customer_id",
        "lowerBound": "1",
        "upperBound": "100",
        "numPartitions": "4",
    }
    assert target.write_options("fact_sales", writers=2)["numPartitions"] == "2"
    assert "user" not in repr(target)


def test_run_parameters_are_constants(spark):
    row = spark.range(1).select(
        dates.date_value(date(2024, 1, 2)).alias("d"),
        dates.time_value(datetime(2024, 1, 2, 3)).alias("t"),
    ).first()
    assert (row.d, row.t) == (date(2024, 1, 2), datetime(2024, 1, 2, 3))


def test_large_loads_write_no_filters(spark, sources, monkeypatch):
    """They load what small ones load, and a small one after them has filters again."""
    monkeypatch.setattr(key_filters, "FEW_ROWS", 0)
    lake = config(sources, "run-1", "2024-08-01 06:00:00")
    filters = key_filters.filters_path(lake.table("warehouse/fact_sales"))
    assert jobs.run_all(spark, lake).counts["load"]["fact_sales"] == 4
    assert jobs.run_load(spark, lake)["fact_sales"] == 0
    assert not storage.exists(spark, filters)
    monkeypatch.undo()
    assert jobs.run_load(spark, lake)["fact_sales"] == 0
    assert storage.exists(spark, filters)
