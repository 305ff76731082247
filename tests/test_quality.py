from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleswright import schemas
from saleswright.functions import dates
from saleswright.operators import constraints, profiling, quality

FACT = (
    "transaction_id string, customer_id long, product_id long, sale_date date, quantity int, "
    "unit_price decimal(10,2), total_amount decimal(12,2)"
)
AS_OF = date(2024, 3, 10)


@pytest.fixture(scope="module")
def tables(spark):
    day = date(2024, 3, 1)
    fact = [
        ("T1", 1, 1, day, 1, Decimal(5), Decimal(5)),
        ("T1", 1, 9, day, 0, Decimal(5), Decimal(-1)),
        (None, None, 1, date(2024, 3, 11), 1, Decimal(-5), Decimal(5)),
    ]
    return {
        "dim_customers": spark.createDataFrame(
            [(1, "C1"), (2, "C2")], "customer_id long, customer_code string"
        ),
        "dim_products": spark.createDataFrame([(1, "P1")], "product_id long, product_code string"),
        "fact_sales": spark.createDataFrame(fact, FACT),
    }


def outcome(checks):
    return {
        (r.table_name, r.check_name): (r.check_result, r.records_processed, r.records_failed)
        for r in checks.collect()
    }


def test_whole_suite(spark, tables):
    found = outcome(quality.run_all_checks(spark, tables, dates.date_value(AS_OF)))
    assert len(found) == 11
    assert found["dim_customers", "completeness"] == ("PASS", 2, 0)
    assert found["dim_customers", "uniqueness"] == ("PASS", 2, 0)
    # One repeated key and one NULL key.
    assert found["fact_sales", "uniqueness"] == ("FAIL", 3, 2)
    assert found["fact_sales", "customer_integrity"] == ("FAIL", 0, 1)
    assert found["fact_sales", "product_integrity"] == ("FAIL", 0, 1)
    assert found["fact_sales", "quantity_validation"] == ("FAIL", 0, 1)
    assert found["fact_sales", "price_validation"] == ("FAIL", 0, 2)
    assert found["fact_sales", "date_validation"] == ("WARNING", 0, 1)


def test_single_checks_agree_with_the_suite(spark, tables):
    as_of = dates.date_value(AS_OF)
    fact = tables["fact_sales"]
    parts = [
        quality.check_completeness(fact, "fact_sales"),
        quality.check_uniqueness(fact, "fact_sales", ["transaction_id"]),
        quality.check_references(fact, tables["dim_customers"], tables["dim_products"]),
        quality.check_business_rules(fact, as_of),
    ]
    suite = outcome(quality.run_all_checks(spark, tables, as_of))
    for part in parts:
        for check, result in outcome(part).items():
            assert suite[check] == result


@pytest.mark.parametrize("bound", [quality.BITMAP_BYTES, 4096])
def test_references_by_bits(spark, monkeypatch, bound):
    """Ids at the edges of buckets, absent ones, zero, negative and NULL, by bits and by join."""
    monkeypatch.setattr(quality, "BITMAP_BYTES", bound)
    held = [1, 2, 8, 9, 32767, 32768, 32769, 65536, 65537, 70_000]
    parent = spark.createDataFrame([(k,) for k in held], "customer_id long")
    items = spark.range(1, 2001).select(F.col("id").cast("int").alias("product_id"))
    asked = [*held, 3, 7, 10, 32766, 32770, 65535, 65538, 98_305, 10**12, 0, -1, -32768, None]
    fact = spark.createDataFrame([(k, k % 2100 if k else None) for k in asked * 3], "customer_id long, product_id int")
    found = quality.check_references(fact, parent, items)
    counts = {r.check_name: r.records_failed for r in found.collect()}
    wrong = [k % 2100 if k else None for k in asked]
    assert counts == {
        "customer_integrity": 3 * (len(asked) - len(held)),
        "product_integrity": 3 * sum(not (k and 1 <= k <= 2000) for k in wrong),
    }
    plan = found._jdf.queryExecution().executedPlan().toString()
    keyed = "hashpartitioning(customer_id" in plan or "hashpartitioning(product_id" in plan
    assert keyed == (bound == 4096)


def test_details(spark, tables):
    checks = quality.check_completeness(tables["dim_products"], "dim_products", least=5)
    assert checks.first().check_details == "Table has only 1 records (< 5)"
    checks = quality.check_uniqueness(
        tables["fact_sales"], "fact_sales", ["customer_id", "product_id"]
    )
    row = checks.first()
    assert row.check_details == "Found 1 duplicate records in customer_id, product_id"


def test_a_check_that_cannot_run_is_an_error(spark, tables):
    broken = dict(tables, fact_sales=tables["fact_sales"].drop("quantity"))
    found = outcome(quality.run_all_checks(spark, broken, dates.date_value(AS_OF)))
    assert found["fact_sales", "quantity_validation"][0] == "ERROR"
    assert found["dim_customers", "uniqueness"][0] == "PASS"
    assert len(found) == 11


def _log(spark, tables):
    checks = quality.run_all_checks(spark, tables, dates.date_value(AS_OF))
    return quality.log_rows(checks, "r", dates.time_value("2024-03-10 00:00:00"))


def test_tallies_gate_and_level(spark, tables):
    summary = quality.summarize_checks(_log(spark, tables))
    row = summary.first()
    assert (row.total_checks, row.passed_checks, row.failed_checks) == (11, 5, 5)
    assert (row.warning_checks, row.error_checks, row.critical_failures) == (1, 0, 3)
    assert quality.add_alert_level(summary).first().alert_level == "CRITICAL"
    with pytest.raises(quality.QualityGateError):
        quality.enforce_gate(summary)


def test_errors_stop_the_gate(spark, tables):
    good = tables["fact_sales"].where("transaction_id = 'T1' and quantity = 1")
    summary = quality.summarize_checks(_log(spark, dict(tables, fact_sales=good)))
    quality.enforce_gate(summary)
    assert quality.add_alert_level(summary).first().alert_level == "NONE"
    broken = dict(tables, fact_sales=good.drop("quantity"))
    with pytest.raises(quality.QualityGateError):
        quality.enforce_gate(quality.summarize_checks(_log(spark, broken)))


def test_warning_level(spark, tables):
    late = tables["fact_sales"].where("transaction_id = 'T1' and quantity = 1")
    checks = quality.run_all_checks(
        spark, dict(tables, fact_sales=late), dates.date_value("2024-01-01")
    )
    log = quality.log_rows(checks, "r", dates.time_value("2024-03-10 00:00:00"))
    level = quality.add_alert_level(quality.summarize_checks(log)).first()
    assert (level.alert_level, level.warning_checks) == ("WARNING", 1)


def violations(df):
    return {r.column_name: r.violations for r in df.collect()}


def test_constraints(spark):
    df = spark.createDataFrame(
        [("T" * 101, None, 1e9, "EURO"), (None, 1, 1.0, "USD")],
        "transaction_id string, quantity int, unit_price double, currency_code string",
    )
    specs = schemas.FACT_SALES
    assert violations(constraints.missing_values(df, "f", specs)) == {
        "transaction_id": 1,
        "quantity": 1,
        "unit_price": 0,
        # Absent columns: every row lacks them.
        "sale_id": 2,
        "sale_date": 2,
        "sale_timestamp": 2,
        "total_amount": 2,
    }
    assert violations(constraints.overlong_texts(df, "f", specs)) == {
        "transaction_id": 1,
        "currency_code": 1,
    }
    assert violations(constraints.overflowing_decimals(df, "f", specs)) == {"unit_price": 1}


def test_profile_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert tuple(profiling.profile(df, "d").first()) == ("d", 3, 2, 2, 1, "OK")
    assert tuple(profiling.duplicate_count(df, "d").first()) == ("d", 3, 1)
    assert {r.column_name: r.null_values for r in profiling.null_counts(df, "d").collect()} == {
        "a": 0,
        "b": 2,
    }
    empty = profiling.profile(df.where("false"), "d").first()
    assert (empty.records, empty.null_values, empty.duplicates) == (0, 0, 0)


def test_missing_source(spark, tmp_path):
    rows = profiling.profile_sources(
        spark, {"gone": lambda: spark.read.parquet(str(tmp_path / "gone"))}
    ).collect()
    assert (rows[0].dataset, rows[0].records, rows[0].status) == ("gone", 0, "NOT_FOUND")


def test_defects(spark):
    sales = spark.createDataFrame(
        [
            ("T1", "2024-01-01", 1.0, 1.0, "CASH"),
            ("T1", "01/02/2024", 0.0, None, ""),
            ("T2", "20240101", -10.0, 1.0, None),
            ("T3", "soon", 999999.99, 1.0, "CASH"),
        ],
        "transaction_id string, sale_date string, unit_price double, discount double, "
        "payment_method string",
    )
    found = {r.defect: (r.n, r.pct) for r in profiling.sales_defects(sales).collect()}
    assert found["repeated_transaction_id"] == (1, 25.0)
    assert found["missing_payment_method"] == (2, 50.0)
    assert found["date_dd_mm_yyyy"][0] == found["date_yyyymmdd"][0] == 1
    assert found["date_mm_dd_yyyy"][0] == 0
    assert found["date_unreadable"][0] == 1
    assert [found[f"price_{k}"][0] for k in ("zero", "negative", "extreme")] == [1, 1, 1]

    customers = spark.createDataFrame(
        [
            ("ana", "Paz", "a@b.com", "+51-999-123456"),
            (" Eva ", "Paz", "a@b.com", "123"),
            ("JOSÉ", "Núñez", None, None),
        ],
        "first_name string, last_name string, email string, phone string",
    )
    found = {r.defect: r.n for r in profiling.customer_defects(customers).collect()}
    assert found == {
        "name_lower": 1,
        "name_upper": 1,
        "name_padded": 1,
        "repeated_email": 1,
        "phone_not_standard": 1,
        "non_ascii": 1,
        "missing_email": 1,
        "missing_phone": 1,
    }
