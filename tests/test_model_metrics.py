from datetime import date, datetime
from decimal import Decimal

import pytest
from fixtures import CUSTOMER_COLUMNS, CUSTOMERS, PRODUCTS, SALES
from pyspark.sql import functions as F

from saleswright.functions import dates
from saleswright.operators import cleaning, ingest, metrics, modelling
from saleswright.operators.keys import dense_ids, surrogate_keys
from saleswright.schemas import FACT_SALES, PRODUCTS_CSV, SALES_CSV



@pytest.fixture(scope="module")
def tables(spark):
    run = dates.time_value("2024-08-01 06:00:00")
    sales = cleaning.clean_sales(spark.createDataFrame(SALES, SALES_CSV))
    customers = modelling.customer_dimension(
        cleaning.clean_customers(spark.createDataFrame(CUSTOMERS, CUSTOMER_COLUMNS)), run
    )
    products = modelling.product_dimension(
        cleaning.clean_products(spark.createDataFrame(PRODUCTS, PRODUCTS_CSV)), run
    )
    fact = modelling.sales_fact(sales, customers, products, run)
    return {"sales": sales, "customers": customers, "products": products, "fact": fact}


def test_fact_golden(tables):
    rows = {r.transaction_id: r for r in tables["fact"].collect()}
    assert set(rows) == {"S1", "S2", "S8", "S10"}
    assert rows["S1"].profit_margin == pytest.approx(0.25)
    assert rows["S1"].product_category == "Non-fiction"
    assert rows["S1"].created_at == datetime(2024, 8, 1, 6)


def test_join_loss(tables):
    loss = modelling.fact_join_loss(tables["sales"], tables["customers"], tables["products"])
    assert tuple(loss.first()) == (5, 4, 1, 0)


def test_daily_category_metrics(tables):
    rows = {r.sale_date: r for r in metrics.daily_category_metrics(tables["fact"]).collect()}
    first = rows[date(2024, 3, 1)]
    assert first.total_sales == Decimal("215.000")
    assert (first.total_quantity, first.transaction_count, first.unique_customers) == (2, 1, 1)
    assert first.avg_transaction_value == 215.0


def test_customer_metrics_recency(tables):
    rows = {
        r.customer_code: r
        for r in metrics.customer_metrics(
            tables["fact"], dates.date_value("2024-03-10")
        ).collect()
    }
    assert (rows["C1"].frequency, rows["C1"].recency_days) == (3, 6)
    assert (rows["C2"].frequency, rows["C2"].recency_days) == (1, 8)


def test_recency_counts_all_segments(spark):
    fact = spark.createDataFrame(
        [("a", "C", "X", date(2024, 1, 1), Decimal(1)), ("b", "C", "Y", date(2024, 1, 5), Decimal(1))],
        "transaction_id string, customer_code string, customer_segment string, sale_date date, "
        "total_amount decimal(18,3)",
    )
    as_of = dates.date_value("2024-01-06")
    assert {r.recency_days for r in metrics.customer_metrics(fact, as_of).collect()} == {1}
    rows = metrics.customer_recency(fact, as_of).collect()
    assert len(rows) == 2 and {r.recency_days for r in rows} == {1}


def test_global_metrics_of_nothing_are_zero(tables):
    row = metrics.global_metrics(tables["fact"].where("false")).first()
    assert [float(v) for v in row] == [0.0] * 5


@pytest.fixture(scope="module")
def stored(tables):
    customers = surrogate_keys(tables["customers"], "customer_code", "customer_id")
    products = surrogate_keys(tables["products"], "product_code", "product_id")
    return modelling.warehouse_fact(tables["fact"], customers, products), products


def test_warehouse_fact_types(stored):
    fact, _ = stored
    assert fact.columns == [s.name for s in FACT_SALES if s.name != "sale_id"]
    assert dict(fact.dtypes)["total_amount"] == "decimal(12,2)"
    assert fact.count() == 4


def test_summary_of_a_day(stored):
    fact, products = stored
    run = dates.time_value("2024-08-01 06:00:00")
    day = metrics.daily_sales_summary(fact, products, dates.date_value("2024-03-04"), run)
    row = day.first()
    assert (row.total_transactions, row.unique_customers) == (2, 1)
    assert row.total_sales_amount == Decimal("1099990.99")
    assert row.avg_transaction_value == Decimal("549995.50")
    assert row.top_product_category == "Non-fiction"


def test_summary_of_an_empty_day_is_one_row(stored):
    fact, products = stored
    run = dates.time_value("2024-08-01 06:00:00")
    rows = metrics.daily_sales_summary(
        fact, products, dates.date_value("1999-01-01"), run
    ).collect()
    assert len(rows) == 1
    assert rows[0].total_transactions == 0
    assert rows[0].total_sales_amount is None and rows[0].top_product_category is None


def test_top_category_ties_go_by_name(spark):
    day = date(2024, 1, 1)
    fact = spark.createDataFrame(
        [(day, "b", "C1", Decimal(5)), (day, "a", "C1", Decimal(5)), (day, None, "C2", Decimal(5))],
        "sale_date date, product_category string, customer_code string, total_amount decimal(18,3)",
    )
    row = metrics.daily_sales_summary_all(fact, dates.time_value("2024-01-02 00:00:00")).first()
    assert row.top_product_category == "a"
    assert (row.total_transactions, row.unique_customers) == (3, 2)


def test_top_categories(spark):
    df = spark.createDataFrame(
        [("a", 1), ("b", 3), ("c", 3), ("d", 0), (None, 9)], "category string, total_amount int"
    )
    assert [r.category for r in metrics.top_categories(df).collect()] == ["b", "c", "a"]


def test_dense_ids_equal_row_number(spark):
    codes = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("code"))
    rows = dense_ids(codes, "code", "n").orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 5001))
    assert [r.code for r in rows] == sorted(r.code for r in rows)


def test_known_keys_keep_their_ids(spark):
    known = spark.createDataFrame([("m", 7), ("z", 9)], "code string, n long")
    df = spark.createDataFrame([("z",), ("b",), ("m",), ("a",)], "code string")
    ids = {r.code: r.n for r in surrogate_keys(df, "code", "n", known).collect()}
    assert ids == {"m": 7, "z": 9, "a": 10, "b": 11}


def test_first_load_into_empty_dimension(spark):
    known = spark.createDataFrame([], "code string, n long")
    df = spark.createDataFrame([("b",), ("a",)], "code string")
    ids = {r.code: r.n for r in surrogate_keys(df, "code", "n", known).collect()}
    assert ids == {"a": 1, "b": 2}


def test_columns_are_added_only_where_inputs_exist(spark):
    bare = spark.createDataFrame([("P1",)], "product_code string")
    assert modelling.with_gross_total(bare).columns == ["product_code"]
    assert modelling.with_rate_total(bare).columns == ["product_code"]
    assert modelling.with_sale_year(bare).columns == ["product_code"]


def test_defaults_fill_absent_columns_only(spark):
    df = spark.createDataFrame([("T1", None)], "transaction_id string, currency_code string")
    run = dates.time_value("2024-08-01 06:00:00")
    row = modelling.with_table_defaults(df, FACT_SALES, run).first()
    assert row.currency_code is None
    assert (row.discount_amount, row.created_at) == (Decimal("0.00"), datetime(2024, 8, 1, 6))


def test_left_enrichment_keeps_unknown_products(spark, tables):
    lines = spark.createDataFrame([("P1",), ("P9",)], "product_code string")
    run = dates.time_value("2024-08-01 06:00:00")
    rows = modelling.enrich_with_products(lines, tables["products"], run).collect()
    assert {r.product_code: r.brand for r in rows} == {"P1": "Acme", "P9": None}


def test_flatten_accepts_missing_structs(spark):
    df = spark.createDataFrame(
        [("C1", None, None, None, "2024-01-01", "gold")],
        "customer_id string, personal_info struct<first_name:string,last_name:string>, "
        "contact struct<email:string,phone:string>, address struct<country:string,city:string>, "
        "registration_date string, segment string",
    )
    row = ingest.flatten_customers(df).first()
    assert (row.customer_code, row.first_name, row.customer_segment) == ("C1", None, "gold")
