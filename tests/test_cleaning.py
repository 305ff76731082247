import math
import os
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from fixtures import CUSTOMER_COLUMNS, CUSTOMERS, PRODUCTS, SALES
from pyspark.sql import functions as F

from saleswright.functions import dates, money
from saleswright.operators import cleaning, dedup
from saleswright.plans import staging
from saleswright.schemas import PRODUCTS_CSV, SALES_CSV
from saleswright.session import ENGINE_CONF, SKEW_CONF, temporary_conf


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(SALES, SALES_CSV)


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, CUSTOMER_COLUMNS)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame(PRODUCTS, PRODUCTS_CSV)


def by_key(df, key):
    return {row[key]: row for row in df.collect()}


def test_clean_sales_golden(sales):
    rows = by_key(cleaning.clean_sales(sales), "transaction_id")
    assert set(rows) == {"S1", "S2", "S8", "S9", "S10"}
    first = rows["S1"]
    assert first.sale_date == date(2024, 3, 1)
    assert first.sale_timestamp == datetime(2024, 3, 1)
    assert (first.tax_amount, first.total_amount) == (Decimal("20.000"), Decimal("215.000"))
    assert (first.payment_method, first.currency_code) == ("CASH", "USD")
    twin = rows["S2"]
    assert (twin.customer_code, twin.discount_amount) == ("C2", Decimal("0.00"))
    assert (twin.total_amount, twin.payment_method) == (Decimal("55.000"), None)
    assert rows["S9"].total_amount == Decimal("500.000")
    assert rows["S10"].total_amount == Decimal("-9.000")


def test_order_sizes(sales):
    sized = cleaning.clean_sales(sales).select(
        "transaction_id", money.order_size(F.col("total_amount")).alias("size")
    )
    assert {r[0]: r[1] for r in sized.collect()} == {
        "S1": "Medium",
        "S2": "Small",
        "S8": "Large",
        "S9": "Large",
        "S10": "Small",
    }


def test_unknown_amount_is_large(spark):
    row = spark.range(1).select(money.order_size(F.lit(None).cast("double")).alias("s")).first()
    assert row.s == "Large"


def test_other_date_forms_can_be_recovered(sales):
    every = (dates.ISO_DATE, *dates.OTHER_DATES)
    rows = by_key(cleaning.clean_sales(sales, every), "transaction_id")
    assert rows["S3"].sale_date == date(2024, 5, 20)
    assert rows["S4"].sale_date == date(2024, 12, 30)
    # Both copies are valid now; the first by the remaining columns survives.
    assert rows["S2"].sale_date == date(2024, 12, 30)


def test_source_currency_can_be_kept(sales):
    priced = sales.withColumn("currency", F.lit("PEN"))
    kept = cleaning.clean_sales(priced, currency=F.col("currency"))
    assert {r.currency_code for r in kept.collect()} == {"PEN"}


def test_rejects_account_for_every_row(sales):
    counts = {
        r.outcome: r.records
        for r in cleaning.count_rejects(
            sales, "transaction_id", cleaning.sales_rules()
        ).collect()
    }
    assert sum(counts.values()) == len(SALES)
    assert counts == {
        "kept": 5,
        "duplicate": 0,
        "missing_transaction_id": 1,
        "missing_customer_code": 1,
        "missing_product_code": 0,
        "bad_quantity": 1,
        "unstorable_unit_price": 0,
        "bad_unit_price": 1,
        "unstorable_discount": 0,
        "bad_sale_date": 3,
    }


NUMBERS = (None, 0.0, -0.004, 0.004, 0.005, 1.0, -3.0, 1e13, 1e14, 1e300, math.nan, math.inf, -math.inf)


def test_filters_agree_with_the_rules(spark):
    """The short filters keep exactly the rows that break no rule."""
    codes = [("T", "C", "P"), (None, "C", "P"), ("T", None, "P"), ("T", "C", None)]
    rows = [(*c, "2024-01-02", 1, x, y) for c in codes for x in NUMBERS for y in NUMBERS]
    rows += [("T", "C", "P", day, q, 1.0, 0.0) for day in ("x", None, "2024-02-30") for q in (None, 0, 1)]
    sales = spark.createDataFrame(
        rows,
        "transaction_id string, customer_code string, product_code string, sale_date string, "
        "quantity int, unit_price double, discount double",
    )
    products = sales.select(
        "product_code", F.col("customer_code").alias("product_name"), "unit_price",
        F.col("discount").alias("cost_price"), F.col("quantity").cast("double").alias("weight_kg"),
    )
    for df, short, rules in (
        (sales, cleaning.valid_sales(), cleaning.sales_rules()),
        (products, cleaning.valid_products(), cleaning.product_rules()),
    ):
        both = df.select(
            F.coalesce(short, F.lit(False)).alias("kept"), cleaning.first_defect(rules).alias("defect")
        ).collect()
        assert any(r.kept for r in both)
        assert all(r.kept == (r.defect is None) for r in both)


def test_clean_customers_golden(customers):
    rows = by_key(cleaning.clean_customers(customers), "customer_code")
    assert set(rows) == {"C1", "C2", "C3"}
    first = rows["C1"]
    assert (first.first_name, first.last_name) == ("Alba", "De La Rosa")
    assert (first.email, first.phone) == ("alba@example.com", "9123456789")
    assert (first.country, first.city) == ("Peru", "Lima")
    assert (first.registration_date, first.customer_segment) == (date(2023, 1, 5), "GOLD")
    second = rows["C2"]
    assert (second.email, second.phone) == (None, "+51999000001")
    assert second.registration_date is None
    assert rows["C3"].email is None


def test_rejected_emails_are_counted(customers):
    row = cleaning.count_rejected_emails(customers).first()
    assert (row.emails, row.email_rejected) == (4, 2)


def test_clean_products_golden(products):
    rows = by_key(cleaning.clean_products(products), "product_code")
    assert set(rows) == {"P1", "P6"}
    assert rows["P1"].product_name == "Macbook Pro"
    assert rows["P1"].category == "Non-fiction"


def test_dedup_keeps_one_row_per_key_and_null(sales):
    once = dedup.one_per_key(sales, ["transaction_id"])
    assert once.count() == 11
    again = dedup.one_per_key(once, ["transaction_id"])
    assert once.exceptAll(again).count() == 0


def test_dedup_does_not_depend_on_row_order(spark, sales):
    shuffled = sales.orderBy(F.rand(7)).repartition(3)
    a = dedup.one_per_key(sales, ["transaction_id"])
    b = dedup.one_per_key(shuffled, ["transaction_id"])
    assert a.exceptAll(b).count() == 0


def test_dedup_prefers_by_condition(sales):
    prefer = F.col("sale_date") == "30/12/2024"
    rows = by_key(dedup.one_per_key(sales, ["transaction_id"], prefer), "transaction_id")
    assert rows["S2"].sale_date == "30/12/2024"


def test_dedup_cuts_copies_before_the_shuffle(sales, capsys):
    dedup.one_per_key(sales, ["transaction_id"]).explain("formatted")
    plan = capsys.readouterr().out
    before, _, after = plan.partition("Exchange")
    assert "WindowGroupLimit" in before
    assert "WindowGroupLimit" in after


def test_complete_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n int, t string")
    assert dedup.complete_distinct(df).collect() == [(1, "a")]


def test_amounts_round_half_up(spark):
    df = spark.createDataFrame([(2.675, 1, None)], "p double, q int, d double")
    row = df.select(
        money.price(F.col("p")).alias("p"),
        money.total_after_rate(F.col("p"), F.col("q"), F.col("d")).alias("t"),
        money.margin(F.col("p"), F.lit(1.0)).alias("m"),
    ).first()
    assert (row.p, row.t) == (Decimal("2.68"), None)
    assert row.m == pytest.approx(1.68 / 2.68)


def test_filter_is_small_enough_to_be_compiled(spark):
    """The JVM interprets methods of more than 8,000 bytes."""
    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    with temporary_conf(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = cleaning.clean_sales(staging.raw_sales(spark, folder))._jdf.queryExecution()
        told = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", told)]
    assert sizes and max(sizes) < 8000


def test_bounds_of_doubles_judge_like_decimals(spark):
    edges = [0.005, 0.004, 0.0, 5e-324, 1e14, 99999999999999.99, 1e300, 2e10, 999999.99, math.inf, math.nan]
    edges += [math.nextafter(v, to) for v in (0.005, 1e14) for to in (0.0, math.inf)]
    values = [(v,) for e in edges for v in (e, -e)] + [(None,)]
    x = F.col("x")
    judged = spark.createDataFrame(values, "x double").select(
        "x",
        F.coalesce(money.price(x) > 0, F.lit(False)).alias("positive"),
        F.coalesce(money.positive_double(x), F.lit(False)).alias("positive_by_bounds"),
        money.storable(x).alias("storable"),
        money.storable_double(x).alias("storable_by_bounds"),
    )
    for r in judged.collect():
        assert (r.positive, r.storable) == (r.positive_by_bounds, r.storable_by_bounds), r.x


def test_filter_makes_no_decimals(spark):
    """Of doubles, that is: their cast goes through texts."""
    sales = spark.createDataFrame([], SALES_CSV)
    told = cleaning.clean_sales(sales)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in told.splitlines() if "Filter" in line and "unit_price" in line]
    assert filters and not any("decimal" in line for line in filters)


def test_large_methods_are_not_interpreted():
    assert int(ENGINE_CONF["spark.sql.codegen.hugeMethodLimit"]) <= 8000
    assert "spark.sql.codegen.hugeMethodLimit" in SKEW_CONF
