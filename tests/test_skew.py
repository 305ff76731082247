"""A third of all rows on one key must not end up in one task."""

import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleswright.functions import dates
from saleswright.operators import merging, metrics, modelling, quality
from saleswright.operators.joins import join_on_text
from saleswright.plans import staging
from saleswright.session import sizing_conf
from saleswright.sources import sinks

HOT_SHARE = 3
N = 60_000


@pytest.fixture(scope="module")
def sales(spark):
    hot = F.col("id") % HOT_SHARE == 0
    code = F.when(hot, F.lit("C0")).otherwise(F.concat(F.lit("C"), (F.col("id") % 500).cast("string")))
    return spark.range(0, N, 1, 8).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("transaction_id"),
        code.alias("customer_code"),
        F.concat(F.lit("P"), (F.col("id") % 7).cast("string")).alias("product_code"),
        F.lit(date(2024, 1, 1)).alias("sale_date"),
        F.lit(date(2024, 1, 1)).cast("timestamp_ntz").alias("sale_timestamp"),
        F.lit(1).alias("quantity"),
        F.lit(Decimal("10.00")).cast("decimal(12,2)").alias("unit_price"),
        F.lit(Decimal("0.00")).cast("decimal(12,2)").alias("discount_amount"),
        F.lit(Decimal("1.000")).cast("decimal(18,3)").alias("tax_amount"),
        F.lit(Decimal("11.000")).cast("decimal(18,3)").alias("total_amount"),
        F.sha2(F.col("id").cast("string"), 512).alias("payment_method"),
        F.lit("USD").alias("currency_code"),
    )


@pytest.fixture(scope="module")
def dims(spark):
    customers = spark.range(500).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_code"),
        F.lit("GOLD").alias("customer_segment"),
    )
    products = spark.range(7).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_code"),
        F.lit("Home").alias("category"),
        F.lit("Acme").alias("brand"),
        F.lit(Decimal("5.00")).cast("decimal(12,2)").alias("cost_price"),
    )
    return customers, products


@pytest.fixture()
def large_scale(spark):
    """Thresholds low enough for the test's data to count as large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan_after(df, capsys):
    df.collect()
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out.split("== Initial Plan ==")[0]


def test_hot_customer_is_split_in_the_fact_join(spark, sales, dims, large_scale, capsys):
    run = dates.time_value("2024-01-02 00:00:00")
    fact = modelling.sales_fact(sales, *dims, run)
    plan = plan_after(fact, capsys)
    assert "SortMergeJoin(skew=true)" in plan
    assert fact.count() == N


def test_hot_customer_recency(sales, large_scale, capsys):
    narrow = sales.select("transaction_id", "customer_code", "sale_date", "payment_method")
    recency = metrics.customer_recency(narrow, dates.date_value("2024-01-03"))
    assert "skew=true" in plan_after(recency, capsys)
    row = recency.agg(F.count("*").alias("n"), F.min("recency_days").alias("d")).first()
    assert (row.n, row.d) == (N, 2)


def test_hot_keys_collapse_before_reference_checks(sales, dims, capsys):
    customers = dims[0].where("customer_code <> 'C0'")
    orphans = quality.count_orphans(sales, customers, "customer_code")
    # One third on C0 plus the rows whose own code is C0.
    expected = sales.where("customer_code = 'C0'").count()
    assert orphans.first().n == expected
    orphans.explain()
    plan = capsys.readouterr().out.split("== Initial Plan ==")[-1]
    assert "partial_count" in plan and "LeftAnti" in plan


def test_one_hot_day_summary(sales):
    fact = sales.withColumn("product_category", F.lit("Home"))
    row = metrics.daily_sales_summary_all(fact, dates.time_value("2024-01-02 00:00:00")).first()
    assert row.total_transactions == N
    assert row.total_sales_amount == Decimal("660000.00")
    assert row.unique_customers == sales.select("customer_code").distinct().count()


def test_hot_key_append(sales):
    hot = sales.select("customer_code", "transaction_id")
    # The target holds the hot key as often as the batch does.
    known = hot.where("customer_code in ('C0', 'C1')").select("customer_code")
    fresh = merging.rows_to_append(known, hot, "customer_code")
    assert fresh.count() == hot.select("customer_code").distinct().count() - 2


def test_partitions_grow_with_the_input():
    small, large = sizing_conf(10**9, 8), sizing_conf(10**14, 8000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    partitions = int(large["spark.sql.shuffle.partitions"])
    assert 10**14 / partitions <= 256 * 1024**2


def test_long_keys_stay_apart(spark):
    keys = spark.createDataFrame([(1234567890123,), (1234567890129,)], "k long")
    assert keys.selectExpr(staging._code("TXN", "k")).distinct().count() == 2


def test_summary_pruned_to_its_day(spark, tmp_path, capsys):
    path = str(tmp_path / "fact")
    fact = spark.range(100).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("sale_date"),
        F.col("id").alias("product_id"),
        F.col("id").alias("customer_id"),
        F.lit(Decimal("1.00")).cast("decimal(12,2)").alias("total_amount"),
    )
    sinks.write_partitioned(fact, path, "sale_date")
    products = spark.range(100).select(F.col("id").alias("product_id"), F.lit("Home").alias("category"))
    day = metrics.daily_sales_summary(
        spark.read.parquet(path),
        products,
        dates.date_value("2024-01-03"),
        dates.time_value("2024-02-01 00:00:00"),
    )
    assert day.first().total_transactions == 10
    day.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(sale_date" in plan
    assert plan.count("FileScan parquet") == plan.count("PartitionFilters: [isnotnull(sale_date")


def test_text_joins_sort_by_hashes(spark, sales, dims, large_scale, capsys):
    """Codes begin alike, so that sorts by them would compare whole texts."""
    run = dates.time_value("2024-01-02 00:00:00")
    plan = plan_after(modelling.sales_fact(sales, *dims, run), capsys)
    sorts = [line for line in plan.splitlines() if " Sort [" in line]
    assert len(sorts) == 4 and all(re.search(r"Sort \[_hash#", line) for line in sorts)
    for how in ("inner", "left", "left_anti"):
        known = dims[0].where("customer_code < 'C3'").unionByName(dims[0].limit(1).selectExpr("null as customer_code", "'x' as customer_segment"))
        mine = join_on_text(sales, known, "customer_code", how)
        plain = sales.join(known, "customer_code", how)
        assert mine.columns == plain.columns
        assert mine.exceptAll(plain).isEmpty() and mine.count() == plain.count()
