"""Loads that do only what is new: merged states, resumed runs, parted deliveries."""

import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_jobs import config, sources  # noqa: F401 - a fixture

from saleswright import schemas
from saleswright.operators import distinct_states, metrics, quarantine
from saleswright.plans import jobs
from saleswright.sources import files
from saleswright.storage import drop

FACT = (
    "transaction_id string, sale_date date, product_category string, customer_code string, "
    "customer_id long, quantity int, total_amount decimal(27,3)"
)
#: Dense ids over several of Spark's bitmap buckets.
BUYERS = [*range(1, 40), 32768, 32769, 65536, 65537, 100_000]


def fact(spark, seed, n, since=date(2024, 1, 1)):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        buyer = rng.choice([*BUYERS, None])
        rows.append(
            (
                None if k % 17 == 0 else f"T{seed}-{k}", since + timedelta(rng.randrange(70)),
                rng.choice(["a", "b", None]), None if buyer is None else f"C{buyer}", buyer,
                rng.randrange(1, 9), None if k % 13 == 0 else Decimal(rng.randrange(10**6)) / 1000,
            )
        )
    return spark.createDataFrame(rows, FACT)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_states_merge_to_the_plain_metrics(spark):
    parts = [fact(spark, s, 300) for s in (1, 2, 3)]
    whole = parts[0].union(parts[1]).union(parts[2])
    states = [distinct_states.partial_states(p) for p in parts]
    merged = distinct_states.merge_states(states[0].union(states[1]))
    found = distinct_states.metrics_of(merged.union(states[2]))
    assert rows_of(found) == rows_of(metrics.daily_category_metrics(whole))
    assert rows_of(distinct_states.metrics_of(states[0].limit(0))) == []


def test_states_are_no_more_than_the_sales(spark):
    """However far apart the buyers' ids are: a state is a row, not a bitmap of all buyers."""
    far = fact(spark, 4, 300).withColumn("customer_id", F.col("customer_id") * 10**9)
    states = distinct_states.partial_states(far)
    assert states.count() <= 300
    assert "binary" not in [kind for _, kind in states.dtypes]
    assert rows_of(distinct_states.metrics_of(states)) == rows_of(metrics.daily_category_metrics(far))


def test_deliveries_fold_in_once(spark, tmp_path):
    path = f"{tmp_path}/states"
    first, late = fact(spark, 1, 300), fact(spark, 2, 60, date(2024, 2, 20))
    jobs.fold_delivery(spark, first, "one", path)
    before = {r.f for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    for _ in range(2):
        jobs.fold_delivery(spark, late, "two", path)
    assert rows_of(jobs.daily_metrics(spark, path)) == rows_of(metrics.daily_category_metrics(first.union(late)))
    # January has no late sales, so its files are those of the first delivery.
    after = {r.f for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    assert {f for f in before if "sale_month=2024-01" in f} == {f for f in after if "sale_month=2024-01" in f}
    jobs.fold_delivery(spark, late.limit(0), "three", path)
    assert rows_of(jobs.daily_metrics(spark, path)) == rows_of(metrics.daily_category_metrics(first.union(late)))


STAGES = {"ingest": "run_ingest", "clean": "run_cleaning", "model": "run_modelling", "load": "run_load", "summary": "run_summary"}
TABLES = ("fact_sales", "daily_category_metrics", "warehouse/dim_customers", "warehouse/fact_sales", "warehouse/daily_sales_summary")


def stored(spark, cfg):
    return {name: rows_of(files.read_table(spark, cfg.table(name))) for name in TABLES}


@pytest.mark.parametrize("at", sorted(STAGES))
def test_a_broken_run_goes_on_where_it_broke(spark, sources, monkeypatch, at):  # noqa: F811
    cfg = config(sources, "run-1", "2024-08-01 06:00:00")
    calls = Counter()
    with monkeypatch.context() as broken:
        for stage, name in STAGES.items():
            plain = getattr(jobs, name)

            def work(spark, cfg, stage=stage, plain=plain):
                calls[stage] += 1
                result = plain(spark, cfg)
                # It breaks off when its tables are written.
                if stage == at and calls[stage] == 1:
                    raise ConnectionError("lost")
                return result

            broken.setattr(jobs, name, work)
        with pytest.raises(ConnectionError):
            jobs.run_all(spark, cfg)
        report = jobs.run_all(spark, cfg)
    done = list(STAGES)[: list(STAGES).index(at)]
    assert report.skipped == tuple(done)
    assert calls == {s: 1 if s in done or s not in (at,) else 2 for s in STAGES}
    resumed = stored(spark, cfg)
    whole = config({**sources, "lake": sources["lake"] + "-whole"}, "run-1", "2024-08-01 06:00:00")
    assert jobs.run_all(spark, whole).counts == report.counts
    assert stored(spark, whole) == resumed


def test_what_ends_a_proof(spark, sources):  # noqa: F811
    """Another run, other settings, other input files, a later run and lost tables."""
    cfg = config(sources, "run-1", "2024-08-01 06:00:00")
    once = jobs.run_journal(spark, cfg)
    table = cfg.table("made")

    def work():
        spark.range(3).write.mode("overwrite").parquet(table)
        return {"made": 3}

    def skips(cfg):
        journal = jobs.run_journal(spark, cfg)
        assert journal.once("ingest", lambda _: [table], work) == {"made": 3}
        return journal.skipped == ["ingest"]

    once.once("ingest", lambda _: [table], work)
    assert skips(cfg)
    assert not skips(config(sources, "run-2", "2024-08-01 06:00:00"))
    assert not skips(cfg) and skips(cfg)
    assert not skips(config(sources, "run-1", "2024-08-01 07:00:00"))
    assert not skips(cfg) and skips(cfg)
    with open(sources["sales_csv"], "a") as more:
        more.write("S99,C1,P1,2024-03-04,1,10.0,0.0,CASH,PEN,web,north\n")
    assert not skips(cfg) and skips(cfg)
    drop(spark, table)
    assert not skips(cfg) and skips(cfg)


def test_parted_delivery(spark, tmp_path):
    rows = [
        ("T1", "C1", "P1", "USD", 1, 1.0), ("T2", "C9", "P1", "USD", 1, 1.0), ("T3", "C1", None, "USD", 1, 1.0),
        (None, "C1", "P1", "USD", 1, 1.0), ("T" * 101, "C1", "P1", "USD", 1, 1.0), ("T6", "C1", "P1", "EURO", 1, 1.0),
        ("T7", "C1", "P1", "USD", None, 1.0), ("T8", "C1", "P1", "USD", 1, 1e9), ("T9", "C9", "P9", "EURO", None, 1e9),
        ("T1", "C1", "P1", "USD", 1, 1.0),
    ]
    sales = spark.createDataFrame(
        rows, "transaction_id string, customer_code string, product_code string, currency_code string, quantity int, unit_price double"
    ).withColumns(
        {
            "sale_date": F.lit("2024-01-01").cast("date"),
            "sale_timestamp": F.lit("2024-01-01").cast("timestamp_ntz"),
            "total_amount": F.lit(1.0),
        }
    )
    customers = spark.createDataFrame([("C1", 1)], "customer_code string, customer_id long")
    products = spark.createDataFrame([("P1", 7)], "product_code string, product_id long")
    path = f"{tmp_path}/parted"
    found = jobs.part_delivery(spark, sales, customers, products, path)
    assert Counter(r.outcome for r in found.collect()) == {
        "stored": 2, "unknown_customer": 2, "unknown_product": 1, "missing_transaction_id": 1,
        "overlong_transaction_id": 1, "overlong_currency_code": 1, "missing_quantity": 1, "overflowing_unit_price": 1,
    }
    kept = found.where(F.col("outcome") == quarantine.STORED).collect()
    assert {(r.transaction_id, r.customer_id, r.product_id) for r in kept} == {("T1", 1, 7)}


def test_absent_columns(spark):
    rules = quarantine.declared_rules(spark.range(1), schemas.FACT_SALES)
    # Columns with a default need not be there.
    assert set(rules) == {f"missing_{c.name}" for c in schemas.FACT_SALES if c.required}
