"""What a run keeps on disk: shuffle files, deliveries and parts of large writes."""

import os
import time

import pytest
from pyspark.sql import functions as F
from test_jobs import config, sources  # noqa: F401

from saleswright import storage
from saleswright.plans import jobs
from saleswright.plans.registry import all_queries
from saleswright.session import temporary_conf
from saleswright.sources import files, key_filters, sinks

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    found = env.blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        names.add(found.next().getName())
    return {name for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("kind", ["table", "partitioned", "scratch"])
def test_shuffle_files_go_with_their_write(spark, tmp_path, kind):
    before = shuffle_files(spark)
    rows = spark.range(1000).repartition(3, "id").withColumn("day", F.col("id") % 3)
    if kind == "table":
        assert sinks.write_table(rows, f"{tmp_path}/t") == 1000
    elif kind == "partitioned":
        assert sinks.write_partitioned(rows, f"{tmp_path}/t", "day") == 1000
    else:
        storage.materialize(rows, "kept")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def rows_of(df):
    return sorted(map(str, df.collect()))


def tables_of(spark, cfg):
    found = {name: rows_of(files.read_table(spark, cfg.table(name))) for name in ("fact_sales", "daily_category_metrics")}
    return found | {"warehouse": rows_of(jobs.warehouse_table(spark, cfg, "fact_sales").drop("sale_id"))}


def test_parts_make_the_same_tables(spark, sources, monkeypatch):  # noqa: F811
    """Written some days at a time, first and second load, with ids that stay unique."""
    monkeypatch.setattr(key_filters, "FEW_ROWS", 0)
    found = []
    for rows in (1 << 24, 1):
        monkeypatch.setattr(sinks, "PART_ROWS", rows)
        cfg = config({**sources, "lake": f"{sources['lake']}-{rows}"}, "run-1", "2024-08-01 06:00:00")
        counts = [stage(spark, cfg) for stage in (jobs.run_ingest, jobs.run_cleaning, jobs.run_modelling, jobs.run_load)]
        # Some sales go and come again.
        path = cfg.table("warehouse/fact_sales")
        days = sorted(name for name in os.listdir(path) if name.startswith("sale_date="))
        assert len(days) > 1
        storage.drop(spark, f"{path}/{days[0]}")
        left = jobs.warehouse_table(spark, cfg, "fact_sales").count()
        again = jobs.run_load(spark, cfg)["fact_sales"]
        assert left + again == counts[-1]["fact_sales"]
        assert jobs.run_load(spark, cfg)["fact_sales"] == 0
        ids = [r.sale_id for r in jobs.warehouse_table(spark, cfg, "fact_sales").select("sale_id").collect()]
        assert len(set(ids)) == len(ids) == counts[-1]["fact_sales"]
        found.append((counts, again, tables_of(spark, cfg)))
        assert not [name for name in os.listdir(cfg.lake) if name.startswith("fact_sales.")]
    assert found[0] == found[1]


def test_parts_replace_a_table_or_leave_none(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    rows = spark.range(60).withColumn("day", F.col("id") % 7)
    assert sinks.write_partitioned(rows, path, "day", 3) == 60
    assert sinks.write_partitioned(rows.where("id < 20"), path, "day", 4) == 20
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(20))
    assert sinks.write_partitioned(rows.limit(0), path, "day", 2) == 0
    broken = rows.withColumn("id", F.when(F.col("day") == 6, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        sinks.write_partitioned(broken, path, "day", 3)
    assert os.listdir(tmp_path) == []


def test_a_large_delivery_is_shuffled_once_to_be_compared(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(key_filters, "FEW_ROWS", 0)
    path = f"{tmp_path}/t"
    stored = spark.range(500).selectExpr("cast(id as string) as key", "id")
    stored.write.parquet(path)
    arriving = spark.range(400, 700).selectExpr("cast(id as string) as key", "id")
    arriving.union(arriving).union(spark.sql("select cast(null as string), 1L")).write.parquet(f"{path}-new")
    arriving = spark.read.parquet(f"{path}-new")
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with temporary_conf(spark, off):
        fresh = key_filters.rows_to_append(spark, path, arriving, "key")
        capsys.readouterr()
        fresh.explain()
        assert capsys.readouterr().out.count("Exchange hashpartitioning") == 2
        found = sorted((r.key or "", r.id) for r in fresh.collect())
    assert found == sorted([("", 1), *((str(k), k) for k in range(500, 700))])


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
@pytest.mark.parametrize("name", ["batch_run", "batch_rerun", "batch_resume"])
def test_deliveries_are_compressed_and_go_when_read(spark, monkeypatch, name):
    shared, seen, plain = storage.shared_dir(spark), [], jobs.run_ingest
    before = set(os.listdir(shared))

    def ingest(spark, cfg):
        for path in (cfg.sales_csv, cfg.products_csv):
            seen.extend(f for f in os.listdir(path) if f.startswith("part-"))
        return plain(spark, cfg)

    monkeypatch.setattr(jobs, "run_ingest", ingest)
    assert all_queries()[name](spark, SF_DIR).count() > 0
    assert seen and all(f.endswith(".csv.gz") for f in seen)
    left = {path.rsplit("-", 1)[0] for path in set(os.listdir(shared)) - before}
    assert left == {"lake"}
