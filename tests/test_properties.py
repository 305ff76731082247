"""Seeded random dirty data against a plain Python reading of the rules."""

import random
import re
from collections import Counter, defaultdict
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest

from saleswright.functions import dates
from saleswright.operators import cleaning, dedup, merging, metrics, profiling, quality
from saleswright.schemas import SALES_CSV

ROWS = 3000


def random_sales(seed):
    rng = random.Random(seed)

    def day():
        d = date(2024, rng.randint(1, 3), rng.randint(1, 28))
        form = rng.choice(["%Y-%m-%d"] * 12 + ["%d/%m/%Y", "%m-%d-%Y", "%Y%m%d", "soon"])
        return d.strftime(form)

    def row(i):
        # A third of all rows share one transaction and one customer.
        hot = i % 3 == 0
        return (
            None if rng.random() < 0.03 else ("T-hot" if hot else f"T{rng.randint(1, ROWS // 2)}"),
            None if rng.random() < 0.03 else ("C-hot" if hot else f"C{rng.randint(1, 40)}"),
            None if rng.random() < 0.02 else f"P{rng.randint(1, 9)}",
            None if rng.random() < 0.02 else day(),
            rng.choice([None, 0, -1, 1, 2, 3, 7]),
            rng.choice([None, 0.0, -10.0, 999999.99, 0.005, round(rng.uniform(1, 300), 2)]),
            rng.choice([None, 0.0, round(rng.uniform(0, 50), 2)]),
            rng.choice([None, "", " cash ", "Card"]),
        )

    return [row(i) for i in range(ROWS)]


def valid(r):
    return (
        None not in r[:3]
        and r[3] is not None
        and re.fullmatch(r"\d{4}-\d{2}-\d{2}", r[3]) is not None
        and r[4] is not None
        and r[4] > 0
        and r[5] is not None
        and r[5] > 0
    )


def order(r):
    return [(v is not None, v if v is not None else 0) for v in r[1:]]


def cents(x):
    return Decimal(str(x)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def expected_clean(rows):
    copies = defaultdict(list)
    for r in rows:
        if valid(r):
            copies[r[0]].append(r)
    result = {}
    for key, group in copies.items():
        r = min(group, key=order)
        gross = cents(r[5]) * r[4]
        off = cents(r[6]) if r[6] is not None else Decimal(0)
        total = gross - off + gross * Decimal("0.1")
        method = r[7].strip(" ").upper() if r[7] is not None else None
        result[key] = (r[1], r[2], date.fromisoformat(r[3]), r[4], total, method)
    return result


@pytest.fixture(scope="module", params=[1, 2])
def raw(spark, request):
    rows = random_sales(request.param)
    return rows, spark.createDataFrame(rows, SALES_CSV).repartition(4)


def test_cleaning_equals_the_rules(raw):
    rows, df = raw
    got = {
        r.transaction_id: (
            r.customer_code, r.product_code, r.sale_date, r.quantity, r.total_amount,
            r.payment_method,
        )
        for r in cleaning.clean_sales(df).collect()
    }
    assert got == expected_clean(rows)


def test_kept_and_rejected_add_up(raw):
    rows, df = raw
    counts = cleaning.count_rejects(df, "transaction_id", cleaning.sales_rules())
    counts = {r.outcome: r.records for r in counts.collect()}
    assert sum(counts.values()) == len(rows)
    assert counts["kept"] == len(expected_clean(rows))
    assert counts["kept"] + counts["duplicate"] == sum(map(valid, rows))


def test_dedup_equals_brute_force(raw):
    rows, df = raw
    best = {}
    for r in rows:
        if r[0] not in best or order(r) < order(best[r[0]]):
            best[r[0]] = r
    got = {r.transaction_id: tuple(r) for r in dedup.one_per_key(df, ["transaction_id"]).collect()}
    assert got == best


def test_metrics_equal_brute_force(spark, raw):
    rows, df = raw
    clean = cleaning.clean_sales(df).withColumnsRenamed({"product_code": "product_category"})
    groups = defaultdict(list)
    for code, product, day, quantity, total, _ in expected_clean(rows).values():
        groups[day, product].append((code, quantity, total))
    got = {
        (r.sale_date, r.product_category): (
            r.total_sales, r.total_quantity, r.transaction_count, r.unique_customers
        )
        for r in metrics.daily_category_metrics(clean).collect()
    }
    assert got == {
        k: (sum(t for *_, t in g), sum(q for _, q, _ in g), len(g), len({c for c, *_ in g}))
        for k, g in groups.items()
    }

    run = dates.time_value("2024-08-01 00:00:00")
    days = {r.summary_date: r for r in metrics.daily_sales_summary_all(clean, run).collect()}
    for day in {k[0] for k in groups}:
        lines = [line for k, g in groups.items() if k[0] == day for line in g]
        sales = Counter()
        for (d, product), g in groups.items():
            if d == day:
                sales[product] += sum(t.quantize(Decimal("0.01"), ROUND_HALF_UP) for *_, t in g)
        best = min(sales, key=lambda p: (-sales[p], p))
        row = days[day]
        assert row.top_product_category == best
        assert row.total_sales_amount == sum(sales.values())
        assert row.total_transactions == len(lines)
        assert row.unique_customers == len({c for c, *_ in lines})


def test_profile_equals_brute_force(raw):
    rows, df = raw
    got = profiling.profile(df, "sales").first()
    assert (got.records, got.null_values, got.duplicates) == (
        len(rows),
        sum(v is None for r in rows for v in r),
        len(rows) - len(set(rows)),
    )


def test_uniqueness_equals_brute_force(raw):
    rows, df = raw
    row = quality.check_uniqueness(df, "sales", ["transaction_id"]).first()
    distinct = len({r[0] for r in rows if r[0] is not None})
    assert (row.records_processed, row.records_failed) == (len(rows), len(rows) - distinct)


def test_orphans_equal_brute_force(spark, raw):
    rows, df = raw
    known = {"C1", "C2", "C3"}
    parent = spark.createDataFrame([(c,) for c in sorted(known)], "customer_code string")
    found = quality.count_orphans(df, parent, "customer_code").first().n
    assert found == sum(r[1] not in known for r in rows)


def test_appending_the_same_batch_again_adds_nothing(raw):
    _, df = raw
    clean = cleaning.clean_sales(df).select("transaction_id", "total_amount")
    fresh = merging.rows_to_append(clean, clean, "transaction_id")
    assert fresh.count() == 0
