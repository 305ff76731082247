"""SQL twins of the registered queries, for DuckDB over the given tables.

The statements are written from the definitions, not from the Spark plans: for
example the deduplication ranks all copies and then filters, where the Spark
side filters first.
"""

from __future__ import annotations

from collections.abc import Iterable

RUN_TS = "TIMESTAMP '2002-01-01 00:00:00'"
EARLIER_TS = "TIMESTAMP '2001-01-01 00:00:00'"
AS_OF = "DATE '2001-07-01'"
SUMMARY_DAY = "DATE '1998-06-15'"

# The email pattern, and below the wordings of the checks.
EMAIL = r"'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'"


def _title(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({text})), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def _iso(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN CAST(try_strptime({text}, '%Y-%m-%d') AS DATE) END"
    )


def _any_date(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN CAST(try_strptime({text}, '%Y-%m-%d') AS DATE) "
        f"WHEN regexp_full_match({text}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') "
        f"THEN CAST(try_strptime({text}, '%d/%m/%Y') AS DATE) "
        f"WHEN regexp_full_match({text}, '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}') "
        f"THEN CAST(try_strptime({text}, '%m-%d-%Y') AS DATE) "
        f"WHEN regexp_full_match({text}, '[0-9]{{8}}') "
        f"THEN CAST(try_strptime({text}, '%Y%m%d') AS DATE) END"
    )


def _price(value: str) -> str:
    return f"TRY_CAST({value} AS DECIMAL(16,2))"


_GROSS = f"{_price('unit_price')} * CAST(quantity AS DECIMAL(10,0))"
_TAX = f"CAST({_GROSS} * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(27,3))"
_OFF = f"CASE WHEN discount IS NULL THEN CAST(0 AS DECIMAL(16,2)) ELSE {_price('discount')} END"
_TOTAL = f"CAST({_GROSS} - ({_OFF}) + {_TAX} AS DECIMAL(27,3))"


def _unstorable(value: str) -> str:
    return f"({value} IS NOT NULL AND {_price(value)} IS NULL)"


def _mean(value: str) -> str:
    return f"CAST(sum({value}) AS DOUBLE) / CAST(count({value}) AS DOUBLE)"


def _size(amount: str) -> str:
    return f"CASE WHEN {amount} < 100 THEN 'Small' WHEN {amount} < 500 THEN 'Medium' ELSE 'Large' END"


def _code(prefix: str, number: str) -> str:
    return f"'{prefix}' || lpad(CAST({number} AS VARCHAR), 19, '0')"


# --- named parts; each may use those before it

_PARTS: dict[str, str] = {}

_PARTS["raw_sales"] = f"""
SELECT
  CASE WHEN NOT (tax = 8 AND disc = 0)
       THEN {_code('TXN', 'l_orderkey')} || '-' || CAST(l_linenumber AS VARCHAR) END AS transaction_id,
  CASE WHEN NOT (tax = 8 AND disc = 1) THEN {_code('CUST', 'o_custkey')} END AS customer_code,
  {_code('PROD', 'l_partkey')} AS product_code,
  CASE WHEN tax = 0 AND disc = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
       WHEN tax = 0 AND disc = 10 THEN strftime(o_orderdate, '%m-%d-%Y')
       WHEN tax = 8 AND disc = 10 THEN strftime(o_orderdate, '%Y%m%d')
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS sale_date,
  CASE WHEN tax = 0 AND disc = 1 THEN 0 WHEN tax = 2 AND disc = 0 AND l_linenumber = 7 THEN 1
       ELSE CAST(l_quantity AS INTEGER) END AS quantity,
  CASE WHEN tax = 0 AND disc = 2 THEN CAST(0 AS DOUBLE)
       WHEN tax = 0 AND disc = 3 THEN CAST(-10 AS DOUBLE)
       WHEN tax = 0 AND disc = 4 THEN CAST(999999.99 AS DOUBLE)
       WHEN tax = 2 AND disc = 0 AND l_linenumber = 7 THEN CAST(2e10 AS DOUBLE)
       WHEN tax = 2 AND disc = 1 AND l_linenumber = 7 THEN CAST(1e300 AS DOUBLE)
       WHEN tax = 2 AND disc = 2 AND l_linenumber = 7 THEN CAST(0.004 AS DOUBLE)
       WHEN tax = 2 AND disc = 5 THEN CAST(9.99 AS DOUBLE)
       ELSE l_extendedprice END AS unit_price,
  CASE WHEN tax = 0 AND disc = 5 THEN CAST(9999999 AS DOUBLE)
       WHEN tax = 2 AND disc = 3 AND l_linenumber = 7 THEN CAST(2e10 AS DOUBLE)
       WHEN tax = 2 AND disc = 4 AND l_linenumber = 7 THEN CAST(1e300 AS DOUBLE)
       WHEN disc > 0 THEN CAST(disc AS DOUBLE) END AS discount,
  CASE WHEN tax = 1 AND disc = 0 THEN NULL
       WHEN tax = 1 AND disc = 10 THEN ''
       ELSE '  ' || lower(substr(o_orderpriority, 3)) || ' ' END AS payment_method
FROM (SELECT *, CAST(round(l_tax * 100) AS INTEGER) AS tax,
             CAST(round(l_discount * 100) AS INTEGER) AS disc FROM lineitem)
JOIN orders ON l_orderkey = o_orderkey
"""

# CSV has no way to tell an empty text from an absent one.
_PARTS["csv_sales"] = """
SELECT * REPLACE (nullif(payment_method, '') AS payment_method) FROM raw_sales
"""

_PARTS["documents_flat"] = f"""
SELECT
  {_code('CUST', 'c_custkey - CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END')} AS customer_code,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal < -900 THEN NULL
       WHEN c_mktsegment = 'BUILDING' THEN lower(given)
       WHEN c_mktsegment = 'MACHINERY' THEN '  ' || given || '  '
       WHEN c_mktsegment = 'FURNITURE' THEN upper(given)
       ELSE given END AS first_name,
  'de la ' || digits AS last_name,
  CASE WHEN c_acctbal < 0 THEN ' customer.' || digits || '@mail.example.com'
       WHEN c_acctbal >= 9700 THEN 'duplicated.email@example.com'
       WHEN c_acctbal >= 9400 THEN 'josé.' || digits || '@mail.example.com'
       WHEN c_mktsegment = 'FURNITURE' THEN 'CUSTOMER.' || digits || '@MAIL.EXAMPLE.COM'
       ELSE 'customer.' || digits || '@mail.example.com' END AS email,
  CASE WHEN c_nationkey = 3 THEN '(912) 345-' || substr(digits, 6, 4)
       WHEN c_nationkey = 4 THEN '051-912-345-' || substr(digits, 7, 3)
       WHEN c_nationkey = 5 THEN NULL
       WHEN c_nationkey = 6 THEN '+51-999-' || digits || ' ext. 0001'
       ELSE '+51-999-' || substr(digits, 4, 6) END AS phone,
  ' ' || lower(n_name) || ' ' AS country,
  lower(r_name) AS city,
  CASE WHEN c_nationkey = 7 THEN strftime(registered, '%d/%m/%Y')
       ELSE strftime(registered, '%Y-%m-%d') END AS registration_date,
  ' ' || lower(c_mktsegment) || ' ' AS customer_segment
FROM (SELECT *, split_part(c_name, '#', 1) AS given, split_part(c_name, '#', 2) AS digits,
             DATE '1995-01-01' + CAST(floor(abs(c_acctbal) / 5) AS INTEGER) AS registered
      FROM customer)
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""

_PARTS["raw_products"] = f"""
SELECT
  {_code('PROD', 'p_partkey - CASE WHEN p_partkey % 40 = 0 THEN 1 ELSE 0 END')} AS product_code,
  CASE WHEN p_size <> 47 THEN p_name END AS product_name,
  ' ' || lower(p_type) AS category,
  split_part(p_name, ' ', 2) AS subcategory,
  upper(p_brand) AS brand,
  CASE WHEN p_size = 13 THEN CAST(0 AS DOUBLE) ELSE p_retailprice END AS unit_price,
  CASE WHEN p_size = 49 THEN NULL
       WHEN p_size = 50 THEN CAST(round(retail * CAST(1.10 AS DECIMAL(3,2)), 2) AS DOUBLE)
       ELSE CAST(round(retail * CAST(0.75 AS DECIMAL(3,2)), 2) AS DOUBLE) END AS cost_price,
  CASE WHEN p_size = 48 THEN CAST(0 AS DOUBLE)
       ELSE CAST(p_size * CAST(0.1 AS DECIMAL(2,1)) AS DOUBLE) END AS weight_kg
FROM (SELECT *, CAST(p_retailprice AS DECIMAL(10,2)) AS retail FROM part)
"""

_PARTS["raw_suppliers"] = f"""
SELECT
  {_code('SUP', 's_suppkey')} AS supplier_id,
  s_name AS company_name,
  'Contact, ' || digits AS contact_person,
  'contact' || digits || '@supplier.example.com' AS email,
  '+51-932-' || substr(digits, 4, 6) AS phone,
  n_name AS country,
  r_name AS city,
  CASE WHEN s_acctbal > 0 THEN s_acctbal END AS rating,
  DATE '1995-01-01' + CAST(floor(abs(s_acctbal) / 5) AS INTEGER) AS contract_start,
  CASE WHEN s_acctbal > 5000 THEN 'NET_60' ELSE 'PREPAID' END AS payment_terms
FROM (SELECT *, split_part(s_name, '#', 2) AS digits FROM supplier)
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""


def _deduplicated_sales(date_expression: str) -> str:
    return f"""
SELECT transaction_id, customer_code, product_code, day AS sale_date, quantity,
  {_price('unit_price')} AS unit_price, {_price('discount')} AS discount,
  upper(trim(payment_method)) AS payment_method,
  CAST(day AS TIMESTAMP) AS sale_timestamp,
  {_OFF} AS discount_amount, {_TAX} AS tax_amount, {_TOTAL} AS total_amount,
  'USD' AS currency_code
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY transaction_id
    ORDER BY valid DESC, customer_code NULLS FIRST, product_code NULLS FIRST, sale_date NULLS FIRST,
      quantity NULLS FIRST, unit_price NULLS FIRST, discount NULLS FIRST,
      payment_method NULLS FIRST) AS place
  FROM (
    SELECT *, coalesce(transaction_id IS NOT NULL AND customer_code IS NOT NULL
      AND product_code IS NOT NULL AND quantity > 0 AND {_price('unit_price')} > 0
      AND day IS NOT NULL AND NOT {_unstorable('discount')}, FALSE) AS valid
    FROM (SELECT *, {date_expression} AS day FROM raw_sales)))
WHERE place = 1 AND valid
"""


_PARTS["clean_sales"] = _deduplicated_sales(_iso("sale_date"))
_PARTS["recovered_sales"] = _deduplicated_sales(_any_date("sale_date"))

_PARTS["clean_customers"] = f"""
SELECT customer_code, {_title('first_name')} AS first_name, {_title('last_name')} AS last_name,
  CASE WHEN regexp_matches(email, {EMAIL}) THEN lower(trim(email)) END AS email,
  regexp_replace(phone, '[^0-9+]', '', 'g') AS phone,
  {_title('country')} AS country, {_title('city')} AS city,
  {_iso('registration_date')} AS registration_date,
  upper(trim(customer_segment)) AS customer_segment
FROM (SELECT *, row_number() OVER (PARTITION BY customer_code ORDER BY valid DESC,
        first_name NULLS FIRST, last_name NULLS FIRST, email NULLS FIRST, phone NULLS FIRST,
        country NULLS FIRST, city NULLS FIRST, registration_date NULLS FIRST,
        customer_segment NULLS FIRST) AS place
      FROM (SELECT *, customer_code IS NOT NULL AND first_name IS NOT NULL
              AND last_name IS NOT NULL AS valid FROM documents_flat))
WHERE place = 1 AND valid
"""

_PARTS["clean_products"] = f"""
SELECT product_code, {_title('product_name')} AS product_name, {_title('category')} AS category,
  {_title('subcategory')} AS subcategory, {_title('brand')} AS brand,
  {_price('unit_price')} AS unit_price, {_price('cost_price')} AS cost_price, weight_kg
FROM (SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY valid DESC,
        product_name NULLS FIRST, category NULLS FIRST, subcategory NULLS FIRST, brand NULLS FIRST,
        unit_price NULLS FIRST, cost_price NULLS FIRST, weight_kg NULLS FIRST) AS place
      FROM (SELECT *, coalesce(product_code IS NOT NULL AND product_name IS NOT NULL
              AND {_price('unit_price')} > 0 AND {_price('cost_price')} > 0
              AND {_price('cost_price')} <= {_price('unit_price')} AND weight_kg > 0, FALSE) AS valid
            FROM raw_products))
WHERE place = 1 AND valid
"""

_PARTS["fact"] = f"""
SELECT s.transaction_id, s.customer_code, s.product_code, s.sale_date, s.sale_timestamp, s.quantity,
  s.unit_price, s.discount_amount, s.tax_amount, s.total_amount, s.payment_method, s.currency_code,
  c.customer_segment, p.category AS product_category, p.brand AS product_brand,
  {RUN_TS} AS created_at,
  CAST(s.unit_price - p.cost_price AS DOUBLE) / CAST(s.unit_price AS DOUBLE) AS profit_margin,
  {_size('s.total_amount')} AS order_size_category
FROM clean_sales s
JOIN clean_customers c ON s.customer_code = c.customer_code
JOIN clean_products p ON s.product_code = p.product_code
"""

_PARTS["customer_ids"] = """
SELECT row_number() OVER (ORDER BY customer_code) AS customer_id, * FROM clean_customers
"""
_PARTS["product_ids"] = """
SELECT row_number() OVER (ORDER BY product_code) AS product_id, * FROM clean_products
"""

_PARTS["stored_fact"] = """
SELECT f.transaction_id, c.customer_id, p.product_id, f.sale_date, f.sale_timestamp, f.quantity,
  TRY_CAST(f.unit_price AS DECIMAL(10,2)) AS unit_price,
  TRY_CAST(f.discount_amount AS DECIMAL(10,2)) AS discount_amount,
  TRY_CAST(f.tax_amount AS DECIMAL(10,2)) AS tax_amount,
  TRY_CAST(f.total_amount AS DECIMAL(12,2)) AS total_amount,
  f.payment_method, f.currency_code, f.created_at
FROM fact f
JOIN customer_ids c ON f.customer_code = c.customer_code
JOIN product_ids p ON f.product_code = p.product_code
"""

# An average to two decimals, half away from zero, in whole numbers: the sum is
# in cents and n counts the rows.
_MEAN_CENTS = "CAST(sign(cents) * ((2 * abs(cents) + n) // (2 * n)) AS DOUBLE) / 100"

_PARTS["day_totals"] = """
SELECT sale_date, sum(amount) AS total, CAST(sum(amount) * 100 AS HUGEINT) AS cents,
  count(*) AS n, count(DISTINCT customer_code) AS customers
FROM (SELECT *, CAST(total_amount AS DECIMAL(26,2)) AS amount FROM fact)
GROUP BY sale_date
"""

_PARTS["day_best"] = """
SELECT sale_date, product_category FROM (
  SELECT sale_date, product_category, row_number() OVER (
    PARTITION BY sale_date ORDER BY sum(CAST(total_amount AS DECIMAL(26,2))) DESC,
      product_category NULLS LAST) AS place
  FROM fact GROUP BY sale_date, product_category)
WHERE place = 1
"""

_PARTS["days"] = f"""
SELECT t.sale_date AS summary_date, CAST(t.total AS DOUBLE) AS total_sales_amount,
  t.n AS total_transactions, t.customers AS unique_customers,
  {_MEAN_CENTS} AS avg_transaction_value, b.product_category AS top_product_category,
  {RUN_TS} AS created_at
FROM day_totals t JOIN day_best b ON t.sale_date IS NOT DISTINCT FROM b.sale_date
"""

_PARTS["unfiltered_sales"] = f"""
SELECT transaction_id, customer_code, product_code, {_iso('sale_date')} AS sale_date, quantity,
  unit_price, discount, payment_method, {_OFF} AS discount_amount, {_TAX} AS tax_amount,
  {_TOTAL} AS total_amount
FROM raw_sales
"""

_PARTS["complete_sales"] = """
SELECT DISTINCT * FROM raw_sales
WHERE transaction_id IS NOT NULL AND customer_code IS NOT NULL AND product_code IS NOT NULL
  AND sale_date IS NOT NULL AND quantity IS NOT NULL AND unit_price IS NOT NULL
  AND discount IS NOT NULL AND payment_method IS NOT NULL
"""

_PARTS["complete_products"] = """
SELECT DISTINCT * FROM raw_products
WHERE product_code IS NOT NULL AND product_name IS NOT NULL AND category IS NOT NULL
  AND subcategory IS NOT NULL AND brand IS NOT NULL AND unit_price IS NOT NULL
  AND cost_price IS NOT NULL AND weight_kg IS NOT NULL
"""

_PARTS["quick_lines"] = f"""
SELECT s.*, CAST({_price('s.unit_price')} * CAST(s.quantity AS DECIMAL(10,0)) AS DECIMAL(27,2))
    * (CAST(1 AS DECIMAL(16,2)) - {_price('s.discount')}) AS total_amount,
  {RUN_TS} AS processing_timestamp, p.category, p.brand
FROM complete_sales s LEFT JOIN complete_products p ON s.product_code = p.product_code
"""


def _check(table: str, name: str, failed: str, good: str, bad: str, source: str,
           processed: str = "0", on_failure: str = "FAIL") -> str:
    bad_before, bad_after = bad.split("{n}")
    return f"""
SELECT '{table}' AS table_name, '{name}' AS check_name,
  CASE WHEN failed = 0 THEN 'PASS' ELSE '{on_failure}' END AS check_result,
  CASE WHEN failed = 0 THEN '{good}'
       ELSE '{bad_before}' || CAST(failed AS VARCHAR) || '{bad_after}' END AS check_details,
  CAST(processed AS BIGINT) AS records_processed, CAST(failed AS BIGINT) AS records_failed
FROM (SELECT {failed} AS failed, {processed} AS processed FROM {source})
"""


def _completeness(table: str, source: str, least: int = 1) -> str:
    return f"""
SELECT '{table}' AS table_name, 'completeness' AS check_name,
  CASE WHEN n >= {least} THEN 'PASS' ELSE 'FAIL' END AS check_result,
  CASE WHEN n >= {least} THEN 'Table has ' || CAST(n AS VARCHAR) || ' records (>= {least})'
       ELSE 'Table has only ' || CAST(n AS VARCHAR) || ' records (< {least})' END AS check_details,
  n AS records_processed, CAST(0 AS BIGINT) AS records_failed
FROM (SELECT count(*) AS n FROM {source})
"""


def _uniqueness(table: str, source: str, *columns: str) -> str:
    names = ", ".join(columns)
    # A key with a NULL part is no key.
    keyed = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {names} FROM {source} WHERE {keyed}))"
    return _check(
        table, "uniqueness", f"count(*) - {distinct}", f"No duplicates found in {names}",
        f"Found {{n}} duplicate records in {names}", source, processed="count(*)",
    )


def _orphans(name: str, parent: str, key: str, noun: str, source: str = "clean_sales") -> str:
    return _check(
        "fact_sales",
        f"{name}_integrity",
        "count(*)",
        f"All {name} references are valid",
        f"Found {{n}} orphan {name} references",
        f"{source} f LEFT JOIN {parent} d ON f.{key} = d.{key} WHERE d.{key} IS NULL",
    )


def _references() -> str:
    return (
        _orphans("customer", "clean_customers", "customer_code", "customer")
        + " UNION ALL "
        + _orphans("product", "clean_products", "product_code", "product")
    )


def _business_rules(source: str) -> str:
    return " UNION ALL ".join(
        [
            _check("fact_sales", "quantity_validation", "count(*)",
                   "All sales have valid quantities", "Found {n} sales with invalid quantities",
                   f"{source} WHERE quantity <= 0"),
            _check("fact_sales", "price_validation", "count(*)",
                   "All prices are positive", "Found {n} records with negative prices",
                   f"{source} WHERE unit_price < 0 OR total_amount < 0"),
            _check("fact_sales", "date_validation", "count(*)",
                   "No future sales dates found", "Found {n} sales with future dates",
                   f"{source} WHERE sale_date > {AS_OF}", on_failure="WARNING"),
        ]
    )


_PARTS["checks"] = " UNION ALL ".join(
    [
        _completeness("dim_customers", "clean_customers"),
        _completeness("dim_products", "clean_products"),
        _completeness("fact_sales", "clean_sales"),
        _uniqueness("dim_customers", "clean_customers", "customer_code"),
        _uniqueness("dim_products", "clean_products", "product_code"),
        _uniqueness("fact_sales", "clean_sales", "transaction_id"),
        _references(),
        _business_rules("clean_sales"),
    ]
)

_PARTS["tallies"] = """
SELECT 'run-1' AS pipeline_run_id, count(*) AS total_checks,
  count(*) FILTER (check_result = 'PASS') AS passed_checks,
  count(*) FILTER (check_result = 'FAIL') AS failed_checks,
  count(*) FILTER (check_result = 'WARNING') AS warning_checks,
  count(*) FILTER (check_result = 'ERROR') AS error_checks,
  count(*) FILTER (check_result = 'ERROR' OR (check_result = 'FAIL' AND check_name IN
    ('completeness', 'uniqueness', 'customer_integrity', 'product_integrity'))) AS critical_failures
FROM checks
"""

# Which part uses which.
_NEEDS: dict[str, tuple[str, ...]] = {
    "csv_sales": ("raw_sales",),
    "clean_sales": ("raw_sales",),
    "recovered_sales": ("raw_sales",),
    "clean_customers": ("documents_flat",),
    "clean_products": ("raw_products",),
    "fact": ("clean_sales", "clean_customers", "clean_products"),
    "customer_ids": ("clean_customers",),
    "product_ids": ("clean_products",),
    "stored_fact": ("fact", "customer_ids", "product_ids"),
    "day_totals": ("fact",),
    "day_best": ("fact",),
    "days": ("day_totals", "day_best"),
    "unfiltered_sales": ("raw_sales",),
    "complete_sales": ("raw_sales",),
    "complete_products": ("raw_products",),
    "quick_lines": ("complete_sales", "complete_products"),
    "checks": ("clean_sales", "clean_customers", "clean_products"),
    "tallies": ("checks",),
}


def _with(select: str, *parts: str) -> str:
    """``select`` after the parts it names and those they need."""
    wanted: dict[str, None] = {}

    def add(name: str) -> None:
        for need in _NEEDS.get(name, ()):
            add(need)
        wanted.setdefault(name)

    for part in parts:
        add(part)
    # Every part is used more than once or not at all costly; computing each
    # once keeps the statement quick.
    heads = ",\n".join(f"{name} AS MATERIALIZED ({_PARTS[name].strip()})" for name in wanted)
    return f"WITH {heads}\n{select.strip()}" if heads else select.strip()


_CLEAN_SALES_COLUMNS = """
transaction_id, customer_code, product_code, sale_date, quantity,
CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount AS DOUBLE) AS discount, payment_method,
sale_timestamp, CAST(discount_amount AS DOUBLE) AS discount_amount,
CAST(tax_amount AS DOUBLE) AS tax_amount, CAST(total_amount AS DOUBLE) AS total_amount,
currency_code
"""

_PRODUCT_COLUMNS = """
product_code, product_name, category, subcategory, brand, CAST(unit_price AS DOUBLE) AS unit_price,
CAST(cost_price AS DOUBLE) AS cost_price, weight_kg
"""

_DAILY_CATEGORY = f"""
SELECT sale_date, product_category, CAST(sum(total_amount) AS DOUBLE) AS total_sales,
  CAST(sum(quantity) AS BIGINT) AS total_quantity, count(transaction_id) AS transaction_count,
  {_mean('total_amount')} AS avg_transaction_value,
  count(DISTINCT customer_code) AS unique_customers
FROM fact GROUP BY sale_date, product_category
"""

_GLOBAL = f"""
coalesce(CAST(sum(total_amount) AS DOUBLE), 0) AS total_sales,
coalesce({_mean('total_amount')}, 0) AS avg_sale,
coalesce(CAST(max(total_amount) AS DOUBLE), 0) AS max_sale,
coalesce(CAST(min(total_amount) AS DOUBLE), 0) AS min_sale,
count(*) AS total_transactions
"""


def _nulls_of(table: str, dataset: str, columns: Iterable[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{c}' AS column_name, "
        f"count(*) FILTER ({c} IS NULL) AS null_values FROM {table}"
        for c in columns
    )


_SALES_COLUMNS = (
    "transaction_id customer_code product_code sale_date quantity unit_price discount "
    "payment_method"
).split()
_CUSTOMER_COLUMNS = (
    "customer_code first_name last_name email phone country city registration_date "
    "customer_segment"
).split()
_PRODUCT_NAMES = (
    "product_code product_name category subcategory brand unit_price cost_price weight_kg"
).split()


def _profile(table: str, dataset: str, columns: list[str]) -> str:
    nulls = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns)
    return f"""
SELECT '{dataset}' AS dataset, count(*) AS records, CAST({len(columns)} AS INTEGER) AS columns,
  CAST({nulls} AS BIGINT) AS null_values,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table})) AS duplicates, 'OK' AS status
FROM {table}
"""


def _defect(table: str, source: str, name: str, count: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS defect, {count} AS n, "
        f"CAST({count} AS DOUBLE) * 100 / CAST(count(*) AS DOUBLE) AS pct FROM {source}"
    )


def _defects(table: str, source: str, counts: dict[str, str]) -> str:
    return " UNION ALL ".join(_defect(table, source, n, c) for n, c in counts.items())


def _violations(checks: Iterable[tuple[str, str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        f"count(*) FILTER ({broken}) AS violations FROM {source}"
        for table, source, column, broken in checks
    )


_SOURCES = {
    "dim_customers": "documents_flat",
    "dim_products": "raw_products",
    "fact_sales": "unfiltered_sales",
}

_NOT_NULL = {
    "dim_customers": ["customer_code"],
    "dim_products": ["product_code"],
    "fact_sales": ["transaction_id", "sale_date", "quantity", "unit_price", "total_amount"],
}
# Required columns that the sources lack, so that every row breaks the rule.
_ABSENT = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "fact_sales": ["sale_id", "sale_timestamp"],
}
_LENGTHS = {
    "dim_customers": {
        "customer_code": 50, "first_name": 100, "last_name": 100, "email": 255, "phone": 20,
        "country": 100, "city": 100, "customer_segment": 50,
    },
    "dim_products": {
        "product_code": 50, "product_name": 255, "category": 100, "subcategory": 100, "brand": 100,
    },
    "fact_sales": {"transaction_id": 100, "payment_method": 50},
}
_DECIMALS = {
    "dim_products": {"unit_price": "10,2", "cost_price": "10,2", "weight_kg": "8,3"},
    "fact_sales": {
        "unit_price": "10,2", "discount_amount": "10,2", "tax_amount": "10,2",
        "total_amount": "12,2",
    },
}


def oracle_queries() -> dict[str, str]:
    """The statement for each registered query that has one."""
    known = "SELECT row_number() OVER (ORDER BY customer_code) AS customer_id, * FROM clean_customers WHERE registration_date < DATE '1998-01-01'"
    sql: dict[str, str] = {}

    sql["daily_category_metrics"] = _with(_DAILY_CATEGORY, "fact")
    # Folding deliveries in gives what one pass over all sales gives.
    sql["daily_metrics_refresh"] = sql["daily_category_metrics"]
    sql["customer_metrics"] = _with(
        f"""
SELECT customer_code, customer_segment, max(sale_date) AS last_purchase_date,
  count(transaction_id) AS frequency, CAST(sum(total_amount) AS DOUBLE) AS monetary_value,
  {_mean('total_amount')} AS avg_order_value,
  CAST(date_diff('day', max(latest), {AS_OF}) AS INTEGER) AS recency_days
FROM (SELECT *, max(sale_date) OVER (PARTITION BY customer_code) AS latest FROM fact)
GROUP BY customer_code, customer_segment""",
        "fact",
    )
    sql["customer_recency_window"] = _with(
        f"""
SELECT transaction_id, customer_code, sale_date, CAST(date_diff('day',
  max(sale_date) OVER (PARTITION BY customer_code), {AS_OF}) AS INTEGER) AS recency_days
FROM clean_sales""",
        "clean_sales",
    )
    sql["global_metrics"] = _with(f"SELECT {_GLOBAL} FROM clean_sales", "clean_sales")
    sql["top_categories"] = _with(
        f"""
SELECT category, CAST(sum(amount) AS DOUBLE) AS total_sales FROM (
  SELECT p.category, {_price('s.unit_price')} * CAST(s.quantity AS DECIMAL(10,0)) AS amount
  FROM complete_sales s LEFT JOIN clean_products p ON s.product_code = p.product_code)
WHERE category IS NOT NULL
GROUP BY category ORDER BY sum(amount) DESC, category LIMIT 3""",
        "complete_sales",
        "clean_products",
    )
    sql["daily_sales_summary"] = _with(
        f"""
SELECT {SUMMARY_DAY} AS summary_date, CAST(total AS DOUBLE) AS total_sales_amount,
  n AS total_transactions, customers AS unique_customers,
  CASE WHEN n > 0 THEN {_MEAN_CENTS} END AS avg_transaction_value,
  (SELECT p.category FROM stored_fact f JOIN product_ids p ON f.product_id = p.product_id
   WHERE f.sale_date = {SUMMARY_DAY} GROUP BY p.category
   ORDER BY sum(f.total_amount) DESC, p.category LIMIT 1) AS top_product_category,
  {RUN_TS} AS created_at
FROM (SELECT sum(total_amount) AS total, CAST(sum(total_amount) * 100 AS HUGEINT) AS cents,
        count(*) AS n, count(DISTINCT customer_id) AS customers
      FROM stored_fact WHERE sale_date = {SUMMARY_DAY})""",
        "stored_fact",
    )
    sql["daily_sales_summary_all"] = _with("SELECT * FROM days", "days")
    sql["order_size_distribution"] = _with(
        f"""
SELECT {_size('total_amount')} AS order_size_category, count(*) AS orders,
  CAST(sum(total_amount) AS DOUBLE) AS total_sales
FROM clean_sales GROUP BY 1""",
        "clean_sales",
    )

    # cleaning
    sql["dedup_by_key"] = _with(
        f"""
SELECT {', '.join(_SALES_COLUMNS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {
            ', '.join(c + ' NULLS FIRST' for c in _SALES_COLUMNS[1:])}) AS place
  FROM raw_sales)
WHERE place = 1""",
        "raw_sales",
    )
    sql["clean_sales"] = _with(f"SELECT {_CLEAN_SALES_COLUMNS} FROM clean_sales", "clean_sales")
    sql["clean_sales_recovered_dates"] = _with(
        "SELECT transaction_id, sale_date, CAST(total_amount AS DOUBLE) AS total_amount "
        "FROM recovered_sales",
        "recovered_sales",
    )
    outcomes = [
        ("missing_transaction_id", "transaction_id IS NULL"),
        ("missing_customer_code", "customer_code IS NULL"),
        ("missing_product_code", "product_code IS NULL"),
        ("bad_quantity", "quantity IS NULL OR quantity <= 0"),
        ("unstorable_unit_price", _unstorable("unit_price")),
        ("bad_unit_price", f"unit_price IS NULL OR {_price('unit_price')} <= 0"),
        ("unstorable_discount", _unstorable("discount")),
        ("bad_sale_date", f"({_iso('sale_date')}) IS NULL"),
    ]
    cases = " ".join(f"WHEN {broken} THEN '{name}'" for name, broken in outcomes)
    names = ", ".join(f"('{n}')" for n, _ in outcomes)
    sql["clean_sales_rejects"] = _with(
        f"""
, judged AS (SELECT *, CASE {cases} END AS defect FROM raw_sales)
SELECT outcome, count(defect) AS records FROM (VALUES {names}) o(outcome)
LEFT JOIN judged ON defect = outcome GROUP BY outcome
UNION ALL SELECT 'kept', count(*) FROM clean_sales
UNION ALL SELECT 'duplicate', count(*) - (SELECT count(*) FROM clean_sales)
FROM judged WHERE defect IS NULL""",
        "clean_sales",
    ).replace("\n, judged", ",\njudged")
    sql["clean_customers"] = _with("SELECT * FROM clean_customers", "clean_customers")
    sql["email_rejects"] = _with(
        f"""
SELECT count(email) AS emails,
  count(*) FILTER (email IS NOT NULL AND NOT regexp_matches(email, {EMAIL})) AS email_rejected
FROM documents_flat""",
        "documents_flat",
    )
    sql["clean_products"] = _with(f"SELECT {_PRODUCT_COLUMNS} FROM clean_products", "clean_products")
    sql["drop_nulls_distinct"] = _with("SELECT * FROM complete_sales", "complete_sales")
    sql["scalar_string_std"] = _with(
        f"""
SELECT customer_code, trim(country) AS trimmed, {_title('first_name')} AS titled,
  upper(trim(customer_segment)) AS coded, lower(first_name) AS lowered,
  regexp_matches(email, {EMAIL}) AS email_ok,
  CASE WHEN regexp_matches(email, {EMAIL}) THEN lower(trim(email)) END AS email,
  regexp_replace(phone, '[^0-9+]', '', 'g') AS phone
FROM documents_flat""",
        "documents_flat",
    )
    sql["scalar_dates"] = _with(
        f"""
SELECT sale_date, n, strict_date, lenient_date, CAST(strict_date AS TIMESTAMP) AS midnight,
  CAST(date_diff('day', strict_date, {AS_OF}) AS INTEGER) AS days_before,
  CAST(year(strict_date) AS INTEGER) AS year
FROM (SELECT sale_date, count(*) AS n, {_iso('sale_date')} AS strict_date,
        {_any_date('sale_date')} AS lenient_date
      FROM raw_sales GROUP BY sale_date)""",
        "raw_sales",
    )
    sql["scalar_conditionals"] = _with(
        f"""
SELECT product_code, unit_price, quantity, CAST(discount_amount AS DOUBLE) AS discount_amount,
  CAST(tax_amount AS DOUBLE) AS tax_amount, CAST(total_amount AS DOUBLE) AS total_amount,
  {_size('total_amount')} AS order_size_category,
  CASE WHEN quantity <> 0 THEN CAST(total_amount AS DOUBLE) / CAST(quantity AS DOUBLE) END AS per_unit,
  CAST(round(total_amount, 1) AS DOUBLE) AS rounded,
  customer_code IS NOT NULL AND unit_price > 0 AS usable
FROM unfiltered_sales""",
        "unfiltered_sales",
    )
    sql["sale_year"] = _with(
        f"SELECT CAST(year({_iso('sale_date')}) AS INTEGER) AS sale_year, count(*) AS n "
        "FROM raw_sales GROUP BY 1",
        "raw_sales",
    )

    # ingestion
    sql["flatten_customers"] = _with("SELECT * FROM documents_flat", "documents_flat")
    sql["ingest_metadata"] = _with(
        f"SELECT *, {RUN_TS} AS ingestion_timestamp, 'suppliers.csv' AS source_file "
        "FROM raw_suppliers",
        "raw_suppliers",
    )
    sql["scan_csv_sales"] = _with("SELECT * FROM csv_sales", "csv_sales")
    sql["scan_csv_products"] = _with("SELECT * FROM raw_products", "raw_products")
    sql["scan_csv_suppliers"] = _with("SELECT * FROM raw_suppliers", "raw_suppliers")
    sql["scan_csv_infer"] = sql["scan_csv_products"]
    sql["scan_json_customers"] = sql["flatten_customers"]
    sql["scan_parquet"] = "SELECT c_custkey, c_name, c_mktsegment FROM customer"

    # model
    audit = f"{RUN_TS} AS created_at, {RUN_TS} AS updated_at"
    sql["dim_customers"] = _with(f"SELECT *, {audit} FROM clean_customers", "clean_customers")
    sql["dim_products"] = _with(
        f"SELECT {_PRODUCT_COLUMNS}, {audit} FROM clean_products", "clean_products"
    )
    amounts = ("unit_price", "discount_amount", "tax_amount", "total_amount")
    as_double = ", ".join(f"CAST({a} AS DOUBLE) AS {a}" for a in amounts)
    sql["fact_sales"] = _with(f"SELECT * REPLACE ({as_double}) FROM fact", "fact")
    sql["fact_join_loss"] = _with(
        """
SELECT count(*) AS rows_in,
  count(*) FILTER (c.customer_code IS NOT NULL AND p.product_code IS NOT NULL) AS rows_out,
  count(*) FILTER (c.customer_code IS NULL) AS missing_customer,
  count(*) FILTER (p.product_code IS NULL) AS missing_product
FROM clean_sales s LEFT JOIN clean_customers c ON s.customer_code = c.customer_code
LEFT JOIN clean_products p ON s.product_code = p.product_code""",
        "fact",
    )
    sql["enrich_left"] = _with(
        f"""
SELECT s.transaction_id, s.product_code, CAST(s.total_amount AS DOUBLE) AS total_amount,
  {RUN_TS} AS processing_timestamp, p.category, p.brand
FROM clean_sales s LEFT JOIN clean_products p ON s.product_code = p.product_code""",
        "clean_sales",
        "clean_products",
    )
    sql["total_gross"] = _with(
        f"SELECT product_code, quantity, unit_price, CAST({_GROSS} AS DOUBLE) AS total_amount "
        "FROM raw_sales",
        "raw_sales",
    )
    sql["total_fractional_discount"] = f"""
SELECT l_orderkey, l_linenumber, unit_price, quantity, discount, CAST({_GROSS}
  * (CAST(1 AS DECIMAL(16,2)) - {_price('discount')}) AS DOUBLE) AS total_amount
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice AS unit_price,
        CAST(l_quantity AS INTEGER) AS quantity,
        CASE WHEN l_discount > 0 THEN l_discount END AS discount FROM lineitem)"""

    # quality
    cleaned = ("clean_sales", "clean_customers", "clean_products")
    sql["dq_completeness"] = _with(
        _completeness("dim_customers", "clean_customers")
        + " UNION ALL "
        + _completeness("dim_products", "clean_products", 10**12),
        *cleaned[1:],
    )
    sql["dq_uniqueness"] = _with(
        _uniqueness("dim_customers", "clean_customers", "customer_code")
        + " UNION ALL "
        + _uniqueness("raw_sales", "raw_sales", "transaction_id")
        + " UNION ALL "
        + _uniqueness("raw_sales", "raw_sales", "customer_code", "product_code")
        + " UNION ALL "
        + _uniqueness("dim_customers", "customer_ids", "customer_id")
        + " UNION ALL "
        + _uniqueness("daily_sales_summary", "days", "summary_date"),
        "customer_ids",
        "days",
    )
    sql["dq_referential"] = _with(_references(), *cleaned)
    known_then = "(SELECT * FROM clean_customers WHERE registration_date < DATE '1998-11-01')"
    sql["dq_referential_ids"] = _with(
        _orphans("customer", known_then, "customer_code", "customer")
        + " UNION ALL "
        + _orphans("product", "clean_products", "product_code", "product"),
        *cleaned,
    )
    sql["dq_business_rules"] = _with(_business_rules("unfiltered_sales"), "unfiltered_sales")
    sql["dq_run_all"] = _with("SELECT * FROM checks", "checks")
    sql["dq_summary"] = _with("SELECT * FROM tallies", "tallies")
    sql["dq_alert_level"] = _with(
        """
SELECT pipeline_run_id, CASE WHEN critical_failures > 0 THEN 'CRITICAL'
  WHEN warning_checks > 0 THEN 'WARNING' ELSE 'NONE' END AS alert_level FROM tallies""",
        "tallies",
    )
    sql["dq_log"] = _with(
        f"""
SELECT row_number() OVER (ORDER BY check_name) AS log_id, 'run-1' AS pipeline_run_id, *,
  {EARLIER_TS} AS execution_time FROM ({_references()})
UNION ALL
SELECT 2 + row_number() OVER (ORDER BY check_name), 'run-2', *, {RUN_TS}
FROM ({_business_rules('unfiltered_sales')})""",
        *cleaned,
        "unfiltered_sales",
    )
    raw_parts = ("documents_flat", "raw_products", "unfiltered_sales")
    sql["constraint_not_null"] = _with(
        _violations(
            [(t, _SOURCES[t], c, f"{c} IS NULL") for t, cols in _NOT_NULL.items() for c in cols]
            + [(t, _SOURCES[t], c, "TRUE") for t, cols in _ABSENT.items() for c in cols]
        ),
        *raw_parts,
    )
    sql["constraint_lengths"] = _with(
        _violations(
            (t, _SOURCES[t], c, f"length({c}) > {n}")
            for t, cols in _LENGTHS.items()
            for c, n in cols.items()
        ),
        *raw_parts,
    )
    sql["constraint_decimals"] = _with(
        _violations(
            (t, _SOURCES[t], c, f"{c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL({p})) IS NULL")
            for t, cols in _DECIMALS.items()
            for c, p in cols.items()
        ),
        *raw_parts,
    )

    # profiles
    sql["profile_nulls"] = _with(
        _nulls_of("raw_sales", "sales", _SALES_COLUMNS)
        + " UNION ALL "
        + _nulls_of("documents_flat", "customers", _CUSTOMER_COLUMNS),
        "raw_sales",
        "documents_flat",
    )
    sql["profile_duplicates"] = _with(
        """
SELECT 'sales' AS dataset, count(*) AS records,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_sales)) AS duplicates
FROM raw_sales
UNION ALL
SELECT 'customer_names', count(*), count(*) - (SELECT count(*) FROM (
  SELECT DISTINCT first_name, country, customer_segment FROM documents_flat))
FROM documents_flat""",
        "raw_sales",
        "documents_flat",
    )
    sql["profile_sources"] = _with(
        _profile("csv_sales", "sales", _SALES_COLUMNS)
        + " UNION ALL "
        + _profile("raw_products", "products", _PRODUCT_NAMES)
        + " UNION ALL "
        + _profile("documents_flat", "customers", _CUSTOMER_COLUMNS)
        + " UNION ALL SELECT 'returns', 0, NULL, NULL, NULL, 'NOT_FOUND'",
        "csv_sales",
        "raw_products",
        "documents_flat",
    )
    sql["defects_sales"] = _with(
        _defects(
            "sales",
            "raw_sales",
            {
                "repeated_transaction_id": "count(transaction_id) - count(DISTINCT transaction_id)",
                "missing_discount": "count(*) FILTER (discount IS NULL)",
                "missing_payment_method": (
                    "count(*) FILTER (payment_method IS NULL OR trim(payment_method) = '')"
                ),
                "date_dd_mm_yyyy": "count(*) FILTER (sale_date LIKE '__/__/____')",
                "date_mm_dd_yyyy": "count(*) FILTER (sale_date LIKE '__-__-____')",
                "date_yyyymmdd": "count(*) FILTER (sale_date LIKE '________')",
                "date_unreadable": (
                    f"count(*) FILTER (sale_date IS NOT NULL AND ({_any_date('sale_date')}) IS NULL)"
                ),
                "price_zero": "count(*) FILTER (unit_price = 0)",
                "price_negative": "count(*) FILTER (unit_price < 0)",
                "price_extreme": "count(*) FILTER (unit_price >= 999999.99)",
            },
        ),
        "raw_sales",
    )
    sql["defects_customers"] = _with(
        _defects(
            "customers",
            "documents_flat",
            {
                "name_lower": (
                    "count(*) FILTER (regexp_matches(first_name, '[a-z]') "
                    "AND first_name = lower(first_name))"
                ),
                "name_upper": (
                    "count(*) FILTER (regexp_matches(first_name, '[A-Z]') "
                    "AND first_name = upper(first_name))"
                ),
                "name_padded": "count(*) FILTER (first_name <> trim(first_name))",
                "repeated_email": "count(email) - count(DISTINCT email)",
                "phone_not_standard": (
                    r"count(*) FILTER (NOT regexp_matches(phone, '^\+51-999-[0-9]{6}$'))"
                ),
                "non_ascii": (
                    "count(*) FILTER (strlen(first_name) <> length(first_name) "
                    "OR strlen(last_name) <> length(last_name) OR strlen(email) <> length(email))"
                ),
                "missing_email": "count(*) FILTER (email IS NULL)",
                "missing_phone": "count(*) FILTER (phone IS NULL)",
            },
        ),
        "documents_flat",
    )
    sql["defects_products"] = _with(
        _defects(
            "products",
            "raw_products",
            {
                "cost_above_price": "count(*) FILTER (cost_price > unit_price)",
                "price_zero": "count(*) FILTER (unit_price = 0)",
                "missing_cost": "count(*) FILTER (cost_price IS NULL)",
            },
        ),
        "raw_products",
    )
    sql["stage_counts"] = _with(
        """
SELECT stage, count(*) AS tables, CAST(sum(n) AS BIGINT) AS records FROM (
  SELECT 'ingest' AS stage, count(*) AS n FROM raw_sales
  UNION ALL SELECT 'ingest', count(*) FROM documents_flat
  UNION ALL SELECT 'ingest', count(*) FROM raw_products
  UNION ALL SELECT 'clean', count(*) FROM clean_sales
  UNION ALL SELECT 'clean', count(*) FROM clean_customers
  UNION ALL SELECT 'clean', count(*) FROM clean_products
  UNION ALL SELECT 'model', count(*) FROM fact)
GROUP BY stage""",
        "fact",
    )

    # warehouse
    sql["surrogate_keys"] = _with(
        f"""
, known AS ({known})
SELECT customer_id, customer_code, customer_segment FROM known
UNION ALL
SELECT (SELECT coalesce(max(customer_id), 0) FROM known)
    + row_number() OVER (ORDER BY customer_code), customer_code, customer_segment
FROM clean_customers WHERE customer_code NOT IN (SELECT customer_code FROM known)""",
        "clean_customers",
    ).replace("\n, known", ",\nknown")
    sql["surrogate_keys_sales"] = _with(
        "SELECT row_number() OVER (ORDER BY transaction_id) AS sale_id, transaction_id, sale_date "
        "FROM clean_sales",
        "clean_sales",
    )
    sql["column_defaults"] = _with(
        f"""
SELECT transaction_id, sale_date, quantity, CAST(discount AS DOUBLE) AS discount, payment_method,
  CAST(0 AS DOUBLE) AS discount_amount, CAST(0 AS DOUBLE) AS tax_amount,
  'USD' AS currency_code, {RUN_TS} AS created_at
FROM clean_sales""",
        "clean_sales",
    )
    sql["warehouse_fact"] = _with(
        f"SELECT * REPLACE ({as_double}) FROM stored_fact", "stored_fact"
    )
    sql["dim_scd1_merge"] = _with(
        f"""
, known AS ({known}),
fresh AS (SELECT * FROM clean_customers
  WHERE registration_date >= DATE '1996-01-01' OR registration_date IS NULL),
ids AS (SELECT (SELECT coalesce(max(customer_id), 0) FROM known)
    + row_number() OVER (ORDER BY customer_code) AS customer_id, customer_code
  FROM fresh WHERE customer_code NOT IN (SELECT customer_code FROM known))
SELECT k.customer_id, k.* EXCLUDE (customer_id, email, customer_segment),
  NULL AS email, 'UNKNOWN' AS customer_segment, {EARLIER_TS} AS created_at, {EARLIER_TS} AS updated_at
FROM known k WHERE customer_code NOT IN (SELECT customer_code FROM fresh)
UNION ALL BY NAME
SELECT k.customer_id, f.*, {EARLIER_TS} AS created_at, {RUN_TS} AS updated_at
FROM fresh f JOIN known k ON f.customer_code = k.customer_code
UNION ALL BY NAME
SELECT i.customer_id, f.*, {RUN_TS} AS created_at, {RUN_TS} AS updated_at
FROM fresh f JOIN ids i ON f.customer_code = i.customer_code""",
        "clean_customers",
    ).replace("\n, known", ",\nknown")
    sql["fact_append_idempotent"] = _with(
        f"""
SELECT transaction_id, sale_date, CAST(total_amount AS DOUBLE) AS total_amount,
  CASE WHEN sale_date < DATE '1999-01-01' THEN {EARLIER_TS} ELSE {RUN_TS} END AS created_at
FROM fact""",
        "fact",
    )
    sql["summary_upsert"] = _with(
        f"""
SELECT summary_date, total_sales_amount,
  CASE WHEN summary_date < DATE '1998-11-10' THEN 0 ELSE total_transactions END AS total_transactions,
  unique_customers, avg_transaction_value,
  CASE WHEN summary_date >= DATE '1998-11-10' THEN top_product_category END AS top_product_category,
  CASE WHEN summary_date < DATE '1999-01-01' THEN {EARLIER_TS} ELSE {RUN_TS} END AS created_at
FROM days""",
        "days",
    )
    sql["insert_if_absent"] = _with(
        f"""
SELECT *, {RUN_TS} AS created_at, {RUN_TS} AS updated_at FROM clean_customers
UNION ALL BY NAME
SELECT customer_code, first_name, last_name, email, customer_segment FROM (SELECT customer_code, first_name, last_name, NULL AS email, customer_segment,
        row_number() OVER (PARTITION BY customer_code ORDER BY first_name NULLS FIRST,
          last_name NULLS FIRST, customer_segment NULLS FIRST) AS place FROM documents_flat) r
WHERE place = 1
  AND NOT EXISTS (SELECT 1 FROM clean_customers c WHERE c.customer_code = r.customer_code)""",
        "clean_customers",
    )

    # sinks
    sql["sink_parquet_roundtrip"] = sql["clean_sales"]
    sql["sink_partitioned_roundtrip"] = _with(
        "SELECT transaction_id, sale_date, product_category, "
        "CAST(total_amount AS DOUBLE) AS total_amount FROM fact",
        "fact",
    )
    sql["sink_csv_roundtrip"] = _with(
        "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount, "
        "nullif(payment_method, '') AS payment_method) FROM quick_lines",
        "quick_lines",
    )
    sql["sink_json_roundtrip"] = sql["daily_category_metrics"]

    # batch runs
    sql["batch_run"] = _with(
        """
SELECT 'ingest' AS stage, 'raw_sales' AS table_name, count(*) AS records FROM raw_sales
UNION ALL SELECT 'ingest', 'raw_customers', count(*) FROM documents_flat
UNION ALL SELECT 'ingest', 'raw_products', count(*) FROM raw_products
UNION ALL SELECT 'clean', 'clean_sales', count(*) FROM clean_sales
UNION ALL SELECT 'clean', 'clean_customers', count(*) FROM clean_customers
UNION ALL SELECT 'clean', 'clean_products', count(*) FROM clean_products
UNION ALL SELECT 'clean', 'clean_sales_removed',
  count(*) - (SELECT count(*) FROM clean_sales) FROM raw_sales
UNION ALL SELECT 'clean', 'clean_customers_removed',
  count(*) - (SELECT count(*) FROM clean_customers) FROM documents_flat
UNION ALL SELECT 'clean', 'clean_products_removed',
  count(*) - (SELECT count(*) FROM clean_products) FROM raw_products
UNION ALL SELECT 'model', 'dim_customers', count(*) FROM clean_customers
UNION ALL SELECT 'model', 'dim_products', count(*) FROM clean_products
UNION ALL SELECT 'model', 'fact_sales', count(*) FROM fact
UNION ALL SELECT 'model', 'daily_category_metrics', count(*)
  FROM (SELECT DISTINCT sale_date, product_category FROM fact)
UNION ALL SELECT 'model', 'customer_metrics', count(*)
  FROM (SELECT DISTINCT customer_code, customer_segment FROM fact)
UNION ALL SELECT 'load', 'dim_customers', count(*) FROM clean_customers
UNION ALL SELECT 'load', 'dim_products', count(*) FROM clean_products
UNION ALL SELECT 'load', 'fact_sales', count(*) FROM fact
UNION ALL SELECT 'quality', 'gate_closed', CAST(count(*) > 0 AS BIGINT) FROM stored_fact
  WHERE unit_price IS NULL OR total_amount IS NULL""",
        "stored_fact",
    )
    sql["batch_rerun"] = _with(
        f"""
SELECT * REPLACE ({as_double}, nullif(payment_method, '') AS payment_method,
  CASE WHEN substr(transaction_id, 22, 1) < '5' THEN {EARLIER_TS} ELSE {RUN_TS} END AS created_at)
FROM stored_fact""",
        "stored_fact",
    )

    # composite
    sql["quick_report"] = _with(
        f"""
SELECT (SELECT count(*) FROM raw_sales) AS original_sales,
  (SELECT count(*) FROM raw_products) AS original_products,
  (SELECT count(*) FROM complete_sales) AS cleaned_sales,
  (SELECT count(*) FROM complete_products) AS cleaned_products,
  count(*) AS final_records, {_GLOBAL}
FROM quick_lines""",
        "quick_lines",
    )
    sql["batch_resume"] = (
        sql["batch_run"]
        + """
UNION ALL SELECT 'ingest', 'passed_over', 1 UNION ALL SELECT 'clean', 'passed_over', 1"""
    )
    # Codes and methods of the given tables are shorter than their columns, so only
    # references and amounts can fail; references are looked at first.
    sql["load_quarantine"] = _with(
        """
SELECT s.transaction_id, CASE
    WHEN c.customer_code IS NULL THEN 'unknown_customer'
    WHEN p.product_code IS NULL THEN 'unknown_product'
    WHEN TRY_CAST(s.unit_price AS DECIMAL(10,2)) IS NULL THEN 'overflowing_unit_price'
    WHEN TRY_CAST(s.discount_amount AS DECIMAL(10,2)) IS NULL THEN 'overflowing_discount_amount'
    WHEN TRY_CAST(s.tax_amount AS DECIMAL(10,2)) IS NULL THEN 'overflowing_tax_amount'
    WHEN TRY_CAST(s.total_amount AS DECIMAL(12,2)) IS NULL THEN 'overflowing_total_amount'
    ELSE 'stored' END AS outcome, CAST(s.total_amount AS DOUBLE) AS total_amount
FROM clean_sales s
LEFT JOIN (SELECT customer_code FROM clean_customers WHERE registration_date < DATE '1998-11-01') c
  ON s.customer_code = c.customer_code
LEFT JOIN clean_products p ON s.product_code = p.product_code""",
        "clean_sales",
        "clean_customers",
        "clean_products",
    )
    return sql
