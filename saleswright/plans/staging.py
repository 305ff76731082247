"""The given star-schema tables as raw sales, customers, products and suppliers.

The source tables are clean, so defects of each kind the rules deal with are
given to rows by the values they carry. Every row of the source tables is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleswright.operators.ingest import flatten_customers
from saleswright.session import SHUFFLES_GO, first_partitions, temporary_conf
from saleswright.sources.files import spread
from saleswright.storage import materialize, scratch_run, size_of


_known_schemas: dict[tuple[str, str], T.StructType] = {}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table; its schema is looked up once per application."""
    path = f"{sf_dir}/{table}.parquet"
    seen = (spark.sparkContext.applicationId, path)
    if seen not in _known_schemas:
        _known_schemas[seen] = spark.read.parquet(path).schema
    return spark.read.schema(_known_schemas[seen]).parquet(path)


#: The tables that sales, customers, products and suppliers are made of.
GIVEN = ("lineitem", "orders", "customer", "part", "supplier")


def given_bytes(spark: SparkSession, sf_dir: str) -> int:
    return sum(size_of(spark, f"{sf_dir}/{table}.parquet") for table in GIVEN)


def _code(prefix: str, number: str) -> str:
    return f"concat('{prefix}', lpad(cast({number} as string), 19, '0'))"


def _columns(expressions: dict[str, str]) -> list[str]:
    return [f"{expression} as {name}" for name, expression in expressions.items()]


def _fields(expressions: dict[str, str]) -> str:
    return f"struct({', '.join(_columns(expressions))})"


def raw_sales_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sales, with the three columns only wide files have."""
    lines = spread(
        given(spark, sf_dir, "lineitem").selectExpr(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_quantity",
            "l_extendedprice",
            "l_returnflag",
            "l_tax",
            "l_discount",
        ),
        # The given table is one row group. Dealt by the key of the join below, so
        # that one shuffle serves both; an order has a handful of lines.
        by=["l_orderkey"],
        parts=first_partitions(spark),
    ).selectExpr(
        "*", "cast(rint(l_tax * 100) as int) as tax", "cast(rint(l_discount * 100) as int) as disc"
    )
    orders = given(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    return lines.join(orders, F.expr("l_orderkey = o_orderkey"), "inner").selectExpr(
        *_columns(
            {
                "transaction_id": (
                    "case when not (tax = 8 and disc = 0) then "
                    f"concat({_code('TXN', 'l_orderkey')}, '-', cast(l_linenumber as string)) end"
                ),
                "customer_code": (
                    f"case when not (tax = 8 and disc = 1) then {_code('CUST', 'o_custkey')} end"
                ),
                "product_code": _code("PROD", "l_partkey"),
                "sale_date": (
                    "case when tax = 0 and disc = 0 then date_format(o_orderdate, 'dd/MM/yyyy') "
                    "when tax = 0 and disc = 10 then date_format(o_orderdate, 'MM-dd-yyyy') "
                    "when tax = 8 and disc = 10 then date_format(o_orderdate, 'yyyyMMdd') "
                    "else date_format(o_orderdate, 'yyyy-MM-dd') end"
                ),
                "quantity": (
                    "case when tax = 0 and disc = 1 then 0 "
                    "when tax = 2 and disc = 0 and l_linenumber = 7 then 1 "
                    "else cast(l_quantity as int) end"
                ),
                "unit_price": (
                    "case when tax = 0 and disc = 2 then 0d when tax = 0 and disc = 3 then -10d "
                    "when tax = 0 and disc = 4 then 999999.99d "
                    "when tax = 2 and disc = 0 and l_linenumber = 7 then 2e10d "
                    "when tax = 2 and disc = 1 and l_linenumber = 7 then 1e300d "
                    "when tax = 2 and disc = 2 and l_linenumber = 7 then 0.004d "
                    "when tax = 2 and disc = 5 then 9.99d else l_extendedprice end"
                ),
                "discount": (
                    "case when tax = 0 and disc = 5 then 9999999d "
                    "when tax = 2 and disc = 3 and l_linenumber = 7 then 2e10d "
                    "when tax = 2 and disc = 4 and l_linenumber = 7 then 1e300d "
                    "when disc > 0 then cast(disc as double) end"
                ),
                "payment_method": (
                    "case when tax = 1 and disc = 0 then null when tax = 1 and disc = 10 then '' "
                    "else concat('  ', lower(substring(o_orderpriority, 3)), ' ') end"
                ),
                "currency": "'PEN'",
                "sales_channel": "lower(l_returnflag)",
                "region": "o_orderstatus",
            }
        )
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sales_wide(spark, sf_dir).drop("currency", "sales_channel", "region")


def _with_places(table: DataFrame, nation_key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    nations, regions = given(spark, sf_dir, "nation"), given(spark, sf_dir, "region")
    places = nations.join(regions, F.expr("n_regionkey = r_regionkey"), "inner")
    return table.join(places, F.expr(f"{nation_key} = n_nationkey"), "inner")


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as nested documents."""
    mail = "concat('customer.', digits, '@mail.example.com')"
    # Cleaning sorts customers within the tasks that read them, as it does products.
    named = spread(given(spark, sf_dir, "customer"), by=["c_custkey"]).selectExpr(
        "*",
        "split_part(c_name, '#', 1) as given",
        "split_part(c_name, '#', 2) as digits",
        "date_add(date'1995-01-01', cast(floor(abs(c_acctbal) / 5) as int)) as registered",
    )
    return _with_places(named, "c_nationkey", spark, sf_dir).selectExpr(
        *_columns(
            {
                # Some customers share the code of the one before.
                "customer_id": _code("CUST", "(c_custkey - if(c_custkey % 50 = 0, 1, 0))"),
                "personal_info": _fields(
                    {
                        "first_name": (
                            "case when c_mktsegment = 'HOUSEHOLD' and c_acctbal < -900 then null "
                            "when c_mktsegment = 'BUILDING' then lower(given) "
                            "when c_mktsegment = 'MACHINERY' then concat('  ', given, '  ') "
                            "when c_mktsegment = 'FURNITURE' then upper(given) else given end"
                        ),
                        "last_name": "concat('de la ', digits)",
                    }
                ),
                "contact": _fields(
                    {
                        "email": (
                            f"case when c_acctbal < 0 then concat(' ', {mail}) "
                            "when c_acctbal >= 9700 then 'duplicated.email@example.com' "
                            "when c_acctbal >= 9400 "
                            "then concat('josé.', digits, '@mail.example.com') "
                            f"when c_mktsegment = 'FURNITURE' then upper({mail}) else {mail} end"
                        ),
                        "phone": (
                            "case c_nationkey "
                            "when 3 then concat('(912) 345-', substring(digits, 6, 4)) "
                            "when 4 then concat('051-912-345-', substring(digits, 7, 3)) "
                            "when 5 then null when 6 then concat('+51-999-', digits, ' ext. 0001') "
                            "else concat('+51-999-', substring(digits, 4, 6)) end"
                        ),
                    }
                ),
                "address": _fields(
                    {"country": "concat(' ', lower(n_name), ' ')", "city": "lower(r_name)"}
                ),
                "registration_date": (
                    "date_format(registered, if(c_nationkey = 7, 'dd/MM/yyyy', 'yyyy-MM-dd'))"
                ),
                "segment": "concat(' ', lower(c_mktsegment), ' ')",
                "status": "'ACTIVE'",
                "preferences": _fields(
                    {"marketing_emails": "c_acctbal > 0", "language": "'ES'", "currency": "'USD'"}
                ),
                "metadata": _fields({"lifetime_value": "c_acctbal"}),
            }
        )
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_customers(customer_documents(spark, sf_dir))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products."""

    def cost(rate: str) -> str:
        return (
            "cast(round(cast(p_retailprice as decimal(10,2)) * "
            f"cast({rate} as decimal(3,2)), 2) as double)"
        )

    return spread(given(spark, sf_dir, "part"), by=["p_partkey"]).selectExpr(
        *_columns(
            {
                "product_code": _code("PROD", "(p_partkey - if(p_partkey % 40 = 0, 1, 0))"),
                "product_name": "case when p_size <> 47 then p_name end",
                "category": "concat(' ', lower(p_type))",
                "subcategory": "split_part(p_name, ' ', 2)",
                "brand": "upper(p_brand)",
                "unit_price": "if(p_size = 13, 0d, p_retailprice)",
                "cost_price": (
                    f"case p_size when 49 then null when 50 then {cost('1.10')} "
                    f"else {cost('0.75')} end"
                ),
                "weight_kg": (
                    "if(p_size = 48, 0d, cast(p_size * cast(0.1 as decimal(2,1)) as double))"
                ),
            }
        )
    )


def raw_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = given(spark, sf_dir, "supplier").selectExpr(
        "*", "split_part(s_name, '#', 2) as digits"
    )
    return _with_places(named, "s_nationkey", spark, sf_dir).selectExpr(
        *_columns(
            {
                "supplier_id": _code("SUP", "s_suppkey"),
                "company_name": "s_name",
                "contact_person": "concat('Contact, ', digits)",
                "email": "concat('contact', digits, '@supplier.example.com')",
                "phone": "concat('+51-932-', substring(digits, 4, 6))",
                "country": "n_name",
                "city": "r_name",
                "rating": "case when s_acctbal > 0 then s_acctbal end",
                "contract_start": (
                    "date_add(date'1995-01-01', cast(floor(abs(s_acctbal) / 5) as int))"
                ),
                "payment_terms": "if(s_acctbal > 5000, 'NET_60', 'PREPAID')",
            }
        )
    )


def write_document_arrays(
    documents: DataFrame, path: str, per_file: int | None = 20_000
) -> None:
    """Write documents the way they are delivered: files that hold one JSON array.

    The number of files grows with the data, unless ``per_file`` is None, which
    makes one file, and rows are dealt out evenly whatever they hold. Each line
    holds one element; the first opens the array and a last line closes it.
    """
    files = 1 if per_file is None else max(1, -(-documents.count() // per_file))
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    dealt = documents.repartition(files).select(
        F.spark_partition_id().alias("file"),
        place.alias("place"),
        F.to_json(F.struct(*documents.columns)).alias("json"),
    )
    with scratch_run(spark := documents.sparkSession), temporary_conf(spark, SHUFFLES_GO):
        dealt = materialize(dealt, "documents")
        opener = F.when(F.col("place") == 0, "[").otherwise(",")
        elements = dealt.withColumn("value", F.concat(opener, "json")).drop("json")
        closers = dealt.groupBy("file").agg(
            (F.max("place") + 1).alias("place"), F.lit("]").alias("value")
        )
        (
            elements.unionByName(closers)
            .repartition(files, "file")
            .sortWithinPartitions("file", "place")
            .select("file", "value")
            .write.partitionBy("file")
            .text(path)
        )
