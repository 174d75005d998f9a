"""Order-line source derived from the TPC-H-style test tables.

The shape is the source file's (same eight header names, file-typed values)
plus the columns that stand in for file order: (l_orderkey, l_partkey,
l_linenumber, l_suppkey, l_extendedprice) is unique and total. Values are
planted by fixed rules on the keys so that every cleaning, quality, staging
and mart branch is reached; no row is filtered out, so the view grows with
lineitem.

Join plan: orders is joined to customer and nation first (orders-sized), then
lineitem to that on the order key with a sort-merge join, then to part.
Catalyst / AQE choose broadcast or sort-merge for the dimension sides from
measured sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that give the fixture a total "file order".
FIXTURE_ORDER = ("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice")


# Declared column types of the test tables this source reads (only the
# columns it uses): a declared schema skips the footer-reading job that
# inference would start for every table.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def joined_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem row, with the columns that its order line is made of."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")

    ocn = (orders.join(customer, orders.o_custkey == customer.c_custkey)
           .join(nation, F.col("c_nationkey") == nation.n_nationkey)
           .select("o_orderkey", "o_custkey", "o_orderdate", "n_nationkey", "n_name"))
    # lineitem x orders is fact-to-fact (both grow with the data): a
    # sort-merge join on the order key, which is the plan at any scale.
    # Small test files would otherwise broadcast lineitem itself and run the
    # whole stage in the scan's single task.
    return (li.join(ocn.hint("merge"), li.l_orderkey == ocn.o_orderkey)
            .join(part, li.l_partkey == part.p_partkey)
            .drop("o_orderkey", "p_partkey"))


def fixture_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source order line per lineitem row, with source-file column names."""
    return order_lines(joined_tables(spark, sf_dir))


def order_lines(rows: DataFrame) -> DataFrame:
    """The source order lines of ``joined_tables``."""
    lok, lpk, lln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    ook, ock = lok, F.col("o_custkey")
    returned = F.col("l_returnflag") == "R"
    pk50 = lpk % 50

    invoice = (F.when(lok % 97 == 0, F.lit(None).cast("string"))
               .when(returned, F.concat(F.lit("C"), _s(ook)))
               .otherwise(_s(ook)))
    stock = (F.when(pk50 == 0, F.lit("POST"))
             .when(pk50 == 1, F.lit(" post "))
             .when(pk50.between(2, 9), F.concat(F.lit("sku"), _s(lpk % 400)))
             .when(pk50 == 10, F.concat(F.lit("SLW"), _s(lok)))
             .when(pk50 == 11, F.lit("nan"))
             .when(pk50 == 12, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("SKU"), _s(lpk))))
    description = (F.when((lln == 7) & (lpk % 3 == 0), F.lit("nan"))
                   .when((lln == 6) & (lpk % 5 == 0), F.lit(None).cast("string"))
                   # longer than the raw table's column
                   .when(lok % 127 == 0, F.concat(F.upper("p_name"), F.repeat(F.lit("-"), 500)))
                   .otherwise(F.concat(F.lit(" "), F.upper("p_name"), F.lit(" "))))
    quantity = (F.when(lok % 113 == 0, F.lit(None).cast("double"))
                .when(returned, -F.col("l_quantity"))
                .otherwise(F.col("l_quantity")))
    minute = F.timestamp_add("MINUTE", ook % 1440, F.col("o_orderdate"))
    invoice_date = (F.when(lok % 109 == 0, F.lit(None).cast("timestamp_ntz"))
                    # lines of one order differ within the second that the raw table keeps
                    .when(lok % 3 == 0, F.timestamp_add("MILLISECOND", lln, minute))
                    .otherwise(minute))
    price = (F.when(lok % 101 == 0, -F.col("p_retailprice"))
             .when(lok % 103 == 0, F.lit(0.0))
             .when(lok % 107 == 0, F.lit(None).cast("double"))
             .when(lok % 131 == 0, F.lit(1e8) + F.col("p_retailprice"))    # too wide for the raw table
             .otherwise(F.col("p_retailprice")))
    customer_id = (F.when(ock % 13 == 0, F.lit(None).cast("string"))
                   .when(ock % 17 == 0, F.lit("  "))
                   .when(ock % 19 == 0, F.lit("NaN"))
                   .when(ock % 4 == 0, _s(ock % 100))
                   .when(ock % 4 == 1, F.concat(F.lit(" "), _s(ock % 500)))
                   .otherwise(_s(ock)))
    country = (F.when(lok % 137 == 0, F.lit(None).cast("string"))
               .when(F.col("n_nationkey") % 2 == 0, F.lower("n_name"))
               .otherwise(F.concat(F.col("n_name"), F.lit(" "))))

    return rows.select(
        invoice.alias("Invoice"),
        stock.alias("StockCode"),
        description.alias("Description"),
        quantity.alias("Quantity"),
        invoice_date.alias("InvoiceDate"),
        price.alias("Price"),
        customer_id.alias("Customer ID"),
        country.alias("Country"),
        *FIXTURE_ORDER,
    )


def fixture_order_column() -> Column:
    """Orderable stand-in for the file position of a fixture row."""
    return F.struct(*[F.col(c) for c in FIXTURE_ORDER])
