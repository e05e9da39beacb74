"""Invoice lines derived from order tables (lineitem, orders, customer, nation, part).

The order tables hold no cancellations, nulls, duplicates or bad prices, so the view adds them by
fixed rules on the keys. Every source row is kept; rows of some orders appear twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.sources.spread import spread

# Key rules of the view.
NULL_TEXT_EVERY = 97
ZERO_QUANTITY_EVERY = 53
ZERO_PRICE_EVERY = 217
NEGATIVE_PRICE_EVERY = 499
NULL_CUSTOMER_EVERY = 4
DUPLICATE_EVERY = 101

LINE_COLUMNS = "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, l_returnflag string"


def retail_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The view as a lazy plan. Join strategies are left to Catalyst, which knows the file sizes."""

    def table(name: str, columns: str) -> DataFrame:
        # A stated schema reads no footer to plan the query.
        return spark.read.schema(columns).parquet(f"{folder}/{name}.parquet")

    lines = table("lineitem", LINE_COLUMNS)
    lines = spread(lines, "l_orderkey", "l_partkey")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table("customer", "c_custkey bigint, c_nationkey int")
    nations = table("nation", "n_nationkey int, n_name string")
    parts = table("part", "p_partkey bigint, p_name string")

    # Orders get their country before lines are joined, so that lines move once for orders and once for
    # parts. Parts come last and by the code that the lines show: where that join is a shuffled one, equal lines
    # then lie together, and whoever removes duplicates needs no third shuffle.
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    stock = lambda c: F.concat(F.lit("P"), F.col(c).cast("string"))
    joined = (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("StockCode", stock("l_partkey"))
        .join(parts.withColumn("_stock", stock("p_partkey")), F.col("StockCode") == F.col("_stock"))
    )
    order, returned = F.col("l_orderkey"), F.col("l_returnflag") == "R"
    key = order.cast("string")
    units = F.col("l_quantity").cast("long")
    opening = (F.lit(6) + F.col("o_orderkey") % 15).cast("int")
    copies = F.when(order % DUPLICATE_EVERY == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return joined.select(
        F.when(returned, F.concat(F.lit("C"), key)).otherwise(key).alias("InvoiceNo"),
        "StockCode",
        F.when(F.col("l_partkey") % NULL_TEXT_EVERY != 0, F.col("p_name")).alias("Description"),
        F.when(returned, -units)
        .when(order % ZERO_QUANTITY_EVERY == 0, F.lit(0).cast("long"))
        .otherwise(units)
        .alias("Quantity"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=opening)).alias("InvoiceDate"),
        F.when(order % ZERO_PRICE_EVERY == 0, F.lit(0.0))
        .when(order % NEGATIVE_PRICE_EVERY == 1, F.lit(-1.0))
        .otherwise(F.col("l_extendedprice") / F.col("l_quantity"))
        .alias("UnitPrice"),
        F.when(F.col("o_custkey") % NULL_CUSTOMER_EVERY != 0, F.col("o_custkey")).alias("CustomerID"),
        F.col("n_name").alias("Country"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")
