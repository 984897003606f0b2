"""Invoice lines out of the driver's order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines with order, buyer country and part.

    Orders meet their buyers before the lines, so the customer join shuffles
    orders rather than lines. Lines and orders grow together and never fit a
    broadcast at scale, so their join is always a sort-merge join, which spills;
    all others are left to the sizes. AQE splits the partitions of hot keys.
    """
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    buyers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    buyers = buyers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    orders = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", "p_brand", "p_name", "p_size"
    )
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    return lines.join(
        orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    ).join(parts, F.col("l_partkey") == F.col("p_partkey"))


def _returned():
    return F.col("l_returnflag") == "R"


def _invoice_no():
    prefix = F.when(_returned(), F.lit("C")).otherwise(F.lit(""))
    return F.concat(prefix, F.col("o_orderkey").cast("string"))


def _quantity():
    return (F.when(_returned(), -1).otherwise(1) * F.col("l_quantity")).cast("int")


def _customer():
    return F.when(
        F.col("o_custkey") % 4 != 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))
    )


def bronze_lines(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """The order tables as cleaned invoice lines."""
    return _order_lines(spark, sf_dir, lines).select(
        _invoice_no().alias("invoiceno"),
        F.concat_ws("-", "p_type", "p_brand").alias("stockcode"),
        F.col("p_name").alias("description"),
        _quantity().alias("quantity"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("invoicedate"),
        (F.col("p_size") * F.lit("0.25").cast("decimal(3,2)")).cast("decimal(10,2)").alias("unitprice"),
        _customer().alias("customerid"),
        "country",
    )


def raw_lines(spark: SparkSession, sf_dir: str, defects: bool) -> DataFrame:
    """The order tables as an uncleaned file: text dates, gaps, odd prices.

    ``defects`` adds what only the strict cleaning forgives: missing invoices,
    quantities and prices and unreadable dates.
    """
    discount, tax = F.col("l_discount"), F.col("l_tax")
    date = F.date_format("o_orderdate", "dd/MM/yyyy H:mm")
    invoice, quantity, price = _invoice_no(), _quantity(), F.col("l_extendedprice") - 2000
    if defects:
        invoice = F.when(tax != 0.01, invoice)
        quantity = F.when(discount != 0.05, quantity)
        price = F.when(discount != 0.1, price)
        date = F.when(tax != 0.08, date).otherwise(F.lit("unknown"))
    return _order_lines(spark, sf_dir).select(
        invoice.alias("Invoice No"),
        F.concat_ws("-", "p_type", "p_brand").alias("Stock Code"),
        F.when(discount != 0.0, F.col("p_name")).alias("Description"),
        quantity.alias("Quantity"),
        date.alias("Invoice Date"),
        price.alias("Unit Price"),
        _customer().alias("Customer ID"),
        F.col("country").alias("Country"),
    )
