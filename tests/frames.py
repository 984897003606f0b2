"""Small hand-made frames."""

import datetime as dt
from decimal import Decimal

from tillworks import schemas

D = Decimal


def day(y, m, d, hour=9):
    return dt.datetime(y, m, d, hour, 30)


def bronze(spark, rows):
    """rows: (invoice, code, description, quantity, timestamp, price, customer, country)."""
    fixed = [(*r[:5], None if r[5] is None else D(str(r[5])), *r[6:]) for r in rows]
    return spark.createDataFrame(fixed, schemas.BRONZE_LINE)


# A Saturday, a Sunday, a Monday, a gap, a year end; returns, two descriptions,
# an unknown and a junk customer, a free product, a line without a country.
LINES = [
    ("1", "B2", "beta", 2, day(2010, 12, 4), 1.50, "10.0", "UK"),
    ("1", "A1", "alpha", 4, day(2010, 12, 4), 2.00, "10.0", "UK"),
    ("2", "A1", "ALPHA", 1, day(2010, 12, 4, 15), 2.50, "20", "UK"),
    ("2", "A1", "alpha", 3, day(2010, 12, 4, 16), 2.00, "20", "UK"),
    ("3", "B2", "beta", 5, day(2010, 12, 5), 1.50, None, "France"),
    ("C4", "B2", "beta", -5, day(2010, 12, 6), 1.50, None, "France"),
    ("5", "POST", "postage", 1, day(2010, 12, 31), 18.00, "junk", "France"),
    ("6", "M", "manual", 1, day(2011, 1, 3), 0.00, "10.0", "France"),
    ("7", "A1", None, 10, day(2011, 1, 3), 2.00, "10.0", None),
    ("8", "NODESC", None, 10, day(2011, 1, 3), 2.00, "10.0", "UK"),
    ("9", "A1", "alpha", 7, day(2011, 1, 4), 2.00, "", "UK"),
]


def silver(spark, rows=LINES):
    from tillworks.operators import silver as S

    lines = bronze(spark, rows)
    dates, products = S.dim_date(lines), S.dim_product(lines)
    return lines, dates, products, S.fact_sales_daily(lines, dates, products)


def fact(spark, rows):
    """rows: (date, product_id, country, customer_id, transactions, quantity, revenue)."""
    full = [
        (d.year * 10000 + d.month * 100 + d.day, p, c, cust, tx, q, D(str(rev)), D("1.000000"), d.year, d.month)
        for d, p, c, cust, tx, q, rev in rows
    ]
    return spark.createDataFrame(full, schemas.FACT_SALES_DAILY)


def dates_of(spark, days):
    from pyspark.sql import functions as F

    from tillworks.operators import silver as S

    frame = spark.createDataFrame([(d,) for d in days], "d date")
    return S.dim_date(frame.select(F.col("d").cast("timestamp_ntz").alias("invoicedate")))


def products(spark, n):
    return spark.createDataFrame(
        [(i, f"P{i}", f"product {i}", "General") for i in range(1, n + 1)], schemas.DIM_PRODUCT
    )


def rows(df, *cols):
    out = df.select(*cols) if cols else df
    return [tuple(r) for r in out.collect()]


def keyed(df, key, *cols):
    return {r[key]: tuple(r[c] for c in cols) for r in df.collect()}
