import datetime as dt

import pytest

from frames import D, rows
from tillworks import schemas
from tillworks.sources import transactions as X

HEADER = ["Invoice No", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "Customer ID", "Country"]
GOOD = ("536365", "85123A", "holder", "6", "01/12/2010 8:26", "2.55", "17850", "United Kingdom")


def raw(spark, *changes):
    """One row per change of the good row; a change is {position: value}."""
    data = [tuple(c.get(i, v) for i, v in enumerate(GOOD)) for c in changes]
    return spark.createDataFrame(data, ", ".join(f"`{h}` string" for h in HEADER))


def test_normalize_columns(spark):
    assert X.normalize_columns(raw(spark, {})).columns == [
        "invoiceno", "stockcode", "description", "quantity", "invoicedate", "unitprice", "customerid", "country",
    ]


def test_strict_keeps_a_good_row(spark):
    out = X.clean_strict(raw(spark, {}))
    assert out.schema.names == schemas.BRONZE_LINE.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.BRONZE_LINE]
    assert rows(out) == [
        ("536365", "85123A", "holder", 6, dt.datetime(2010, 12, 1, 8, 26), D("2.55"), "17850", "United Kingdom")
    ]


@pytest.mark.parametrize(
    "change",
    [{0: None}, {1: None}, {4: None}, {4: "not a date"}, {4: "31/02/2010 8:26"}, {5: "-0.001"}, {5: "10000.01"}, {5: "10000.004"}],
)
def test_strict_drops(spark, change):
    assert X.clean_strict(raw(spark, change)).count() == 0


@pytest.mark.parametrize(
    "change,column,value",
    [
        ({2: None}, "description", "Unknown"), ({3: None}, "quantity", 0), ({3: "-6"}, "quantity", -6),
        ({3: "6.9"}, "quantity", 6), ({5: None}, "unitprice", D("0.00")), ({5: "0"}, "unitprice", D("0.00")),
        ({5: "10000"}, "unitprice", D("10000.00")), ({5: "2.555"}, "unitprice", D("2.56")),
        ({6: None}, "customerid", None), ({6: "17850.0"}, "customerid", "17850.0"), ({7: None}, "country", None),
        ({0: "C536365"}, "invoiceno", "C536365"),
        ({4: "2010-12-01 08:26:00"}, "invoicedate", dt.datetime(2010, 12, 1, 8, 26)),
        ({4: "2010-12-01"}, "invoicedate", dt.datetime(2010, 12, 1)),
    ],
)
def test_strict_fills(spark, change, column, value):
    assert rows(X.clean_strict(raw(spark, change)), column) == [(value,)]


@pytest.mark.parametrize("change", [{3: "many"}, {5: "cheap"}])
def test_strict_fails_on_text_for_numbers(spark, change):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        X.clean_strict(raw(spark, change)).collect()


@pytest.mark.parametrize(
    "change,column,value",
    [
        ({2: None}, "description", "UNKNOWN"), ({6: None}, "customerid", ""), ({0: None}, "invoiceno", None),
        ({1: None}, "stockcode", None), ({4: None}, "invoicedate", None), ({5: "20000"}, "unitprice", D("20000.00")),
        ({5: None}, "unitprice", None),
    ],
)
def test_lenient_keeps(spark, change, column, value):
    assert rows(X.clean_lenient(raw(spark, change)), column) == [(value,)]


def test_lenient_drops_negative_prices(spark):
    assert X.clean_lenient(raw(spark, {5: "-1"})).count() == 0


@pytest.mark.parametrize(
    "change,message",
    [({3: "many"}, "CAST_INVALID_INPUT"), ({3: None}, "quantity is missing"),
     ({5: "cheap"}, "CAST_INVALID_INPUT"), ({4: "someday"}, "unreadable date")],
)
def test_lenient_fails(spark, change, message):
    with pytest.raises(Exception, match=message):
        X.clean_lenient(raw(spark, change)).collect()


CSV = """InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country
1,A1,"RED, ROUND",6,"01/12/2010 8:26",2.55,17850,"United Kingdom"
C2,B2,,-1,"13/12/2010 18:06",3.39,,France
"""


def test_csv_source(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(CSV)
    lines = X.read_transactions(spark, str(path))
    out = X.clean_strict(lines)
    assert rows(out.drop("source_file")) == [
        ("1", "A1", "RED, ROUND", 6, dt.datetime(2010, 12, 1, 8, 26), D("2.55"), "17850", "United Kingdom"),
        ("C2", "B2", "Unknown", -1, dt.datetime(2010, 12, 13, 18, 6), D("3.39"), None, "France"),
    ]
    bronze = X.bronze_rows(out, "b1")
    assert bronze.columns == schemas.BRONZE_TABLE.names
    found = bronze.select("source_file", "ingest_batch", "invoice_month").distinct().collect()
    assert [(r[0].endswith("sales.csv"), r[1], r[2]) for r in found] == [(True, "b1", "2010-12")]


def test_parquet_source(spark, tmp_path):
    raw(spark, {}, {0: None}).write.parquet(str(tmp_path / "p"))
    assert X.clean_strict(X.read_transactions(spark, str(tmp_path / "p"), "parquet")).count() == 1
    with pytest.raises(ValueError):
        X.read_transactions(spark, "x", "xlsx")


def test_csv_with_other_header_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text(CSV.replace("StockCode", "Sku"))
    with pytest.raises(Exception, match="(?i)header"):
        X.read_transactions(spark, str(tmp_path / "x.csv")).collect()


def test_float_columns_of_a_frame(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [("1", "A1", None, 2.0, dt.datetime(2010, 12, 1), 2.5, 17850.0, "UK"),
         ("2", "A1", None, nan, dt.datetime(2010, 12, 1), nan, nan, "UK")],
        "InvoiceNo string, StockCode string, Description string, Quantity double, InvoiceDate timestamp_ntz, "
        "UnitPrice double, CustomerID double, Country string",
    )
    got = rows(X.clean_strict(df), "quantity", "unitprice", "customerid")
    assert got == [(2, D("2.50"), "17850.0"), (0, D("0.00"), None)]
    assert rows(X.clean_lenient(df.limit(1)), "quantity", "customerid") == [(2, "17850.0")]
    with pytest.raises(Exception, match="quantity is missing"):
        X.clean_lenient(df).collect()


def test_cleaning_report(spark):
    df = raw(spark, {}, {0: None}, {4: None}, {4: "someday"}, {5: "-1"}, {5: "10001"}, {5: None})
    assert rows(X.cleaning_report(df)) == [(7, 2, 1, 2, 2)]
    assert X.clean_strict(df).count() == 2
