"""Spreadsheet workbooks as source and sink."""

import datetime as dt
import io
import zipfile

import pyarrow as pa
import pytest

from tillworks import schemas
from tillworks.sources import sheet_xml
from tillworks.sources import transactions as X
from tillworks.sources import workbooks as W

NAMES = schemas.SOURCE_FILE.names
DAY = dt.datetime(2010, 12, 1, 8, 26)
LINES = [
    ("536365", "85123A", "HEART <T-LIGHT> & \"HOLDER\"", 6, DAY, 2.55, "17850", "United Kingdom"),
    ("536366", "22633", "é 日本 _x000D_ \x0b tail\r", -1, DAY + dt.timedelta(hours=30), 0.5, None, "France"),
    ("C53", "21730", None, None, dt.datetime(2011, 10, 9), None, "12.0", None),
    (None, "22", "no invoice", 1, DAY, 1.0, "1", "France"),
    ("9", "22", " dear ", 1, DAY, 10001.0, "1", "France"),
    ("9", "22", "", 1, None, 1.0, "1", "France"),
]


def lines(spark, parts=1):
    schema = "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, UnitPrice double, CustomerID string, Country string"
    return spark.createDataFrame(LINES, schema).coalesce(parts)


def cleaned(df):
    return sorted(map(tuple, X.clean_strict(df).drop("source_file").collect()), key=repr)


def by_hand(path, sheets, strings=(), book="", styles=""):
    """A workbook of given sheet XML, its parts in another folder than usual names."""
    with zipfile.ZipFile(path, "w") as z:
        marks = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="k{i}"/>' for i, n in enumerate(sheets))
        z.writestr(W.WORKBOOK, f'<workbook xmlns="{W._MAIN}" xmlns:r="{W._OFFICE}">{book}<sheets>{marks}</sheets></workbook>')
        links = "".join(f'<Relationship Id="k{i}" Type="{W._OFFICE}/worksheet" Target="/xl/tabs/{i}.xml"/>' for i in range(len(sheets)))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{W._PACKAGE}/relationships">{links}</Relationships>')
        for i, rows in enumerate(sheets.values()):
            z.writestr(f"xl/tabs/{i}.xml", f'<worksheet xmlns="{W._MAIN}"><sheetData>{rows}</sheetData></worksheet>')
        if strings:
            z.writestr(W.STRINGS, f'<sst xmlns="{W._MAIN}">{"".join(f"<si>{s}</si>" for s in strings)}</sst>')
        if styles:
            z.writestr(W.STYLES, f'<styleSheet xmlns="{W._MAIN}">{styles}</styleSheet>')


def test_two_sheets_read_as_their_csv(spark, tmp_path):
    df = lines(spark)
    assert W.write_workbooks(df, f"{tmp_path}/x", sheet_rows=4) == len(LINES)
    df.where("Description IS NULL OR Description NOT LIKE '%\r%'").write.option("header", True).csv(f"{tmp_path}/c")
    got = X.read_transactions(spark, f"{tmp_path}/x", "xlsx", W.ALL)
    assert got.columns == [*NAMES, "source_file"]
    assert got.select("source_file").distinct().first()[0].endswith("/x/part-00000.xlsx")
    expected = [r for r in cleaned(got) if "\r" not in r[2]]
    csv = X.read_transactions(spark, f"{tmp_path}/c").withColumn("InvoiceDate", X.F.substring(X.F.translate("InvoiceDate", "T", " "), 1, 19))
    assert expected == cleaned(csv) and len(expected) == 2
    assert [r[2] for r in cleaned(got) if r[0] == "536366"] == [LINES[1][2]]
    first = X.read_transactions(spark, f"{tmp_path}/x", "xlsx")
    assert first.count() == 3
    named = X.read_transactions(spark, f"{tmp_path}/x", "xlsx", ["Sheet2", "none"])
    assert [r["InvoiceNo"] for r in named.collect()] == [None, "9", "9"]


def test_rewritten_partitions_and_folders(spark, tmp_path):
    df = spark.range(1000).selectExpr("cast(id as string) AS InvoiceNo", "id % 2 = 0 AS even").repartition(5)
    assert W.write_workbooks(df, f"file://{tmp_path}/x") == 1000
    assert W.write_workbooks(df, f"file://{tmp_path}/x") == 1000
    (tmp_path / "x" / "_unfinished.xlsx").write_bytes(b"half")
    got = W.read_workbooks(spark, f"{tmp_path}/x", ["invoice no", "Even"])
    assert sorted(map(tuple, got.drop("source_file").collect())) == sorted((str(i), str(i % 2 == 0).lower()) for i in range(1000))
    assert got.select("source_file").distinct().count() == 5


def test_more_rows_than_a_batch(spark, tmp_path):
    W.write_workbooks(spark.range(2 * W.BATCH_ROWS + 1).coalesce(1), f"{tmp_path}/x")
    got = W.read_workbooks(spark, f"{tmp_path}/x", ["id"])
    assert got.selectExpr("sum(cast(id AS bigint))", "count(*)").first() == (W.BATCH_ROWS * (2 * W.BATCH_ROWS + 1), 2 * W.BATCH_ROWS + 1)


def test_large_partitions_fill_several_workbooks(spark, tmp_path):
    df = spark.range(50_000, numPartitions=2)
    assert W.write_workbooks(df, f"{tmp_path}/x", workbook_rows=9_999) == 50_000
    assert W.write_workbooks(df, f"{tmp_path}/x", workbook_rows=9_999) == 50_000
    files = sorted(p.name for p in (tmp_path / "x").iterdir() if not p.name.startswith("."))
    assert files == sorted(f"part-0000{i}{k}.xlsx" for i in range(2) for k in ["", "-1", "-2"])
    got = W.read_workbooks(spark, f"{tmp_path}/x", ["id"])
    assert got.selectExpr("count(*)", "count(distinct id)", "sum(cast(id AS bigint))").first() == (50_000, 50_000, 50_000 * 49_999 // 2)
    counts = {r["source_file"][-15:]: r["count"] for r in got.groupBy("source_file").count().collect()}
    assert sorted(counts.values()) == [5_002, 5_002, 9_999, 9_999, 9_999, 9_999]


def test_kinds_of_cells(spark, tmp_path):
    rows = (
        '<row r="3"/><row r="5"><c r="B5" t="s"><v>0</v></c><c r="C5" t="inlineStr"><is><t>b</t></is></c>'
        '<c r="D5" t="s"><v>0</v></c><c r="AA5" t="str"><v>z</v></c></row>'
        '<row><c r="B6" t="s"><v>1</v></c><c t="b"><v>1</v></c><c r="D6"><v>7</v></c><c r="AA6" s="1"><v>40513.351388888892</v></c></row>'
        '<row r="8"><c r="B8" t="e"><v>#N/A</v></c><c r="C8"/><c r="AA8" s="2"><v>1.5</v></c></row>'
        '<row r="9"><c r="B9" t="s"><v>2</v></c><c r="AA9" s="3"><v>0.25</v></c></row>'
        '<row r="10"><c r="B10" t="s"><v>3</v></c><c r="C10" t="d"><v>2010-12-01T08:26:00.000Z</v></c></row>'
    )
    strings = ["<t>A A</t>", "<r><t>ri</t></r><r><rPr/><t>ch</t></r><rPh><t>no</t></rPh>", "<t>_x0041__x005F_x0042_</t>", "<t></t>"]
    formats = '<numFmts><numFmt numFmtId="170" formatCode="[Red]0.0&quot;days&quot;"/><numFmt numFmtId="171" formatCode="[h]:mm"/></numFmts>'
    styles = formats + '<cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
    by_hand(tmp_path / "a.xlsx", {"one": rows, "empty": ""}, strings, styles=styles)
    got = W.read_workbooks(spark, str(tmp_path), ["aa", "B", "z", "q"], W.ALL).drop("source_file")
    assert [tuple(r) for r in got.collect()] == [
        ("rich", "true", "2010-12-01 08:26:00", None), (None, None, "1.5", None),
        ("A_x0042_", None, "1899-12-30 06:00:00", None), (None, "2010-12-01 08:26:00", None, None),
    ]


def test_calendar_from_1904(spark, tmp_path):
    rows = '<row><c t="inlineStr"><is><t>d</t></is></c></row><row><c s="0"><v>1</v></c></row>'
    by_hand(tmp_path / "a.xlsx", {"s": rows}, book='<workbookPr date1904="1"/>', styles='<cellXfs><xf numFmtId="14"/></cellXfs>')
    assert W.read_workbooks(spark, str(tmp_path), ["d"]).first()["d"] == "1904-01-02 00:00:00"


def test_empty_and_broken(spark, tmp_path):
    assert W.write_workbooks(lines(spark).limit(0), f"{tmp_path}/none") == 0
    by_hand(tmp_path / "a.xlsx", {"s": ""})
    assert W.read_workbooks(spark, str(tmp_path), NAMES).count() == 0
    (tmp_path / "b.xlsx").write_bytes(b"no zip")
    with pytest.raises(Exception, match="not a workbook: .*b.xlsx"):
        W.read_workbooks(spark, str(tmp_path), NAMES).count()
    with pytest.raises(ValueError, match="sheets"):
        W.read_workbooks(spark, str(tmp_path), NAMES, "second")


def test_no_such_path(spark, tmp_path):
    with pytest.raises(ValueError, match="no file or folder of workbooks: .*/gone"):
        W.read_workbooks(spark, f"{tmp_path}/gone", NAMES)


def test_written_rows_are_found_by_position(monkeypatch):
    parsed, row = [], W.Workbook._row
    monkeypatch.setattr(W.Workbook, "_row", lambda self, e: parsed.append(e) or row(self, e))
    n, file = 20_000, io.BytesIO()
    columns = {
        "i": list(range(n)), "text": [None if i % 3 else f"{i} & <{i}>" for i in range(n)], "price": [i / 4 for i in range(n)],
        "day": [DAY + dt.timedelta(hours=i) for i in range(n)], "even": [i % 2 == 0 for i in range(n)],
    }
    batch = pa.RecordBatch.from_pydict(columns)
    assert W.write_workbook(file, batch.schema.names, iter([batch])) == n
    pieces = list(W.Workbook(file.getvalue()).batches("Sheet1", ["even", "none", "day", "price", "text", "i"]))
    got = [r for piece in pieces for r in zip(*[c.to_pylist() for c in piece])]
    assert got == [
        (str(e).lower(), None, str(d), str(p), t, str(i)) for i, t, p, d, e in zip(*columns.values())
    ]
    assert len(pieces) > 1 and len(parsed) == 1


ODD = {
    "plain": '<row r="2" spans="1:2"><c r="A2" t="s"><v>1</v></c><c r="B2"><v>2.50</v></c></row><row r="3"/><row r="4"></row>',
    "nothing in it": '<row r="2"><c r="A2" s="1"/><c r="B2" t="s"><v>2</v></c></row><row r="3"><c r="C3" t="s"><v>0</v></c></row>',
    "wrong child": '<row r="2"><c r="A2"><is><t>x</t></is></c><c r="B2" t="inlineStr"><v>1</v></c><c r="C2" t="e"><v>#N/A</v></c></row>',
    "column twice": '<row r="2"><c r="A2"><v>1</v></c><c r="A2"><v>2</v></c></row>',
    "kinds mixed": '<row r="2"><c r="A2" s="1"><v>2.75</v></c><c r="B2" t="b"><v>0</v></c></row>'
    '<row r="3"><c r="A3" t="str"><v>_x0041_</v></c><c r="B3" t="d"><v>2010-12-01T08:26:00Z</v></c></row><row r="4"><c r="B4"><v>7</v></c></row>',
    "entities": '<row r="2"><c r="A2" t="inlineStr"><is><t>a&amp;lt;&#65; &gt;</t></is></c><c r="B2" t="str"><v>&#95;x0041_</v></c></row>',
    "line ends": '<row r="2">\r\n<c r="A2" t="inlineStr"><is><t>a\r\nb\rc</t></is></c>\r\n</row>',
    "no reference": '<row r="2"><c r="B2"><v>1</v></c></row><row><c><v>5</v></c></row>',
    "other order": '<row r="2"><c t="b" r="A2"><v>1</v></c></row>',
    "formula, runs": '<row r="2"><c r="A2"><f>1+1</f><v>2</v></c><c r="B2" t="inlineStr"><is><r><t>ri</t></r><r><t>ch</t></r></is></c></row>',
    "comment": '<row r="2"><c r="A2"><v>1</v></c></row><!-- <row r="3"><c r="A3"><v>2</v></c></row> --><row r="4"><c r="A4"><v>3</v></c></row>',
    "section": '<row r="2"><c r="A2" t="str"><v><![CDATA[</row><row>]]></v></c></row><row r="3"><c r="A3"><v>3</v></c></row>',
    "sign in text": '<row r="2"><c r="A2" t="str"><v>a > b</v></c></row>',
}


@pytest.mark.parametrize("name", ODD)
@pytest.mark.parametrize("chunk", [50, 1 << 20])
def test_both_ways_of_reading(monkeypatch, tmp_path, name, chunk):
    header = '<row r="1"><c r="A1" t="inlineStr"><is><t>a</t></is></c><c r="B1" t="inlineStr"><is><t>b</t></is></c></row>'
    styles = '<cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs>'
    strings = ["<t>s</t>", "<t>t</t>", "<t></t>"]
    by_hand(tmp_path / "a.xlsx", {"s": header + ODD[name] + ODD["plain"]}, strings, styles=styles)
    monkeypatch.setattr(sheet_xml, "CHUNK_BYTES", chunk)

    def rows():
        book = W.Workbook((tmp_path / "a.xlsx").read_bytes())
        return [r for piece in book.batches("s", ["b", "a", "q"]) for r in zip(*[c.to_pylist() for c in piece])]

    by_position = rows()
    monkeypatch.setattr(sheet_xml, "cells_of", lambda chunk: None)
    assert by_position == rows() and ("2.50", "t", None) in by_position


def test_dates_beyond_the_calendar_fail_in_any_column(tmp_path):
    rows = '<row r="1"><c r="A1"><v>1</v></c></row><row r="2"><c r="A2"><v>1</v></c><c r="B2" s="0"><v>1e9</v></c></row>'
    by_hand(tmp_path / "a.xlsx", {"s": rows}, styles='<cellXfs><xf numFmtId="14"/></cellXfs>')
    with pytest.raises(OverflowError):
        list(W.Workbook((tmp_path / "a.xlsx").read_bytes()).batches("s", ["a"]))


def test_numbers_are_written_as_python_writes_them():
    values = [0.0, -0.0, 1.0, 2.55, 1e-4, 9e-5, 1e9, 123456789012345.6, 1e16, 1e300, 5e-324, float("inf"), None, 4753.369999999999]
    xml = bytes(sheet_xml.rows_xml(pa.RecordBatch.from_pydict({"x": values}), 1)).decode()
    cells = ["" if v is None else f'<c r="A{i}"><v>{v!r}</v></c>' for i, v in enumerate(values, 1)]
    assert xml == "".join(f'<row r="{i}">{c}</row>' for i, c in enumerate(cells, 1))


def test_white_space_is_marked_where_programs_may_change_it():
    for texts, marked in [(["a b", None, ""], False), (["a", " b"], True), (["a", "b "], True), (["a\nb"], True), ([None], False)]:
        xml = bytes(sheet_xml.rows_xml(pa.RecordBatch.from_pydict({"x": pa.array(["  ", *texts], pa.string())}).slice(1), 1))
        assert (b'xml:space="preserve"' in xml) == marked
