"""Spreadsheet workbooks (.xlsx) as a source and a sink of rows.

Reading: Spark's binary-file source lists and fetches the workbooks, so every Hadoop file system and its
credentials work; a task takes the workbooks of its split one by one and streams the rows out of the zipped XML in
Arrow batches. A sheet holds at most ``SHEET_ROWS`` rows, which bounds a workbook; only its shared strings are kept
beside the batch. Rows of the form that programs write are found by position, thousands at a time (``sheet_xml``), all
others by the XML parser, with the same result. Files whose names start with ``_`` or ``.`` are left out, as everywhere
in Spark.

Every cell is read as text under the given columns, like a CSV file: cleaning decides what a bad value means.

* Header: first row that has a cell. Names are matched without case and spaces; of equal ones the first counts,
  a missing column is NULL, further columns are left out.
* Numbers keep their stored digits; under a date style they become ``yyyy-MM-dd HH:mm:ss``, rounded to seconds.
* Booleans read ``true`` or ``false``; error cells, empty texts and missing cells are NULL.
* A row without any value is left out. A sheet without rows gives none. A file that is no workbook fails the job.
"""

from __future__ import annotations

import datetime as dt
import io
import itertools
import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.sources import sheet_xml
from tillworks.sources.sheet_xml import EPOCH, EPOCH_1904

FIRST, ALL = "first", "all"
BATCH_ROWS = 8192
PIECE_BYTES = 1 << 24
#: A third of the default's time for a tenth more bytes.
COMPRESSION = 3

#: Rows of a workbook written here: some 15 MB zipped, of which Spark's reader holds several copies.
WORKBOOK_ROWS = 1 << 18

# Fixed values of the file format: sheet size, date styles, names of parts.
SHEET_ROWS = 1_048_576
DATE_STYLES = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
WORKBOOK, STYLES, STRINGS = "xl/workbook.xml", "xl/styles.xml", "xl/sharedStrings.xml"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_TYPES = "application/vnd.openxmlformats-officedocument.spreadsheetml"

#: Cell types; another one reads as "n". "date" is a number under a date style.
KINDS = ["n", "inlineStr", "str", "s", "b", "d", "e", "date"]
_NO_DATE = re.compile(r'"[^"]*"|\\.|_.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', re.IGNORECASE)


def _key(name: str) -> str:
    return name.lower().replace(" ", "")


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _closed(events: Iterator[tuple[str, ElementTree.Element]], name: str, parents: list) -> Iterator[ElementTree.Element]:
    """Closed elements of a name, each emptied after use, so that the document never stands in memory."""
    for event, element in events:
        if event == "start":
            parents.append(element)
            continue
        parents.pop()
        if _tag(element) == name:
            yield element
            element.clear()
            if parents:
                parents[-1].remove(element)


def _text(element: ElementTree.Element) -> str:
    """Text of a string item: its runs joined, phonetic hints left out."""
    parts = []
    for child in element:
        if _tag(child) == "t":
            parts.append(child.text or "")
        elif _tag(child) == "r":
            parts += [t.text or "" for t in child if _tag(t) == "t"]
    return sheet_xml.unescape("".join(parts))


def _iso(raw: str) -> str:
    return raw.rstrip("Z").partition(".")[0].replace("T", " ")


class Workbook:
    """One open workbook: sheets in their order, shared strings, styles that mean dates."""

    def __init__(self, content: bytes):
        self.parts = zipfile.ZipFile(io.BytesIO(content))
        book = ElementTree.fromstring(self.parts.read(WORKBOOK))
        links = ElementTree.fromstring(self.parts.read("xl/_rels/workbook.xml.rels"))
        targets = {e.get("Id"): e.get("Target") for e in links if e.get("Type", "").endswith("/worksheet")}
        self.sheets: dict[str, str] = {}
        self.epoch = EPOCH
        for e in book.iter():
            if _tag(e) == "workbookPr" and e.get("date1904") in ("1", "true"):
                self.epoch = EPOCH_1904
            if _tag(e) == "sheet" and (target := targets.get(e.get(f"{{{_OFFICE}}}id"))):
                self.sheets[e.get("name")] = posixpath.normpath(posixpath.join("/xl", target)).lstrip("/")
        names = set(self.parts.namelist())
        self.strings = []
        if STRINGS in names:
            with self.parts.open(STRINGS) as file:
                events = ElementTree.iterparse(file, events=("start", "end"))
                self.strings = [_text(e) for e in _closed(events, "si", [])]
        self.shared = pa.array([s or None for s in self.strings], pa.string())
        self.filled = self.shared.is_valid().to_numpy(zero_copy_only=False)
        self.dates = self._date_styles() if STYLES in names else set()

    def _date_styles(self) -> set[int]:
        root = ElementTree.fromstring(self.parts.read(STYLES))
        dates = set(DATE_STYLES)
        for e in root.iter():
            if _tag(e) == "numFmt":
                plain = _NO_DATE.sub("", e.get("formatCode", "")).lower()
                is_date = plain != "general" and any(c in plain for c in "ymdhs")
                (dates.add if is_date else dates.discard)(int(e.get("numFmtId")))
        styles = [x for group in root if _tag(group) == "cellXfs" for x in group]
        return {i for i, x in enumerate(styles) if int(x.get("numFmtId", "0")) in dates}

    def _value(self, cell: ElementTree.Element) -> str | None:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            return next((_text(e) for e in cell if _tag(e) == "is"), None) or None
        raw = next((e.text for e in cell if _tag(e) == "v"), None)
        if not raw or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(raw)] or None
        if kind == "b":
            return "true" if raw == "1" else "false"
        if kind == "d":
            return _iso(raw)
        if kind == "n" and int(cell.get("s", "0")) in self.dates:
            when = self.epoch + dt.timedelta(seconds=round(float(raw) * 86400))
            return when.strftime("%Y-%m-%d %H:%M:%S")
        return sheet_xml.unescape(raw) if kind == "str" else raw

    def _row(self, row: ElementTree.Element) -> dict[int, str]:
        """Values of a row by column number."""
        cells, at = {}, -1
        for cell in row:
            if _tag(cell) != "c":
                continue
            at += 1
            if ref := cell.get("r"):
                at = 0
                for letter in ref.rstrip("0123456789"):
                    at = at * 26 + ord(letter) - 64
                at -= 1
            if (value := self._value(cell)) is not None:
                cells[at] = value
        return cells

    def _kind(self, form: dict[str, str]) -> str:
        kind = form.get("t", "n")
        if kind == "n" and int(form.get("s", "0")) in self.dates:
            return "date"
        return kind if kind in KINDS[:-1] else "n"

    def _columns(self, cells: sheet_xml.Cells, places: list[int]) -> list[pa.Array] | None:
        """Values at wanted places of all rows that have a value, as ``_row`` gives them; None if it has to say."""
        kind = np.array([KINDS.index(self._kind(f)) for f in cells.forms], np.int64)[cells.form]
        filled = (kind != KINDS.index("e")) & ((kind == KINDS.index("inlineStr")) == cells.inline)
        if len(at := np.flatnonzero(filled & (kind == KINDS.index("s")))):
            try:
                index = cells.text(at).cast(pa.int64()).to_numpy()
            except pa.ArrowInvalid:
                return None
            if index.min() < 0 or index.max() >= len(self.strings):
                return None
            filled[at] = self.filled[index]
        dates = np.zeros(len(kind), np.int64)
        if len(at := np.flatnonzero(filled & (kind == KINDS.index("date")))):
            if (seconds := sheet_xml.seconds_of(cells.text(at), self.epoch)) is None:
                return None
            dates[at] = seconds
        present = np.zeros(cells.rows, bool)
        present[cells.row[filled]] = True
        number, n = np.cumsum(present) - 1, int(present.sum())
        out = []
        for place in places:
            at = np.flatnonzero(filled & (cells.column == place + 1))
            rows = number[cells.row[at]]
            if (rows[1:] <= rows[:-1]).any():  # a column twice in a row
                return None
            texts, kinds = cells.text(at), kind[at]
            values = texts
            for k in np.flatnonzero(np.bincount(kinds)):
                here = kinds == k
                mask = pa.array(here)
                found = texts if here.all() else texts.filter(mask)
                if KINDS[k] == "date":
                    found = pa.array(dates[at[here]]).cast(pa.timestamp("s")).cast(pa.string())
                else:
                    found = self._converted(KINDS[k], cells, found)
                values = found if here.all() else pc.replace_with_mask(values, mask, found)
            if len(at) < n:
                where = np.full(n, -1)
                where[rows] = np.arange(len(at))
                values = values.take(pa.array(where, mask=where < 0))
            out.append(values)
        return out

    def _converted(self, kind: str, cells: sheet_xml.Cells, texts: pa.StringArray) -> pa.Array:
        if kind in ("inlineStr", "str"):
            return cells.unescaped(texts)
        if kind == "s":
            return self.shared.take(texts.cast(pa.int64()))
        if kind == "b":
            return pc.if_else(pc.equal(texts, "1"), "true", "false")
        return pa.array([_iso(t) for t in texts.to_pylist()], pa.string()) if kind == "d" else texts

    def batches(self, sheet: str, keys: Sequence[str]) -> Iterator[list[pa.Array]]:
        """Wanted columns of the rows below the header that have a value, some thousand rows at a time."""
        parser, parents, places, out = ElementTree.XMLPullParser(("start", "end")), [], None, []
        odd = False
        with self.parts.open(self.sheets[sheet]) as file:
            for piece, whole in sheet_xml.pieces(file):
                at = 0
                while at < len(piece):
                    plain = whole and not odd
                    if plain and places is not None and (cells := sheet_xml.cells_of(piece[at:])) is not None:
                        if (columns := self._columns(cells, places)) is not None:
                            if out:
                                yield [pa.array(v, pa.string()) for v in zip(*out)]
                                out = []
                            yield columns
                            break
                    end = piece.index(b"</row>", at) + 6 if plain and places is None else len(piece)
                    odd = odd or sheet_xml.OTHER.search(piece, at, end) is not None
                    parser.feed(piece[at:end])
                    at = end
                    for row in _closed(parser.read_events(), "row", parents):
                        if not (values := self._row(row)):
                            continue
                        if places is None:
                            header = {}
                            for i, name in values.items():
                                header.setdefault(_key(name), i)
                            places = [header.get(k, -1) for k in keys]
                            continue
                        out.append([values.get(p) for p in places])
                        if len(out) == BATCH_ROWS:
                            yield [pa.array(v, pa.string()) for v in zip(*out)]
                            out = []
        parser.close()
        if out:
            yield [pa.array(v, pa.string()) for v in zip(*out)]


def _sheets(book: Workbook, wanted: str | Sequence[str]) -> list[str]:
    if wanted == FIRST:
        return list(book.sheets)[:1]
    return list(book.sheets) if wanted == ALL else [s for s in book.sheets if s in wanted]


def read_workbooks(
    spark: SparkSession, path: str, columns: Sequence[str], sheets: str | Sequence[str] = FIRST
) -> DataFrame:
    """Rows of all workbooks under a path, text columns as named, and ``source_file``.

    ``sheets``: the first sheet, all sheets, or a list of names, of which a workbook need not have any. A path that
    is not there is a ValueError, as a file that is no workbook is.
    """
    columns, keys = list(columns), [_key(c) for c in columns]
    names = [*columns, "source_file"]
    if not isinstance(sheets, str):
        sheets = list(sheets)
    elif sheets not in (FIRST, ALL):
        raise ValueError(f"sheets: {FIRST}, {ALL} or a list of names")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            for content, source in zip(files.column(0), files.column(1)):
                source = source.as_py()
                try:
                    book = Workbook(content.as_py())
                except (zipfile.BadZipFile, KeyError) as error:
                    raise ValueError(f"not a workbook: {source}") from error
                for sheet in _sheets(book, sheets):
                    for values in book.batches(sheet, keys or [""]):
                        path = pa.repeat(pa.scalar(source, pa.string()), len(values[0]))
                        yield pa.RecordBatch.from_arrays([*values[:len(keys)], path], names=names)

    try:
        files = (
            spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise ValueError(f"no file or folder of workbooks: {path}") from error
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return files.select("content", F.col("_metadata.file_path").alias("source")).mapInArrow(read, schema)


def _frame(sheets: int) -> dict[str, str]:
    """The parts of a workbook beside its sheets."""
    head, ids = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>', range(1, sheets + 1)
    relations = f'{head}<Relationships xmlns="{_PACKAGE}/relationships">'
    parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{_TYPES}.worksheet+xml"/>' for i in ids)
    return {
        "[Content_Types].xml": f'{head}<Types xmlns="{_PACKAGE}/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/{WORKBOOK}" ContentType="{_TYPES}.sheet.main+xml"/>'
        f'<Override PartName="/{STYLES}" ContentType="{_TYPES}.styles+xml"/>{parts}</Types>',
        "_rels/.rels": f'{relations}<Relationship Id="r1" Type="{_OFFICE}/officeDocument" Target="{WORKBOOK}"/></Relationships>',
        WORKBOOK: f'{head}<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>'
        + "".join(f'<sheet name="Sheet{i}" sheetId="{i}" r:id="s{i}"/>' for i in ids) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": relations
        + "".join(f'<Relationship Id="s{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in ids)
        + f'<Relationship Id="styles" Type="{_OFFICE}/styles" Target="styles.xml"/></Relationships>',
        STYLES: f'{head}<styleSheet xmlns="{_MAIN}"><fonts><font/></fonts><fills><fill/></fills><borders><border/></borders>'
        '<cellStyleXfs><xf/></cellStyleXfs><cellXfs><xf numFmtId="0"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>',
    }


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, not many of large ones at a time."""
    for b in batches:
        step = max(1, b.num_rows * PIECE_BYTES // max(b.nbytes, PIECE_BYTES))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def write_workbook(
    file: io.IOBase, columns: Sequence[str], batches: Iterator[pa.RecordBatch], sheet_rows: int = SHEET_ROWS
) -> int:
    """One workbook from a stream of batches; a full sheet is followed by another one. Returns the number of rows."""
    n = sheets = 0
    header = pa.RecordBatch.from_arrays([pa.array([c], pa.string()) for c in columns], names=columns)
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED, compresslevel=COMPRESSION) as parts:
        pieces = _pieces(batches)
        following = next(pieces, None)
        while following is not None or not sheets:
            sheets += 1
            with parts.open(f"xl/worksheets/sheet{sheets}.xml", "w", force_zip64=True) as out:
                out.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_MAIN}"><sheetData>'.encode())
                out.write(sheet_xml.rows_xml(header, 1))
                at = 2
                while following is not None and at <= sheet_rows:
                    room = sheet_rows + 1 - at
                    rows, rest = following.slice(0, room), following.slice(room)
                    out.write(sheet_xml.rows_xml(rows, at))
                    at, n = at + rows.num_rows, n + rows.num_rows
                    following = rest if rest.num_rows else next(pieces, None)
                out.write(b"</sheetData></worksheet>")
        for name, text in _frame(sheets).items():
            parts.writestr(name, text)
    return n


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


def write_workbooks(
    df: DataFrame, folder: str, sheet_rows: int = SHEET_ROWS, workbook_rows: int = WORKBOOK_ROWS
) -> int:
    """Workbooks of at most ``workbook_rows`` rows of a partition, in a folder whose scheme pyarrow knows; returns the number of rows.

    Columns are texts, numbers, booleans or timestamps, written without zone. Files get their names, by partition and
    place in it, when all are whole, and only those of the attempts that Spark took; a repeated write replaces files of
    the same names.
    """
    from pyspark import TaskContext

    columns = df.columns
    plain = df.select(*[
        F.col(f.name).cast("timestamp_ntz") if isinstance(f.dataType, (T.TimestampType, T.DateType)) else F.col(f.name)
        for f in df.schema.fields
    ])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = (b for b in batches if b.num_rows)
        rest = list(itertools.islice(filled, 1))

        def following() -> Iterator[pa.RecordBatch]:
            """What goes into the next workbook."""
            room = workbook_rows
            while rest and room:
                b = rest.pop()
                yield b.slice(0, room)
                rest.extend([b.slice(room)] if b.num_rows > room else itertools.islice(filled, 1))
                room -= min(room, b.num_rows)

        if not rest:
            return
        store, place = _store(folder)
        store.create_dir(place, recursive=True)
        part, k = TaskContext.get().partitionId(), 0
        while rest:
            own, name = f"_{uuid.uuid4()}", f"part-{part:05d}-{k}.xlsx" if k else f"part-{part:05d}.xlsx"
            with store.open_output_stream(f"{place}/{own}") as out:
                n = write_workbook(out, columns, following(), sheet_rows)
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "own": [own], "name": [name]})
            k += 1

    written = plain.mapInArrow(write, "n bigint, own string, name string").collect()
    store, place = _store(folder)
    for file in written:
        store.move(f"{place}/{file['own']}", f"{place}/{file['name']}")
    return sum(file["n"] for file in written)
