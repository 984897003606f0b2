"""Sheet XML of workbooks, thousands of rows at a time.

Reading: ``cells_of`` takes whole rows as bytes and finds their tags and texts by position. It knows the plain form
that programs write: unprefixed rows of cells that have a reference first and a value or one inline text. Of anything
else (formulas, formatted runs, comments, cells without a reference) it says None, and the caller's XML parser reads
those rows.

Writing: ``rows_xml`` joins the cells of a record batch.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21
#: Chunks with more forms of cell attributes, or of 1 GB and more, are left to the XML parser.
FORMS, CHUNK_LIMIT = 64, 1 << 30

# Fixed values of the file format: day zero of both calendars.
EPOCH, EPOCH_1904 = dt.datetime(1899, 12, 30), dt.datetime(1904, 1, 1)
_DAY, _UNIX = 86400, dt.datetime(1970, 1, 1)

ESCAPED = re.compile(r"_x([0-9A-Fa-f]{4})_")
_ESCAPED_RE2 = "_x[0-9A-Fa-f]{4}_"
_UNSAFE = re.compile("_(?=x[0-9A-Fa-f]{4}_)|[\\x00-\\x08\\x0b-\\x1f\\ufffe\\uffff]")
_UNSAFE_RE2 = r"[&<>\x00-\x08\x0b-\x1f\x{fffe}\x{ffff}]|" + _ESCAPED_RE2
_UNSAFE_MARKS = [b"&", b"<", b">", b"\xef", b"_x"]
_ENTITY = re.compile(rb"&(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);")
_ATTRIBUTE = r' +([\w:.-]+)="([^"<&\t\n]*)"'
_ATTRIBUTES, _ATTRIBUTE = re.compile(f"(?:{_ATTRIBUTE})* *", re.ASCII), re.compile(_ATTRIBUTE, re.ASCII)
_DECLARATION = re.compile(rb"(?:\xef\xbb\xbf)?<\?xml[^>]*\?>")
#: Comments, other sections, instructions: rows after one of these may be part of it.
OTHER = re.compile(rb"<!|<\?(?!xml\s)")
_ENCODING = re.compile(rb"""encoding\s*=\s*["']([^"']*)""")

# Tags by the two bytes after "<", the length of those without attributes, and what may follow each.
_ROW, _NO_ROW, _ROW_END, _C, _NO_C, _C_END, _V, _V_END, _IS, _IS_END, _T, _T_END = range(1, 13)
_TAGS = np.zeros(1 << 16, np.uint8)
for _two, _tag in {
    b"ro": _ROW, b"/r": _ROW_END, b"c ": _C, b"/c": _C_END, b"v>": _V, b"/v": _V_END, b"is": _IS, b"/i": _IS_END, b"t ": _T,
    b"t>": _T, b"/t": _T_END,
}.items():
    _TAGS[_two[0] << 8 | _two[1]] = _tag
_LENGTHS = np.zeros(16, np.int64)
_LENGTHS[[_ROW_END, _C_END, _V, _V_END, _IS, _IS_END, _T_END]] = [5, 3, 2, 3, 3, 4, 3]
_FOLLOWS = np.zeros(256, bool)
for _tag, _next in {
    _ROW: (_C, _NO_C, _ROW_END), _NO_ROW: (_ROW, _NO_ROW), _ROW_END: (_ROW, _NO_ROW), _C: (_V, _IS, _C_END),
    _NO_C: (_C, _NO_C, _ROW_END), _C_END: (_C, _NO_C, _ROW_END), _V: (_V_END,), _V_END: (_C_END,), _IS: (_T,),
    _T: (_T_END,), _T_END: (_IS_END,), _IS_END: (_C_END,),
}.items():
    _FOLLOWS[[_tag << 4 | n for n in _next]] = True


def pieces(file) -> Iterator[tuple[bytes, bool]]:
    """A sheet's bytes in order; pieces marked True are whole rows, if ``cells_of`` knows their form.

    Nothing is marked in another encoding. Pieces end with a tag unless the sheet does not.
    """
    plain, rest, first = True, b"", True
    while data := file.read(CHUNK_BYTES):
        data, rest = rest + data, b""
        if first and (head := _DECLARATION.match(data)):
            coding = _ENCODING.search(head[0])
            plain = coding is None or coding[1].lower() == b"utf-8"
            yield head[0], False
            data = data[head.end():]
        first = False
        if not plain:
            yield data, False
            continue
        end = data.rfind(b"</row>")
        begin = data.find(b"<row", 0, max(end, 0))
        if begin < 0:
            end = data.rfind(b">") + 1
            yield data[:end], False
        else:
            end += len(b"</row>")
            yield data[:begin], False
            yield data[begin:end], True
        rest = data[end:]
    yield rest, False


@dataclass
class Cells:
    """Cells that have a text, in their order."""

    rows: int
    row: np.ndarray  # from 0
    column: np.ndarray  # from 1
    inline: np.ndarray
    form: np.ndarray  # place in forms, the attributes beside the reference
    forms: list[dict[str, str]]
    texts: pa.StringArray  # every second one is a cell's
    has_entity: bool

    def text(self, at: np.ndarray) -> pa.StringArray:
        """Decoded texts of cells by number."""
        found = self.texts.take(pa.array(2 * at))
        if self.has_entity and pc.any(marked := pc.match_substring(found, "&")).as_py():
            coded = "</t><t>".join(found.filter(marked).to_pylist())
            plain = [e.text for e in ElementTree.fromstring(f"<x><t>{coded}</t></x>")]
            found = pc.replace_with_mask(found, marked, pa.array(plain, pa.string()))
        return found

    def unescaped(self, texts: pa.StringArray) -> pa.StringArray:
        if b"_x" in _bytes(texts):
            marked = pc.match_substring_regex(texts, _ESCAPED_RE2)
            plain = [unescape(t) for t in texts.filter(marked).to_pylist()]
            texts = pc.replace_with_mask(texts, marked, pa.array(plain, pa.string()))
        return texts


def _bytes(texts: pa.StringArray) -> bytes:
    """All texts one after the other."""
    _, ends, data = texts.buffers()
    if data is None or not len(texts):
        return b""
    ends = np.frombuffer(ends, np.int32)
    begin, end = int(ends[texts.offset]), int(ends[texts.offset + len(texts)])
    return data.slice(begin, end - begin).to_pybytes()


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: chr(int(m[1], 16)), text)


def _forms(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[dict[str, str]]] | None:
    """Number of the form of each cell's further attributes, and what they say; None if that is not plain."""
    form, forms, width = np.zeros(len(begin), np.int64), [], end - begin
    for w in np.flatnonzero(np.bincount(width)):
        left = np.flatnonzero(width == w)
        if w == 0:
            form[left] = len(forms)
            forms.append({})
            continue
        seen = np.lib.stride_tricks.sliding_window_view(raw, w)[begin[left]]
        while len(left):
            text = seen[0].tobytes().decode("utf-8", "replace")
            if len(forms) == FORMS or not _ATTRIBUTES.fullmatch(text):
                return None
            said = _ATTRIBUTE.findall(text)
            if len(dict(said)) < len(said) or "r" in dict(said):
                return None
            same = seen.view(f"S{w}")[:, 0] == seen[0].tobytes()
            form[left[same]] = len(forms)
            forms.append(dict(said))
            left, seen = left[~same], seen[~same]
    return form, forms


def cells_of(chunk: bytes) -> Cells | None:
    """Cells of whole rows, or None if they have another form than the plain one."""
    if b"\r" in chunk:  # as XML reads line ends
        chunk = chunk.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
    if len(chunk) >= CHUNK_LIMIT or b"\xef" in chunk and (b"\xef\xbf\xbe" in chunk or b"\xef\xbf\xbf" in chunk):
        return None
    raw, data = np.frombuffer(chunk, np.uint8), pa.py_buffer(chunk)
    if (low := raw < 32).any() and not np.isin(raw[low], (9, 10)).all():
        return None
    if (has_entity := b"&" in chunk) and len(_ENTITY.findall(chunk)) < chunk.count(b"&"):
        return None
    try:
        whole = np.array([0, len(chunk)], np.int32)
        pa.StringArray.from_buffers(1, pa.py_buffer(whole), data).validate(full=True)
    except pa.ArrowInvalid:
        return None

    marks = np.flatnonzero((raw & ~np.uint8(ord("<") ^ ord(">"))) == ord("<"))
    opened, closed = marks[0::2].copy(), marks[1::2].copy()
    if not len(opened) or len(opened) != len(closed) or (raw.take(opened) != ord("<")).any() or (raw.take(closed) != ord(">")).any():
        return None
    tags = _TAGS.take(raw[1:].take(opened).astype(np.uint16) << 8 | raw[2:].take(opened))
    length = _LENGTHS.take(tags)
    if not tags.all() or ((length != closed - opened) & (length > 0)).any():
        return None
    ends = np.flatnonzero(raw.take(closed - 1) == ord("/"))
    if not np.isin(tags[ends], (_ROW, _C)).all():
        return None
    for tag, i, allowed in (_ROW, 3, b"w"), (_ROW, 4, b" >/"), (_ROW_END, 3, b"o"), (_ROW_END, 4, b"w"), (_IS_END, 3, b"s"):
        if not np.isin(raw[opened[tags == tag] + i], list(allowed)).all():
            return None
    tags[ends] += 1
    if tags[0] not in (_ROW, _NO_ROW) or tags[-1] != _ROW_END:
        return None
    if not _FOLLOWS.take(tags[:-1] << 4 | tags[1:]).all():
        return None

    at = np.flatnonzero(tags == _C)
    inside = tags[at + 1]
    at, inside = at[inside != _C_END], inside[inside != _C_END]
    inline = inside == _IS
    begin, end = closed[at + 1 + inline] + 1, opened[at + 2 + inline]
    filled = np.flatnonzero(begin < end)
    at, inline, begin, end = at[filled], inline[filled], begin[filled], end[filled]

    place = opened[at] + 2
    if not all((raw[i:].take(place) == byte).all() for i, byte in enumerate(b' r="')):
        return None
    place += 4
    column = np.zeros(len(at), np.int64)
    for _ in range(3):
        byte = raw.take(place) - np.uint8(ord("A"))
        if not (letter := byte < 26).any():
            break
        column = np.where(letter, column * 26 + byte + 1, column)
        place += letter
    while (digit := raw.take(place) - np.uint8(ord("0")) < 10).any():
        place += digit
    if not ((raw.take(place) == ord('"')) & (column > 0)).all():
        return None
    if (found := _forms(raw, place + 1, closed[at])) is None:
        return None

    offsets = np.empty(2 * len(at) + 1, np.int32)
    offsets[0:-1:2], offsets[1::2], offsets[-1] = begin, end, len(chunk)
    texts = pa.StringArray.from_buffers(2 * len(at), pa.py_buffer(offsets), data)
    number = np.cumsum((tags == _ROW) | (tags == _NO_ROW))
    return Cells(int(number[-1]), number[at] - 1, column, inline, *found, texts, has_entity)


def seconds_of(days: pa.StringArray, epoch: dt.datetime) -> np.ndarray | None:
    """Day numbers as seconds since 1970, rounded; None if one is no number or beyond years of four digits."""
    try:
        seconds = np.rint(days.cast(pa.float64()).to_numpy(zero_copy_only=False) * _DAY)
    except pa.ArrowInvalid:
        return None
    low, high = ((dt.datetime(y, 1, 1) - epoch).total_seconds() for y in (1000, 9999))
    if not ((seconds >= low) & (seconds < high)).all():
        return None
    return seconds.astype(np.int64) + (epoch - _UNIX) // dt.timedelta(seconds=1)


def _letters(i: int) -> str:
    out = ""
    while i >= 0:
        i, digit = divmod(i, 26)
        out, i = chr(65 + digit) + out, i - 1
    return out


def _safe(text: str) -> str:
    return escape(_UNSAFE.sub(lambda m: f"_x{ord(m[0]):04X}_", text))


def _safe_texts(column: pa.Array) -> pa.Array:
    column = column.cast(pa.string())
    column.validate(full=True)
    every = _bytes(column)
    if not every or np.frombuffer(every, np.uint8).min() >= 32 and not any(mark in every for mark in _UNSAFE_MARKS):
        return column
    marked = pc.match_substring_regex(column, _UNSAFE_RE2).fill_null(False)
    if not pc.any(marked).as_py():
        return column
    plain = [_safe(t) for t in column.filter(marked).to_pylist()]
    return pc.replace_with_mask(column, marked, pa.array(plain, pa.string()))


def _has_edges(texts: pa.StringArray) -> bool:
    """Whether a text begins or ends with white space or has line ends or tabs, which programs may change."""
    every = np.frombuffer(_bytes(texts), np.uint8)
    if not len(every):
        return False
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    ends = ends - ends[0]
    edges = ends[:-1][ends[:-1] < ends[1:]], ends[1:][ends[:-1] < ends[1:]] - 1
    return every.min() < 32 or any((every.take(at) == 32).any() for at in edges)


def _float_texts(column: pa.Array) -> pa.Array:
    """Doubles as Python writes them: shortest digits, a point in whole ones."""
    values = column.fill_null(1.0).to_numpy(zero_copy_only=False)
    size = np.abs(values)
    alike = ((size >= 1e-4) & (size < 1e9)) | (size == 0)
    whole = np.where(alike, values, 0.5) % 1 == 0
    text = column.cast(pa.string())
    if whole.any():
        text = pc.binary_join_element_wise(text, pc.if_else(pa.array(whole), ".0", ""), "")
    if not alike.all():
        others = pa.array([repr(v) for v in values[~alike].tolist()], pa.string())
        text = pc.replace_with_mask(text, pa.array(~alike), others)
    return text


def _cells_xml(letter: str, at: pa.Array, column: pa.Array) -> pa.Array:
    """Cells of a column, NULL where it has no value."""
    kind, attributes, begin, end = column.type, "", "<v>", "</v>"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        texts = _safe_texts(column)
        attributes, begin, end = ' t="inlineStr"', "<is><t>", "</t></is>"
        if _has_edges(texts):
            begin = '<is><t xml:space="preserve">'
    elif pa.types.is_boolean(kind):
        attributes, texts = ' t="b"', column.cast(pa.int8()).cast(pa.string())
    elif pa.types.is_integer(kind):
        texts = column.cast(pa.string())
    elif pa.types.is_floating(kind):
        texts = _float_texts(column.cast(pa.float64()))
    elif pa.types.is_timestamp(kind):
        attributes = ' s="1"'
        micros = (EPOCH - _UNIX) // dt.timedelta(microseconds=1)
        since = column.cast(pa.timestamp("us")).cast(pa.int64())
        if pc.any(pc.greater(pc.abs(since), 1 << 52)).as_py():  # doubles do not hold each of them
            days = [None if v is None else (v - EPOCH) / dt.timedelta(days=1) for v in column.to_pylist()]
            texts = _float_texts(pa.array(days, pa.float64()))
        else:
            texts = _float_texts(pc.divide(pc.subtract(since, micros).cast(pa.float64()), _DAY * 1e6))
    else:
        texts = pa.array([None if v is None else f"{v}" for v in column.to_pylist()], pa.string())
    return pc.binary_join_element_wise(f'<c r="{letter}', at, f'"{attributes}>{begin}', texts, f"{end}</c>", "")


def rows_xml(batch: pa.RecordBatch, at: int) -> memoryview:
    """Rows of a batch as XML; the first has number ``at``."""
    numbers = pa.array(np.arange(at, at + batch.num_rows)).cast(pa.string())
    cells = [_cells_xml(_letters(i), numbers, c) for i, c in enumerate(batch.columns)]
    rows = pc.binary_join_element_wise('<row r="', numbers, '">', *cells, "</row>", "", null_handling="replace")
    ends = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset:][:len(rows) + 1]
    return memoryview(rows.buffers()[2])[ends[0]:ends[-1]]
