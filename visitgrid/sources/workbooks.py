"""Workbook files to cells.

The only row-wise Python stage: an .xlsx file is a zip of XML parts, which Spark
cannot read.  It goes in two steps.  The first opens each file, lists its sheets and
names, and passes on the wanted sheets as they lie in the zip, still compressed, one row
each.  Those rows are dealt out by file and sheet, so the sheets of a large workbook go to
several tasks; the second step parses each as a stream, row by row.  Cells leave in
batches of bounded size, and a file that cannot be read gives an error row instead of
failing the job.
"""

from __future__ import annotations

import contextlib
import functools
import io
import itertools
import json
import posixpath
import re
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from datetime import datetime, time, timedelta
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.text import base_name, sheet_list_hash

SCAN_SCHEMA = (
    "kind string, workbook_id string, sheet string, row int, col int, ctype string, raw string, name string"
)
#: A row of a sheet as one row, with its cells in the order they were found in: an array for
#: each of their parts, so that a cell is found by its column without laying out the others.  ``since``
#: is the first of the filled rows that lead to it without a gap, or null if that is not known.
ROW_SCHEMA = f"{SCAN_SCHEMA}, cells struct<cols: array<int>, ctypes: array<string>, raws: array<string>, since: int>"
CELL_COLUMNS = ("workbook_id", "sheet", "row", "col", "ctype", "raw")
FORMATS = ("xlsx", "xlsm", "xls")
_PART_SCHEMA = f"{SCAN_SCHEMA}, strings array<string>, settings string, data binary"
_BATCH_ROWS, _BATCH_PARTS = 50_000, 200
_SPACE = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_ROW, _CELL, _VALUE, _INLINE = (_SPACE + tag for tag in ("row", "c", "v", "is"))
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

# Number formats that show a date or a time.
_DATE_FORMAT_IDS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def workbook_files(spark: SparkSession, folder: str, formats: Iterable[str] = FORMATS, skip_locks: bool = False) -> DataFrame:
    """Files of a folder tree: (source_path, content), ready for :func:`scan_workbooks`.

    Executors list and read the files; ``skip_locks`` leaves out ``~$`` lock files.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .where(F.lower("path").rlike(r"\.(" + "|".join(formats) + ")$"))
        .select(F.col("path").alias("source_path"), "content")
    )
    return files.where(~base_name(F.col("source_path")).startswith("~$")) if skip_locks else files


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _texts(node) -> str:
    """Text of a shared or inline string; phonetic runs are not part of it."""
    out = []
    for child in node:
        kind = _local(child.tag)
        if kind == "t":
            out.append(child.text or "")
        elif kind == "r":
            out.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return "".join(out)


#: A shared string without formats: text that an XML parser gives as it stands.
_PLAIN_STRING = '<si><t(?: xml:space="preserve")?>[^<>&\x00-\x1f\x7f-\x9f\ud800-\udfff\ufffe\uffff]*</t></si>'
_PLAIN_STRINGS = re.compile(f"([^&]*?<sst(?: [^<>&]*)?>)((?:{_PLAIN_STRING})*)(</sst>[ \\n]*)")
_STRING_TEXT = re.compile(">([^<>]*)</t>")
_SHELL_BYTES = 4096


def _plain_strings(xml: bytes) -> list[str] | None:
    """The shared strings where none has formats, or None where the XML parser is needed."""
    try:
        whole = _PLAIN_STRINGS.fullmatch(xml.decode())
    except UnicodeDecodeError:
        return None
    if whole is None or len(whole[1]) > _SHELL_BYTES or not _is_string_shell((whole[1] + whole[3]).encode()):
        return None
    return _STRING_TEXT.findall(whole[2])


@functools.lru_cache(maxsize=100)
def _is_string_shell(xml: bytes) -> bool:
    """Shared strings without their texts: well formed, and in no other encoding."""
    if re.search(rb"encoding=(?!.UTF-8.)", xml, re.IGNORECASE) or b"<!" in xml:
        return False
    try:
        root = ElementTree.fromstring(xml)
    except (ElementTree.ParseError, ValueError):
        return False
    return _local(root.tag) == "sst" and not len(root)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    if book.getinfo("xl/sharedStrings.xml").file_size <= _CHUNK_BYTES:
        with contextlib.suppress(zipfile.BadZipFile, zlib.error, EOFError):  # the parser below meets it again
            found = _plain_strings(book.read("xl/sharedStrings.xml"))
            if found is not None:
                return found
    found = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, node in ElementTree.iterparse(part):
            if _local(node.tag) == "si":
                found.append(_texts(node))
                node.clear()
    return found


def _shows_date(code: str) -> bool:
    bare = re.sub(r'"[^"]*"|\\.|_.|\[(?![hms]+\])[^\]]*\]', "", code.lower().split(";")[0])
    return bool(re.search(r"[dmyhs]", bare)) and "general" not in bare


def _shows_duration(code: str) -> bool:
    return bool(re.search(r"\[h+\]|\[m+\]|\[s+\]", code.lower()))


def _date_styles(book: zipfile.ZipFile) -> dict[int, str]:
    """Style index -> ``date`` or ``duration``."""
    if "xl/styles.xml" not in book.namelist():
        return {}
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    codes = {int(n.get("numFmtId")): n.get("formatCode", "") for n in root.iter(f"{_SPACE}numFmt")}
    styles = {}
    for index, xf in enumerate(root.iterfind(f"{_SPACE}cellXfs/{_SPACE}xf")):
        number = int(xf.get("numFmtId", 0))
        if number == 46 or _shows_duration(codes.get(number, "")):
            styles[index] = "duration"
        elif number in _DATE_FORMAT_IDS or _shows_date(codes.get(number, "")):
            styles[index] = "date"
    return styles


def _serial_value(serial: float, base_1904: bool, duration: bool) -> tuple[str, str]:
    """(ctype, text) of a number cell with a date format."""
    if duration:
        return "duration", str(timedelta(days=serial))
    whole, part = divmod(serial, 1)
    clock = timedelta(milliseconds=round(part * 86_400_000))
    if 0 <= serial < 1 and clock.days == 0:
        moment = datetime.min + clock
        return "time", str(time(moment.hour, moment.minute, moment.second, moment.microsecond))
    if 0 < serial < 60 and not base_1904:
        whole += 1
    start = datetime(1904, 1, 1) if base_1904 else datetime(1899, 12, 30)
    return "date", str(start + timedelta(days=whole) + clock)


def _column(ref: str) -> int:
    number = 0
    for letter in ref:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number


def _cell_value(cell, strings: list[str], styles: dict[int, str], base_1904: bool) -> tuple[str, str] | None:
    kind, text = cell.get("t", "n"), None
    for child in cell:
        if child.tag == _VALUE:
            text = child.text
        elif child.tag == _INLINE and kind == "inlineStr":
            return "text", _texts(child)
    if not text:
        return None
    if kind == "n":
        real = "." in text or "e" in text or "E" in text
        number = float(text) if real else int(text)
        style = styles.get(int(cell.get("s", 0))) if styles else None
        if style:
            try:
                return _serial_value(number, base_1904, style == "duration")
            except (OverflowError, ValueError):
                return "text", "#VALUE!"
        return ("float" if real else "int"), str(number)
    if kind == "s":
        return "text", strings[int(text)]
    if kind == "b":
        return "bool", str(bool(int(text)))
    if kind == "d":
        return "date", text.rstrip("Z").replace("T", " ")
    return "text", text  # formula text and error codes


def _sheet_cells(part, strings, styles, base_1904) -> Iterator[tuple[int, int, str, str]]:
    """Filled cells of one sheet part, parsed as a stream."""
    row = 0
    for _, node in ElementTree.iterparse(part):
        if node.tag != _ROW:
            continue
        row = int(node.get("r", row + 1))
        col = 0
        for cell in node:
            if cell.tag != _CELL:
                continue
            col = _column(cell.get("r", "")) or col + 1
            value = _cell_value(cell, strings, styles, base_1904)
            if value is not None:
                yield row, col, *value
        node.clear()


def _sheet_parts(book: zipfile.ZipFile) -> tuple[list[tuple[str, str]], ElementTree.Element]:
    """[(sheet name, part name)] in workbook order, and the workbook part."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {link.get("Id"): link.get("Target") for link in links}
    present, sheets = set(book.namelist()), []
    for sheet in root.iter(f"{_SPACE}sheet"):
        target = targets[sheet.get(_REL)]
        part = target.lstrip("/") if target.startswith("/") else posixpath.normpath("xl/" + target)
        if part in present:
            sheets.append((sheet.get("name"), part))
    return sheets, root


class _Inflated:
    """Stream of the content of a zip entry from its bytes in the archive."""

    def __init__(self, data: bytes, method: int, checksum: int):
        self.data, self.at, self.checksum, self.seen = memoryview(data), 0, checksum, 0
        self.inflate = zlib.decompressobj(-zlib.MAX_WBITS) if method == zipfile.ZIP_DEFLATED else None

    def read(self, size: int = -1) -> bytes:
        step = 1 << 16 if size is None or size < 0 else size
        out = b""
        while not out and self.at < len(self.data):
            piece = self.data[self.at : self.at + step]
            self.at += len(piece)
            out = self.inflate.decompress(piece) if self.inflate else bytes(piece)
            if self.inflate and self.at == len(self.data):
                out += self.inflate.flush()
        self.seen = zlib.crc32(out, self.seen)
        if not out and self.seen != self.checksum:
            raise zipfile.BadZipFile("Bad CRC-32 for a sheet")
        return out


def _entry(book: zipfile.ZipFile, content: bytes, name: str) -> tuple[bytes, int, int]:
    """Bytes of an entry as they lie in the archive, how they are packed, and their checksum."""
    info = book.getinfo(name)
    if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        return book.read(name), zipfile.ZIP_STORED, info.CRC
    name_size, extra_size = struct.unpack_from("<HH", content, info.header_offset + 26)
    start = info.header_offset + 30 + name_size + extra_size
    return content[start : start + info.compress_size], info.compress_type, info.CRC


def open_workbook(content: bytes, wanted: set[str] | None = None) -> Iterator[tuple]:
    """Rows (kind, sheet, row, col, ctype, raw, name, strings, settings, data) of one
    workbook: its sheets and names, and a ``part`` for each sheet that a rule asks for."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        sheets, root = _sheet_parts(book)
        flags = root.find(f"{_SPACE}workbookPr")
        base_1904 = flags is not None and flags.get("date1904") in ("1", "true")
        strings, styles = _shared_strings(book), _date_styles(book)
        for position, (name, _) in enumerate(sheets, start=1):
            yield "sheet", name, position, *_NOTHING[2:]
        for defined in root.iter(f"{_SPACE}definedName"):
            target, mark, address = (defined.text or "").rpartition("!")
            if not mark or defined.get("localSheetId") is not None:
                continue
            # A name that is no single cell is found too; it has no value.
            spot = re.fullmatch(r"\$?([A-Za-z]+)\$?(\d+)", address)
            row, col = (int(spot.group(2)), _column(spot.group(1))) if spot else (None, None)
            yield "name", target.strip("'").replace("''", "'"), row, col, None, None, defined.get("name"), None, None, None
        for name, part_name in sheets:
            if wanted is None or name in wanted:
                try:
                    data, method, checksum = _entry(book, content, part_name)
                except (zipfile.BadZipFile, zlib.error, struct.error, NotImplementedError) as exc:
                    yield "sheet_error", name, None, None, None, f"{type(exc).__name__}: {exc}", *_NOTHING[5:]
                    continue
                settings = json.dumps({"styles": styles, "base_1904": base_1904, "method": method, "checksum": checksum})
                yield "part", name, None, None, None, None, None, strings, settings, data


_NOTHING = (None,) * 9


def parse_part(sheet: str, strings: list[str], settings: str, data: bytes) -> Iterator[tuple]:
    """Rows (kind, sheet, row, col, ctype, raw, name) of the cells of a sheet.  A sheet whose
    XML breaks off gives the cells before the break and a ``sheet_error`` row."""
    known = json.loads(settings)
    styles = {int(k): v for k, v in known["styles"].items()}
    try:
        part = _Inflated(data, known["method"], known["checksum"])
        for row, col, ctype, raw in _sheet_cells(part, strings, styles, known["base_1904"]):
            yield "cell", sheet, row, col, ctype, raw, None
    except (ElementTree.ParseError, zipfile.BadZipFile, zlib.error, KeyError, ValueError, IndexError) as exc:
        yield "sheet_error", sheet, None, None, None, f"{type(exc).__name__}: {exc}", None


#: Whole rows of cells that are a number, a truth value, a shared string or nothing; empty
#: rows may stand between them.  Nothing is captured, so one pass decides.
_ROW_START = r'<row r="[0-9]{1,7}"(?: (?:spans|s|ht|customFormat|customHeight|hidden|outlineLevel|collapsed)="[^"<>&]*")*>'
_EMPTY_ROWS = r'(?:<row r="[0-9]{1,7}"/>|<row r="[0-9]{1,7}"></row>)*'
_PLAIN_CELL = (
    r'<c r="[A-Z]{1,3}[0-9]{1,7}"(?: s="[0-9]{1,6}")?(?: t="[nsb]")?'
    r'(?:/>|><v>-?[0-9]{1,30}(?:\.[0-9]{1,30})?(?:[eE][+-]?[0-9]{1,3})?</v></c>)'
)
_PLAIN_ROWS = rf"^{_EMPTY_ROWS}(?:{_ROW_START}(?:{_PLAIN_CELL})+</row>{_EMPTY_ROWS})+$"
_CTYPES = ("int", "float", "text", "bool", "date", "time", "duration")
_ROWS_AT = re.compile(rb"<sheetData>(?=<row)")
_CHUNK_BYTES = 4 << 20


@functools.lru_cache(maxsize=100_000)
def _dated(text: str, base_1904: bool, duration: bool) -> tuple[str, str]:
    number = int(text) if text.lstrip("-").isdigit() else float(text)
    try:
        return _serial_value(number, base_1904, duration)
    except (OverflowError, ValueError):
        return "text", "#VALUE!"


@functools.lru_cache(maxsize=100)
def _is_small_shell(xml: bytes) -> bool:
    return _is_shell(xml)


def _is_shell(xml: bytes) -> bool:
    """A sheet without its rows: well formed, in the usual name space and no other encoding."""
    if re.search(rb"encoding=(?!.UTF-8.)", xml, re.IGNORECASE) or b"<!" in xml:
        return False
    try:
        root = ElementTree.fromstring(xml)
    except (ElementTree.ParseError, ValueError):
        return False
    return root.tag == f"{_SPACE}worksheet" and root.find(f"{_SPACE}sheetData") is not None and root.find(f".//{_ROW}") is None


def _number_at(data: np.ndarray, at: np.ndarray, most: int) -> np.ndarray:
    """The number whose digits begin at each place; it ends before the first other byte."""
    found, on = np.zeros(len(at), np.int64), np.ones(len(at), bool)
    for n in range(most):
        digit = data[at + n] - np.uint8(48)
        on &= digit <= 9
        if not on.any():
            break
        found = np.where(on, found * 10 + digit, found)
    return found


def _number_before(data: np.ndarray, end: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The number whose digits end before each place, and the place before its first digit."""
    found, at, on = np.zeros(len(end), np.int64), end - 1, np.ones(len(end), bool)
    for n in range(most):
        digit = data[at] - np.uint8(48)
        on &= digit <= 9
        if not on.any():
            break
        found = np.where(on, found + digit * np.int64(10**n), found)
        at = at - on
    return found, at


def _cut(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts at the given places; their bytes one after the other, and where each begins."""
    ends = np.cumsum(size)
    begins = ends - size
    joined = data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - begins, size)]
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(joined)), joined, begins


def _are_plain(rows: Sequence[str]) -> list[bool]:
    return pc.match_substring_regex(pa.array(rows, pa.string()), _PLAIN_ROWS).to_pylist()


def _plain_cells(rows: str, strings: pa.Array, styles: dict[int, str], base_1904: bool) -> pa.Table | None:
    """(row, col, ctype, raw) of the cells of whole rows by array operations over all of
    them, or None where something stands there that needs the XML parser."""
    found = _cells_at_tags([rows.encode()], strings, [len(strings)], styles, base_1904) if _are_plain([rows])[0] else None
    return None if found is None else found.drop_columns("sheet_no")


def _cells_at_tags(
    sheets: Sequence[bytes], strings: pa.Array, n_strings: Sequence[int], styles: dict[int, str], base_1904: bool,
) -> pa.Table | None:
    """(sheet_no, row, col, ctype, raw) of the cells of some sheets' rows, which the regular
    expression has found to be plain: each value, its type and its style stand at a known
    distance from a tag.  ``strings`` has the shared strings of all sheets, one after the other."""
    data = np.frombuffer(b"".join(sheets), np.uint8)
    tags = np.flatnonzero(data == ord("<"))
    kinds = data[tags + 1]
    value = np.flatnonzero(kinds == ord("v"))
    cell, start = tags[value - 1], tags[value] + 3
    size = tags[value + 1] - start
    row_tags = tags[kinds == ord("r")]
    row = _number_at(data, row_tags + 8, 7)[np.searchsorted(row_tags, cell) - 1]
    col, on = np.zeros(len(cell), np.int64), np.ones(len(cell), bool)
    for n in range(3):
        letter = data[cell + 6 + n]
        on &= letter >= ord("A")
        col = np.where(on, col * 26 + letter - 64, col)

    kind = data[start - 6]  # of t="s"><v>; without it the last digit of a style or an address
    shared, truth = kind == ord("s"), kind == ord("b")
    style, before = _number_before(data, start - 5 - 6 * (kind > ord("9")), 7)
    style[data[before] != ord('"')] = 0  # digits of an address
    number = ~(shared | truth)

    text, joined, begins = _cut(data, start, size)
    owner = np.repeat(np.arange(len(size)), size)
    is_real, has_power = np.zeros(len(size), bool), np.zeros(len(size), bool)
    is_real[owner[joined == ord(".")]] = True
    has_power[owner[(joined | 32) == ord("e")]] = True
    no_digits = is_real & ~has_power & (data[start + size - 2] == ord("."))  # at most one digit after the point
    first, last = data[start], data[start + size - 1]
    is_real |= has_power
    if ((shared | truth) & (is_real | (first == ord("-")) | (size > 9))).any():
        return None
    sheet_no = np.searchsorted(np.cumsum([len(rows) for rows in sheets]), cell, side="right")
    at, counts = _number_at(data, start[shared], 9), np.asarray(n_strings, np.int64)
    if (at >= counts[sheet_no[shared]]).any():
        return None
    at += (np.cumsum(counts) - counts)[sheet_no[shared]]
    dated = np.isin(style, list(styles)) & number if styles else np.zeros(len(size), bool)

    # Python spells a number the same way: up to 14 digits, no zeros to drop, no power of ten
    zero = first == ord("0")
    small = zero & (size > 4)
    small[small] = _starts(data, start[small], b"0.000")
    begun = ~zero | ((size > 1) & (data[start + np.minimum(size - 1, 1)] == ord(".")))
    real_same = ~has_power & (size < 16) & ((last != ord("0")) | no_digits) & begun & ~small
    same = np.where(is_real, real_same, ~zero | (size == 1)) & (first != ord("-"))
    odd = number & (dated | ~same)

    # each text is spelled once for each of its kinds: an integer, a real number, a date of a style
    texts = text.filter(pa.array(odd)).dictionary_encode()
    forms = np.where(dated, style + 2, is_real)[odd]
    pairs = texts.indices.to_numpy() * np.int64(10**7) + forms
    order = np.argsort(pairs, kind="stable")
    is_new = np.concatenate([[True], np.diff(pairs[order]) > 0])[: len(pairs)]
    which = np.empty(len(pairs), np.int64)
    which[order] = np.cumsum(is_new) - 1
    digits, spelled = texts.dictionary.to_pylist(), []
    for pair in pairs[order][is_new].tolist():
        found, form = digits[pair // 10**7], pair % 10**7
        spelled.append(
            _dated(found, base_1904, styles[form - 2] == "duration") if form >= 2
            else ("float", str(float(found))) if form else ("int", str(int(found))))
    code = np.where(shared, 2, np.where(truth, 3, is_real))
    code[odd] = np.array([_CTYPES.index(v[0]) for v in spelled], np.int64)[which]
    raw = pa.concat_arrays([text, strings, pa.array(["False", "True"]), pa.array([v[1] for v in spelled], pa.string())])
    place = np.arange(len(size))
    place[shared] = len(size) + at
    place[truth] = len(size) + len(strings) + (_number_at(data, start[truth], 9) > 0)
    place[odd] = len(size) + len(strings) + 2 + which
    return pa.table({
        "sheet_no": pa.array(sheet_no), "row": pa.array(row.astype(np.int32)), "col": pa.array(col.astype(np.int32)),
        "ctype": pa.array(_CTYPES).take(pa.array(code)), "raw": raw.take(pa.array(place))})


def _starts(data: np.ndarray, at: np.ndarray, text: bytes) -> np.ndarray:
    return np.logical_and.reduce([data[at + n] == byte for n, byte in enumerate(text)])


def _plain_rows(part: _Inflated, strings: list[str], styles: dict[int, str], base_1904: bool) -> Iterator[pa.Table]:
    """Cells of a sheet, some whole rows at a time.  Ends early, by ``ValueError``, where
    the XML parser is needed; the cells so far are the first that it finds."""
    held, texts, shell = b"", pa.array(strings, pa.string()), None
    while True:
        piece = part.read()
        held += piece
        if shell is None:
            begun = _ROWS_AT.search(held)
            if begun is None and piece and len(held) < _CHUNK_BYTES:
                continue
            shell = held[: begun.end()] if begun else b""
            if not _is_shell(shell + b"</sheetData></worksheet>"):
                raise ValueError("no plain sheet")
            held = held[begun.end() :]
        if piece and len(held) < _CHUNK_BYTES:
            continue
        ready = held.rfind(b"</sheetData>") if not piece else held.rfind(b"</row>") + len(b"</row>")
        if ready < len(b"</row>"):
            raise ValueError("no end of a row")
        found = _plain_cells(held[:ready].decode(), texts, styles, base_1904)
        if found is None:
            raise ValueError("no plain rows")
        yield found
        held = held[ready:]
        if not piece:
            if not _is_shell(shell + held):
                raise ValueError("no plain end")
            return


def _plain_body(data: bytes, method: int, checksum: int) -> bytes | None:
    """Bytes of the rows of a sheet of bounded size, or None where it is larger, broken, or
    something stands outside its rows that only the XML parser knows."""
    part, held, size = _Inflated(data, method, checksum), [], 0
    try:
        while piece := part.read():
            held.append(piece)
            size += len(piece)
            if size > _CHUNK_BYTES:
                return None
    except (zipfile.BadZipFile, zlib.error):
        return None
    xml = b"".join(held)
    begun, end = _ROWS_AT.search(xml), xml.rfind(b"</sheetData>")
    if begun is None or end < begun.end():
        return None
    shell, shell_end = xml[: begun.end()], xml[end:]
    if len(shell) + len(shell_end) > _SHELL_BYTES or not _is_small_shell(shell + b"</sheetData></worksheet>") or not _is_small_shell(shell + shell_end):
        return None
    return xml[begun.end() : end]


def plain_sheets(parts: pa.RecordBatch) -> Iterator[tuple[list[int], pa.Table]]:
    """Cells of the sheets that are plain from their beginning to their end, several sheets
    at a time: their places among ``parts``, and a table (sheet_no, row, col, ctype, raw) in
    which ``sheet_no`` counts these places.  Sheets that are in no list need :func:`part_tables`.
    """
    def found(group: list[tuple[int, bytes, str]], settings: tuple) -> Iterator[tuple[list[int], pa.Table]]:
        plain = [item for item, good in zip(group, _are_plain([text for _, _, text in group])) if good]
        places = [n for n, _, _ in plain]
        own = parts.column("strings").take(pa.array(places, pa.int64()))
        counts = pc.fill_null(pc.list_value_length(own), 0).to_pylist()
        cells = _cells_at_tags([rows for _, rows, _ in plain], own.flatten(), counts, dict(settings[0]), settings[1]) if plain else None
        if cells is not None:
            yield places, cells

    groups: dict[tuple, list[tuple[int, bytes, str]]] = {}
    size = 0
    for n, (settings, data) in enumerate(zip(parts.column("settings").to_pylist(), parts.column("data"))):
        known = json.loads(settings)
        rows = _plain_body(data.as_py(), known["method"], known["checksum"])
        try:
            text = None if rows is None else rows.decode()
        except UnicodeDecodeError:
            continue
        if text is None:
            continue
        key = tuple((int(k), v) for k, v in known["styles"].items()), known["base_1904"]
        groups.setdefault(key, []).append((n, rows, text))
        size += len(rows)
        if size >= _CHUNK_BYTES:
            for key, group in groups.items():
                yield from found(group, key)
            groups, size = {}, 0
    for key, group in groups.items():
        yield from found(group, key)


def part_tables(sheet: str, strings: list[str], settings: str, data: bytes) -> Iterator[pa.Table]:
    """The rows of :func:`parse_part` as tables.  Sheets of plain cells are read by array
    operations; at the first thing that these do not know the XML parser takes over."""
    known = json.loads(settings)
    styles = {int(k): v for k, v in known["styles"].items()}
    done = 0
    try:
        for found in _plain_rows(_Inflated(data, known["method"], known["checksum"]), strings, styles, known["base_1904"]):
            done += found.num_rows
            yield found.add_column(0, "kind", pa.repeat("cell", found.num_rows)).add_column(1, "sheet", pa.repeat(sheet, found.num_rows)).append_column(
                "name", pa.nulls(found.num_rows, pa.string()))
    except (ValueError, zipfile.BadZipFile, zlib.error, pa.ArrowException):
        rest = itertools.islice(parse_part(sheet, strings, settings, data), done, None)
        while rows := list(itertools.islice(rest, _BATCH_ROWS)):
            kinds = zip(_PART_TYPES, zip(*rows))
            yield pa.table({name: pa.array(values, dtype) for (name, dtype), values in kinds})


_PART_TYPES = [(n, pa.int32() if n in ("row", "col") else pa.string()) for n in ("kind", "sheet", "row", "col", "ctype", "raw", "name")]


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    pending: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*pending), schema)], schema=schema)

    for row in rows:
        pending.append(row)
        if len(pending) >= most:
            yield batch()
            pending.clear()
    if pending:
        yield batch()


def _row_table(found: pa.Table, item: pa.StructType) -> pa.Table:
    """Cells that follow each other in one row, from left to right, as one ``row``; other
    kinds stay as they are."""
    at = pc.equal(found["kind"], "cell")
    cells, rest = found.filter(at).combine_chunks(), found.filter(pc.invert(at))
    out = [rest.append_column("cells", pa.nulls(rest.num_rows, item))]
    if cells.num_rows:
        out.append(_packed_rows(cells, None, cells["workbook_id"], cells["sheet"], item))
    return pa.concat_tables(out)


def _packed_rows(cells: pa.Table, sheet_no: np.ndarray | None, books: pa.Array, sheets: pa.Array, item: pa.StructType) -> pa.Table:
    """Cells as rows; ``sheet_no`` tells of which sheet a cell is, else each has its own names."""
    if not cells.num_rows:
        sheet_no = np.empty(0, np.int64)
    numbers, columns = cells["row"].to_numpy(), cells["col"].to_numpy()
    new = (numbers[1:] != numbers[:-1]) | (columns[1:] <= columns[:-1])
    new = new if sheet_no is None else new | (sheet_no[1:] != sheet_no[:-1])
    begins = np.flatnonzero(np.concatenate([[True], new])[: cells.num_rows])
    offsets = pa.array(np.append(begins, cells.num_rows), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, cells[name].combine_chunks(), type=field.type) for name, field in zip(("col", "ctype", "raw"), item)]
    none, own = len(begins), pa.array(begins if sheet_no is None else sheet_no[begins])
    since = pa.nulls(none, pa.int32()) if sheet_no is None else _since(numbers[begins], sheet_no[begins])
    return pa.table({
        "kind": pa.repeat("row", none), "workbook_id": books.take(own), "sheet": sheets.take(own), "row": cells["row"].take(pa.array(begins)),
        "col": pa.nulls(none, pa.int32()), "ctype": pa.nulls(none, pa.string()), "raw": pa.nulls(none, pa.string()),
        "name": pa.nulls(none, pa.string()), "cells": pa.StructArray.from_arrays([*lists, since], fields=list(item))})


def _since(rows: np.ndarray, sheet_no: np.ndarray) -> pa.Array:
    """Of whole sheets: the first of the rows that lead to each without a gap; null where the
    rows of a sheet do not ascend."""
    same, step = sheet_no[1:] == sheet_no[:-1], rows[1:] - rows[:-1]
    starts = np.concatenate([[True], ~same | (step != 1)])[: len(rows)]
    first = rows[starts][np.cumsum(starts) - 1]
    return pa.array(first.astype(np.int32), mask=np.isin(sheet_no, sheet_no[1:][same & (step < 1)]))


def _flat_cells(cells: pa.Table, sheet_no: np.ndarray, books: pa.Array, sheets: pa.Array) -> pa.Table:
    own, size = pa.array(sheet_no), cells.num_rows
    return pa.table({
        "kind": pa.repeat("cell", size), "workbook_id": books.take(own), "sheet": sheets.take(own), "row": cells["row"], "col": cells["col"],
        "ctype": cells["ctype"], "raw": cells["raw"], "name": pa.nulls(size, pa.string())})


def scan_workbooks(files: DataFrame, sheets: Iterable[str] | None = None, by_row: bool = False) -> DataFrame:
    """(source_path, content) -> rows of kind ``sheet``, ``name``, ``cell``,
    ``sheet_error`` or ``error``.

    With ``by_row`` the cells of a row leave as one row of kind ``row`` with all of them
    in ``cells``, from left to right; a row that does not come so leaves as several.

    ``workbook_id`` is the path.  Rows leave in Arrow batches of bounded size, so
    memory holds the files or sheets of one input batch and one output batch.  A file that
    is no workbook gives one ``error`` row and nothing else.  Sheets that no rule asks for
    are listed but neither passed on nor read.
    """
    wanted = None if sheets is None else set(sheets)
    plain, full, packed = (to_arrow_schema(StructType.fromDDL(x)) for x in (SCAN_SCHEMA, _PART_SCHEMA, ROW_SCHEMA))
    item = packed.field("cells").type

    def list_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for found in batches:
                for path, content in zip(found.column("source_path"), found.column("content")):
                    book = path.as_py()
                    try:
                        for kind, *rest in open_workbook(content.as_py(), wanted):
                            yield kind, book, *rest
                    except Exception as exc:  # isolate the file: it becomes its own error row
                        yield "error", book, None, None, None, None, f"{type(exc).__name__}: {exc}", *_NOTHING[5:]

        return _batches(rows(), full, _BATCH_PARTS)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in batches:
            part = pc.equal(found.column("kind"), "part")
            listed = pa.Table.from_batches([found.filter(pc.invert(part)).select(plain.names)])
            yield from (_row_table(listed, item) if by_row else listed).to_batches()

            pending, size = [], 0
            parts, done = found.filter(part), set()
            for places, cells in plain_sheets(parts):
                own = parts.take(pa.array(places, pa.int64()))
                names = cells["sheet_no"].to_numpy(), own.column("workbook_id"), own.column("sheet")
                yield from (_packed_rows(cells, *names, item) if by_row else _flat_cells(cells, *names)).to_batches()
                done.update(places)
            for n in range(parts.num_rows):
                if n in done:
                    continue
                row = parts.slice(n, 1).to_pylist()[0]
                for cells in part_tables(row["sheet"], row["strings"], row["settings"], row["data"]):
                    own = cells.append_column("workbook_id", pa.repeat(pa.scalar(row["workbook_id"], pa.string()), cells.num_rows)).select(plain.names)
                    pending.append(_row_table(own, item) if by_row else own)
                    size += cells.num_rows
                    if size >= _BATCH_ROWS:
                        yield from pa.concat_tables(pending).combine_chunks().to_batches()
                        pending, size = [], 0
            if pending:
                yield from pa.concat_tables(pending).combine_chunks().to_batches()

    spark = files.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    listed = files.select("source_path", "content").mapInArrow(list_parts, _PART_SCHEMA)
    # a given number is not coalesced: the parts are small as they lie in the zip, and parsing them is CPU work
    return listed.repartition(tasks, "workbook_id", "sheet").mapInArrow(parse, ROW_SCHEMA if by_row else SCAN_SCHEMA)


def rows(scan: DataFrame) -> DataFrame:
    """Rows of a scan by row, with their cells."""
    return scan.where(F.col("kind") == "row").select("workbook_id", "sheet", "row", "cells")


def cells(scan: DataFrame) -> DataFrame:
    if "cells" in scan.columns:
        cell = F.arrays_zip(*[F.col(f"cells.{parts}").alias(name) for parts, name in (("cols", "col"), ("ctypes", "ctype"), ("raws", "raw"))])
        return rows(scan).select("workbook_id", "sheet", "row", F.inline(cell))
    return scan.where(F.col("kind") == "cell").select(*CELL_COLUMNS)


def sheet_errors(scan: DataFrame) -> DataFrame:
    return scan.where(F.col("kind") == "sheet_error").select("workbook_id", "sheet", F.col("raw").alias("error"))


def defined_names(scan: DataFrame) -> DataFrame:
    return scan.where(F.col("kind") == "name").select("workbook_id", "name", "sheet", "row", "col")


def workbooks(scan: DataFrame) -> DataFrame:
    """One row per file: path, file name, sheet list, fingerprint, error."""
    listed = scan.where(F.col("kind").isin("sheet", "error")).groupBy("workbook_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "sheet", F.struct("row", "sheet")))).alias("_sheets"),
        F.max(F.when(F.col("kind") == "error", F.col("raw"))).alias("error"),
    )
    names = F.transform("_sheets", lambda s: s["sheet"])
    return listed.select(
        "workbook_id",
        F.col("workbook_id").alias("source_path"),
        base_name(F.col("workbook_id")).alias("source_filename"),
        names.alias("sheets"),
        sheet_list_hash(names).alias("workbook_hash"),
        "error",
    )
