"""Small workbook writer: turns rows of the given tables into files to scan."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from xml.sax.saxutils import escape

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006/relationships"
_STYLES = (
    f'<styleSheet xmlns="{_MAIN}"><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd hh:mm"/></numFmts>'
    '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/></cellXfs></styleSheet>'
)


def column_letters(number: int) -> str:
    letters = ""
    while number:
        number, rest = divmod(number - 1, 26)
        letters = chr(65 + rest) + letters
    return letters


def _cell(ref: str, value, strings: dict[str, int]) -> str:
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value!r}</v></c>'
    if isinstance(value, datetime):
        days = (value - datetime(1899, 12, 30)).total_seconds() / 86_400
        return f'<c r="{ref}" s="2"><v>{days!r}</v></c>'
    if isinstance(value, date):
        return f'<c r="{ref}" s="1"><v>{(value - date(1899, 12, 30)).days}</v></c>'
    index = strings.setdefault(value, len(strings))
    return f'<c r="{ref}" t="s"><v>{index}</v></c>'


def make_workbook(sheets: Mapping[str, Sequence[tuple[int, int, object]]], names: Mapping[str, str] | None = None) -> bytes:
    """Sheet name -> filled cells (row, column, value) -> bytes of an .xlsx file."""
    strings: dict[str, int] = {}
    bodies = {}
    for name, cells in sheets.items():
        rows: dict[int, list[str]] = {}
        for row, col, value in sorted(cells, key=lambda c: (c[0], c[1])):
            rows.setdefault(row, []).append(_cell(f"{column_letters(col)}{row}", value, strings))
        bodies[name] = "".join(f'<row r="{row}">{"".join(found)}</row>' for row, found in rows.items())
    return pack_workbook(bodies, list(strings), names)


def pack_workbook(
    bodies: Mapping[str, str], strings: Sequence[str], names: Mapping[str, str] | None = None, level: int | None = None,
) -> bytes:
    """Sheet name -> XML of its rows, and the shared strings -> bytes of an .xlsx file."""
    parts, entries, links = {}, [], []
    for number, (name, body) in enumerate(bodies.items(), start=1):
        parts[f"xl/worksheets/sheet{number}.xml"] = f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>'
        entries.append(f'<sheet name="{escape(name)}" sheetId="{number}" r:id="rId{number}"/>')
        links.append(f'<Relationship Id="rId{number}" Type="{_DOC}/worksheet" Target="worksheets/sheet{number}.xml"/>')
    defined = "".join(f'<definedName name="{escape(n)}">{escape(ref)}</definedName>' for n, ref in (names or {}).items())
    parts["xl/workbook.xml"] = (
        f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOC}"><sheets>{"".join(entries)}</sheets>'
        f"<definedNames>{defined}</definedNames></workbook>"
    )
    parts["xl/_rels/workbook.xml.rels"] = f'<Relationships xmlns="{_PKG}">{"".join(links)}</Relationships>'
    parts["xl/styles.xml"] = _STYLES
    shared = "".join(f'<si><t xml:space="preserve">{escape(text)}</t></si>' for text in strings)
    parts["xl/sharedStrings.xml"] = f'<sst xmlns="{_MAIN}">{shared}</sst>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=level) as book:
        for part, xml in parts.items():
            book.writestr(part, '<?xml version="1.0" encoding="UTF-8"?>' + xml)
    return out.getvalue()
