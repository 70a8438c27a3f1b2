"""Small workbooks and archives out of rows, as inputs for the readers."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable
from datetime import datetime
from xml.sax.saxutils import escape

_SHEET_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_REL_NS = "http://schemas.openxmlformats.org/package/2006/relationships"
_DATE_STYLE = 1


def _letters(i: int) -> str:
    name = ""
    i += 1
    while i:
        i, rest = divmod(i - 1, 26)
        name = chr(65 + rest) + name
    return name


def _cell_xml(value, reference: str, shared: dict[str, int] | None) -> str:
    if value is None:
        return ""
    if isinstance(value, datetime):
        serial = (value - datetime(1899, 12, 30)).total_seconds() / 86400
        return f'<c r="{reference}" s="{_DATE_STYLE}"><v>{serial!r}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value}</v></c>'
    if shared is None:
        return f'<c r="{reference}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
    return f'<c r="{reference}" t="s"><v>{shared.setdefault(value, len(shared))}</v></c>'


def workbook_bytes(sheets: Iterable[tuple[str, list[list]]], inline: bool = False) -> bytes:
    """An .xlsx file: text, numbers, dates (style 1) and gaps."""
    shared: dict[str, int] | None = None if inline else {}
    parts, entries, links = {}, [], []
    for n, (name, rows) in enumerate(sheets, 1):
        body = []
        for r, row in enumerate(rows, 1):
            cells = "".join(_cell_xml(v, f"{_letters(c)}{r}", shared) for c, v in enumerate(row))
            body.append(f'<row r="{r}">{cells}</row>')
        parts[f"xl/worksheets/sheet{n}.xml"] = f'<worksheet xmlns="{_SHEET_NS}"><sheetData>{"".join(body)}</sheetData></worksheet>'
        entries.append(f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>')
        links.append(f'<Relationship Id="rId{n}" Type="{_DOC_NS}/worksheet" Target="worksheets/sheet{n}.xml"/>')
    parts["xl/workbook.xml"] = (
        f'<workbook xmlns="{_SHEET_NS}" xmlns:r="{_DOC_NS}"><sheets>{"".join(entries)}</sheets></workbook>'
    )
    parts["xl/_rels/workbook.xml.rels"] = f'<Relationships xmlns="{_REL_NS}">{"".join(links)}</Relationships>'
    parts["xl/styles.xml"] = (
        f'<styleSheet xmlns="{_SHEET_NS}"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>'
    )
    if shared is not None:
        items = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in shared)
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{_SHEET_NS}">{items}</sst>'
    return archive_bytes({n: '<?xml version="1.0" encoding="UTF-8"?>' + x for n, x in parts.items()})


def archive_bytes(members: dict[str, str | bytes]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name, content)
    return buffer.getvalue()
