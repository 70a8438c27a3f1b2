"""Bytes of one file to rows of cells. The only Python that runs per row.

Workbooks, archives and legacy encodings have no Spark reader, so a task decodes
the files it was given. A cell is ``(text, number, timestamp)``; blanks are None.
"""

from __future__ import annotations

import csv
import io
import posixpath
import re
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from itertools import islice
from xml.etree import ElementTree

from ..constants import EXPORT_EXTENSIONS, HEADER_SEARCH_ROWS, MISSING_WORDS

Cell = tuple[str | None, float | None, datetime | None]
BLANK: Cell = (None, None, None)
_MISSING = frozenset(MISSING_WORDS)
_ZIP_MAGIC = b"PK\x03\x04"
_OLD_WORKBOOK_MAGIC = b"\xd0\xcf\x11\xe0"
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


class Unsupported(Exception):
    """The format has no reader here."""


@dataclass
class Sheet:
    name: str
    rows: Iterable[list[Cell]]  # gone through twice


@dataclass
class Decoded:
    kind: str
    sheets: list[Sheet]
    member: str | None = None
    encoding: str | None = None


# What no export writes into text, so bytes of another format are not read as rows.
_CONTROLS = re.compile(r"[\x00-\x08\x0e-\x1b]")


# --- text ---------------------------------------------------------------------
def decode_text(content: bytes, encodings: list[str]) -> tuple[str, str]:
    """The first encoding that reads every byte; a byte order mark decides for UTF-16."""
    if content[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return content.decode("utf-16"), "utf-16"
    if content[:3] == b"\xef\xbb\xbf":
        encodings = ["utf-8-sig", *encodings]
    for encoding in encodings:
        try:
            return content.decode(encoding), encoding
        except UnicodeDecodeError:
            continue
    raise UnicodeDecodeError("any", content[:1], 0, 1, f"none of {encodings} fits")


def text_cell(value: str | None) -> Cell:
    return BLANK if value is None or value.strip() in _MISSING else (value, None, None)


class CsvRows:
    """The rows of a CSV file, read anew each time: a file's cells are many times its bytes, so they are never held together."""

    def __init__(self, content: bytes, encoding: str, longest: int):
        self.content, self.encoding, self.longest = content, encoding, longest

    def __iter__(self) -> Iterator[list[Cell]]:
        csv.field_size_limit(self.longest)
        with io.TextIOWrapper(io.BytesIO(self.content), self.encoding, newline="") as lines:
            for row in csv.reader(lines):
                if row:
                    yield [BLANK if v.strip() in _MISSING else (v, None, None) for v in row]


def csv_sheet(content: bytes, encodings: list[str], name: str) -> tuple[Sheet, str]:
    text, encoding = decode_text(content, encodings)
    if _CONTROLS.search(text):
        raise ValueError("control characters: this is no text")
    return Sheet(name, CsvRows(content, encoding, max(len(text), 131072))), encoding


# --- workbooks ------------------------------------------------------------------
def _builtin_date_format(number: int) -> bool:
    return 14 <= number <= 22 or 27 <= number <= 36 or 45 <= number <= 47 or 50 <= number <= 58


def _date_code(code: str) -> bool:
    bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.', "", code).lower()
    return bool(re.search(r"[dmyhs]", bare)) and "general" not in bare


def _xml(archive: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(archive.read(name)) if name in archive.namelist() else None


def _date_styles(archive: zipfile.ZipFile) -> list[bool]:
    root = _xml(archive, "xl/styles.xml")
    if root is None:
        return []
    codes = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_MAIN}numFmt")}
    formats = root.find(f"{_MAIN}cellXfs")
    ids = [int(x.get("numFmtId", "0")) for x in (formats if formats is not None else [])]
    return [_date_code(codes[i]) if i in codes else _builtin_date_format(i) for i in ids]


def _joined_text(node: ElementTree.Element) -> str:
    """The text runs of a string item, without the phonetic hints."""
    plain = [t.text or "" for t in node.findall(f"{_MAIN}t")]
    runs = [t.text or "" for r in node.findall(f"{_MAIN}r") for t in r.findall(f"{_MAIN}t")]
    return "".join(plain + runs)


def _column(reference: str) -> int:
    n = 0
    for ch in reference:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _number_text(value: float) -> str:
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)


def _moment_cell(moment: datetime) -> Cell:
    return moment.isoformat(), None, moment.replace(tzinfo=timezone.utc)


def _cell(node: ElementTree.Element, shared: list[str], dates: list[bool], epoch: datetime) -> Cell:
    kind = node.get("t", "n")
    if kind == "inlineStr":
        inline = node.find(f"{_MAIN}is")
        return text_cell(_joined_text(inline) if inline is not None else None)
    value = node.find(f"{_MAIN}v")
    raw = value.text if value is not None else None
    if raw is None or kind == "e":
        return BLANK
    if kind == "s":
        return text_cell(shared[int(raw)])
    if kind == "str":
        return text_cell(raw)
    if kind == "b":
        return ("True" if raw == "1" else "False"), None, None
    if kind == "d":
        return _moment_cell(datetime.fromisoformat(raw.replace("Z", "")))
    number = float(raw)
    style = int(node.get("s", "0"))
    if style < len(dates) and dates[style]:
        try:
            return _moment_cell(epoch + timedelta(microseconds=round(number * 86400) * 1000000))
        except OverflowError:
            pass
    return _number_text(number), number, None


def workbook_sheets(content: bytes) -> list[Sheet]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        book = _xml(archive, "xl/workbook.xml")
        links = _xml(archive, "xl/_rels/workbook.xml.rels")
        if book is None or links is None:
            raise zipfile.BadZipFile("no workbook inside")
        targets = {r.get("Id"): r.get("Target") for r in links}
        properties = book.find(f"{_MAIN}workbookPr")
        from_1904 = properties is not None and properties.get("date1904") in ("1", "true")
        epoch = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)
        strings = _xml(archive, "xl/sharedStrings.xml")
        shared = [_joined_text(si) for si in strings.findall(f"{_MAIN}si")] if strings is not None else []
        dates = _date_styles(archive)
        sheets = []
        for entry in book.iter(f"{_MAIN}sheet"):
            target = targets[entry.get(_REL)]
            part = target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
            rows = []
            with archive.open(part) as stream:
                for _, node in ElementTree.iterparse(stream):
                    if node.tag != f"{_MAIN}row":
                        continue
                    row: list[Cell] = []
                    for c in node.findall(f"{_MAIN}c"):
                        at = _column(c.get("r", "")) if c.get("r") else len(row)
                        row.extend([BLANK] * (at - len(row)))
                        row.append(_cell(c, shared, dates, epoch))
                    if any(cell != BLANK for cell in row):
                        rows.append(row)
                    node.clear()
            sheets.append(Sheet(entry.get("name", ""), rows))
        return sheets


# --- files ---------------------------------------------------------------------
def archive_member(content: bytes) -> tuple[str, bytes] | None:
    """The member to read: the first export file named like posts, else the first one."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        names = [n for n in archive.namelist() if n.lower().endswith((".csv", ".xls", ".xlsx"))]
        names.sort(key=lambda n: "post" not in n.lower())
        return (names[0], archive.read(names[0])) if names else None


def decode_file(name: str, content: bytes, encodings: list[str]) -> Decoded:
    """Route by extension and by the leading bytes; a workbook that is none is read as CSV."""
    extension = posixpath.splitext(name.lower())[1]
    if extension == ".zip":
        member = archive_member(content)
        if member is None:
            return Decoded("zip", [])
        inner = decode_file(member[0], member[1], encodings)
        return Decoded(f"zip/{inner.kind}", inner.sheets, member[0], inner.encoding)
    if extension == ".xlsx" and content[:4] == _ZIP_MAGIC:
        return Decoded("xlsx", workbook_sheets(content))
    if content[:4] == _OLD_WORKBOOK_MAGIC or extension == ".xls":
        raise Unsupported("binary .xls workbooks have no reader here; save as .xlsx or .csv")
    sheet, encoding = csv_sheet(content, encodings, "")
    return Decoded("csv" if extension in EXPORT_EXTENSIONS else "other", [sheet], None, encoding)


def _told(rows: Iterable[list[Cell]]) -> tuple[int, list[list[Cell]], list[str | None]]:
    """The number of rows, the first ones, and per column the first text below those searched for a header."""
    n, head, later = 0, [], []
    for n, row in enumerate(rows, 1):
        if n <= HEADER_SEARCH_ROWS:
            head.append(row)
            continue
        later.extend([None] * (len(row) - len(later)))
        for i, cell in enumerate(row):
            if later[i] is None and cell[0] is not None:
                later[i] = cell[0]
    return n, head, later


def chunk_records(
    path: str, mtime: datetime, content: bytes, encodings: list[str], chunk_rows: int
) -> Iterator[dict]:
    """One record per chunk of rows; a file without rows still gives one, with its status."""
    name = posixpath.basename(path)
    base = {
        "path": path, "file_name": name, "mtime": mtime, "n_bytes": len(content), "kind": None,
        "member": None, "encoding": None, "sheets": [], "sheet": None, "sheet_idx": 0, "sheet_rows": 0,
        "first_row": 0, "head": [], "later": [], "rows": [], "status": "ok", "error": None,
    }
    try:
        decoded = decode_file(name, content, encodings)
        told = [_told(sheet.rows) for sheet in decoded.sheets]
    except Unsupported as problem:
        yield {**base, "status": "unsupported", "error": str(problem)}
        return
    except Exception as problem:  # noqa: BLE001 - whatever a damaged file raises, the others go on
        yield {**base, "status": "unreadable", "error": f"{type(problem).__name__}: {problem}"}
        return
    base.update(
        kind=decoded.kind, member=decoded.member, encoding=decoded.encoding, sheets=[s.name for s in decoded.sheets]
    )
    if not any(n for n, _, _ in told):
        yield {**base, "status": "empty"}
        return
    for index, (sheet, (n, head, later)) in enumerate(zip(decoded.sheets, told)):
        common = {**base, "sheet": sheet.name, "sheet_idx": index, "sheet_rows": n, "head": head, "later": later}
        rows = iter(sheet.rows)
        for start in range(0, n, chunk_rows):
            yield {**common, "first_row": start, "rows": list(islice(rows, chunk_rows))}
