"""Workbook sheets as rows.

No Spark source reads workbooks, so this is the one Python step: a
``mapInArrow`` over rows of ``(path, content)`` -- the shape ``binaryFile``
gives -- that opens each workbook (``.xlsx`` with the standard library's
``zipfile`` and ``ElementTree``, ``.xls`` with ``sources/xls``; what the content
is decides, not its name), finds the wanted sheet, and yields its rows as text. One
workbook is one input row, so workbooks are spread over tasks like any file.
Types are applied afterwards in Spark (``cast``), never by guessing per file.

A writer for the same minimal workbook layout renders fixture workbooks
(inline strings and numeric cells) inside Spark with ``applyInPandas``, one
workbook per group; the groups are bounded (one measurement-month each).
"""

from __future__ import annotations

import io
import re
import zipfile
from functools import lru_cache
from xml.etree import ElementTree as ET

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, StringType, StructField, StructType

from cellstar.sources import xls

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "p": "http://schemas.openxmlformats.org/package/2006/relationships"}
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")
BATCH_ROWS = 5_000  # rows per Arrow batch handed back to Spark


@lru_cache(maxsize=1024)
def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _sheet_path(z: zipfile.ZipFile, sheet_name: str | None) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheets = wb.findall("m:sheets/m:sheet", NS)
    if not sheets:
        raise ValueError("workbook has no sheets")
    chosen = sheets[0] if sheet_name is None else next(
        (s for s in sheets if s.get("name") == sheet_name), None)
    if chosen is None:
        raise ValueError(f"no sheet named {sheet_name!r}")
    rid = chosen.get(f"{{{NS['r']}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels.findall("p:Relationship", NS) if r.get("Id") == rid)
    return target.lstrip("/") if target.startswith("/") else "xl/" + target


def iter_sheet_rows(content: bytes, sheet_name: str | None = "Sheet1"):
    """Yield the rows of one sheet as text cells (shared, inline and plain
    strings, numbers as written, booleans as TRUE/FALSE). The sheet XML is
    parsed as a stream and each row is released once read, so memory stays
    bounded by one row, not by the sheet."""
    if content[:8] == xls.MAGIC:
        yield from xls.iter_sheet_rows(content, sheet_name)
        return
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            sst = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t")) for si in sst.findall("m:si", NS)]
        row_tag, c_tag, t_tag, v_tag = (f"{{{NS['m']}}}{x}" for x in ("row", "c", "t", "v"))
        with z.open(_sheet_path(z, sheet_name)) as fh:
            for _, el in ET.iterparse(fh, events=("end",)):
                if el.tag != row_tag:
                    continue
                cells: dict[int, str | None] = {}
                for c in el.iter(c_tag):
                    t = c.get("t")
                    if t == "inlineStr":
                        val = "".join([x.text or "" for x in c.iter(t_tag)])
                    else:
                        v = c.find(v_tag)
                        val = None if v is None else v.text
                        if t == "s" and val is not None:
                            val = shared[int(val)]
                        elif t == "b" and val is not None:
                            val = "TRUE" if val == "1" else "FALSE"
                    cells[_col_index(_CELL_REF.match(c.get("r")).group(1))] = val
                el.clear()
                width = max(cells) + 1 if cells else 0
                yield [cells.get(i) for i in range(width)]


def uses_1904(content: bytes) -> bool:
    """Whether the workbook counts its date numbers from 1904."""
    if content[:8] == xls.MAGIC:
        return xls.uses_1904(content)
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        pr = ET.fromstring(z.read("xl/workbook.xml")).find("m:workbookPr", NS)
    return pr is not None and pr.get("date1904", "0").lower() in ("1", "true")


def _opened(content: bytes, sheet_name: str | None):
    """``uses_1904`` and the rows of one sheet."""
    if content[:8] == xls.MAGIC:
        return xls.opened(content, sheet_name)
    return uses_1904(content), iter_sheet_rows(content, sheet_name)


def sheet_rows(content: bytes, sheet_name: str | None = "Sheet1") -> list[list[str | None]]:
    """All rows of one sheet (see ``iter_sheet_rows``)."""
    return list(iter_sheet_rows(content, sheet_name))


def read_sheets(files: DataFrame, columns: list[str], sheet_name: str | None = "Sheet1",
                fill_text: str | None = None) -> DataFrame:
    """Rows of ``sheet_name`` (first sheet when None) of every workbook.

    ``columns`` are picked by header name (first row); missing ones are NULL.
    Output: ``source``, ``row_no``, ``error``, ``date1904`` and ``columns`` as
    text. A workbook that cannot be read, or breaks off, yields one row with its
    ``error``; ``whole_files`` then keeps out the rows before it, too.
    ``fill_text`` (C16) replaces empty cells, as the reference's ``fillna('')``.
    """
    schema = StructType([StructField("source", StringType()), StructField("row_no", IntegerType()),
                         StructField("error", StringType()), StructField("date1904", BooleanType())]
                        + [StructField(c, StringType()) for c in columns])

    fields = pa.schema([("source", pa.string()), ("row_no", pa.int32()), ("error", pa.string()), ("date1904", pa.bool_()),
                        *((c, pa.string()) for c in columns)])

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), fields)], schema=fields)

    def parse(batches):
        out: list[tuple] = []
        for batch in batches:
            for path, book in zip(batch.column(0), batch.column(1)):   # one workbook at a time leaves Arrow
                path = path.as_py()
                try:
                    base, rows = _opened(book.as_py(), sheet_name)
                    header = next(rows, [])
                    pos = {name: i for i, name in enumerate(header) if name is not None}
                    at = [pos.get(c) for c in columns]
                    for n, r in enumerate(rows, start=1):
                        cells = [r[i] if i is not None and i < len(r) else None for i in at]
                        if fill_text is not None:
                            cells = [fill_text if v is None else v for v in cells]
                        out.append((path, n, None, base, *cells))
                        if len(out) >= BATCH_ROWS:       # bounded batches, even for one huge sheet
                            yield sent(out)
                            out = []
                except Exception as e:  # A15: report the workbook, keep going (rows already sent stay)
                    out.append((path, None, f"{type(e).__name__}: {e}", None, *[None] * len(columns)))
        if out:
            yield sent(out)

    return files.select("path", "content").mapInArrow(parse, schema)


# --- writing (fixtures) -------------------------------------------------------------

_CT = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
       '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
       '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
       '<Default Extension="xml" ContentType="application/xml"/>'
       '<Override PartName="/xl/workbook.xml" '
       'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
       '<Override PartName="/xl/worksheets/sheet1.xml" '
       'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
         '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
         '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
         'officeDocument" Target="xl/workbook.xml"/></Relationships>')
_WB_RELS = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
            'worksheet" Target="worksheets/sheet1.xml"/></Relationships>')


def workbook_bytes(header: list[str], rows: list[list], numeric: set[str], sheet: str = "Sheet1") -> bytes:
    from xml.sax.saxutils import escape
    lines = []
    for r, values in enumerate([header] + rows, start=1):
        cells = []
        for i, v in enumerate(values):
            if v is None:
                continue
            ref = f"{_col_letters(i)}{r}"
            if r > 1 and header[i] in numeric:
                cells.append(f'<c r="{ref}"><v>{escape(str(v))}</v></c>')
            else:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>')
        lines.append(f'<row r="{r}">{"".join(cells)}</row>')
    sheet_xml = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                 f'<worksheet xmlns="{NS["m"]}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
    wb = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
          f'<workbook xmlns="{NS["m"]}" xmlns:r="{NS["r"]}"><sheets>'
          f'<sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _CT)
        z.writestr("_rels/.rels", _RELS)
        z.writestr("xl/workbook.xml", wb)
        z.writestr("xl/_rels/workbook.xml.rels", _WB_RELS)
        z.writestr("xl/worksheets/sheet1.xml", sheet_xml)
    return buf.getvalue()


def render_workbooks(rows: DataFrame, file_col: str, columns: list[str], numeric: set[str],
                     order_by: list[str], folder: str = "raw-data/machine_1",
                     sheet: str = "Sheet1", extension: str = ".xlsx") -> DataFrame:
    """One workbook per ``file_col`` value, in the format that ``extension``
    names: ``(path, content)`` rows.

    Values are rendered to text by Spark first (``cast(.. as string)``), so
    the workbook holds exactly Spark's text of each value.
    """
    text = rows.select(F.col(file_col).alias("_file"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
                       *[F.col(c).cast("string").alias(c) for c in columns])
    out_schema = StructType([StructField("path", StringType()), StructField("content", BinaryType())])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([f"_o{i}" for i in range(len(order_by))])
        body = [[None if pd.isna(v) else v for v in r] for r in pdf[columns].itertuples(index=False)]
        name = f"{folder}/{pdf['_file'].iloc[0]}{extension}"
        write = xls.workbook_bytes if extension == ".xls" else workbook_bytes
        return pd.DataFrame({"path": [name], "content": [write(columns, body, numeric, sheet)]})

    return text.groupBy("_file").applyInPandas(one, out_schema)
