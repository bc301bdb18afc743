"""Workbook reader: sheets by name, numeric and inline cells, bad workbooks reported."""

import io
import zipfile

from pyspark.sql import Row

from cellstar.sources.sheet import read_sheets, sheet_rows, workbook_bytes


def test_roundtrip_and_missing_columns():
    wb = workbook_bytes(["a", "b", "c"], [["x", "1.5", None], ["y", None, "z"]], {"b"})
    assert sheet_rows(wb) == [["a", "b", "c"], ["x", "1.5"], ["y", None, "z"]]


def test_shared_strings_are_resolved():
    wb = io.BytesIO(workbook_bytes(["a"], [["x"]], set()))
    z = zipfile.ZipFile(wb)
    parts = {n: z.read(n) for n in z.namelist()}
    parts["xl/sharedStrings.xml"] = (b'<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                                     b'<si><t>hello</t></si></sst>')
    parts["xl/worksheets/sheet1.xml"] = (
        b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
        b'<row r="1"><c r="B1" t="s"><v>0</v></c></row></sheetData></worksheet>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as w:
        for n, b in parts.items():
            w.writestr(n, b)
    assert sheet_rows(out.getvalue()) == [[None, "hello"]]


def test_read_sheets_reports_bad_workbooks(spark):
    good = workbook_bytes(["record_ID", "step_name"], [["1", "rest"]], {"record_ID"})
    df = spark.createDataFrame([Row(path="/w/good.xlsx", content=good), Row(path="/w/bad.xlsx", content=b"nope"),
                                Row(path="/w/other.xlsx", content=workbook_bytes(["x"], [], set(), sheet="S2"))],
                               "path string, content binary")
    out = {r.source: r for r in read_sheets(df, ["record_ID", "step_name", "missing"]).collect()}
    assert out["/w/good.xlsx"].record_ID == "1" and out["/w/good.xlsx"].missing is None
    assert out["/w/bad.xlsx"].error.startswith("BadZipFile")
    assert "no sheet named 'Sheet1'" in out["/w/other.xlsx"].error
