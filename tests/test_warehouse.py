"""The warehouse entry point on real files in a folder (as a user lands them)."""

import tempfile

from cellstar.plans.warehouse import Landed, land_dat, landing_files
from cellstar.sources.fixtures import DAT_TABLE_COLUMNS


def test_landed_dat_files_by_name(spark):
    root = tempfile.mkdtemp(prefix="landing-")
    cols = "\t".join(DAT_TABLE_COLUMNS)
    for name, hour in [("2001", "01"), ("2003", "02")]:
        text = (f"Operator:\tOperator_1\nElectrodes: material_A\nMeasurement Data:\n{cols}\n"
                f"2024-01-01 {hour}:00:00.000000" + "\t1.5" * 14 + "\n")
        with open(f"{root}/{name}.dat", "w", encoding="latin-1") as fh:
            fh.write(text)
    with open(f"{root}/notes.txt", "w") as fh:
        fh.write("not a data file")
    rows = Landed(None, land_dat(landing_files(spark, root, glob="*.dat"))).dat_rows().collect()
    assert sorted(r.table_name for r in rows) == ["2001_table", "2003_table"]
    assert {r.voltage_v for r in rows} == {"1.5"} and {r.operator for r in rows} == {"Operator_1"}


def test_timestamp_forms_and_bad_cells(spark):
    """ISO forms with 0-9 digits load; one bad cell keeps its whole file out."""
    from cellstar.plans.warehouse import land_dat as land
    cols = "\t".join(DAT_TABLE_COLUMNS)
    text = {"good": ["2024-01-01 00:00:00", "2024-01-01T00:00:01.5", "2024-01-01 00:00:02.123456789"],
            "badtime": ["2024-01-01 00:00:00", "yesterday"], "badcell": ["2024-01-01 00:00:00"]}
    rows = [(f"/x/{name}.dat", bytearray(("Operator:\tO\nThikness: 0\nMeasurement Data:\n" + cols + "\n" + "".join(
        t + "\t" + "\t".join(["1.5"] * 13 + ["oops" if name == "badcell" else "NaN"]) + "\n" for t in times)).encode(
        "latin-1"))) for name, times in text.items()]
    landed = Landed(None, land(spark.createDataFrame(rows, "path string, content binary")))
    got = sorted((r.table_name, str(r.timestamp)) for r in landed.dat_rows().collect())
    assert got == [("good_table", "2024-01-01 00:00:00"), ("good_table", "2024-01-01 00:00:01.500000"),
                   ("good_table", "2024-01-01 00:00:02.123456")]
    from cellstar.sources.dat import broken_files
    assert {r.source: r.error for r in broken_files(landed.dat).collect()} == {
        "/x/badtime.dat": "unreadable timestamp: yesterday",
        "/x/badcell.dat": "unreadable o2_level_percent: oops"}


def test_workbook_date_numbers_and_missing_texts(spark):
    from cellstar.plans.warehouse import SHEET_COLUMNS, SHEET_NUMERIC, land_sheets
    from cellstar.sources.dat import broken_files
    from cellstar.sources.sheet import workbook_bytes
    line = lambda time, volts="1.25": ["1", "1", "0", "rest", "0.0", volts, "100.0", "0.5", "0.6", time, "yes"]
    good = workbook_bytes(SHEET_COLUMNS, [line("45292.00001157"), line("45292.5", "NaN")], SHEET_NUMERIC)
    iso = workbook_bytes(SHEET_COLUMNS, [line("2024-01-01T00:00:01")], SHEET_NUMERIC - {"timestamp"})
    bad = workbook_bytes(SHEET_COLUMNS, [line("45292.5"), line("soon")], SHEET_NUMERIC - {"timestamp"})
    import io
    import zipfile
    cut = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(good)) as z, zipfile.ZipFile(cut, "w") as w:
        for name in z.namelist():
            raw = z.read(name)
            w.writestr(name, raw[:-60] if name.endswith("sheet1.xml") else raw)
    old = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(good)) as z, zipfile.ZipFile(old, "w") as w:
        for name in z.namelist():
            w.writestr(name, z.read(name).replace(b"<sheets>", b'<workbookPr date1904="1"/><sheets>'))
    rows = [(f"/x/{n}.xlsx", bytearray(b)) for n, b in
            [("good", good), ("iso", iso), ("bad", bad), ("cut", cut.getvalue()), ("old", old.getvalue())]]
    landed = Landed(land_sheets(spark.createDataFrame(rows, "path string, content binary")), None)
    got = sorted((r.table_name, str(r.timestamp), r.voltage_V) for r in landed.sheet_rows().collect())
    assert [g for g in got if g[0] != "old_table"] == [
        ("good_table", "2024-01-01 00:00:00.999648", "1.25"), ("good_table", "2024-01-01 12:00:00", None),
        ("iso_table", "2024-01-01 00:00:01", "1.25")]
    assert ("old_table", "2028-01-02 12:00:00", None) in got
    errors = {r.source: r.error for r in broken_files(landed.sheet).collect()}
    assert errors["/x/bad.xlsx"] == "unreadable timestamp: soon" and "ParseError" in errors["/x/cut.xlsx"]
    assert set(errors) == {"/x/bad.xlsx", "/x/cut.xlsx"}
