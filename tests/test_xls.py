"""Legacy workbooks: packed numbers, strings over continuation records, allocation tables, broken files."""

import random
import struct

import pytest
from pyspark.sql import Row

from cellstar.sources import xls
from cellstar.sources.sheet import read_sheets, sheet_rows, uses_1904, workbook_bytes


def numbers_as_floats(rows):
    return [[r[0], *(None if v is None else float(v) for v in r[1:])] for r in rows]


@pytest.mark.parametrize("rows,letters", [(0, 5), (3, 5), (200, 300), (150, 9000), (65_000, 6)])
def test_round_trip_at_every_size(rows, letters):
    """From the root's mini sectors up to allocation tables beyond the header's."""
    rng = random.Random(rows)
    values = [float(rng.randint(-10**9, 10**9)), 0.25, 12.34, -0.01, 1e300, 2.0**40, -(2.0**29), 0.1]
    body = [["".join(rng.choice("abcé日Ω ") if rng.random() < .1 else "q" for _ in range(rng.randint(1, letters))) + str(i),
             *(repr(rng.choice(values)) for _ in range(10 if rows > 10_000 else 4))] for i in range(rows)]
    header = ["t", *(f"n{k}" for k in range(10 if rows > 10_000 else 4))]
    book = xls.workbook_bytes(header, body, set(header[1:]))
    if rows > 10_000:
        assert len(book) > 109 * 128 * 512      # more allocation sectors than the header lists
    got = list(xls.iter_sheet_rows(book))
    assert got[0] == header and numbers_as_floats(got[1:]) == numbers_as_floats(body)


def test_equals_the_xml_workbook():
    header, numeric = ["record_ID", "step_name", "voltage_V", "current_mA"], {"record_ID", "current_mA"}
    body = [["1", "rest", "NAN", "100"], ["2", "Überspannung", None, "-0.5"], ["3", "日本", "1.25", None]]
    assert sheet_rows(xls.workbook_bytes(header, body, numeric)) == sheet_rows(workbook_bytes(header, body, numeric))
    assert uses_1904(xls.workbook_bytes(header, body, numeric, date1904=True))
    assert not uses_1904(xls.workbook_bytes(header, body, numeric))
    assert sheet_rows(xls.workbook_bytes(header, body, numeric, sheet="Ω"), "Ω")[0] == header


def test_packed_numbers():
    for x in (0.0, 1.0, -1.0, 123456.78, -0.01, 2.0**29 - 1, -(2.0**29), 2.0**29, 0.5, 1e300):
        rk = xls._pack(x)
        assert rk is None or xls._packed(rk) == x
    assert xls._pack(0.1 + 0.2) is None and xls._packed(xls._pack(0.29)) == 0.29
    assert [xls.number_text(x) for x in (3.0, -0.5, 45292.50001157, 1e20)] == ["3", "-0.5", "45292.50001157", "1e+20"]


def cell_records(*records):
    """A workbook with the given cell records in place of its own."""
    book = xls.workbook_stream(xls.workbook_bytes(["a"], [], set()))
    at = book.rfind(struct.pack("<HH", xls.LABELSST, 10))
    return xls._compound(book[:at] + b"".join(xls._record(k, d) for k, d in records) + xls._record(xls.EOF, b""))


def test_other_cells():
    place = lambda r, c: struct.pack("<HHH", r, c, 0)
    formula = lambda r, c, result: (xls.FORMULA, place(r, c) + result + bytes(8))
    book = cell_records(
        (xls.LABEL, place(0, 0) + struct.pack("<HB", 2, 0) + b"hi"),
        (xls.BOOLERR, place(0, 1) + b"\x01\x00"), (xls.BOOLERR, place(0, 2) + b"\x07\x01"),
        (0x0201, place(0, 3)),                                       # an empty cell
        formula(2, 0, struct.pack("<d", 2.5)), formula(2, 1, b"\0" * 6 + b"\xff\xff"),
        (xls.STRING, struct.pack("<HB", 1, 1) + "Ω".encode("utf-16-le")),
        formula(2, 2, b"\x01\0\x01\0\0\0\xff\xff"), formula(2, 3, b"\x02\0\x2a\0\0\0\xff\xff"),
        formula(2, 4, b"\x03\0\0\0\0\0\xff\xff"))
    assert list(xls.iter_sheet_rows(book)) == [["hi", "TRUE", "#DIV/0!"], ["2.5", "Ω", "TRUE", "#N/A"]]


def test_strings_may_change_width_in_a_continuation():
    pieces = [struct.pack("<II", 1, 1) + struct.pack("<HB", 5, 0) + b"ab", b"\x01" + "Ωx".encode("utf-16-le"), b"\x00c"]
    reader = xls._Pieces(pieces)
    reader.take(8)
    assert reader.text() == "abΩxc"
    rich = xls._Pieces([struct.pack("<HBHI", 2, 0x0C, 1, 3) + b"hi" + bytes(4) + bytes(3), struct.pack("<HB", 1, 0) + b"z"])
    assert [rich.text(), rich.text()] == ["hi", "z"]


def test_broken_workbooks_are_reported_whole(spark):
    good = xls.workbook_bytes(["a", "b"], [[f"x{i}", str(i)] for i in range(2000)], {"b"})
    loop = bytearray(good)
    fat = (struct.unpack_from("<I", good, 76)[0] + 1) * 512
    struct.pack_into("<I", loop, fat + 4 * 3, 3)                      # a sector that follows itself
    stream = xls.workbook_stream(good)
    locked = xls._compound(stream[:20] + xls._record(xls.FILEPASS, bytes(6)) + stream[20:])
    older = xls._compound(stream[:4] + struct.pack("<H", 0x0500) + stream[6:])
    files = {"good": good, "cut": good[:len(good) // 2], "loop": bytes(loop), "locked": locked, "older": older,
             "head": good[:600], "other": xls.workbook_bytes(["a"], [], set(), sheet="S2"),
             "short": xls._compound(stream[:-4])}
    df = spark.createDataFrame([Row(path=n, content=c) for n, c in files.items()], "path string, content binary")
    rows = read_sheets(df, ["a", "b"]).collect()
    errors = {r.source: r.error for r in rows if r.error}
    assert set(errors) == set(files) - {"good"}
    assert "encrypted" in errors["locked"] and "version" in errors["older"] and "no sheet named" in errors["other"]
    assert "sector chain" in errors["loop"] and "breaks off" in errors["short"]
    assert sum(r.source == "good" for r in rows) == 2000


def test_rows_out_of_order_and_rows_one_by_one():
    """Rows come as they are read where they ascend, and sorted where they don't."""
    label = lambda r, c, t: (xls.LABEL, struct.pack("<HHH", r, c, 0) + struct.pack("<HB", len(t), 0) + t.encode())
    mixed = cell_records(label(2, 0, "c"), label(0, 0, "a"), label(2, 1, "d"), label(1, 0, "b"))
    assert list(xls.iter_sheet_rows(mixed)) == [["a"], ["b"], ["c", "d"]]
    book = xls.workbook_bytes(["a", "b"], [[f"x{i}", str(i)] for i in range(30_000)], {"b"})
    import tracemalloc
    _, rows = xls.opened(book)
    next(rows)
    tracemalloc.start()
    assert sum(1 for _ in rows) == 30_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 20


def test_large_groups_become_several_workbooks(spark):
    from cellstar.plans.registry_ingest import _bounded_books
    rows = spark.range(100).selectExpr("id", "CASE WHEN id < 90 THEN '1001_202401' ELSE '1002_202401' END AS f")
    cut = _bounded_books(rows, "f", "id", most=30)
    files = {r.f: r["count"] for r in cut.groupBy("f").count().collect()}
    assert files.pop("1002_202401") == 10 and sum(files.values()) == 90 and len(files) == 3
    assert all(f.startswith("1001_202401_") for f in files)
