"""The command line builds and publishes the star schema from a landing folder."""

import os
import tempfile

from cellstar.__main__ import main
from cellstar.plans.warehouse import METADATA_COLUMNS, SHEET_COLUMNS, SHEET_NUMERIC
from cellstar.sources.fixtures import DAT_TABLE_COLUMNS
from cellstar.sources.sheet import workbook_bytes


def test_cli_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="landing-")
    for d in ("machine_1", "machine_2", "metadata"):
        os.makedirs(os.path.join(root, d))
    cols = "\t".join(DAT_TABLE_COLUMNS)
    with open(os.path.join(root, "machine_2", "2001.dat"), "w", encoding="latin-1") as fh:
        fh.write("Operator:\tOperator_1\nElectrodes: material_A\nElectrodes Area [cm²]: 5.0\n"
                 f"Measurement Data:\n{cols}\n" + "".join(
                     f"2024-01-01 00:00:0{i}.000000" + "\t1.5" * 14 + "\n" for i in range(3)))
    with open(os.path.join(root, "machine_2", "2003.dat"), "w", encoding="latin-1") as fh:
        fh.write("Operator:\tOperator_1\nno marker here\n")                      # quarantined
    rows = [[str(i + 1), "1", "0", "rest", str(float(i)), "1.25", "100.0", "0.5", "0.6",
             f"2024-01-02 00:00:0{i}", "yes"] for i in range(2)]
    with open(os.path.join(root, "machine_1", "1002.xlsx"), "wb") as fh:
        fh.write(workbook_bytes(SHEET_COLUMNS, rows, SHEET_NUMERIC - {"timestamp"}))
    # another letter case loads; what cannot load is reported, whatever its kind
    os.rename(os.path.join(root, "machine_2", "2001.dat"), os.path.join(root, "machine_2", "2001.DAT"))
    for name in ("machine_1/1004.xls", "machine_2/notes.txt", "stray.dat"):
        with open(os.path.join(root, name), "w") as fh:
            fh.write("none of these is a workbook")
    meta = [["1002_meta", "Operator_2", "medium", "machine_1", "machine_1", "material_B", "1002"]]
    with open(os.path.join(root, "metadata", "metadata.xlsx"), "wb") as fh:
        fh.write(workbook_bytes(METADATA_COLUMNS, meta, set(), sheet="metadata"))
    out = tempfile.mkdtemp(prefix="gold-") + "/gold"
    report = main(["--landing", root, "--out", out])
    t = report["tables"]
    assert (t["fact_dat_measurements"], t["fact_excel_measurements"]) == (3, 2)
    assert (t["dim_machine"], t["dim_measurement"], t["dim_electrode_material"]) == (2, 2, 2)
    name = lambda rows: sorted(q["source"].rsplit("/", 1)[-1] for q in rows)
    assert name(report["quarantined"]) == ["1004.xls", "2003.dat"]
    assert name(report["skipped"]) == ["notes.txt", "stray.dat"]
    assert report["not_loaded"] == 4
