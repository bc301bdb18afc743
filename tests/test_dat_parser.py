"""Parser edge cases on hand-made .dat bytes."""

from pyspark.sql import Row

from cellstar.sources.dat import parse_dat, parse_files
from cellstar.sources.fixtures import DAT_TABLE_COLUMNS

COLS = "\t".join(DAT_TABLE_COLUMNS)


def files(spark, docs):
    return spark.createDataFrame([Row(path=f"/x/{k}.dat", content=v.encode("latin-1")) for k, v in docs.items()],
                                 "path string, content binary")


def test_header_rules_and_rows(spark):
    text = ("Operator:\tTech A\r\nElectrodes: mat:A\r\nDiaphragm: D1\r\nDiaphragm: D2\r\nno colon here\r\n"
            "Electrodes Area [cm²]: 5.0\r\nH2 Flow: 0.9\r\n"
            "Measurement Data:\r\n" + COLS + "\r\n"
            "2024-01-01 00:00:01.000000\t1.81\t0.5\t0.2\t99.9\tNAN\t2.0\t5\t5\t5\t60\t60\t58\t50\t50\r\n"
            "2024-01-01 00:00:02.000000\tNaN\t\t0.2\t99.9\tNAN\t2.0\t5\t5\t5\t60\t60\t58\t50\t50\r\n\r\n")
    out = parse_dat(files(spark, {"2001_a": text})).orderBy("line_no").collect()
    assert [r.status for r in out] == ["ok", "ok"]
    r0, r1 = out
    assert r0.operator == "Tech A"                 # tab after the colon is stripped
    assert r0.electrodes == "mat:A"                # split at the first colon only
    assert r0.diaphragm == "D2"                    # a repeated key keeps its last value
    assert r0.electrodes_area == "5.0"             # ² decoded from ISO-8859-1
    assert r0.h2_flow == "0.9" and r1.h2_flow == "0.9"   # header key equal to a column wins
    assert r0.voltage_v == "1.81" and r0.o2_purity_percent == "NAN"  # NAN stays text for the cleaning rule
    assert r1.voltage_v is None                    # NaN and empty cells are missing
    assert r0.h2_level_percent == "50"             # the misspelt '[H2 Level [%]' column is found
    assert str(r0.timestamp) == "2024-01-01 00:00:01"


def test_bad_files_are_quarantined_and_others_continue(spark):
    good = "Operator:\tX\nMeasurement Data:\n" + COLS + "\n2024-01-01 00:00:01.000000\t1\t1\t1\t1\t1\t1\t1\t1\t1\t1\t1\t1\t1\t1\n"
    docs = {"ok": good, "nomarker": "Operator:\tX\nfoo: bar\n", "nocols": "Operator:\tX\nMeasurement Data:",
            "empty": "", "wide": good + "2024-01-01 00:00:02.000000" + "\t1" * 15 + "\n"}
    out = {r.file_stem: r for r in parse_dat(files(spark, docs)).collect()}
    assert out["ok"].status == "ok"
    assert out["nomarker"].status == "quarantined" and out["nomarker"].error == "no measurement data marker"
    assert out["nocols"].status == "quarantined" and out["nocols"].error == "no column line"
    assert out["empty"].status == "quarantined"
    assert out["wide"].status == "quarantined" and out["wide"].error == "row with more cells than columns"


def test_repeated_key_last_wins_under_strict_map_policy(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    try:
        r = parse_files(files(spark, {"f": "A: 1\nA: 2\nB: 3\nMeasurement Data:\n" + COLS + "\n"})).first()
        assert r.header == {"A": "2", "B": "3"}
    finally:
        spark.conf.unset("spark.sql.mapKeyDedupPolicy")


def test_header_map_only_before_marker(spark):
    text = "A: 1\nMeasurement Data:\n" + COLS + "\nB: 2\n"
    r = parse_files(files(spark, {"f": text})).first()
    assert r.header == {"A": "1"}


def _lambda_bodies(plan: str):
    i = 0
    while True:
        i = plan.find("lambdafunction(", i)
        if i < 0:
            return
        depth, j = 0, i + len("lambdafunction")
        while j < len(plan):
            depth += {"(": 1, ")": -1}.get(plan[j], 0)
            j += 1
            if depth == 0:
                break
        yield plan[i:j]
        i = j


def test_pushed_filters_never_reparse_inside_a_lambda(spark):
    """A filter on a parse result is pushed down to the scan with the parse
    inlined; no lambda may then contain the file decode (that would re-parse
    the whole file once per line)."""
    from pyspark.sql import functions as F

    from cellstar.sources.dat import dat_rows_from_files, ingest_status
    text = "Operator:\tX\nMeasurement Data:\n" + COLS + "\n" + "2024-01-01 00:00:01.000000\t1\n" * 3
    df = files(spark, {"a": text, "b": "no marker"})
    parsed = parse_dat(df)
    frames = [dat_rows_from_files(parsed),
              ingest_status(parsed).filter(F.col("status") == "quarantined"),
              parse_files(df).filter(F.col("error").isNull())]
    for f in frames:
        plan = f._jdf.queryExecution().optimizedPlan().toString()
        assert not [b for b in _lambda_bodies(plan) if "decode" in b]
    assert dat_rows_from_files(parsed).count() == 3


def test_a_cell_is_looked_up_once_a_line(spark):
    """The checks of a cell name its text; they don't take it from the line again."""
    files = spark.createDataFrame([("a.dat", bytearray(b"x"))], "path string, content binary")
    plan = parse_dat(files)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("element_at(_values") <= 2 * len(DAT_TABLE_COLUMNS)
