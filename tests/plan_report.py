"""Write PLANS.md: the physical operators of the headline queries.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
For each query it lists exchanges (shuffles), joins with their strategy,
aggregates (partial / final), generators, windows and scans with their read
schema and pushed filters, taken from the executed plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = ("Exchange", "Join", "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Generate",
        "Window", "FileScan", "BroadcastExchange", "MapInPandas", "FlatMapGroupsInPandas",
        "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "Union")


def condensed(plan: str) -> list[str]:
    out = []
    for line in plan.split("\n"):
        body = line.lstrip(" :+-*()0123456789")
        op = body.split(" ")[0].split("(")[0]
        if not any(k in op for k in KEEP):
            continue
        body = re.sub(r"#\d+L?", "", body)
        body = re.sub(r"\[plan_id=\d+\]", "", body)
        if body.startswith("FileScan"):
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", body)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", body)
            part = re.search(r"PartitionFilters: (\[[^\]]*\])", body)
            fmt = body.split()[1]
            body = (f"FileScan {fmt} ReadSchema={schema.group(1) if schema else '?'}"
                    + (f" PushedFilters={pushed.group(1)}" if pushed and pushed.group(1) != "[]" else "")
                    + (f" PartitionFilters={part.group(1)}" if part and part.group(1) != "[]" else ""))
        out.append(body[:200])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    import __spark_entry__ as E
    from cellstar.session import get_session
    spark = get_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    q = E.queries()
    names = ["q1_material_by_density", "q2_machine_compare", "q3_degradation", "q4_h2_output", "star_join",
             "fact_dat", "dat_ingest", "sheet_ingest", "parquet_scan", "check_foreign_keys", "document_upsert",
             "pseudonymize", "file_sequence"]
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `python tests/plan_report.py {sf_dir}` on local[8], AQE on (initial plans; AQE may")
    print("turn a shuffle join into a broadcast at run time when the real size is small). Operators only:")
    print("exchanges, joins, aggregates, generators, windows, Python steps, scans (with pruned read schema).\n")
    frames = [(name, q[name](spark, sf_dir)) for name in names]
    frames += build_plans(spark, sf_dir)
    for name, df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```")
        print("\n".join(condensed(plan)))
        print("```\n")


def build_plans(spark, sf_dir):
    """Plans inside the star build: the fact's key lookups and a dimension's members."""
    from cellstar.operators import dims as D
    from cellstar.operators.lookup import Lookup, resolve_keys
    from cellstar.plans.catalog import star_for
    from cellstar.plans.star import _TS_MICROS_OF_DAY, _time_lookup
    st = star_for(spark, sf_dir)
    lookups = resolve_keys(st.silver_dat.selectExpr("*", f"{_TS_MICROS_OF_DAY} AS time_us"), [
        Lookup(st.dim_machine, "machine_id", ["machine_name"]),
        Lookup(st.dim_measurement, "measurement_id", ["measurement_name"]),
        Lookup(st.dim_date, "date_id", ["date"]),
        _time_lookup(st.dim_time),
        Lookup(st.dim_electrode_material, "electrode_material_id", ["electrode_material"]),
        Lookup(st.dim_operator, "operator_id", ["operator_name"], mode="optional"),
        Lookup(st.dim_dat_metadata, "dat_metadata_id", D.DAT_METADATA_KEY, mode="null_safe")])
    ranged = lookups.repartitionByRange("measurement_name", "timestamp", "record_id") \
        .sortWithinPartitions("measurement_name", "timestamp", "record_id")
    members = D.time_members(st.silver_excel).unionByName(D.time_members(st.silver_dat))
    return [("fact_dat build: key lookups + range partition for dense keys", ranged),
            ("dim_time build: members (partial aggregate per batch)", members)]


if __name__ == "__main__":
    main()
