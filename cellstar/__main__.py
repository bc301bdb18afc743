"""Command line: landed files -> star schema -> published tables.

    python -m cellstar --landing <root> --out <root> [--master local[8]]

``<root>`` holds workbooks below ``machine_1`` and ``metadata`` and ``.dat``
files below ``machine_2``, in any letter case (any file system Spark reads).
Prints the row count of every published table. Every file that was not loaded
is a row of the published table ``ingest_report`` (source, status, error);
their number is printed, with at most ``REPORT_LINES`` of them.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cellstar.plans.warehouse import build_warehouse, land
from cellstar.session import configure, get_session
from cellstar.sinks.publish import publish, read_published
from cellstar.sources.files import routed, skipped

REPORT_LINES = 50


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="cellstar")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default=None, help="local master for a stand-alone run")
    args = ap.parse_args(argv)
    # on a cluster (spark-submit) take the provided session; --master only for stand-alone runs
    spark = get_session(master=args.master) if args.master else configure(SparkSession.builder.getOrCreate())
    root = args.landing.rstrip("/")
    out = args.out.rstrip("/")
    landed = land(routed(spark, root, "machine_2"), routed(spark, root, "machine_1"))
    star = build_warehouse(None, None, routed(spark, root, "metadata"), landed=landed)
    left_out = (landed.quarantine().select("source", F.lit("quarantined").alias("status"), "error")
                .unionByName(skipped(spark, root).select("source", F.lit("skipped").alias("status"), "error")))
    publish({**star.tables(), "ingest_report": left_out}, out)   # the report is of the same commit
    tables = read_published(spark, out)
    left_out = tables["ingest_report"]
    shown = left_out.orderBy("status", "source").limit(REPORT_LINES).collect()
    report = {
        "tables": {name: tables[name].count() for name in star.tables()},
        "not_loaded": left_out.count(),
        "quarantined": [{"source": r.source, "error": r.error} for r in shown if r.status == "quarantined"],
        "skipped": [{"source": r.source, "error": r.error} for r in shown if r.status == "skipped"],
    }
    print(json.dumps(report, indent=2))
    return report


if __name__ == "__main__":
    main()
