"""Queries called from several threads share one build of each artefact."""

from concurrent.futures import ThreadPoolExecutor

import __spark_entry__ as E
from cellstar.plans import catalog

SF = "/root/testdata/sf0.001"


def test_parallel_queries_agree_with_sequential(spark):
    q = E.queries()
    names = ["q2_machine_compare", "dat_ingest", "fact_dat", "rows_per_file", "q4_h2_output", "dat_header_map"]
    catalog.clear_cache()
    with ThreadPoolExecutor(6) as pool:
        parallel = dict(zip(names, pool.map(lambda n: sorted(map(tuple, q[n](spark, SF).collect())), names)))
    for n in names:
        assert sorted(map(tuple, q[n](spark, SF).collect())) == parallel[n], n
    star_keys = [k for k in catalog._CACHE if k[0] == "star"]
    assert len(star_keys) == 1  # built once
