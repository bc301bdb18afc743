"""cellstar: a Spark-native star-schema engine for electrolyzer measurement data.

Instrument readings (machine 1 workbooks, machine 2 ``.dat`` files) are
ingested, cleaned and typed, turned into a star schema with stable dense keys,
checked, pseudonymised and published; four analysis questions run on top.
Everything is expressed with the DataFrame / SQL API so that Catalyst plans
the work and it scales with the cluster.
"""

from cellstar.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
