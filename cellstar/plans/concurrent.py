"""Submit independent Spark jobs together.

Building the seven dimensions (or the two facts) are independent jobs; the
driver submits them from a few threads so the cluster schedules their tasks
side by side instead of one small job after the other.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def run_concurrently(jobs: dict[str, Callable[[], object]], max_workers: int = 8) -> dict[str, object]:
    if len(jobs) <= 1:
        return {k: f() for k, f in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(jobs))) as pool:
        futures = {k: pool.submit(f) for k, f in jobs.items()}
        return {k: fut.result() for k, fut in futures.items()}
