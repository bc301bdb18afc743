"""One commit for many tables (B5-B8): immutable folders and one pointer.

    <root>/_versions/<mark>/<table>/   files of one publication, never changed
    <root>/_commits/000000000007.json  version 7: each table's folders

A publication first writes all its folders; nobody reads them yet. Then it
claims the next version number by renaming one small file to a name that must not
exist, which the file system decides (an object store needs a rename or put that
fails on an existing name). So a version has all of its tables or doesn't exist,
a failure anywhere leaves the version before, and of two publishers that began
from one version the second is told so. A table can name folders of earlier
versions: unchanged tables are carried along, and appended rows are one more
folder. Readers take a version and keep it, whatever is published meanwhile;
``expire`` removes what only old versions name.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cellstar.plans.concurrent import run_concurrently

DIGITS = 12


class Conflict(RuntimeError):
    """Another publication took the version number first."""


@dataclass
class Draft:
    """Written folders that wait for their commit."""

    root: str
    base: int
    mark: str
    tables: dict[str, list[str]]
    schemas: dict[str, dict]
    note: dict = field(default_factory=dict)


def _store(spark: SparkSession, root: str):
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    return jvm, conf, path, path(root).getFileSystem(conf)


def list_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, ascending (one small file each)."""
    _, _, path, fs = _store(spark, root)
    folder = path(f"{root.rstrip('/')}/_commits")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:DIGITS]) for n in names if n.endswith(".json") and n[:DIGITS].isdigit())


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The commit of a version (the newest when None); version 0 is empty."""
    if version is None:
        version = (list_versions(spark, root) or [0])[-1]
    if version == 0:
        return {"version": 0, "tables": {}, "schemas": {}, "note": {}}
    name = f"{root.rstrip('/')}/_commits/{version:0{DIGITS}d}.json"
    return json.loads(spark.read.text(name, wholetext=True).first()[0])


def read_version(spark: SparkSession, root: str, version: int | None = None,
                 fmt: str = "parquet") -> dict[str, DataFrame]:
    """The tables of one version, each with the schema it was committed with."""
    root = root.rstrip("/")
    m = manifest(spark, root, version)
    out = {}
    for name, folders in m["tables"].items():
        parts = [spark.read.format(fmt).schema(StructType.fromJson(m["schemas"][name])).load(f"{root}/{f}") for f in folders]
        df = parts[0]
        for part in parts[1:]:
            df = df.unionByName(part)
        out[name] = df
    return out


def prepare(spark: SparkSession, root: str, tables: dict[str, DataFrame], append: dict[str, DataFrame] | None = None,
            partition_by: dict[str, list[str]] | None = None, base: int | None = None, carry: bool = False,
            fmt: str = "parquet", note: dict | None = None) -> Draft:
    """Write the folders of a new version. ``tables`` are whole; ``append`` adds
    rows to the base version's tables; with ``carry`` its other tables are kept.
    ``base`` is the version that the tables were made from (the newest when None)."""
    root = root.rstrip("/")
    old = manifest(spark, root, base)
    mark = uuid.uuid4().hex[:12]
    named = {k: list(v) for k, v in old["tables"].items()} if carry else {}
    schemas = {k: v for k, v in old["schemas"].items() if carry or k in (append or {})}
    draft = Draft(root, old["version"], mark, named, schemas, note or {})

    def write(name: str, df: DataFrame) -> None:
        by = (partition_by or {}).get(name)
        # rows are gathered by partition folder, a large folder over several files
        w = (df.hint("rebalance", *by) if by else df).write.mode("errorifexists").format(fmt)
        (w.partitionBy(*by) if by else w).save(f"{root}/_versions/{mark}/{name}")

    frames = {**tables, **(append or {})}
    try:
        run_concurrently({n: (lambda n=n, d=d: write(n, d)) for n, d in frames.items()})
    except Exception:   # all writers have ended by now
        discard(spark, draft)
        raise
    for name, df in frames.items():
        more = name in (append or {})
        named[name] = [*(old["tables"].get(name, []) if more else []), f"_versions/{mark}/{name}"]
        if not more or name not in schemas:
            schemas[name] = df.schema.jsonValue()
    return draft


def commit(spark: SparkSession, draft: Draft) -> int:
    """Make the draft the next version after its base; ``Conflict`` (and its
    folders go) when there is one already."""
    jvm, conf, path, fs = _store(spark, draft.root)
    version = draft.base + 1
    folder = f"{draft.root}/_commits"
    fs.mkdirs(path(folder))
    waiting, target = path(f"{folder}/.{draft.mark}"), path(f"{folder}/{version:0{DIGITS}d}.json")
    out = fs.create(waiting, True)
    out.write(bytearray(json.dumps({"version": version, "mark": draft.mark, "tables": draft.tables,
                                    "schemas": draft.schemas, "note": draft.note}).encode()))
    out.close()
    taken = False
    try:
        if fs.exists(target):
            taken = True
        else:
            none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(draft.root).toUri(), conf).rename(
                waiting, target, none)
    except Exception:
        if not fs.exists(waiting) or not fs.exists(target):
            raise
        taken = True
    if taken:
        fs.delete(waiting, False)
        discard(spark, draft)
        raise Conflict(f"version {version} of {draft.root} was published meanwhile")
    return version


def discard(spark: SparkSession, draft: Draft) -> None:
    """Remove the folders of a draft that isn't committed."""
    _, _, path, fs = _store(spark, draft.root)
    fs.delete(path(f"{draft.root}/_versions/{draft.mark}"), True)


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` versions, and the folders that only
    those name. Not while a publication is being written: its folders have no
    version yet and are left alone only if they carry a mark no version has had."""
    root = root.rstrip("/")
    _, _, path, fs = _store(spark, root)
    numbers = list_versions(spark, root)
    gone, kept = numbers[:-keep], numbers[-keep:]
    used = {f for v in kept for folders in manifest(spark, root, v)["tables"].values() for f in folders}
    for v in gone:
        for folders in manifest(spark, root, v)["tables"].values():
            for f in folders:
                if f not in used:
                    fs.delete(path(f"{root}/{f}"), True)
    for v in gone:
        fs.delete(path(f"{root}/_commits/{v:0{DIGITS}d}.json"), False)
    return gone
