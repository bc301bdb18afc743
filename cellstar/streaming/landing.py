"""Incremental ingest of landed ``.dat`` files with Structured Streaming.

The reference re-runs its whole chain by hand and re-reads every file. Here
newly landed files are picked up by a file stream (``binaryFile``), parsed
with the same stateless expressions as the batch ingest, and appended to the
bronze table by the Parquet file sink. The sink's commit log plus the
checkpoint (below the shared checkpoint folder) give exactly-once output per
file: a restarted or re-run job skips files it has already committed, and a
lost executor only repeats an uncommitted micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from cellstar.functions.clean import measurement_name, path_stem
from cellstar.operators.keys import stage
from cellstar.operators.lookup import broadcast_if_small
from cellstar.plans.star import build_star, update_star
from cellstar.plans.warehouse import land
from cellstar.sinks.publish import DEFAULT_PARTITIONS, publish, read_published
from cellstar.sinks.versions import manifest
from cellstar.sources.dat import parse_dat
from cellstar.sources.files import ROUTE_GLOBS, route


# The fixed schema of the binaryFile source (a stream must state it).
BINARY_FILE_SCHEMA = StructType([
    StructField("path", StringType(), False), StructField("modificationTime", TimestampType(), False),
    StructField("length", LongType(), False), StructField("content", BinaryType(), True)])


def stem_from_path(path_col: str = "path"):
    """``file_stem=<stem>`` folder when present, else the file name's stem."""
    folder = F.regexp_extract(F.col(path_col), r"file_stem=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(path_stem(path_col))


def ingest_stream(spark: SparkSession, landing_root: str, glob: str = ROUTE_GLOBS["machine_2"],
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.load(landing_root).withColumn("file_stem", stem_from_path())
    return parse_dat(files, name_col="file_stem")


def run_available_now(spark: SparkSession, landing_root: str, bronze_path: str, checkpoint: str,
                      glob: str = ROUTE_GLOBS["machine_2"]) -> None:
    """Process every file not yet committed, then stop (batch-like scheduling)."""
    rows = ingest_stream(spark, landing_root, glob)
    q = (rows.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint)
         .partitionBy("status")
         .trigger(availableNow=True)
         .start(bronze_path))
    q.awaitTermination()


# --- landing to star, exactly once ---------------------------------------------------------

#: The bronze tables grow by folders; a measurement's rows lie together in them.
BRONZE_PARTITIONS = {"bronze_dat": ["measurement"], "bronze_sheet": ["measurement"]}


def _digested(files: DataFrame, machine: str) -> DataFrame:
    return files.select("path", "content", F.sha2("content", 256).alias("digest"), F.lit(machine).alias("machine"))


def _unseen(files: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """Files whose content was never loaded, one of each content."""
    one = files.groupBy("digest").agg(F.min("path").alias("path"))
    fresh = files.join(one, ["digest", "path"], "left_semi").dropDuplicates(["digest"])
    return fresh if ledger is None else fresh.join(ledger.select("digest"), "digest", "left_anti")


def load_batch(dat_files: DataFrame, sheet_files: DataFrame, root: str, batch: int = 0,
               metadata: DataFrame | None = None) -> int | None:
    """Bring landed files (path, content) into the published star; the new
    version, or None when every file's content was loaded before.

    One commit holds the star, the parsed rows (bronze) and the ledger of file
    digests, so either all of a batch is there or nothing: a batch that is run
    again after a failure anywhere finds its files in the ledger, or no trace of
    them. A file uploaded under a second name has a known digest and counts once.
    A measurement that several batches deliver is rebuilt from all its parsed rows;
    where a batch brings new measurements only, the facts grow by one folder.
    """
    spark = dat_files.sparkSession
    base = manifest(spark, root)
    have = read_published(spark, root, base["version"])
    ledger = have.get("ledger")
    fresh = stage(_unseen(_digested(dat_files, "machine_2").unionByName(_digested(sheet_files, "machine_1")), ledger),
                  "landed_files")
    if fresh.isEmpty():
        return None
    landed = land(fresh.filter("machine = 'machine_2'").withColumn("file_stem", stem_from_path()),
                  fresh.filter("machine = 'machine_1'"))
    bad = landed.quarantine().select("source", F.lit(True).alias("bad"))
    # one row a file, all of the batch's files
    noted = fresh.select("digest", F.col("path").alias("source"), "machine").join(bad, "source", "left").select(
        "digest", "source", "machine", F.when(F.col("bad"), F.lit("quarantined")).otherwise(F.lit("loaded")).alias("status"),
        F.lit(batch).cast("long").alias("batch"))
    own = measurement_name("table_name").alias("measurement")
    new = {"bronze_sheet": stage(landed.sheet_rows().select("*", own), "batch_sheet"),
           "bronze_dat": stage(landed.dat_rows().select("*", own), "batch_dat")}
    touched = stage(new["bronze_sheet"].select("measurement").unionByName(new["bronze_dat"].select("measurement"))
                    .distinct(), "touched")
    rows = {}
    for name, df in new.items():    # with the rows that earlier batches brought of the same measurements: their folders only
        earlier = have[name].join(broadcast_if_small(touched), "measurement", "left_semi") if name in have else df.limit(0)
        rows[name] = earlier.select(df.columns).unionByName(df)
    existing = {k: v for k, v in have.items() if k.startswith(("dim_", "fact_"))}
    if touched.isEmpty():
        tables, append = {}, {}
    else:
        star = update_star(existing, rows["bronze_sheet"], rows["bronze_dat"], metadata) if existing else \
            build_star(rows["bronze_sheet"], rows["bronze_dat"], metadata)
        tables = star.tables()
        grown = star.fresh_facts if star.fresh_facts and not star.replaced else {}
        tables = {k: v for k, v in tables.items() if k not in grown}
        append = {**grown, **new}
    append["ledger"] = noted
    publish(tables, root, append=append, base=base["version"], carry=True, note={"batch": batch},
            partition_by={**DEFAULT_PARTITIONS, **BRONZE_PARTITIONS})
    return base["version"] + 1


def stream_to_star(spark: SparkSession, landing_root: str, published_root: str, checkpoint: str,
                   glob: str = ROUTE_GLOBS["machine_2"], max_files_per_trigger: int | None = None,
                   metadata: DataFrame | None = None) -> None:
    """Load every landed ``.dat`` file and workbook not yet loaded into the
    published star, batch by batch, then stop. A file's route is its folder's;
    files that match ``glob`` outside machine_1 are machine 2's."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    below = F.substring_index(F.col("path"), landing_root.rstrip("/").split("://")[-1], -1)

    def one(files: DataFrame, batch: int) -> None:
        books = route(below) == "machine_1"
        load_batch(files.filter(~books), files.filter(books), published_root, batch, metadata)

    (reader.load(landing_root).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
