"""Session settings and the shared folder for stage tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Skewed partitions are split by AQE at run time; forcing it lets the split happen
# even where a later aggregate then needs one more exchange. The JVM never compiles
# methods over 8000 bytes: past that, expressions are generated in several methods.
# Arrow batches are bounded by bytes too: 10,000 long texts would be held by the JVM and by Python.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are written for."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "creelgrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Shuffle files of a write are of no use once the table is there.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dirs: dict[str, str] = {}
_stages: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local master without that setting may use a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="creelgrid-", dir="/tmp")
    return _local_dirs[app]


def stage_table(df: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of it.

    Cuts the lineage (a lost executor re-reads the table, not the whole plan)
    and gives later joins a plain scan with column pruning and pushed filters.
    The shuffle files of the write go with its end, not with the driver's next garbage
    collection, so the disk holds those of one step at a time.
    """
    spark = df.sparkSession
    path = f"{base or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    _stages.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stages(spark: SparkSession, *tables: DataFrame) -> int:
    """Remove the folders of these stage tables, or of all the application wrote, and count them.

    Frames that read them are unusable afterwards: for the end of a run.
    """
    own = _stages.get(spark.sparkContext.applicationId, [])
    files = [f for t in tables for f in t.inputFiles()]
    gone = [p for p in own if not tables or any(p.rsplit("/", 1)[1] in f for f in files)]
    for path in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        own.remove(path)
    return len(gone)
