"""Session helpers: local sessions for tests and the bench, shared folders, checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A period, team or season table is far below this; above it the join is left to the optimizer.
BROADCAST_ROWS = 200_000

# Remembers the fallback folder of a local session.
LOCAL_FOLDER = "panelcast.local.folder"

# Scratch tables of this process that are still there, and names of some in the catalog; ``release`` removes them.
SCRATCH: list[str] = []
NAMED: list[str] = []


def local_session(app: str, cpus: int = 8, memory: str = "8g") -> SparkSession:
    """A session for one machine. On a cluster, use the session that is given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, falls back to a folder of its own,
    which goes when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(LOCAL_FOLDER, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="panelcast-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set(LOCAL_FOLDER, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; ``release`` removes what is written there."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    SCRATCH.append(path)
    return path


def scratch_name(name: str) -> str:
    """A new name for the catalog; ``release`` drops it."""
    NAMED.append(f"{name}_{uuid.uuid4().hex}")
    return NAMED[-1]


def release(spark: SparkSession) -> None:
    """Remove the scratch tables and the kept tables of this session. Call it once their results have been used."""
    spark.catalog.clearCache()
    while NAMED:
        spark.sql(f"DROP TABLE IF EXISTS {NAMED.pop()}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(SCRATCH.pop())
        path.getFileSystem(conf).delete(path, True)


# Removes a query's shuffle files when it has ended, not when the driver happens to collect garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as a table in the shared folder and read it back.

    A lost executor cannot change rows that are already written, and later steps read only the
    columns they need. The shuffle files behind the table are not needed any more and go at once.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Remove a written table that nothing reads any more."""
    files = table.inputFiles()
    spark = table.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in [p for p in SCRATCH if any(f"/{p.rsplit('/', 1)[-1]}/" in f for f in files[:1])]:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
        SCRATCH.remove(folder)


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only after counting that it holds at most ``max_rows`` rows.

    The count stops at ``max_rows + 1`` rows. A larger table is returned as it is, and the
    optimizer joins it by shuffle.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
