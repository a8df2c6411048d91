"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Runtime SQL settings every job here relies on. Shuffle width is left to the cluster: give AQE
# a generous initial partition count there and let it coalesce.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when that costs one more exchange behind it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "larkspur", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; ``master`` is only given for local runs, spark-submit sets it otherwise."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting
    falls back to a temporary folder: on a cluster such a folder is lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = context.getCheckpointDir()
        if current:
            return current
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="larkspur-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, below one folder per application."""
    application = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark).rstrip('/')}/larkspur/{application}/{uuid.uuid4().hex}/{name}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    The worker that prepares a stateful stream runs beside the driver and gets no such files; it
    finds the package by its path.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="larkspur-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context = spark.sparkContext
    context.addPyFile(str(archive))
    known = context.environment.get("PYTHONPATH")
    context.environment["PYTHONPATH"] = os.pathsep.join(
        [str(package.parent), *([known] if known else [])]
    )
    _shipped.add(application)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several branches read one expensive intermediate: it cuts lineage, survives the
    loss of executors and gives later stages true sizes and column pruning.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by ``materialise`` once no later plan reads it."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if f"/larkspur/{spark.sparkContext.applicationId}/" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Even out a scan that has fewer splits than the cluster has cores, ahead of heavy work per row.

    A large input keeps its splits and is not shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(2 * cores, key) if scan.rdd.getNumPartitions() < cores else scan


#: Rows that one task sorts or groups, about, in tables of which the session's tasks would get more.
TASK_ROWS = 2_000_000


def more_tasks(df: DataFrame, rows: int) -> int | None:
    """Tasks that ``rows`` rows of ``df`` need, if the session's would hold more than ``TASK_ROWS`` each."""
    tasks = -(-rows // TASK_ROWS)
    return tasks if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` of some ``rows`` rows over more tasks by ``keys`` than the session's, if those would hold more than
    ``TASK_ROWS`` each: so a task's memory does not follow the input. Smaller inputs stay as they are.
    """
    tasks = more_tasks(df, rows)
    return df.repartition(tasks, *keys) if tasks else df
