"""SparkSession construction and lineage helpers.

On a cluster the session is created by the platform; ``get_spark`` only fills
in settings that are not already set, so cluster configuration always wins.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on for correctness (UTC wall-clock maths) and
# for plan quality (AQE coalescing, skew-join splitting).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "cartlens",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("CARTLENS_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: send it with the application, once, as ``--py-files`` would."""
    sc = spark.sparkContext
    if any(name.startswith("cartlens-") for name in sc._python_includes):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="cartlens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = Path(folder) / f"cartlens-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and intermediate tables, from
    ``spark.checkpoint.dir``. Only a local master may leave it unset: a
    private folder is registered then; executors of a cluster could not see one.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="cartlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def clear_checkpoints(spark: SparkSession) -> None:
    """Remove what this application's checkpoints left in the shared folder; call it when
    no checkpointed frame is needed any more (``spark.cleaner.referenceTracking.cleanCheckpoints``
    lets Spark do so frame by frame)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        path = sc._jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the checkpoint folder now (a job runs here). In the shared folder of a
    cluster the copy survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Like :func:`cut_lineage`, as Parquet: compressed columns, of which a reader takes those it needs. Its size, unlike a
    checkpoint's, is the size that it has; ``options`` are the writer's."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/cartlens-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table of :func:`stored` that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if not folder.rsplit("/", 1)[1].startswith("cartlens-"):
            raise ValueError(f"not a stored table: {folder}")
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that are gone: it does so once the driver has collected their
    objects, which a quiet driver may put off until the disk is full."""
    spark.sparkContext._jvm.System.gc()
