"""Session helpers: sane defaults for local tests, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tally") -> SparkSession:
    """A session for tests and the bench. On a cluster use the cluster's own session."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # single-machine sessions: smaller AQE target partitions keep all local cores busy on the
    # small shuffles of test data (a cluster keeps its own, larger setting)
    b = b.config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    b = b.config("spark.driver.memory", "16g")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for tables that cut lineage, as the session names it.

    A cluster names it in ``spark.checkpoint.dir``, which is only read here. A ``local[...]``
    session without the setting gets a scratch folder of its own (tests); any other master
    without it is an error, because a folder of one machine is not seen by the others.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tally-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession) -> str:
    """A new path under the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tally-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame) -> str:
    """Write ``df`` as Parquet under the shared folder and return the path."""
    path = scratch_path(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared checkpoint folder and read it back.

    Survives executor loss (files on the shared file system, never a machine-local folder or
    ``localCheckpoint``) and, unlike ``Dataset.checkpoint(eager=True)``, computes the input only
    once; the re-read gets column pruning and filter pushdown. The folder stays until the caller
    removes it (``drop_scratch``) or the cluster clears its checkpoint folder."""
    return df.sparkSession.read.schema(df.schema).parquet(write_scratch(df))


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder made by ``write_scratch`` once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    Python stages call functions of this package, so workers must be able to import it; a
    cluster where it is installed (or passed with ``--py-files``) gets the same code twice,
    which does no harm."""
    sc = spark.sparkContext
    if getattr(sc, "_tally_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tally-src-"), "tally_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._tally_shipped = True
