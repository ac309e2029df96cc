"""Session settings and durable intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "pilotlamp", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators rely on; cluster settings are left alone."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read: ``spark.checkpoint.dir`` of the session.

    Only a local master may go without the setting; it then uses a temporary folder that ends with the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="pilotlamp-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_MADE: list[str] = []


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new path below the shared folder, remembered until ``drop_tables``."""
    _MADE.append(f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}")
    return _MADE[-1]


def drop_tables(spark: SparkSession) -> int:
    """Delete all intermediate tables made so far in this process; call it when the results that read them are stored."""
    made, _MADE[:] = _MADE[:], []
    conf = spark._jsc.hadoopConfiguration()
    for path in made:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(made)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors and fixes values that a recomputation could change.
    Parquet keeps column pruning and gives the optimiser real sizes.
    """
    spark = df.sparkSession
    path = new_folder(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
