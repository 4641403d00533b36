"""Session builder and cluster-safe checkpointing."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "threadloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE and its skew handling on; ``conf`` overrides any setting."""
    b = SparkSession.builder.appName(app)
    if master or "SPARK_MASTER" not in os.environ:
        b = b.master(master or "local[*]")
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    spark = b.config(map={**base, **conf}).getOrCreate()
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a single-machine session (``local`` or ``local[...]``) without that setting gets a folder of
    its own; on a cluster a machine-local folder would be lost with its executor, so that is refused.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="threadloom-checkpoint-")
    sc.setCheckpointDir(named)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def whole_groups(df: DataFrame, key: str, *order: str) -> DataFrame:
    """``df`` sorted by ``key`` and ``order`` in partitions that hold each key whole, for operators that stream over it.

    The rows are dealt by a hash of the key's hash: a plain ``repartition(key)`` above a join on that key is optimised
    away, and adaptive execution may then turn the join's shuffle into a local read, which tears the groups apart.
    """
    return df.repartition(F.xxhash64(F.col(key))).sortWithinPartitions(key, *order)


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, counted; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that it need not be installed there.

    The archive lies on the driver only; Spark serves it from there to every executor, new ones included.
    """
    sc = spark.sparkContext
    if getattr(sc, "_threadloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    place = os.path.join(tempfile.mkdtemp(prefix="threadloom-"), "threadloom.zip")
    with zipfile.ZipFile(place, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("threadloom", os.path.relpath(full, root)))
    sc.addPyFile(place)
    sc._threadloom_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
