"""Session helpers: table loading and lineage cuts that survive executor loss."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; set one only where none is named.

    ``spark.checkpoint.dir`` is read from the session.  Only a local master
    without that setting gets a temporary folder: on a cluster a machine-local
    folder would be lost with the machine, so its absence is an error there.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        context.setCheckpointDir(named)
        return
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(os.path.join(tempfile.gettempdir(), "oreweave-checkpoints"))


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint in the shared folder (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions, for operators that must fix it themselves."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once per application.

    Workers import it when they unpickle functions; on a cluster they need not
    have it installed.
    """
    import zipfile

    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="oreweave-")
    target = os.path.join(folder, "oreweave_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(base, f)
                    z.write(path, os.path.join("oreweave", os.path.relpath(path, root)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)
