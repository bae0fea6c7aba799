"""What every job needs on a cluster: a folder all machines see, checkpoints in it, and this package
on the executors."""

import gc
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import labelloom


def ship_package() -> None:
    """Functions of this package travel by value inside the tasks, so executors and their Python
    workers need no copy of it on their disks."""
    cloudpickle.register_pickle_by_value(labelloom)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only where none is set and all of
    Spark runs in this one process (tests, a laptop), a folder of this machine is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    base = tempfile.mkdtemp(prefix="labelloom-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def work_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_folder(spark)}/labelloom-{uuid.uuid4().hex}"


def cut(df: DataFrame, files: int | None = None) -> DataFrame:
    """The rows, computed once and kept in the shared folder: what follows neither repeats the work
    nor depends on any executor staying alive. Spark removes the files with the frame when
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.

    Each partition becomes a file. ``files`` merges those of a small result that comes out of a wide
    shuffle: to that number, which should follow the data, and never below two for each core."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    if files is not None:
        df = df.coalesce(max(files, 2 * context.defaultParallelism))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffles (and, where it may, the checkpoints) of frames that nothing refers to any
    more. It goes by the collection of objects on the driver, which has no reason to run while only disks fill up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
