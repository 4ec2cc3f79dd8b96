"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings that matter at scale. Joins and aggregations start from many shuffle
# partitions and are merged at run time to the advisory size; hot join
# partitions are split. No join is hinted: a side is broadcast only when its
# measured size is under Spark's threshold.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # HTML rows are large: bound an Arrow batch by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    # The JVM never compiles a method over 8000 bytes: long projections run
    # faster as split expressions than as one generated method above that size.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "shelfmark",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the defaults above; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with the machine, so that is
    an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="shelfmark-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def make_folder(spark: SparkSession, folder: str) -> None:
    """Make a folder, wherever it is, if it is not there."""
    files, path = _file_system(spark, folder)
    files.mkdirs(path)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none where it does not exist."""
    files, path = _file_system(spark, folder)
    return [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []


def create_new(spark: SparkSession, file: str) -> bool:
    """Make an empty file that is not there yet; false if another was first.

    One step of the file system (HDFS and local disks); a store without an exclusive
    create cannot decide between two callers.
    """
    files, path = _file_system(spark, file)
    files.mkdirs(path.getParent())
    if files.getUri().getScheme() == "file":
        return spark.sparkContext._jvm.java.io.File(path.toUri().getPath()).createNewFile()
    try:
        files.create(path, False).close()
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def move(spark: SparkSession, file: str, target: str) -> None:
    """Rename a file within one file system."""
    files, path = _file_system(spark, file)
    if not files.rename(path, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{file} could not be moved to {target}")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that one of our jobs wrote, wherever it is."""
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for a written table or a stream."""
    return f"{checkpoint_root(spark).rstrip('/')}/shelfmark/{name}-{uuid.uuid4().hex}"
