"""Session factory and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Parquet expands to about this many times its size when rows are shuffled
EXPANSION = 4

# Spark settings every job relies on where nothing else is set.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # plans are built once per job and micro-batch; recording the Python line of every column
    # expression takes a quarter of that time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 << 20, floor: int = 8) -> int:
    """Initial shuffle partitions so one partition holds about ``target_bytes``.

    AQE merges partitions that turn out small but adds none except for skewed joins, so the initial
    number has to fit the largest shuffle of the job. ``input_bytes`` are bytes of parquet.
    """
    return max(floor, -(-int(input_bytes) * EXPANSION // target_bytes))


def create_session(
    app_name: str = "ledgerline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session. Connector packages, endpoints and credentials come in through ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(conf or {})
    if shuffle_partitions:
        settings.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    # what spark-submit, a properties file or the caller has set stays
    given = {key for key, _ in session.sparkContext.getConf().getAll()}
    for key, value in DEFAULTS.items():
        if key not in given and key not in settings and session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def size_shuffles(session: SparkSession, input_bytes: int) -> int | None:
    """Set the shuffle partitions of a job by its input, unless the user has set a number."""
    key = "spark.sql.shuffle.partitions"
    if key in dict(session.sparkContext.getConf().getAll()):
        return None
    number = shuffle_partitions_for(input_bytes)
    session.conf.set(key, str(number))
    return number


def stored_bytes(session: SparkSession, path: str) -> int:
    """Bytes of the files below a folder, 0 when it is missing."""
    folder = session.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(session.sparkContext._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength() if files.exists(folder) else 0


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine; on a cluster the executors could
    not see it, so a missing setting is an error there.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="ledgerline-")
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of a path, and the path for it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder."""
    files, found = file_system(spark, path)
    return files.exists(found)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a path made by :func:`scratch_path`."""
    files, folder = file_system(spark, path)
    files.delete(folder, True)
