"""Session helpers: a local session for tests and the folder for intermediate files."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cpus: int = 8, memory: str = "8g", app: str = "clickcast", checkpoint_dir: str | None = None
) -> SparkSession:
    """A ``local[cpus]`` session for tests and the bench. On a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # A long session makes the code of thousands of plans; when the JVM's default space for compiled code is full, it
        # stops compiling. What is kept of finished queries would fill the heap.
        .config("spark.driver.extraJavaOptions", "-XX:ReservedCodeCacheSize=1g")
        .config("spark.sql.ui.retainedExecutions", "20")
        .config("spark.ui.retainedJobs", "50")
        .config("spark.ui.retainedStages", "50")
        .config("spark.ui.retainedTasks", "2000")
    )
    if checkpoint_dir is not None:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that setting is absent and the session is local does a temporary folder stand in for it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    local = re.match(r"local(\[|$)", spark.sparkContext.master) is not None
    if named:
        return named
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    path = tempfile.mkdtemp(prefix="clickcast-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Give the session a checkpoint folder, for ``checkpoint()`` and for models that cut their own lineage."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = shared_dir(spark)
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)


def session_beside(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session on the same context with the settings of ``spark``, but for these. Its tables may not be joined with others."""
    beside = spark.newSession()
    for name, value in {**spark.conf.getAll, **settings}.items():
        if beside.conf.isModifiable(name):
            beside.conf.set(name, value)
    return beside


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` with the checkpoint folder in place."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read again: a cut in the lineage whose size Spark knows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whichever store the path names."""
    store, place = _hadoop(spark, path)
    return store.exists(place)


def empty_folder(spark: SparkSession, path: str) -> None:
    """Remove what an earlier run has written to ``path``."""
    store, place = _hadoop(spark, path)
    store.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None where there is none."""
    store, place = _hadoop(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written whole beside its place and put there by one rename, over what is there."""
    folder, name = os.path.split(path)
    store, draft = _hadoop(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    stream = store.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    # Only this interface renames over a file in one step.
    fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration()).rename(draft, _hadoop(spark, path)[1], options)


def file_facts(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, bytes and time of change of the files at ``path``, without Spark's own marks."""
    store, place = _hadoop(spark, path)
    if not store.exists(place):
        return []
    found = ((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in store.listStatus(place))
    return sorted((n, size, at) for n, size, at in found if not n.startswith(("_", ".")))


# The file that names the current one of several folders beside it.
POINTER = "current"


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder below ``path`` that is current, if there is one."""
    return read_text(spark, f"{path}/{POINTER}")


def point_to(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the current folder below ``path``."""
    write_text(spark, f"{path}/{POINTER}", version)
