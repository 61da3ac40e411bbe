"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(app_name: str = "stationtide", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings this engine relies on (all are Spark defaults or AQE switches)."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the
    whole session runs in one process (tests); it goes when that process ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="stationtide-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the shared folder; never reused, so a rerun cannot read stale files."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike a local one."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


#: Folders that were staged within the current :func:`tidied`.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def tidied(*sessions: SparkSession):
    """Work that leaves nothing on the disks but what it stores: shuffle files go when the action that wrote them has ended, and
    what was staged goes at the end. No table that rests on staged rows may be read afterwards."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = [s.conf.get(name, None) for s in sessions]
    for s in sessions:
        s.conf.set(name, "true")
    token = _STAGED.set([])
    try:
        yield
    finally:
        paths = _STAGED.get()
        _STAGED.reset(token)
        # Back to front: two names may be one session.
        for s, value in reversed(list(zip(sessions, before))):
            s.conf.unset(name) if value is None else s.conf.set(name, value)
        context = sessions[0].sparkContext
        for folder in paths:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read from there: what a checkpoint does, but compressed, and read by
    column. Within :func:`tidied` they are gone at its end."""
    path = scratch_path(df.sparkSession, label)
    if _STAGED.get() is not None:
        _STAGED.get().append(path)
    # A column without a type has nothing but nulls, and no file format for them.
    untyped = [f.name for f in df.schema.fields if f.dataType.typeName() == "void"]
    df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c in untyped}) if untyped else df
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def smaller_partitions(spark: SparkSession, factor: int):
    """Adaptive execution takes a ``factor`` of its partition size meanwhile: for stages that turn a row they have read into several."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    n_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(name, str(max(n_bytes // factor, 1 << 20)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Fixed rows of a few short columns: this many take some tens of megabytes at most.
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a count; above the bound Spark joins by shuffle and splits skew."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
