"""Tables, the shared folder, and cutting lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own_dirs: list[str] = []
_written: list[str] = []


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hexloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder takes its place if everything runs on one
    machine; on a cluster, whose executors would each write to a disk of their own, it
    raises ``RuntimeError``.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
    if not _own_dirs:
        _own_dirs.append(tempfile.mkdtemp(prefix="hexloom-"))
        atexit.register(_remove_own)
    return f"file://{_own_dirs[0]}"


def _remove_own() -> None:
    import shutil

    for path in _own_dirs:
        shutil.rmtree(path, ignore_errors=True)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables of :func:`materialise`, from number ``since`` on.

    Results that read them must have been written or collected before.
    """
    import shutil

    while len(_written) > since:
        path = _written.pop()
        try:
            if path.startswith("file:") or ":" not in path:
                shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)
            else:
                jvm = spark.sparkContext._jvm
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session may be gone; the folder is the cluster's to clean then
            return


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end, by when results that need
    them must be written: ``with scratch(spark): query(spark, dir).write.parquet(out)``."""
    since = len(_written)
    try:
        yield
    finally:
        release(spark, since)


def ship(spark: SparkSession) -> None:
    """Give the workers of a cluster this package, where they don't have it installed."""
    import shutil

    home = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="hexloom-ship-")) / home.name
    atexit.register(shutil.rmtree, base.parent, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(str(base), "zip", home.parent, home.name))


def settle(spark: SparkSession) -> None:
    """Let go of what finished plans hold.

    Spark deletes shuffle files and broadcasts only once the driver's garbage is collected,
    which a driver with memory to spare puts off while the disks fill.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialise(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts lineage at the cost of one columnar write: a lost executor costs a
    re-read, not a re-run of what came before, and the next plan sees real sizes. Tables
    stay until :func:`scratch` or :func:`release` deletes them, or the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/hexloom/{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if not _written:
        atexit.register(release, spark)
    _written.append(path)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
