"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}
_staged: dict[str, list[str]] = {}
_named: dict[str, list[str]] = {}


def local_session(cpus: str = "8", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster job brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tabkit")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local master may go without it: there a temporary folder is as good
    as a shared one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _local_scratch:
        _local_scratch[sc.applicationId] = tempfile.mkdtemp(prefix="tabkit-")
    return _local_scratch[sc.applicationId]


def stage(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it back.

    Cuts lineage, survives executor loss, and fixes columns such as the
    partition number that a second run could compute differently. Being
    Parquet, later readers fetch only the columns they use.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stage_path(df))


def stage_path(df: DataFrame) -> str:
    path = f"{scratch_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _staged.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when their query ends, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "true")
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that stage() wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keep_until_release(spark: SparkSession, path: str, table: str | None = None) -> None:
    """Note a folder written beside stage(), and the name it has in the catalog, for release()."""
    app = spark.sparkContext.applicationId
    _staged.setdefault(app, []).append(path)
    if table:
        _named.setdefault(app, []).append(table)


def release(spark: SparkSession) -> int:
    """Delete the tables this application staged, once results built on them are stored."""
    for name in _named.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)
