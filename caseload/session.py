"""Session helpers: local session for tests, shared folder, lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

_made: dict[str, list[str]] = {}  # paths of each application, for release()
_own: dict[str, str] = {}  # folders of local sessions without the setting
_kept: list[tempfile.TemporaryDirectory] = []


def local_session(cores: str = "8", app: str = "caseload") -> SparkSession:
    """Session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # methods above this size are not compiled by the JVM; Spark then splits them
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def sibling_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of the same application with the settings of ``spark`` and these besides.

    Frames made in it are planned by its settings, wherever they are run; other frames keep theirs.
    """
    other = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if other.conf.isModifiable(key):
            other.conf.set(key, value)
    return other


def in_session(df: DataFrame, spark: SparkSession) -> DataFrame:
    """``df`` as a frame of another session of the application; what is joined to it is planned there.

    Frames take the session of their left side; the empty one is gone from the optimised plan.
    """
    none = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
    return none.filter(F.lit(False)).union(df)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as ``spark.checkpoint.dir`` of the session names it.

    Where driver and executors are one process (master ``local`` or ``local[n]``) a session
    without the setting gets a folder of its own, which goes when the process ends. Anywhere
    else a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or _own.get(spark.sparkContext.applicationId)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.TemporaryDirectory(prefix="caseload-", ignore_cleanup_errors=True)
    _kept.append(folder)
    _own[spark.sparkContext.applicationId] = folder.name
    return folder.name


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder; ``release`` removes it."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def settle(df: DataFrame, label: str = "settled", compression: str | None = None) -> DataFrame:
    """Compute ``df`` once into the shared folder and go on from the file.

    The copy is Parquet: later reads take only the columns and rows they need, and losing
    executors costs nothing. ``compression`` of the files, such as ``zstd``; None leaves it to Spark.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Remove what this application has put below the shared folder; returns how many paths.

    For the end of a run: frames that still read those paths can't be used afterwards.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(paths)
