"""Session helpers: recommended SQL settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime-measured broadcast limit. Static (estimate-based) broadcast is switched
# off by `tune`, so a join side is only broadcast once AQE has measured it.
AQE_BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(master: str = "local[*]", app: str = "ledgerlake",
                  shuffle_partitions: int = 8, checkpoint_dir: str | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's own session and call `tune`."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    if checkpoint_dir is not None and not _configured_checkpoint_dir(spark):
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Set the SQL options every ledgerlake job relies on (all runtime-settable)."""
    conf = spark.conf
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # broadcast decisions only from runtime sizes, never from file-size estimates
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(AQE_BROADCAST_BYTES))
    conf.set("spark.sql.parquet.filterPushdown", "true")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster (`spark.checkpoint.dir`).

    Raises if the session names none: a machine-local fallback would break on a
    cluster, so tests must set one explicitly.
    """
    d = _configured_checkpoint_dir(spark)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def _path_and_fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables.

    All paths of one application lie in one folder that is marked for deletion
    when the driver ends, so intermediate tables never pile up across runs.
    """
    root = f"{checkpoint_dir(spark).rstrip('/')}/ledgerlake/{spark.sparkContext.applicationId}"
    jpath, fs = _path_and_fs(spark, root)
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path_and_fs(spark, path)
    return bool(fs.exists(jpath))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none where it does not exist."""
    jpath, fs = _path_and_fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(jpath)] if fs.exists(jpath) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    jpath, fs = _path_and_fs(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small text file that appears whole and only if there is none yet; False where there is.

    HDFS refuses to rename onto a name in use. A POSIX rename would replace the
    file, so on a local or mounted file system a hard link, which is refused, gives the name."""
    jpath, fs = _path_and_fs(spark, path)
    jvm = spark._jvm
    fs.mkdirs(jpath.getParent())
    temp = jvm.org.apache.hadoop.fs.Path(jpath.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(temp, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(temp.toUri().getPath(), jpath.toUri().getPath())
            return True
        return not fs.exists(jpath) and bool(fs.rename(temp, jpath))
    except FileExistsError:
        return False
    finally:
        fs.delete(temp, False)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that no later plan reads."""
    jpath, fs = _path_and_fs(spark, path)
    fs.delete(jpath, True)


def materialise(df: DataFrame, name: str = "cut") -> tuple[DataFrame, str]:
    """Write `df` as a Parquet table in the shared checkpoint folder; return the
    table read back and its path (for `discard`)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` as a Parquet table in the shared checkpoint folder and
    read it back: the plan runs once (an eager `checkpoint()` without a cache
    runs it twice), the result survives executor loss, and later plans see
    real file statistics."""
    return materialise(df)[0]
