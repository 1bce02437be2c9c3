"""Session settings, shared scratch space and input spreading."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a batch that Spark sends to Python; an executor and its workers hold several of them, and what is made of them.
ARROW_BYTES = 4 << 20


def small_batches(spark: SparkSession, most: int = ARROW_BYTES) -> None:
    """Have Spark send tables to Python in batches of at most ``most`` bytes, unless the session asks for less."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now)) > most:
        spark.conf.set(key, f"{most}b")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on."""
    small_batches(spark)
    # a repeated key in a model reply: the last one wins
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables written between stages.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Where that is
    unset, a session on one machine gets a local folder; on a cluster each
    executor would write to its own disk, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext._jsc.sc().isLocal():
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="docsheaf-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, in any store that Spark reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files behind, which else stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a stage once and read it back, so that later stages never redo it."""
    with shuffles_end(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def computed_once(df: DataFrame, *columns: str) -> DataFrame:
    """Keep later filters on these columns above the projection that computes them.

    Catalyst pushes a filter below a projection by repeating its expressions,
    which would parse or pack every row twice. It does not push one below a
    generator, so the columns pass through a generator of one row.
    """
    held = F.inline_outer(F.array(F.struct(*columns)))
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, held).select(*df.columns)
