"""The folder that all executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task takes where it makes rows of every word.
TASK_BYTES = 4 << 20

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Where that is unset a temporary folder serves, but only in local mode.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own_dir:
        _own_dir[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="tesserae-")
    return _own_dir[context.applicationId]


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    Lineage ends at the written table, so a lost executor costs no more than
    the running stage, and what follows reads the columns that it needs.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str, text: str | Column, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``df`` with the rows of a key in one partition, partitions of about ``task_bytes`` of the column ``text``.

    Windows, groups and joins by the key and more need no further shuffle, and
    what a task's texts explode into fits it, however large the table. In place
    of a text's name, a column says how many bytes a row makes.
    """
    size = df.agg(F.sum(F.octet_length(text) if isinstance(text, str) else text)).first()[0] or 0
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, size // task_bytes + 1), key)


def cut_together(df: DataFrame, tag: str) -> DataFrame:
    """``cut``, where rows that lie together by some of a join's keys aren't shuffled anew by all of them."""
    conf, name = df.sparkSession.conf, "spark.sql.requireAllClusterKeysForCoPartition"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return cut(df, tag)
    finally:
        conf.set(name, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whichever store it names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
