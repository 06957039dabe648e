"""File-system helpers on the session's Hadoop FileSystem (works for local
paths and cluster stores alike)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def child_dirs(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Names of the sub-directories of ``root`` starting with ``prefix``."""
    fs, p, _ = _fs(spark, root)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)]


def committed_dirs(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Sub-directories of ``root`` starting with ``prefix`` that hold a
    completed Spark write (the ``_SUCCESS`` marker of the job commit)."""
    fs, p, jvm = _fs(spark, root)
    return [name for name in child_dirs(spark, root, prefix)
            if fs.exists(jvm.org.apache.hadoop.fs.Path(jvm.org.apache.hadoop.fs.Path(p, name), "_SUCCESS"))]
