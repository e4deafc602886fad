"""File-system helpers. Every path is resolved the way Spark resolves it (the
path's scheme, else the default file system), for data and manifests alike."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

#: File systems whose rename is atomic and refuses an existing name (fixed list).
ATOMIC_RENAME = ("file", "hdfs", "viewfs", "abfs", "abfss")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def scheme(spark: SparkSession, path: str) -> str:
    return _fs(spark, path)[0].getUri().getScheme()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def ensure_dir(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    return bool(fs.rename(p, _fs(spark, dst)[1]))


def set_time(spark: SparkSession, path: str, millis: int) -> None:
    """Set the modification time of a file."""
    fs, p = _fs(spark, path)
    fs.setTimes(p, millis, -1)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below the path."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def partition_values(spark: SparkSession, path: str, col: str) -> list[int]:
    pre = f"{col}="
    return [int(n[len(pre):]) for n in list_names(spark, path) if n.startswith(pre)]


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` holding ``text`` only if it does not exist; False if it does.

    The text is written aside and then given its name, so readers never see
    half a file and a crash leaves no broken one. On local disk the name is a
    hard link, elsewhere a rename that does not overwrite. File systems without
    such a rename are refused, and any other error is raised as it is.
    """
    fs, p = _fs(spark, path)
    kind = fs.getUri().getScheme()
    if kind not in ATOMIC_RENAME:
        raise ValueError(f"{kind}:// has no atomic rename; publish to one of {', '.join(ATOMIC_RENAME)}")
    jvm = spark.sparkContext._jvm
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
        out.hsync()
    finally:
        out.close()
    try:
        if kind == "file":
            try:
                os.link(aside.toUri().getPath(), p.toUri().getPath())
                return True
            except FileExistsError:
                return False
        if fs.exists(p):
            return False
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(aside, p, options)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True
    finally:
        fs.delete(aside, False)
