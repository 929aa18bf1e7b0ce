"""Small documents on any Hadoop file system, replaced atomically (tmp file, then rename)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _path(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The document, or None where there is none."""
    jvm, p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """Readers see the old document or the new one, never a torn one. Without ``overwrite`` one of several writers wins; the others get FileExistsError."""
    jvm, p, fs = _path(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) if p.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.OVERWRITE if overwrite else kinds.NONE
    try:
        context.rename(context.makeQualified(tmp), context.makeQualified(p), options)
    except Exception:
        fs.delete(tmp, False)
        if not overwrite and fs.exists(p):
            raise FileExistsError(path) from None
        raise


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; whether there was one."""
    _, p, fs = _path(spark, path)
    return bool(fs.delete(p, True))


def listing(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Names in a folder, sorted; empty where the folder is missing."""
    _, p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(suffix))
