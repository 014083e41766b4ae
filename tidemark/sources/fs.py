"""Folder names, existence and removal through Hadoop's FileSystem, so any storage Spark reads works.

Only names of folders pass through the driver, never data.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Characters that Spark escapes in the value of a partition folder; fixed, since both must name the same folders.
ESCAPED = "\"#%'*/:=?\\{[]^\x7f" + "".join(map(chr, range(1, 32)))


def folder(name: str, value: str) -> str:
    """``name=value`` as Spark writes it."""
    return f"{name}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a pattern, sorted; empty when the base is missing."""
    hadoop_path, fs = _path(spark, pattern)
    return sorted(status.getPath().toString() for status in (fs.globStatus(hadoop_path) or []))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; empty when it is missing."""
    hadoop_path, fs = _path(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path)) if fs.exists(hadoop_path) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    hadoop_path, fs = _path(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written, by the clock of this machine."""
    hadoop_path, fs = _path(spark, path)
    return (spark._jvm.System.currentTimeMillis() - fs.getFileStatus(hadoop_path).getModificationTime()) / 1000


def folder_values(path: str) -> dict[str, str]:
    """``.../a=1/b=2`` -> {"a": "1", "b": "2"}; the innermost value of a repeated name counts."""
    parts = (part.split("=", 1) for part in path.rstrip("/").split("/") if "=" in part)
    return {name: unquote(value) for name, value in parts}


def remove(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.delete(hadoop_path, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or folder another name."""
    hadoop_path, fs = _path(spark, path)
    if not fs.rename(hadoop_path, _path(spark, to)[0]):
        raise OSError(f"could not rename {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    hadoop_path, fs = _path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Create a small file that readers see whole or not at all."""
    hidden, fs = _path(spark, f"{folder}/_{name}")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not fs.rename(hidden, _path(spark, f"{folder}/{name}")[0]):
        raise OSError(f"could not commit {folder}/{name}")


def create_text(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Create a small file unless there is one of that name; False if there is.

    The file is written under a hidden name and then published whole, so readers never find it empty. Of several
    writers one succeeds.
    """
    hidden, fs = _path(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    try:
        return publish(spark, hidden.toString(), f"{folder}/{name}")
    finally:
        fs.delete(hidden, False)


def publish(spark: SparkSession, path: str, to: str) -> bool:
    """Give a finished file its name unless that name is taken; False if it is.

    A rename on a local disk replaces what is there, so a second link is made there instead. Elsewhere the rename
    refuses, which HDFS does as one step.
    """
    source, fs = _path(spark, path)
    target, jvm = _path(spark, to)[0], spark._jvm
    try:
        if fs.getUri().getScheme() == "file":
            local = [jvm.java.nio.file.Path.of(jvm.java.net.URI.create(fs.makeQualified(p).toUri().toString())) for p in (target, source)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            _rename_unless_there(spark, source, target)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _rename_unless_there(spark: SparkSession, source, target) -> None:
    jvm = spark._jvm
    options = jvm.org.apache.hadoop.fs.Options.Rename
    none = spark.sparkContext._gateway.new_array(options, 1)
    none[0] = options.NONE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, none)
