"""Small text files on whatever file system the path names."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path fits the glob pattern."""
    found = _system(spark, pattern).globStatus(_path(spark, pattern))
    return found is not None and len(found) > 0


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder; none if it is not there."""
    if not exists(spark, folder):
        return []
    return [f.getPath().getName() for f in _system(spark, folder).listStatus(_path(spark, folder))]


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


#: Schemes of object stores: there a file appears when its upload ends, and only if it is absent.
_CONDITIONAL = ("s3a", "abfs", "abfss", "gs")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with this text unless it is there; of several writers just one succeeds.

    Local files are linked into place, object stores are asked for a conditional upload, and other
    systems (HDFS) rename without replacing. Readers never see a part of the text.
    """
    system, target = _system(spark, path), _path(spark, path)
    scheme = system.getUri().getScheme()
    if scheme in _CONDITIONAL:
        return _create_conditionally(spark, system, target, text)
    aside = f"{path}.{uuid.uuid4().hex}"
    _write(system.create(_path(spark, aside), True), text)
    try:
        if scheme == "file":
            local = _path(spark, aside).toUri().getPath()
            os.link(local, target.toUri().getPath())
        else:
            rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                target.toUri(), spark._jsc.hadoopConfiguration()
            )
            context.rename(_path(spark, aside), target, spark._sc._gateway.new_array(rename, 0))
            return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        system.delete(_path(spark, aside), False)
    return True


def _create_conditionally(spark: SparkSession, system, target, text: str) -> bool:
    builder = system.createFile(target).overwrite(False)
    builder.opt("fs.option.create.conditional.overwrite", True)
    try:
        _write(builder.build(), text)
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def _write(stream, text: str) -> None:
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Readers see the old text or the new one, never a part: written aside, then renamed.

    Counts on a rename that replaces its target at once, as HDFS and local disks have it; an object
    store needs a committer of its own here.
    """
    aside = f"{path}.{uuid.uuid4().hex}"
    _write(_system(spark, path).create(_path(spark, aside), True), text)
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark._sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, path).toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(_path(spark, aside), _path(spark, path), how)
