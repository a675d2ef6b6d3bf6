"""A folder that is replaced as a whole, once its new content is complete."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A new folder beside ``path`` that takes its place when the block ends well.

    If the block fails the new folder is removed and ``path`` stays as it is. The exchange
    is two renames, of the old folder and of the new one. What stops between them leaves the
    old folder aside, and the next call puts it back. There is no lock: one writer at a time.
    """
    files, own = _file_system(spark, path)
    parent = own.getParent()
    old = _child(spark, parent, f".{own.getName()}.old")
    new = _child(spark, parent, f".{own.getName()}.{uuid.uuid4().hex}")
    _recover(files, own, old)
    try:
        yield new.toString()
        if files.exists(own):
            _rename(files, own, old)
        _rename(files, new, own)
    except BaseException:
        files.delete(new, True)
        _recover(files, own, old)
        raise
    files.delete(old, True)
    spark.catalog.refreshByPath(path)


def _recover(files: JavaObject, own: JavaObject, old: JavaObject) -> None:
    """Put the old folder back if nothing has taken its place, or else remove it."""
    if files.exists(old):
        if files.exists(own):
            files.delete(old, True)
        else:
            _rename(files, old, own)


def _rename(files: JavaObject, source: JavaObject, target: JavaObject) -> None:
    if not files.rename(source, target):
        raise OSError(f"cannot rename {source.toString()} to {target.toString()}")


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    own = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    files = own.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return files, files.makeQualified(own)


def _child(spark: SparkSession, parent: JavaObject, name: str) -> JavaObject:
    return spark._jvm.org.apache.hadoop.fs.Path(parent, name)
