"""Refreshes that survive a failure: staged versions and a manifest that readers follow.

``mode("overwrite")`` deletes the old data before the new is written, so a job
that dies in between leaves nothing.  Here every refresh of ``path`` writes a
new folder ``<path>.versions/<id>``; when it is complete, the small manifest
``<path>.current``, which names it, is replaced by an atomic rename.  Readers
resolve ``path`` through the manifest: they see the old version until the
rename and the new one after it, and a reader that has begun keeps its files.
A failed refresh leaves a folder that no manifest names; ``prune`` removes such
folders and all versions but the last ones.

A path without a manifest is read as it is, so older folders stay readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _read_manifest(spark: SparkSession, path: str) -> str | None:
    manifest, fs = _hadoop(spark, f"{path.rstrip('/')}.current")
    if not fs.exists(manifest):
        return None
    stream = fs.open(manifest)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def resolve(spark: SparkSession, path: str) -> str:
    """The folder that holds the current version of ``path``."""
    version = _read_manifest(spark, path)
    return f"{path.rstrip('/')}.versions/{version}" if version else path


def published(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` has a current version, or a folder of its own."""
    p, fs = _hadoop(spark, path)
    return _read_manifest(spark, path) is not None or fs.exists(p)


def _commit(spark: SparkSession, path: str, version: str) -> None:
    jvm, path = spark._jvm, path.rstrip("/")
    staged, fs = _hadoop(spark, f"{path}.current-{version}")
    out = fs.create(staged, True)
    try:
        out.writeUTF(version)
    finally:
        out.close()
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(f"{path}.current")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(staged), fs.makeQualified(target), how)


def refresh(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Call ``write(folder)`` for a new version of ``path``, then make it current.  Returns the folder.

    If ``write`` fails the old version stays current.
    """
    version = uuid.uuid4().hex[:16]
    folder = f"{path.rstrip('/')}.versions/{version}"
    write(folder)
    _commit(spark, path, version)
    return folder


def prune(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove all versions but the current one and the ``keep`` - 1 latest others; returns how many went.

    Call it when no refresh of ``path`` runs and no reader needs older versions.
    """
    current = _read_manifest(spark, path)
    base, fs = _hadoop(spark, f"{path.rstrip('/')}.versions")
    if current is None or not fs.exists(base):
        return 0
    old = sorted((s for s in fs.listStatus(base) if s.getPath().getName() != current),
                 key=lambda s: s.getModificationTime(), reverse=True)[keep - 1:]
    for s in old:
        fs.delete(s.getPath(), True)
    return len(old)
