"""Batch numbers and attempts: who may write where, decided by files that are created if absent.

A run claims a batch number by creating its claim file, which only one run can; it holds the run's id. A run that
finds its number taken goes on to the next free one, a run that finds its own claim (it died and starts again) claims
the number's next attempt. Every attempt writes into directories of its own, and the ledger row of the attempt that
came to its end is the commit: whatever an attempt without such a row left behind is never read, and two attempts
never write the same files.
"""

from __future__ import annotations

import uuid

from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import SparkSession
from py4j.protocol import Py4JJavaError


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file unless it exists; True for the one caller that created it.

    File systems with an atomic create (HDFS, object stores with conditional puts) decide it themselves; the local
    one does through an exclusive create.
    """
    p, fs = _path(spark, path)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(p.getParent())
    local = (p.toUri().getScheme() or fs.getUri().getScheme()) == "file"
    try:
        if local:
            # the exclusive create takes the place; the text follows
            if not jvm.java.io.File(p.toUri().getPath()).createNewFile():
                return False
            out = fs.create(p, True)
        else:
            out = fs.create(p, False)
    except (Py4JJavaError, CapturedException) as exc:
        name = str(getattr(exc, "java_exception", exc))
        if "AlreadyExists" in name or fs.exists(p):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder (none if there is no such folder); for folders of claim files."""
    p, fs = _path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p) if f.isFile()] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a claim file (empty while its creator has not written it yet)."""
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def claim_batch(spark: SparkSession, root: str, run_id: str, least: int, taken: frozenset[int] = frozenset()) -> tuple[int, int]:
    """``(batch number, attempt)`` for a run: ``least`` or the next number that no other run holds."""
    number = int(least)
    while True:
        claim = f"{root.rstrip('/')}/{number}"
        if number not in taken and create_if_absent(spark, claim, run_id):
            return number, 0
        p, fs = _path(spark, claim)
        if fs.exists(p) and read_text(spark, claim) == run_id:
            attempt = 1
            while not create_if_absent(spark, f"{claim}.{attempt}", uuid.uuid4().hex):
                attempt += 1
            return number, attempt
        number += 1
