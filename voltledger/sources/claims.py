"""Numbers that several writers share out among themselves, by files that only one can create."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Ids in one claim. A writer leaves the rest of its last claim unused.
BLOCK = 1 << 20


def created_alone(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there. Of several writers that try, one creates it."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    system.mkdirs(target.getParent())
    try:
        if system.getUri().getScheme() == "file":
            # Hadoop's local file system looks first and creates afterwards; the system call does both.
            place = jvm.java.io.File(system.makeQualified(target).toUri().getPath())
            return place.createNewFile()
        system.create(target, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def _last_claim(spark: SparkSession, folder: str) -> int:
    """The number of the last claim in a folder, -1 if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(target):
        return -1
    names = [status.getPath().getName() for status in system.listStatus(target)]
    return max((int(name[6:]) for name in names if re.fullmatch(r"claim-\d+", name)), default=-1)


def claim_ids(spark: SparkSession, folder: str, count: int, size: int = BLOCK) -> list[int]:
    """First ids of as many blocks of ``size`` consecutive ids as ``count`` ids take.

    A block is claimed by creating its file in ``folder``, for good: a writer that fails leaves a
    gap. All writers of a folder must use one ``size``. Ids start at 1.
    """
    firsts: list[int] = []
    number = _last_claim(spark, folder) + 1
    while len(firsts) * size < count:
        if created_alone(spark, f"{folder}/claim-{number:012d}"):
            firsts.append(1 + number * size)
        number += 1
    return firsts
