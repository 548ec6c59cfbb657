"""Artefacts that are replaced as a whole: versions side by side, and a marker for each.

A job writes all it has to say into a folder of its own and then makes one empty
file with that folder's number. Making a file is atomic in any store, so
a reader that asks for the last marker finds one complete version at any time,
also while the next is being written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from tripline.sources.files import MissingArtefact
from tripline.sources.session import remove


def _store(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path, path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    path, store = _store(spark, folder)
    return sorted(int(s.getPath().getName()) for s in store.globStatus(path(f"{folder}/[0-9]*")) or [])


def version_of(spark: SparkSession, out: str, made_by: str = "the job") -> tuple[int, str]:
    """Number and folder of the version that counts now. Read it once and then
    take all artefacts from that folder: they belong together."""
    known = _numbers(spark, f"{out}/published")
    if not known:
        raise MissingArtefact(f"nothing is published at {out}; run {made_by} first")
    return known[-1], f"{out}/versions/{known[-1]:012d}"


def publish(spark: SparkSession, out: str, write: Callable[[str], object], keep: int = 3) -> int:
    """Let ``write`` fill a folder of its own, then make it the version that counts.

    Returns its number, which it takes before it writes; of two jobs at once the
    one that began last counts in the end. A job that fails publishes nothing
    and its folder goes. Versions older than the last ``keep`` are removed, so a reader
    has that many publications to finish in.
    """
    path, store = _store(spark, out)
    number = (_numbers(spark, f"{out}/taken") or [0])[-1] + 1
    while not store.createNewFile(path(f"{out}/taken/{number:012d}")):
        number += 1
    folder = f"{out}/versions/{number:012d}"
    try:
        write(folder)
    except BaseException:
        remove(spark, folder)
        raise
    store.createNewFile(path(f"{out}/published/{number:012d}"))
    for old in _numbers(spark, f"{out}/published")[:-keep]:
        remove(spark, f"{out}/versions/{old:012d}")
    return number
