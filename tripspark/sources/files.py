"""Folders and marker files through Hadoop's file systems: what Spark can read and write, this can list, claim, rename and delete."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, none if it does not exist."""
    fs, place = _located(spark, path)
    if not fs.exists(place):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _located(spark, path)
    return fs.exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, place = _located(spark, path)
    fs.mkdirs(place)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Whether there was something to delete."""
    fs, place = _located(spark, path)
    return fs.delete(place, True)


def claim_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if another caller created it first."""
    fs, place = _located(spark, path)
    fs.mkdirs(place.getParent())
    return fs.createNewFile(place)


def rename_folder(spark: SparkSession, source: str, target: str) -> None:
    """Move a complete folder to a name that does not exist yet."""
    fs, place = _located(spark, source)
    _, goal = _located(spark, target)
    if fs.exists(goal) or not fs.rename(place, goal):
        raise FileExistsError(f"{target} exists, or {source} could not be moved there")


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the folders ``<column>=<value>``."""
    found = (re.fullmatch(rf"{re.escape(column)}=(.+)", name) for name in folder_names(spark, path))
    return [m.group(1) for m in found if m]
