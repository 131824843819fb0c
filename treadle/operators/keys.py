"""Surrogate keys: whole numbers without gaps, handed out by counting.

New versions are stored first; the key of one is its place in its partition after the counts of the
partitions before it and of all keys handed out so far.  The map of natural key and start day to key is an
append-only table, so a version that was given a key keeps it, in a repeated run as in a dimension that
is built anew, and two versions never share one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from treadle.operators.sinks import BatchTable
from treadle.session import run_folder

#: Batches after which the map is written anew as one.
COMPACT_AFTER = 60


#: Where a stored row was written: its partition, and its place in that.
PART, PLACE = "_part", "_at"


def numbered(df: DataFrame) -> DataFrame:
    """Rows with their places, to be written at once: a place counts only as it was stored."""
    return df.withColumn(PART, F.spark_partition_id()).withColumn(PLACE, F.monotonically_increasing_id())


class KeyMap:
    """The keys of one dimension; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.table = spark, BatchTable(spark, root)

    def _last(self) -> int:
        return max((n["last"] for n in self.table.notes()), default=0)

    def keys_of(self, versions: DataFrame, by: Sequence[str], key: str) -> DataFrame:
        """``by`` and ``key`` of each of the (few) distinct versions; those without a key get the next ones."""
        by = list(by)
        wanted = versions.select(*by).distinct()
        folder = run_folder(self.spark, "versions")
        numbered(wanted).write.parquet(folder)
        wanted = self.spark.read.parquet(folder)
        if not self.table.exists():
            return self._hand_out(wanted, by, key)
        held = self.table.read().join(F.broadcast(wanted.select(*by)) if wanted.count() < 100_000 else wanted.select(*by), by, "left_semi")
        new = wanted.join(held, by, "left_anti")
        return held if new.isEmpty() else held.unionByName(self._hand_out(new, by, key))

    def _hand_out(self, new: DataFrame, by: list[str], key: str) -> DataFrame:
        folder = run_folder(self.spark, "new-versions")
        numbered(new.select(*by)).write.parquet(folder)
        stored = self.spark.read.parquet(folder)
        starts, last = self._starts(_counted(stored))
        if starts is None:
            return stored.select(*by, F.lit(0).cast("bigint").alias(key))
        keyed = stored.join(starts, PART).select(*by, (F.col(PLACE) + F.col("_start")).alias(key))
        self._add(keyed, by, last)
        return keyed

    def first_keys(self, stored: DataFrame, by: Sequence[str], key: str) -> DataFrame | None:
        """Stored :func:`numbered` versions with the first keys of an empty map, by their places alone.

        None if that can't be: there are keys already, or rows that share a version, or lack part of it.
        """
        if self.table.exists() or not stored.filter(F.col(key).isNotNull()).isEmpty():
            return None
        odd = F.col("_n") > 1
        for c in by:
            odd = odd | F.col(c).isNull()
        if not stored.groupBy(*by).agg(F.count("*").alias("_n")).filter(odd).isEmpty():
            return None
        starts, last = self._starts(_counted(stored))
        if starts is None:
            return None
        keyed = stored.join(starts, PART).select(*[
            (F.col(PLACE) + F.col("_start")).alias(c) if c == key else F.col(c) for c in stored.columns if c not in (PART, PLACE)])
        self._add(keyed.select(*by, key), list(by), last)
        return keyed

    def _starts(self, counted: list) -> tuple[DataFrame | None, int]:
        """What is added to the places of each partition, and the last key handed out."""
        last, starts = self._last(), []
        for r in counted:
            starts.append((r[PART], last + 1 - r["first"]))
            last += r.n
        return (F.broadcast(self.spark.createDataFrame(starts, f"{PART} int, _start long")) if starts else None), last

    def _add(self, keyed: DataFrame, by: list[str], last: int) -> None:
        self.table.append(keyed, uuid.uuid4().hex, last=last)
        if len(self.table.notes()) > COMPACT_AFTER:
            self.table.compact(by)


def _counted(stored: DataFrame) -> list:
    """One row per partition of the write: its rows and the place of the first."""
    return stored.groupBy(PART).agg(F.count("*").alias("n"), F.min(PLACE).alias("first")).orderBy(PART).collect()


def with_keys(spark: SparkSession, root: str, versions: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """Stored ``versions`` with the keys that are NULL filled in; those stored as :func:`numbered` lose their places."""
    if PART in versions.columns:
        keyed = KeyMap(spark, root).first_keys(versions, by, key)
        if keyed is not None:
            return keyed
        versions = versions.drop(PART, PLACE)
    open_ = versions.filter(F.col(key).isNull())
    if open_.isEmpty():
        return versions
    given = KeyMap(spark, root).keys_of(open_, by, key).withColumnRenamed(key, "_given")
    return versions.join(given, list(by), "left").select(*[
        F.coalesce(F.col(key), F.col("_given")).alias(c) if c == key else F.col(c) for c in versions.columns])
