"""Table writes: full refresh, month partitions, upserts and error records."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def _sized(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Few files per partition value; AQE splits a value that is too big for one task."""
    return df.hint("rebalance", *[F.col(c) for c in by]) if by else df


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite") -> None:
    """Write with rows clustered on ``keys`` so that row groups carry tight min/max ranges."""
    spread = df.hint("rebalance", *[F.col(k) for k in keys])
    spread.sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def with_month(df: DataFrame, day: str, month: str = "month") -> DataFrame:
    return df.withColumn(month, F.date_format(F.col(day), "yyyy-MM"))


def out_of_range(day: Column, low, high) -> Column:
    """Rows a strict monthly range would refuse; an open end is None."""
    test = day.isNull()
    if low is not None:
        test = test | (day < F.lit(low))
    if high is not None:
        test = test | (day >= F.lit(high))
    return test


def write_months(df: DataFrame, path: str, day: str, keys: Sequence[str] = (), month: str = "month",
                 replaced: Sequence[str] = ()) -> None:
    """Replace the months present in ``df`` and leave every other month alone.

    The same call serves the first load, a daily append and a re-run: running it again
    with the same rows gives the same table.  ``replaced`` names the months (``yyyy-MM``) that are
    being replaced: one that comes out empty loses its old rows.
    """
    write_filed(with_month(df, day, month), path, month, keys, replaced)


def write_filed(df: DataFrame, path: str, month: str, keys: Sequence[str] = (), replaced: Sequence[str] = ()) -> None:
    """:func:`write_months` for rows that carry their month already."""
    seen = Observation()
    if replaced:  # the months among them that have rows are noted while writing
        df = df.observe(seen, F.collect_set(F.when(F.col(month).isin(*replaced), F.col(month))).alias("left"))
    ready = _sized(df, [month])
    if keys:
        ready = ready.sortWithinPartitions(month, *keys)
    (ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(month).parquet(path))
    if replaced:
        for gone in sorted(set(replaced) - set(observed(seen, "left", ()))):
            drop_folder(df.sparkSession, f"{path}/{month}={gone}")


def stored_months(spark: SparkSession, path: str, month: str = "month") -> list[str]:
    """The months a table has folders for: one call to the file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    return sorted(n.removeprefix(f"{month}=") for n in names if n.startswith(f"{month}=") and "__" not in n)


def observed(seen: Observation, name: str, without_rows):
    """What was noted during a write; a plan known to be empty is optimized away with its observer."""
    try:
        return seen.get[name]
    except Py4JJavaError as none:
        if "assertion failed" not in str(none):
            raise
        return without_rows


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_days(df: DataFrame, path: str, day: str, keys: Sequence[str] = (), month: str = "month") -> None:
    """Like :func:`write_months` for daily snapshots: only the days present are replaced."""
    ready = _sized(with_month(df, day, month).withColumn("day", F.date_format(F.col(day), "dd")), [month, "day"])
    if keys:
        ready = ready.sortWithinPartitions(month, "day", *keys)
    (ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(month, "day").parquet(path))


def replace_records(records: DataFrame, path: str, batch: str, source: str | None = None, day: str = "ErrorDate",
                    even: bool = False) -> None:
    """Write a batch's error records of one table, or of the tables they name, in place of those it wrote before.

    They are dealt out for few files, unless their partitions are ``even`` already.
    """
    named = F.col("SourceTable") if source is None else F.lit(source)
    filed = with_month(records, day).withColumn("batch", F.lit(batch)).withColumn("source", named)
    (_sized(filed, [] if even else ["month", "batch", "source"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month", "batch", "source").parquet(path))


def read_months(spark: SparkSession, path: str, months: Sequence[str] | None = None,
                month: str = "month") -> DataFrame:
    """A month-partitioned table; a list of months prunes the folders that are read."""
    df = spark.read.parquet(path)
    return df if months is None else df.filter(F.col(month).isin(*months))


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


class VersionedTable:
    """A table whose every refresh goes to a new folder and is switched to when complete.

    A manifest lists the complete versions and their parts.  It is written under another name and
    renamed once the data is there, so a reader never sees a half-written table, a job may read the
    version it is about to replace, and a read costs two calls to the file system however many
    versions there are.  A table has one writer at a time.
    """

    #: Parts of a version.
    WHOLE = "whole"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _manifests(self, fs) -> list[str]:
        """Names of the manifests, oldest first; a commit keeps two."""
        try:
            found = [s.getPath().getName() for s in fs.listStatus(self._path("_manifest"))]
        except Py4JJavaError as error:
            if "FileNotFoundException" not in str(error.java_exception.getClass().getName()):
                raise
            return []
        return sorted(n for n in found if n.endswith(".json") and n[0].isdigit())

    def _state(self) -> list[dict]:
        """The complete versions, oldest first, as name and parts."""
        fs, _ = self._fs()
        names = self._manifests(fs)
        if not names:
            return []
        stream = fs.open(self._path("_manifest", names[-1]))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, state: list[dict]) -> None:
        fs, _ = self._fs()
        names = self._manifests(fs)
        number = int(names[-1].split(".")[0]) + 1 if names else 1
        draft = self._path("_manifest", f".draft-{uuid.uuid4().hex}")
        stream = fs.create(draft)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        if not fs.rename(draft, self._path("_manifest", f"{number:010d}.json")):
            raise OSError(f"another writer has changed {self.root}")
        for old in names[:-1]:
            fs.delete(self._path("_manifest", old), False)

    def versions(self) -> list[str]:
        """Names of the complete versions, oldest first."""
        return [v["name"] for v in self._state()]

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, schema=None) -> DataFrame:
        """The newest complete version, or no rows of ``schema`` if there is none yet."""
        done = self.versions()
        if done:
            return self.spark.read.parquet(f"{self.root}/{done[-1]}")
        if schema is None:
            raise FileNotFoundError(f"no complete version below {self.root}")
        return self.spark.createDataFrame([], schema)

    def _drop(self, *parts: str) -> None:
        fs, _ = self._fs()
        fs.delete(self._path(*parts), True)

    def prune(self, keep: int = 2) -> list[str]:
        """Delete versions older than the newest ``keep``; readers of those must be done."""
        state = self._state()
        old = [v["name"] for v in state[:-keep]]
        if old:
            self._commit(state[-keep:])
        for version in old:
            self._drop(version)
        return old

    def _listed(self, *parts: str) -> list[str]:
        """Names of the folders in one of the table's folders."""
        fs, _ = self._fs()
        folder = self._path(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()) if fs.exists(folder) else []

    def _entry(self, name: str) -> dict:
        """What the manifest says of a version that has been written."""
        return {"name": name, "parts": [self.WHOLE]}

    def write(self, df: DataFrame, keys: Sequence[str] = (), partition: Sequence[str] = (), kind: str = "", **note) -> str:
        state = self._state()
        number = int(state[-1]["name"].split("-")[0][1:]) + 1 if state else 1
        name = f"v{number:08d}-{kind}{uuid.uuid4().hex[:8]}"
        ready = _sized(df, partition or keys)
        if keys:
            ready = ready.sortWithinPartitions(*partition, *keys)
        writer = ready.write.mode("errorifexists")
        if partition:
            writer = writer.partitionBy(*partition)
        writer.parquet(f"{self.root}/{name}")
        self._commit([*state, self._entry(name) | note])
        return name


class BatchTable(VersionedTable):
    """Rows that are only ever added to, a batch at a time.

    A batch is written to a folder of its own and counts once the manifest lists it: a batch that is
    repeated adds nothing, and rows of a task or a job that failed halfway are never read.  With ``day``
    a batch is filed by month, and readers that want some months open their folders only.
    """

    FILED = "filed_month"

    def batches(self) -> list[str]:
        return [b for v in self._state() for b in v["batches"]]

    def notes(self) -> list[dict]:
        return self._state()

    def exists(self) -> bool:
        return bool(self._state())

    def _entry(self, name: str) -> dict:
        return {"name": name, "parts": [p for p in self._listed(name) if p.startswith(f"{self.FILED}=")] or [self.WHOLE]}

    def append(self, df: DataFrame, batch: str, day: str | None = None, **note) -> bool:
        """Add a batch; False if the table has it already."""
        if batch in self.batches():
            return False
        filed = df if day is None else with_month(df, day, self.FILED)
        self.write(filed, partition=[] if day is None else [self.FILED], batches=[batch], **note)
        return True

    def _folders(self, state: Sequence[dict], months: Sequence[str] | None) -> list[str]:
        wanted = None if months is None else {f"{self.FILED}={m}" for m in months}
        return [f"{self.root}/{v['name']}" + ("" if p == self.WHOLE else f"/{p}") for v in state for p in v["parts"]
                if wanted is None or p == self.WHOLE or p in wanted]

    def read(self, schema=None, months: Sequence[str] | None = None) -> DataFrame:
        state = self._state()
        if not state and schema is None:
            raise FileNotFoundError(f"no batch below {self.root}")
        if not state:
            return self.spark.createDataFrame([], schema)
        folders = self._folders(state, months)
        if not folders:
            return self.spark.read.parquet(*self._folders(state, None)).limit(0)
        return self.spark.read.parquet(*folders)

    def compact(self, keys: Sequence[str] = ()) -> None:
        """All batches in one folder; the old ones go with the next :meth:`prune`."""
        state = self._state()
        if len(state) > 1:
            batches = [b for v in state for b in v["batches"]]
            filed = any(p != self.WHOLE for v in state for p in v["parts"])
            if filed:
                raise ValueError("a table filed by month stays as it is")
            ready = _sized(self.read(), keys)
            name = f"v{int(state[-1]['name'].split('-')[0][1:]) + 1:08d}-{uuid.uuid4().hex[:8]}"
            ready.write.mode("errorifexists").parquet(f"{self.root}/{name}")
            self._commit([{**state[-1], **self._entry(name), "batches": batches}])
            for v in state:
                self._drop(v["name"])

    def prune(self, keep: int = 2) -> list[str]:
        return []  # every batch counts


class HistoryTable(VersionedTable):
    """A versioned dimension whose runs write open rows and newly closed rows only.

    Each version has one folder of open rows and one of the rows that run closed.  The open rows of
    the newest version are current, and closed rows are those of all versions since the last full
    one, read at once.  So a day costs what is open and what changed, however long the history is.

    With ``key`` closed rows are laid out by buckets of it.  A version may then hold some buckets whole,
    which take the place of those buckets' rows in all versions before it: so a change of the past
    rewrites the buckets it falls in and leaves the files of all others alone.
    """

    FULL = "full-"
    OPEN, CLOSED = "IsCurrent=true", "IsCurrent=false"
    BUCKET = "KeyBucket"

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str] = (), buckets: int = 16):
        super().__init__(spark, root)
        self.key, self.buckets = tuple(key), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.key]), F.lit(self.buckets)).cast("int")

    def _entry(self, name: str) -> dict:
        found = {"name": name, "parts": [p for p in self._listed(name) if p in (self.OPEN, self.CLOSED)]}
        if self.key:
            found["buckets"] = [int(p.split("=")[1]) for p in self._listed(name, self.CLOSED)]
        return found

    def _held(self) -> list[dict]:
        """Versions that hold rows; an empty dimension counts as not loaded yet."""
        return [v for v in self._state() if v["parts"]]

    def versions(self) -> list[str]:
        return [v["name"] for v in self._held()]

    def _rows(self, versions: Sequence[str], part: str) -> DataFrame:
        """The rows of one part of some versions (folders without folders in them, or one of any kind)."""
        df = self.spark.read.parquet(*[f"{self.root}/{v}/{part}" for v in versions]).drop(self.BUCKET)
        at = df.columns.index("ValidToDate") + 1
        return df.withColumn("IsCurrent", F.lit(part == self.OPEN)).select(
            *df.columns[:at], "IsCurrent", *df.columns[at:])

    def _open(self, held: Sequence[dict]) -> DataFrame:
        newest = held[-1]
        if self.OPEN in newest["parts"]:
            return self._rows([newest["name"]], self.OPEN)
        return self._rows([newest["name"]], self.CLOSED).filter("IsCurrent")  # every row was closed

    def read_open(self) -> DataFrame:
        return self._open(self._held())

    def since_full(self) -> int:
        """Versions since the last full one, that included."""
        return len(self._held()[self._start(self._held()):])

    def _start(self, held: Sequence[dict]) -> int:
        full = [i for i, v in enumerate(held) if self.FULL in v["name"]]
        return full[-1] if full else 0

    def read(self, schema=None) -> DataFrame:
        held = self._held()
        if not held:
            return super().read(schema)
        out, closed = self._open(held), self._closed(held)
        return out if closed is None else out.unionByName(closed)

    def read_closed(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Closed rows, of some buckets if asked; None if there are none."""
        return self._closed(self._held(), buckets)

    def _closed(self, held: Sequence[dict], buckets: Sequence[int] | None = None) -> DataFrame | None:
        counted, taken = [], set()
        for v in reversed(held[self._start(held):]):  # a bucket held whole hides earlier rows of it
            if self.CLOSED in v["parts"] and "buckets" in v:
                counted += [f"{v['name']}/{self.CLOSED}/{self.BUCKET}={b}" for b in v["buckets"]
                            if b not in taken and (buckets is None or b in buckets)]
            elif self.CLOSED in v["parts"]:
                counted.append(f"{v['name']}/{self.CLOSED}")
            taken |= set(v.get("whole", ()))
        if not counted:
            return None
        df = self.spark.read.parquet(*[f"{self.root}/{c}" for c in counted])
        at = df.columns.index("ValidToDate") + 1
        return df.withColumn("IsCurrent", F.lit(False)).select(*df.columns[:at], "IsCurrent", *df.columns[at:])

    def prune(self, keep: int = 2) -> list[str]:
        """Delete what no reader needs: versions before the last full one, and the open rows
        of all but the newest ``keep`` versions.  ``write_full(read())`` compacts first."""
        held = self._held()
        start = self._start(held)
        kept = [dict(v) for v in held[start:]]
        gone = []
        for v in kept[:-keep]:
            if self.OPEN in v["parts"]:
                gone.append((v["name"], self.OPEN))
                v["parts"] = [p for p in v["parts"] if p != self.OPEN]
        old = [v["name"] for v in held[:start]]
        if old or gone:
            self._commit(kept)
        for parts in [(v,) for v in old] + gone:
            self._drop(*parts)
        return old

    def _laid_out(self, rows: DataFrame, keys: Sequence[str], kind: str = "", **note) -> str:
        if not self.key:
            return self.write(rows, keys, partition=["IsCurrent"], kind=kind, **note)
        return self.write(rows.withColumn(self.BUCKET, self.bucket()), keys, partition=["IsCurrent", self.BUCKET], kind=kind, **note)

    def write_step(self, merged: DataFrame, keys: Sequence[str] = (), whole: Sequence[int] = ()) -> str:
        """Open rows and the rows this run closed, as a merge of :meth:`read_open` gives them, and all
        closed rows of the buckets that are held ``whole``."""
        return self._laid_out(merged, keys, **({"whole": sorted(whole)} if whole else {}))

    def write_full(self, dimension: DataFrame, keys: Sequence[str] = ()) -> str:
        """The whole dimension; closed rows of earlier versions no longer count."""
        return self._laid_out(dimension, keys, kind=self.FULL)
