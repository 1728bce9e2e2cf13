"""A change log of bounded width: batches merged into larger and larger folders under one manifest.

Each micro-batch becomes a folder of level 0. As soon as a level has ``fan`` folders, they are merged into one of
the next level, so a reader opens at most ``fan - 1`` folders for each level, and there are as
many levels as the logarithm of the number of batches; every change is rewritten once a level.
The manifest, a small file with a version, says which folders count. It is written beside its name and renamed
at the end, so a reader sees the log before a change or after it. Folder names are never used twice:
what a failed run left is in no manifest and is never read.

A folder knows the numbers of the batches in it. A batch that comes again replaces its folder while it has one of its own,
and is left out once merged. There is one writer, the streaming query.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.streaming.feeds import latest

FAN = 8


@dataclass(frozen=True)
class Folder:
    name: str
    level: int
    batches: tuple[int, ...]


class ChangeLog:
    """The log at ``path``; ``merge`` reduces rows and may be applied to its own results in any order."""

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], fan: int = FAN):
        if fan < 2:
            raise ValueError("a level needs at least two folders before it is merged")
        self.spark, self.path, self.merge, self.fan = spark, path.rstrip("/"), merge, fan

    def _place(self, name: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The newest version, 0 before the first batch."""
        place, fs = self._place("_manifest")
        if not fs.exists(place):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return max((int(n) for n in names if n.isdecimal()), default=0)

    def folders(self, version: int | None = None) -> list[Folder]:
        """Folders of a version, the newest without."""
        version = self.version() if version is None else version
        if not version:
            return []
        place, fs = self._place(f"_manifest/{version}")
        stream = fs.open(place)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Folder(f["name"], f["level"], tuple(f["batches"])) for f in json.loads(text)]

    def _commit(self, before: int, folders: Sequence[Folder]) -> None:
        target, fs = self._place(f"_manifest/{before + 1}")
        if fs.exists(target):
            raise RuntimeError(f"version {before + 1} of {self.path} was written by someone else")
        draft, _ = self._place(f"_manifest/_{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps([asdict(f) for f in folders]).encode()))
        finally:
            out.close()
        if not fs.rename(draft, target):
            raise RuntimeError(f"version {before + 1} of {self.path} could not be named")

    def _write(self, rows: DataFrame, level: int, batches: Sequence[int]) -> Folder:
        folder = Folder(f"level-{level}-{uuid.uuid4().hex}", level, tuple(sorted(batches)))
        rows.write.parquet(f"{self.path}/{folder.name}")
        return folder

    def add(self, batch: DataFrame, number: int) -> None:
        """One batch, reduced; then whatever merges it makes due."""
        version, held = self.version(), self.folders()
        if any(number in f.batches and f.level for f in held):
            return
        held = [f for f in held if number not in f.batches]
        self._commit(version, [*held, self._write(self.merge(batch), 0, [number])])
        self.compact()

    def compact(self) -> None:
        """Merges every level that is full, from below; each merge is a version of its own."""
        level = 0
        while level <= max((f.level for f in self.folders()), default=-1):
            version, held = self.version(), self.folders()
            full = [f for f in held if f.level == level]
            if len(full) >= self.fan:
                batches = [n for f in full for n in f.batches]
                merged = self._write(self.merge(self._rows(full)), level + 1, batches)
                self._commit(version, [*(f for f in held if f.level != level), merged])
            level += 1

    def _rows(self, folders: Sequence[Folder]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{f.name}" for f in folders])

    def read(self) -> DataFrame:
        """All changes, reduced over the folders of the newest version."""
        held = self.folders()
        if not held:
            raise ValueError(f"the log at {self.path} has no batch yet")
        return self.merge(self._rows(held))

    def vacuum(self, keep: int = 2) -> int:
        """Deletes folders that none of the newest ``keep`` versions has, for when no older reader is left."""
        newest = self.version()
        alive = {f.name for v in range(max(newest - keep + 1, 1), newest + 1) for f in self.folders(v)}
        place, fs = self._place("")
        gone = [s.getPath() for s in fs.listStatus(place) if s.getPath().getName().startswith("level-")]
        gone = [p for p in gone if p.getName() not in alive]
        for p in gone:
            fs.delete(p, True)
        return len(gone)


def versions_log(
    spark: SparkSession, path: str, keys: Sequence[str], updated: str, ties: Sequence[str] = (), fan: int = FAN
) -> ChangeLog:
    """A log of the latest version per key; late and repeated changes count like any other."""
    return ChangeLog(spark, path, lambda rows: latest(rows, keys, updated, ties), fan)


def windows_log(spark: SparkSession, path: str, key: str, fan: int = FAN) -> ChangeLog:
    """A log of parts of windows (window_start, key, n, first_ts, last_ts), added up; see ``window_parts``."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("window_start", key).agg(
            F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
        )

    return ChangeLog(spark, path, merge, fan)


def window_parts(batch: DataFrame, key: str, ts: str, width: str) -> DataFrame:
    """Rows as parts of windows, one each; the log adds them up."""
    start = F.window(ts, width)["start"].alias("window_start")
    return batch.select(start, key, F.lit(1).cast("long").alias("n"), F.col(ts).alias("first_ts"), F.col(ts).alias("last_ts"))


def follow(stream: DataFrame, log: ChangeLog, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """Drains the stream into the log; returns the finished query."""

    def add(batch: DataFrame, number: int) -> None:
        # A batch is read for its newest times and for its rows.
        batch.persist()
        try:
            log.add(prepare(batch) if prepare else batch, number)
        finally:
            batch.unpersist()

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
