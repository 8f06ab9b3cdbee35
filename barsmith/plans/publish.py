"""Results of a run, published as one.

A run writes all its tables below ``runs/<run id>`` and, when all are there, one
small file below ``published`` that names the run and the folder of each table.
The file is written under a temporary name and moved, so it is there whole or
not at all, and readers go by the last one: they see every table of one run,
never this run's first results beside the last run's others.  A run that dies
leaves a folder that no file names.
"""
from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import SparkSession

RUNS, PUBLISHED = "runs", "published"


class Folder:
    """A folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(self.conf)

    def path(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, name: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.path(name))) if self.exists(name) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_whole(self, name: str, text: str) -> None:
        """The file is there with all its text, or not."""
        folder, _, last = name.rpartition("/")
        temporary = self.path(f"{folder}/_{last}-{uuid.uuid4().hex}")
        stream = self.fs.create(temporary)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.rename(temporary, self.path(name)):
            raise OSError(f"{name} could not be written")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class Run:
    """The tables of one run below ``root``."""

    def __init__(self, spark: SparkSession, root: str, run_id: str | None = None):
        self.folder = Folder(spark, root)
        self.id = run_id or f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        self.tables: dict[str, str] = {}

    def path(self, name: str) -> str:
        """Where the run writes a table, which it will publish."""
        return self.tables.setdefault(name, f"{self.folder.root}/{RUNS}/{self.id}/{name}")

    def publish(self, keep: int = 2) -> None:
        """Name this run's tables as the current ones.  Folders that only earlier
        publications than the last ``keep`` name are deleted."""
        names = publications(self.folder)
        last = int(names[-1].split("-")[0]) if names else 0
        own = f"{last + 1:09d}-{self.id}.json"
        self.folder.write_whole(f"{PUBLISHED}/{own}", json.dumps({"run": self.id, "tables": self.tables}, sort_keys=True))
        names = publications(self.folder)
        told = {n: set(json.loads(self.folder.read(f"{PUBLISHED}/{n}"))["tables"].values()) for n in names}
        used = set().union(*(told[n] for n in names[-keep:]))
        for n in names[:-keep]:
            for path in told[n] - used:
                self.folder.delete(path.removeprefix(f"{self.folder.root}/"))
            self.folder.delete(f"{PUBLISHED}/{n}")


def publications(folder: Folder) -> list[str]:
    """The names of publications, the last one at the end."""
    return [n for n in folder.names(PUBLISHED) if n.endswith(".json") and n[0] not in "._"]


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """{table: folder} of the current run; empty if none was published."""
    folder = Folder(spark, root)
    names = publications(folder)
    return json.loads(folder.read(f"{PUBLISHED}/{names[-1]}"))["tables"] if names else {}
