"""Whole file changes of a table: files that join it, files that leave it.

Parquet tables have no transactions, and a load that only adds files (append) or
replaces the files of some partitions would otherwise stop half-way without a
trace.  Here the new files are first written to a hidden folder of the table,
``_wl_txn_<batch>`` (readers skip names that begin with ``_``).  One small commit
file, put in place by a rename, decides: without it nothing has happened; with
it the change *will* happen, finished by ``finish`` in this run or by the next
job that opens the table (``catalog.exists`` and ``recover`` call it).  Finishing moves
the new files in, removes the files that the commit names, registers new
partitions, notes the batch in the table's properties and deletes the folder.
Every step can be repeated.  Files of other writers are never touched, as the
commit names what leaves one by one.

File system calls go through the session's own Hadoop API, so any scheme
works.  A rename is one metadata call per file; on a store without renames it copies.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

PREFIX, COMMIT = "_wl_txn_", "_wl_commit"


class ChangedMeanwhile(RuntimeError):
    """Another writer changed the table between the reading and the commit of a load."""


class Files:
    """The few file system calls of a transaction."""

    def __init__(self, spark: SparkSession, location: str):
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.root = self.path(location)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._jvm = jvm

    def at(self, *parts: str):
        out = self.root
        for p in parts:
            out = self.path(out, p)
        return out

    def exists(self, *parts: str) -> bool:
        return self.fs.exists(self.at(*parts))

    def children(self, *parts: str) -> list[tuple[str, bool]]:
        """(name, is a folder) below a folder; none where it does not exist."""
        at = self.at(*parts)
        if not self.fs.exists(at):
            return []
        return [(s.getPath().getName(), s.isDirectory()) for s in self.fs.listStatus(at)]

    def data_files(self, *parts: str) -> list[str]:
        """Paths below a folder of the files that readers see."""
        out = []
        for name, folder in self.children(*parts):
            if name.startswith(("_", ".")) and "=" not in name:
                continue
            out += [f"{name}/{x}" for x in self.data_files(*parts, name)] if folder else [name]
        return out

    def read(self, *parts: str) -> str:
        stream = self.fs.open(self.at(*parts))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def write(self, text: str, *parts: str) -> None:
        stream = self.fs.create(self.at(*parts), True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()

    def move(self, source: list[str], target: list[str]) -> None:
        """Rename; a file that is already there has been moved before."""
        a, b = self.at(*source), self.at(*target)
        self.fs.mkdirs(b.getParent())
        if not self.fs.rename(a, b) and not self.fs.exists(b):
            raise OSError(f"cannot move {a.toString()} to {b.toString()}")

    def delete(self, *parts: str) -> None:
        self.fs.delete(self.at(*parts), True)


def prepare(df: DataFrame, location: str, batch: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write the new files of a batch beside the table; an unfinished try of the batch is written anew."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{location.rstrip('/')}/{PREFIX}{batch}")


def commit(spark: SparkSession, location: str, batch: str, properties: dict[str, str], removed: list[str] = ()) -> None:
    """Decide a prepared change: ``removed`` files (paths below the table) leave, ``properties`` are set with it."""
    files = Files(spark, location)
    gone = [f for f in removed if not files.exists(*f.split("/"))]
    if gone:
        files.delete(f"{PREFIX}{batch}")
        raise ChangedMeanwhile(f"{len(gone)} file(s) of {location} were replaced by another writer, {gone[0]} among them")
    files.write(json.dumps({"properties": properties, "removed": list(removed)}), f"{PREFIX}{batch}", f"{COMMIT}.tmp")
    files.move([f"{PREFIX}{batch}", f"{COMMIT}.tmp"], [f"{PREFIX}{batch}", COMMIT])


def undecided(spark: SparkSession, location: str) -> list[str]:
    """Folders with a commit that is not finished."""
    files = Files(spark, location)
    return [n for n, folder in files.children() if folder and n.startswith(PREFIX) and files.exists(n, COMMIT)]


def apply(spark: SparkSession, location: str, folder: str) -> tuple[dict[str, str], list[str]]:
    """Carry out a committed change; returns its properties and the partition paths of its new files."""
    files = Files(spark, location)
    decided = json.loads(files.read(folder, COMMIT))
    parts = json.loads(files.read(folder, f"{COMMIT}.parts")) if files.exists(folder, f"{COMMIT}.parts") else None
    new = files.data_files(folder)
    if parts is None:  # noted before the first file moves, so that a later run knows them all
        parts = sorted({f.rpartition("/")[0] for f in new if "/" in f})
        files.write(json.dumps(parts), folder, f"{COMMIT}.parts.tmp")
        files.move([folder, f"{COMMIT}.parts.tmp"], [folder, f"{COMMIT}.parts"])
    for f in new:
        files.move([folder, *f.split("/")], f.split("/"))
    for f in decided["removed"]:
        files.delete(*f.split("/"))
    return decided["properties"], parts


def close(spark: SparkSession, location: str, folder: str) -> None:
    Files(spark, location).delete(folder)
