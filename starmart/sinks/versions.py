"""Tables that are replaced together.

Below a root, every write goes to a folder of its own, and a numbered manifest lists the folders that make up each
table. One small file switches readers from a version to the next: a reader has all tables of one version, old folders
stay until ``expire``, and a partition that did not change is listed again instead of being written again. Nothing is
moved or overwritten, so stores without a rename of folders serve as well.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MANIFESTS = "_versions"
WHOLE = ""


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._jvm, self._path = jvm, jvm.org.apache.hadoop.fs.Path
        self._store = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._store.listStatus(path)) if self._store.exists(path) else []

    def version(self) -> int:
        """The number of the newest version; 0 before the first."""
        return max((int(n[:-5]) for n in self._names(MANIFESTS) if re.fullmatch(r"\d+\.json", n)), default=0)

    def manifest(self, version: int | None = None) -> dict[str, dict[str, str]]:
        """Table -> partition -> folder below the root. Tables without partitions have one, named ''."""
        version = self.version() if version is None else version
        if not version:
            return {}
        stream = self._store.open(self._path(f"{self.root}/{MANIFESTS}/{version:08d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, name: str, schema, version: int | None = None, parts: list[str] | None = None) -> DataFrame:
        """A table of one version, or the named partitions of it; no other folder is listed or read."""
        folders = self.manifest(version)[name]
        chosen = sorted(folder for part, folder in folders.items() if parts is None or part in parts)
        if not chosen:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{folder}" for folder in chosen])

    def write(self, name: str, frame: DataFrame, part: Column | None = None) -> dict[str, str]:
        """Write the rows to a new folder, by ``part`` if given; the entry for ``commit``."""
        folder = f"{name}/{uuid.uuid4().hex}"
        if part is None:
            frame.write.parquet(f"{self.root}/{folder}")
            return {WHOLE: folder}
        (frame.withColumn("part", F.coalesce(part, F.lit("none"))).repartition("part", "business_id")
         .sortWithinPartitions("part", "business_id").write.partitionBy("part").parquet(f"{self.root}/{folder}"))
        return {n.removeprefix("part="): f"{folder}/{n}" for n in self._names(folder) if n.startswith("part=")}

    def discard(self, entry: dict[str, str]) -> None:
        """Delete folders that no version lists."""
        for folder in entry.values():
            self._store.delete(self._path(f"{self.root}/{folder}"), True)

    def commit(self, tables: dict[str, dict[str, str]], base: int) -> int:
        """Publish the next version: the tables of ``base`` with these in place of theirs.

        Of two writers that started from the same version only one can claim the next; the other one fails.
        """
        version = base + 1
        claim = self._path(f"{self.root}/{MANIFESTS}/{version:08d}.claim")
        if self.version() != base or not self._store.createNewFile(claim):
            raise RuntimeError(f"version {version} of {self.root} was written or claimed by someone else")
        temporary = self._path(f"{self.root}/{MANIFESTS}/{version:08d}.{uuid.uuid4().hex}.tmp")
        stream = self._store.create(temporary)
        stream.write(bytearray(json.dumps({**self.manifest(base), **tables}, sort_keys=True).encode()))
        stream.close()
        if not self._store.rename(temporary, self._path(f"{self.root}/{MANIFESTS}/{version:08d}.json")):
            raise OSError(f"version {version} of {self.root} could not be published")
        return version

    def expire(self, keep: int = 2) -> list[str]:
        """Drop all but the last ``keep`` versions and the folders that only those listed; the folders dropped."""
        numbers = [int(n[:-5]) for n in self._names(MANIFESTS) if re.fullmatch(r"\d+\.json", n)]
        folders = {n: {f for parts in self.manifest(n).values() for f in parts.values()} for n in numbers}
        old = numbers[:-keep] if keep else numbers
        kept = set().union(*[folders[n] for n in numbers if n not in old])
        gone = sorted(set().union(*[folders[n] for n in old]) - kept)
        for number in old:
            for kind in ("json", "claim"):
                self._store.delete(self._path(f"{self.root}/{MANIFESTS}/{number:08d}.{kind}"), False)
        for folder in gone:
            self._store.delete(self._path(f"{self.root}/{folder}"), True)
        return gone


def is_versioned(spark: SparkSession, root: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{MANIFESTS}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
