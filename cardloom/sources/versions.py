"""Stored tables that change whole: a version replaces some parts and keeps the others.

A table is cut into parts by a hash of its key. A version writes the parts it
changes into a folder of its own, then a manifest that names, for every part, the
folder that holds it. Readers take the newest manifest, so they see the table
before a version or after it, never between; a job that dies leaves no manifest. A
version written again replaces its own folder. Version names sort by time.

A manifest has the schema and at most as many entries as there are parts, and is
the only thing that the driver reads.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "part_of_table"


class Versions:
    """``schema`` may be left out where a version was written before."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None, keys: tuple[str, ...] = (), parts: int = 1):
        self.spark, self.root, self.schema, self.keys, self.parts = spark, root.rstrip("/"), schema, keys, parts
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def part(self) -> Column:
        """The part of a row, by its keys."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int") if self.keys else F.lit(0)

    def touched(self, rows: DataFrame) -> list[int]:
        """Parts that the rows fall into; at most ``parts`` numbers."""
        return sorted(r[0] for r in rows.select(self.part().alias("p")).distinct().collect())

    def versions(self) -> list[str]:
        folder = self._path(f"{self.root}/manifests")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(n.removesuffix(".json") for n in names if n.endswith(".json"))

    def _manifest(self, before: str | None) -> dict:
        names = [v for v in self.versions() if before is None or v < before]
        if not names:
            return {"parts": {}, "schema": None}
        stream = self._files.open(self._path(f"{self.root}/manifests/{names[-1]}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def manifest(self, before: str | None = None) -> dict[int, str]:
        """Folder of each part in the newest version, or the newest before one; parts without rows are left out."""
        return {int(p): v for p, v in self._manifest(before)["parts"].items()}

    def read(self, before: str | None = None, parts: list[int] | None = None) -> DataFrame:
        """The rows of the newest version, or the newest before one, of all parts or some."""
        found = self._manifest(before)
        schema = self.schema or T.StructType.fromJson(found["schema"])
        paths = [f"{self.root}/data/{v}/{PART}={p}" for p, v in sorted(found["parts"].items()) if parts is None or int(p) in parts]
        # a version may have no rows at all
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def write(self, rows: DataFrame, version: str, parts: list[int] | None = None) -> None:
        """A version in which ``rows`` are all rows of ``parts`` (default: of the table)."""
        folder = f"{self.root}/data/{version}"
        schema = self.schema or rows.schema
        placed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields]).withColumn(PART, self.part())
        # a large part is split into several files again
        writer = placed.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(PART).parquet(folder)
        names = [s.getPath().getName() for s in self._files.listStatus(self._path(folder))]
        written = {int(n.split("=")[1]) for n in names if n.startswith(f"{PART}=")}
        kept = {} if parts is None else {p: v for p, v in self.manifest(before=version).items() if p not in parts}
        self._publish(version, schema, kept | dict.fromkeys(written, version))

    def _publish(self, version: str, schema: T.StructType, held: dict[int, str]) -> None:
        """The manifest is written beside and renamed: it is there whole or not at all."""
        target, draft = self._path(f"{self.root}/manifests/{version}.json"), self._path(f"{self.root}/manifests/.{version}.draft")
        out = self._files.create(draft, True)
        out.write(bytearray(json.dumps({"parts": {str(p): v for p, v in sorted(held.items())}, "schema": schema.jsonValue()}).encode()))
        out.close()
        if self._files.exists(target):
            self._files.delete(target, False)
        if not self._files.rename(draft, target):
            raise OSError(f"manifest {version} of {self.root} was not renamed")

    def clean(self, keep: int = 2) -> list[str]:
        """Deletes manifests but the newest ``keep``, and the folders that none of those names; returns the folders' versions."""
        names = self.versions()
        for name in names[:-keep]:
            self._files.delete(self._path(f"{self.root}/manifests/{name}.json"), False)
        used = {v for name in names[-keep:] for v in self.manifest(before=f"{name}\0").values()}
        stored = {s.getPath().getName() for s in self._files.listStatus(self._path(f"{self.root}/data"))}
        # a folder newer than all manifests may be one that is being written
        gone = sorted(v for v in stored - used if names and v <= names[-1])
        for version in gone:
            self._files.delete(self._path(f"{self.root}/data/{version}"), True)
        return gone
