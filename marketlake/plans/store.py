"""Tables as versioned Parquet folders.

A change is a new version; a small manifest names the folders of the current one, by
partition where the table has a partition column, so that an upsert rewrites only
partitions the source touches. Nothing is read and overwritten in one plan.

Writers don't wait for each other. Each works out its change from the version that
it has read and may only publish the one after it: the manifest is written beside
the others under a name of its own and then renamed, which fails if another writer
has published that version meanwhile. The writer then looks at what came in between.
Where its partitions are untouched, its folders hold and it publishes them on top of
the new version; else it merges anew. So no committed row is lost and no half-written
version is ever seen. The rename must not replace what is there: local folders and
stores that keep to Hadoop's rules for renaming (HDFS, ABFS) do.

``vacuum`` removes folders that no kept version names.
"""

from __future__ import annotations

import os
import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.merge import merge_upsert

MANIFEST = T.StructType([T.StructField("version", T.LongType()), T.StructField("part", T.StringType()), T.StructField("path", T.StringType())])
#: Times that a writer starts anew after another one was faster.
ATTEMPTS = 10
NO_VALUE = "__none__"


class Conflict(RuntimeError):
    """Another writer has published the version that this one worked for."""


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # Files

    def _path(self, *names: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *names)))

    def _fs(self):
        path = self._path()
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _folders(self, *names: str) -> dict[str, int]:
        """Folders under a path and the times (ms) they were changed."""
        fs, path = self._fs(), self._path(*names)
        return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(path) if s.isDirectory()} if fs.exists(path) else {}

    def _rename(self, source: str, target: str) -> None:
        """Moves a folder; raises Conflict if the target is there. One step on local disks and on HDFS."""
        fs = self._fs()
        local = fs.resolvePath(self._path()).toUri()
        if local.getScheme() == "file":
            base = unquote(urlparse(local.toString()).path)
            try:
                os.rename(f"{base}/{source}", f"{base}/{target}")  # fails if the target is a folder with files
            except OSError as e:
                if os.path.isdir(f"{base}/{target}"):
                    raise Conflict(target) from e
                raise
            return
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path().toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._path(source), self._path(target), none)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(target) from e
            raise

    # Versions

    def version(self, name: str) -> int:
        """0: there is no such table."""
        return max((int(f[1:]) for f in self._folders(name, "_manifest") if re.fullmatch(r"v\d+", f)), default=0)

    def exists(self, name: str) -> bool:
        return self.version(name) > 0

    def _commit(self, name: str, base: int, parts: Mapping[str, str]) -> int:
        """Publishes the version after ``base``; raises Conflict if there is one."""
        made = self.spark.createDataFrame([(base + 1, p, path) for p, path in parts.items()], MANIFEST)
        own = f"{name}/_manifest/.{uuid.uuid4().hex}"
        made.coalesce(1).write.parquet(f"{self.root}/{own}")
        try:
            self._rename(own, f"{name}/_manifest/v{base + 1:09d}")
        except Conflict:
            self._fs().delete(self._path(own), True)
            raise
        return base + 1

    def _parts(self, name: str, version: int | None = None) -> dict[str, str]:
        v = self.version(name) if version is None else version
        return {r["part"]: r["path"] for r in self.spark.read.schema(MANIFEST).parquet(f"{self.root}/{name}/_manifest/v{v:09d}").collect()} if v else {}

    def _rows(self, paths: Sequence[str], schema: T.StructType | None) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(*paths)

    def read(self, name: str, schema: T.StructType | None = None, parts: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """The current rows, or those of named partitions; an empty table of ``schema`` if there is none."""
        return self._rows([p for k, p in sorted(self._parts(name, version).items()) if parts is None or k in parts], schema)

    # Changes

    def _write(self, name: str, df: DataFrame, partition: str | None, sort: Sequence[str]) -> dict[str, str]:
        base = f"{self.root}/{name}/{uuid.uuid4().hex}"
        if partition is None:
            (df.sortWithinPartitions(*sort) if sort else df).write.parquet(base)
            return {"": base}
        out = df.withColumn("_part", _part(partition))
        out = out.hint("rebalance", "_part") if not sort else out.repartitionByRange("_part", *sort).sortWithinPartitions("_part", *sort)
        out.write.partitionBy("_part").parquet(base)
        folders = self._folders(name, base.rsplit("/", 1)[1])  # odd characters of a value are escaped in its folder's name
        return {unquote(f.removeprefix("_part=")): f"{base}/{f}" for f in folders if f.startswith("_part=")}

    def _publish(self, name: str, base: int, kept: Mapping[str, str], drop: set[str], new: Mapping[str, str], read: Mapping[str, str] | None) -> int:
        """Puts the new folders in the place of those dropped, on top of the newest version.

        read: the folders that the new ones were made from; Conflict if any of them has been replaced since, or another has joined them. None: made from no rows.
        """
        for _ in range(ATTEMPTS):
            try:
                return self._commit(name, base, {k: p for k, p in kept.items() if k not in drop} | dict(new))
            except Conflict:
                base = self.version(name)
                kept = self._parts(name, base)
                if read is not None and {k: p for k, p in kept.items() if k in drop} != dict(read):
                    raise
        raise Conflict(f"{name}: {ATTEMPTS} versions came in between")

    def overwrite(self, name: str, df: DataFrame, partition: str | None = None, sort: Sequence[str] = ()) -> int:
        """A new version with exactly these rows, whatever was there; with ``partition`` a folder for each of its values, rows sorted inside."""
        new = self._write(name, df, partition, sort)
        for _ in range(ATTEMPTS):
            try:
                return self._commit(name, self.version(name), new)
            except Conflict:
                pass
        raise Conflict(f"{name}: {ATTEMPTS} versions came in between")

    def append(self, name: str, df: DataFrame) -> int:
        """Rows in a folder of their own; others' commits can't be in its way."""
        new = self._write(name, df, None, ())
        base = self.version(name)
        return self._publish(name, base, self._parts(name, base), set(), {uuid.uuid4().hex: new[""]}, None)

    def upsert(self, name: str, source: DataFrame, keys: Sequence[str], partition: str | None = None, sort: Sequence[str] = ()) -> int:
        """Rewrites the partitions that the source touches; others keep their folders. The partition column is part of the key."""
        touched = None if partition is None else [r[0] for r in source.select(_part(partition)).distinct().collect()]
        return self.update(name, lambda old: merge_upsert(old, source, keys), source.schema, partition, touched, sort)

    def update(self, name: str, change: Callable[[DataFrame], DataFrame], schema: T.StructType | None = None, partition: str | None = None, parts: Sequence[str] | None = None, sort: Sequence[str] = ()) -> int:
        """The table, or its named partitions, replaced by what ``change`` makes of its rows.

        ``change`` is called again, on newer rows, when another writer has replaced any of
        them meanwhile. With ``parts`` it must return rows of these partitions alone.
        """
        for _ in range(ATTEMPTS):
            base = self.version(name)
            kept = self._parts(name, base)
            read = {k: p for k, p in kept.items() if parts is None or k in parts}
            new = self._write(name, change(self._rows(sorted(read.values()), schema)), partition, sort)
            drop = set(kept) if parts is None else set(parts)
            try:
                # A change of the whole table is void as soon as any other version is there.
                return self._commit(name, base, new) if parts is None else self._publish(name, base, kept, drop, new, read)
            except Conflict:
                self._forget(name, new)
        raise Conflict(f"{name}: {ATTEMPTS} versions came in between")

    def _forget(self, name: str, new: Mapping[str, str]) -> None:
        for top in {p.removeprefix(f"{self.root}/{name}/").split("/")[0] for p in new.values()}:
            self._fs().delete(self._path(name, top), True)

    def vacuum(self, name: str, keep: int = 2, seconds: float = 7 * 86400) -> list[str]:
        """Removes versions but the last ``keep``, and folders of rows that none of these names; returns the folders.

        What has changed within ``seconds`` stays, as it may belong to a version that is just being written or read.
        """
        before, fs = (time.time() - seconds) * 1000, self._fs()
        manifests = self._folders(name, "_manifest")
        versions = sorted(int(f[1:]) for f in manifests if re.fullmatch(r"v\d+", f))
        live = {p for v in versions[-keep:] for p in self._parts(name, v).values()}
        old = {f"v{v:09d}" for v in versions[:-keep]}
        for f, changed in manifests.items():
            if changed <= before and (f in old or f.startswith(".")):
                fs.delete(self._path(name, "_manifest", f), True)
        gone = []
        for top, changed in self._folders(name).items():
            if top.startswith("_") or changed > before or f"{self.root}/{name}/{top}" in live:
                continue
            inside = [f for f in self._folders(name, top) if f.startswith("_part=")]
            dead = [f for f in inside if f"{self.root}/{name}/{top}/{f}" not in live]
            for f in [""] if len(dead) == len(inside) else dead:
                path = f"{top}/{f}".rstrip("/")
                fs.delete(self._path(name, path), True)
                gone.append(path)
        return gone


def _part(partition: str) -> Column:
    return F.coalesce(F.nullif(F.col(partition).cast("string"), F.lit("")), F.lit(NO_VALUE)).alias("_part")
