"""Tables that grow by micro-batches, as a compacted log under a versioned manifest.

A batch writes one folder per table and then, by one rename, a manifest that names every folder of every
table. Readers take the newest manifest, so they see all tables as of one batch. Four folders of a size
are merged into one of the next, so a table of n batches has about 3 log4(n) folders and a row is
rewritten log4(n) times at most. A batch that was committed before is not written again. Folders that
the last two manifests do not name are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Fold = Callable[[DataFrame], DataFrame]

# Folders of one size that make one of the next.
FAN = 4
# Manifests kept: a reader may be as many versions behind, less one.
_KEPT = 2


@dataclass(frozen=True)
class Version:
    """What one manifest names: batch, and per table its schema and folders with their size class."""

    batch: int
    tables: dict[str, dict]

    def folders(self, table: str) -> list[str]:
        return [name for _, name in self.tables.get(table, {"parts": []})["parts"]]


class LiveLog:
    """One writer, any number of readers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where = self._path(folder)
        fs = self._files()
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def _versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names("manifest") if n.endswith(".json") and n[0].isdigit())

    def _load(self, batch: int) -> Version:
        stream = self._files().open(self._path("manifest", f"{batch}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(batch, json.loads(text))

    def newest(self) -> Version | None:
        known = self._versions()
        return self._load(known[-1]) if known else None

    def read(self, table: str, version: Version) -> DataFrame | None:
        folders = version.folders(table)
        if not folders:
            return None
        paths = [f"{self.root}/{table}/{name}" for name in folders]
        return self.spark.read.schema(version.tables[table]["schema"]).parquet(*paths)

    def has(self, batch: int) -> bool:
        known = self._versions()
        return bool(known) and known[-1] >= batch

    def put(self, df: DataFrame, table: str, batch: int) -> str:
        """Write rows of a batch to a folder that no reader sees before the batch is committed."""
        name = f"{batch}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{table}/{name}")
        return name

    def commit(self, batch: int, written: dict[str, tuple[str, str]], folds: dict[str, Fold]) -> None:
        """Publish a batch: table -> (folder, schema). folds say how rows of merged folders combine."""
        before = self.newest()
        tables = {} if before is None else {t: {**v, "parts": [list(p) for p in v["parts"]]} for t, v in before.tables.items()}
        for table, (folder, schema) in written.items():
            entry = tables.setdefault(table, {"schema": schema, "parts": []})
            entry["parts"].append([0, folder])
            self._merge(table, entry, batch, folds[table])
        fs, draft = self._files(), self._path("manifest", f".{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(tables).encode()))
        out.close()
        if not fs.rename(draft, self._path("manifest", f"{batch}.json")):
            raise RuntimeError(f"batch {batch} was committed by another writer")
        self._sweep()

    def _merge(self, table: str, entry: dict, batch: int, fold: Fold) -> None:
        parts = entry["parts"]
        while len(parts) >= FAN and len({level for level, _ in parts[-FAN:]}) == 1:
            level = parts[-1][0]
            paths = [f"{self.root}/{table}/{name}" for _, name in parts[-FAN:]]
            rows = fold(self.spark.read.schema(entry["schema"]).parquet(*paths))
            parts[-FAN:] = [[level + 1, self.put(rows, table, batch)]]

    def _sweep(self) -> None:
        known = self._versions()
        fs = self._files()
        for old in known[:-_KEPT]:
            fs.delete(self._path("manifest", f"{old}.json"), False)
        kept = [self._load(v) for v in known[-_KEPT:]]
        for table in kept[-1].tables:
            named = {name for version in kept for name in version.folders(table)}
            for name in self._names(table):
                if name not in named:
                    fs.delete(self._path(table, name), True)
