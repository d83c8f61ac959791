"""A sink's manifest: which of its folders are live, replaced as a whole.

A sink writes new folders beside the old ones and then commits a small JSON document that
names the live ones; readers look there and never list data files.  Documents are numbered
(a stream takes its batch id), written under a temporary name and renamed, so a reader sees
the old state or the new one.  The last ``keep`` documents stay, for readers that have just
opened the one before and for a batch that runs again; folders that no kept document names
are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import SparkSession


class Folder:
    """The few file system calls a sink needs, on whatever store the path names."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.base = base.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, name: str = "") -> list[str]:
        if not self._fs.exists(self._path(name)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(name)))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears whole; one that is there already is replaced."""
        parent, _, last = name.rpartition("/")
        draft = f"{parent}/.{last}.draft"
        stream = self._fs.create(self._path(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.delete(name)
        if not self._fs.rename(self._path(draft), self._path(name)):
            raise OSError(f"{name} could not be put in place under {self.base}")

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be renamed to {new} under {self.base}")

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._path(name), True)


class Manifest:
    """The documents under ``<base>/_manifest``; ``folders`` of each lists what it needs."""

    def __init__(self, spark: SparkSession, base: str, keep: int = 2) -> None:
        self.folder = Folder(spark, base)
        self.keep = max(1, keep)

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.folder.names("_manifest") if n.endswith(".json") and n[:-5].isdigit())

    def latest(self, before: int | None = None) -> dict | None:
        """The live document, or the last one numbered below ``before``; None if there is none."""
        found = [v for v in self.versions() if before is None or v < before]
        return json.loads(self.folder.read(f"_manifest/{found[-1]:012d}.json")) if found else None

    def commit(self, version: int, folders: Iterable[str], **content) -> None:
        """Make ``content`` live under ``version``, then delete what only older documents name."""
        self.folder.write(f"_manifest/{version:012d}.json", json.dumps({"folders": sorted(folders), **content}))
        versions = [v for v in self.versions() if v <= version]
        kept, old = versions[-self.keep:], versions[: -self.keep]
        needed = {f for v in kept for f in json.loads(self.folder.read(f"_manifest/{v:012d}.json"))["folders"]}
        for v in old:
            for name in json.loads(self.folder.read(f"_manifest/{v:012d}.json"))["folders"]:
                if name not in needed:
                    self.folder.delete(name)
            self.folder.delete(f"_manifest/{v:012d}.json")
