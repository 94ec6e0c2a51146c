"""Build markers and plans as a data source: folders are listed inside tasks, and a stream brings each marker once.

Register MarkerSource and read format "build_markers" with the option path, a
folder that all executors reach by one path, and name ("_SUCCESS" unless given).
Spark asks for spark.sql.python.filterPushdown.enabled to be true, as filters are
pushed down.
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

_MOLECULE = re.compile(r"molecule_id=([^/]+)")
SCHEMA = "path string, molecule_id string, status string, record string, broken boolean, named_at double"
#: Seconds that a stream stays behind, so that no marker is named before its end and seen after it.
BEHIND = 2.0


class _Folder(InputPartition):
    def __init__(self, path: str, deep: bool, since: float | None = None, until: float | None = None):
        self.path, self.deep, self.since, self.until = path, deep, since, until


def _markers(folder: _Folder, name: str) -> Iterator[tuple]:
    """Rows of the markers in a folder, and below it if deep; named_at is when a file got its name."""
    todo = [folder.path]
    while todo:
        at = todo.pop()
        try:
            entries = sorted(os.scandir(at), key=lambda e: e.name)
        except FileNotFoundError:
            continue
        for entry in entries:
            if entry.is_dir(follow_symlinks=False):
                if folder.deep:
                    todo.append(entry.path)
            elif entry.name == name:
                named = entry.stat().st_ctime
                if (folder.since is None or named > folder.since) and (folder.until is None or named <= folder.until):
                    yield _row(entry.path, named)


def _row(path: str, named: float) -> tuple:
    with open(path, encoding="utf-8", errors="replace") as file:
        text = file.read()
    try:
        record = json.loads(text)
    except (ValueError, RecursionError):
        record = None
    own = record if isinstance(record, dict) else {}
    found = _MOLECULE.search(path)
    molecule, status = own.get("molecule_id", found and found[1]), own.get("status")
    return path, None if molecule is None else str(molecule), None if status is None else str(status), text, not own, named


def _folders(root: str, only: set[str] | None, since: float | None = None, until: float | None = None) -> list[_Folder]:
    """The root itself, not deep, and each folder in it, deep; of molecules' folders only those asked for."""
    try:
        below = sorted(e.path for e in os.scandir(root) if e.is_dir(follow_symlinks=False))
    except FileNotFoundError:
        below = []
    keep = lambda p: only is None or not (m := _MOLECULE.fullmatch(os.path.basename(p))) or m[1] in only
    return [_Folder(root, False, since, until), *(_Folder(p, True, since, until) for p in below if keep(p))]


class _Reader(DataSourceReader):
    def __init__(self, root: str, name: str):
        self.root, self.name, self.only = root, name, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Folders of other molecules are not opened; Spark still filters, as a marker may name another molecule."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("molecule_id",):
                asked = {str(v) for v in (f.value if isinstance(f, In) else [f.value])}
                self.only = asked if self.only is None else self.only & asked
            yield f

    def partitions(self) -> list[_Folder]:
        return _folders(self.root, self.only)

    def read(self, partition: _Folder) -> Iterator[tuple]:
        yield from _markers(partition, self.name)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, root: str, name: str):
        self.root, self.name = root, name

    def initialOffset(self) -> dict:
        return {"until": 0.0}

    def latestOffset(self) -> dict:
        return {"until": time.time() - BEHIND}

    def partitions(self, start: dict, end: dict) -> list[_Folder]:
        return _folders(self.root, None, start["until"], end["until"])

    def read(self, partition: _Folder) -> Iterator[tuple]:
        yield from _markers(partition, self.name)


class MarkerSource(DataSource):
    """Files of one name below a folder, a row each: (path, molecule_id, status, record, broken, named_at).

    record is the file's text, molecule_id the one it names or else its path's,
    broken whether it is no JSON object. Each folder in the root is listed by a task
    of its own. A stream's offsets are times: a marker belongs to the batch in
    whose span it got its name, and a batch that runs again reads the same span.
    """

    @classmethod
    def name(cls) -> str:
        return "build_markers"

    def schema(self) -> str:
        return SCHEMA

    def _where(self) -> tuple[str, str]:
        root = self.options["path"]
        return root.removeprefix("file://").removeprefix("file:"), self.options.get("name", "_SUCCESS")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(*self._where())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(*self._where())
